"""

Every query reads whole driver tables through the stand-in views. Where a full
result would repeat a row per asset and day, the registered query totals the
operator's whole output per day instead.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T  # noqa: E402

from cohortline.functions import numbers, text  # noqa: E402
from cohortline.operators import (  # noqa: E402
    asof,
    attribution as at,
    billing,
    calendar,
    cohorts,
    crm,
    events as ev,
    identity as ids,
    lifecycle,
    lifetimes,
    milestones,
    querylog as ql,
    registrations as reg,
    retention as ret,
    usage,
    user360,
)
from cohortline.plans import logs, usage as usage_plans, users as user_plans  # noqa: E402
from cohortline.sources import commits, stand_in as s, tables  # noqa: E402
from cohortline.sources.stand_in import StandIn  # noqa: E402
from cohortline.streaming.rollup import minute_rollup  # noqa: E402

try:
    import cohortline.llm.queries as corpus
    import cohortline.llm.oracle as corpus_sql
    import corpus_pipeline
except ModuleNotFoundError as missing:
    if missing.name not in ("cohortline.llm", "cohortline.llm.queries", "corpus_pipeline"):
        raise
    corpus = None

WINDOW = ("2024-01-05", "2024-01-25")


def settle(frame: DataFrame) -> DataFrame:
    """Plain comparable types: long for counts, double for decimals, timestamps without zone."""
    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(f.name)

    return frame.select(*[plain(f) for f in frame.schema.fields])


def _daily(v: StandIn) -> DataFrame:
    return ev.daily_interactions(v.event_log(), ev.interaction_spec())


def _registrations(v: StandIn) -> DataFrame:
    return reg.registrations_by_day(v.registrants(), v.registrant_assets(), s.INTERNAL_DOMAINS)


def _visits(v: StandIn, build: Callable) -> DataFrame:
    views = v.page_views().where(F.col("project_id") == s.TENANT)
    return build(views, at.first_touch_by_device(user_plans.touches(v)), s.LANDING_PATHS, s.EVENT_START, s.EVENT_AS_OF, s.OWN)


def _log(v: StandIn) -> DataFrame:
    return ql.structured_log(ql.extract_logs(v.query_logs()), s.CLIENTS)


def _day_counts(v: StandIn, kind: str, keys: list[str], name: str) -> DataFrame:
    table = v.raw_events().where(F.lower("raw_event_type") == kind)
    return ev.daily_event_counts(table, keys, *WINDOW, name)


def _timeline(v: StandIn) -> DataFrame:
    made = [_day_counts(v, kind, ["distinct_id"], "n") for kind in ("create_db", "create_from_snapshot")]
    return ev.activation_timeline(
        _day_counts(v, "login", ["distinct_id", "email"], "n"),
        _day_counts(v, "open_db", ["event_label", "distinct_id"], "n"),
        made,
    )


def _url_ids(v: StandIn) -> DataFrame:
    url = F.col("current_url")
    kind = F.when(url.endswith("/created"), 0).when(url.endswith("/detail"), 1).otherwise(2)
    return v.raw_events().groupBy(
        kind.alias("url_kind"),
        text.asset_id_from_url(url, "created").alias("created_id"),
        text.asset_id_from_url(url, "detail").alias("detail_id"),
    ).agg(F.count("*").alias("n"))


def _first_channels(v: StandIn) -> DataFrame:
    plain = at.OwnSites(s.OWN.domains, s.OWN.referrer_domains, s.OWN.mail_host, None)
    touches = v.page_views().groupBy(*at.TOUCH).agg(F.count("*").alias("n"))
    return touches.select(
        "*", at.first_touch_channel(s.OWN).alias("channel_with_oauth"),
        at.first_touch_channel(plain).alias("channel_without_oauth"),
    )


def _last_channels(v: StandIn) -> DataFrame:
    seen = v.page_views().groupBy("referrer").agg(F.count("*").alias("n"))
    return seen.select("referrer", at.last_touch_channel(F.col("referrer"), s.OWN).alias("channel"), "n")


def _live_digest(v: StandIn) -> DataFrame:
    live = lifetimes.daily_live_assets(v.assets(), s.ASSET_START, s.ASSET_AS_OF)
    return live.groupBy("calendar_dt").agg(
        F.count("*").alias("assets"), F.sum("dbid").alias("dbid_sum"), F.sum("userkey").alias("userkey_sum"),
        F.count("db_destroyed_at").alias("ending"), F.sum("initial_size_gb").alias("gb"),
    )


def _usage_digest(v: StandIn) -> DataFrame:
    return _digest_days(usage.daily_usage(v.assets(), v.size_history(), s.ASSET_AS_OF))


def _written_usage(v: StandIn) -> DataFrame:
    """A load, two daily runs, one of them twice, and a run of the remaining days."""
    out = f"{tables.shared_folder(v.spark)}/usage_{uuid.uuid4().hex}"
    # The stand-in knows ends of assets beyond ASSET_AS_OF, so the last run takes them in.
    days = (None, "1997-03-01", "1997-03-02", "1997-03-03", "2003-12-31")
    for after, through in [*zip(days, days[1:]), days[1:3]]:
        usage_plans.run_days(v.assets(), v.size_history(), out, through, after)
    return _digest_days(usage_plans.table(v.spark, out, s.ASSET_AS_OF))


def _digest_days(days: DataFrame) -> DataFrame:
    sums = ("total_db", "qualified_db", "qualified_gb", "qualified_db_deleted", "qualified_db_new")
    return days.groupBy("as_of_date", "db_billing_identity", "user_classification").agg(
        F.count("*").alias("users"), *[F.sum(c).alias(c) for c in sums], F.count("qualified_db").alias("users_qualified"),
        F.sum("userkey").alias("userkeys"), F.sum(F.col("userkey") * F.col("total_db")).alias("userkey_dbs"),
        F.sum(F.col("userkey") * F.length("account_id")).alias("userkey_accounts"),
    )


def _querying_digest(v: StandIn) -> DataFrame:
    queries = cohorts.daily_queries(v.assets(), v.asset_minutes())
    active = cohorts.active_and_querying(v.assets(), queries, s.ASSET_START, s.ASSET_AS_OF)
    # Cut, not matched: this runs once per owner-day.
    key = F.substring_index(F.substr("email", F.lit(2)), "@", 1).cast("long")
    return active.groupBy("calendar_dt").agg(
        F.count("*").alias("emails"), F.sum("active_user_yn").alias("active_users"), F.sum(key).alias("keys"),
        F.sum(key * F.col("active_user_yn")).alias("active_keys"),
    )


def _moments(v: StandIn) -> DataFrame:
    born = v.assets().select("dbid", F.col("db_created_at").alias("at"))
    return born.unionByName(born.select("dbid", (F.col("at") + F.expr("INTERVAL 30 DAYS")).alias("at")))


def _edges(v: StandIn) -> DataFrame:
    return lifetimes.size_as_of(_moments(v), v.size_history(), "at", closed=False)


def _history(v: StandIn) -> DataFrame:
    return ret.cumulative_history(ret.create_destroy_log(v.assets(), s.ASSET_START, s.ASSET_AS_OF))


def _months(v: StandIn) -> DataFrame:
    return ret.active_months(_history(v))


def _older_history(v: StandIn) -> DataFrame:
    log = ret.active_users(v.assets(), s.ASSET_START, s.ASSET_AS_OF)
    return ret.older_history(log).withColumnsRenamed(
        {"total_db_created_till_dt": "made", "total_db_destroyed_till_dt": "gone"}
    )


def _milestone(v: StandIn, name: str) -> DataFrame:
    return user_plans.milestone_parts(v.assets(), v.asset_minutes(), v.agent_facts(), v.dump_uploads(),
                                      s.TOOL_AGENTS, s.NON_PROGRAMMATIC_AGENTS)[name]


def _written_user_360(v: StandIn) -> DataFrame:
    run = f"user_360_{uuid.uuid4().hex}"
    out = f"{tables.shared_folder(v.spark)}/{run}"
    return user_plans.write_user_360(v.user_tables(), v.user_rules(), out, run, buckets=8)


def _gaps(v: StandIn) -> DataFrame:
    summary = billing.user_asset_summary(v.assets(), s.ASSET_AS_OF).select("userkey", "start_date")
    asked = _milestone(v, "first_query").select("userkey", "first_query")
    rows = v.users().select("userkey", "createdat").join(summary, "userkey", "left").join(asked, "userkey", "left")
    return milestones.time_to_milestone(rows, "createdat", "start_date", {"first_query": "first_query"})


def _tier_labels(v: StandIn) -> DataFrame:
    summary = billing.user_asset_summary(v.assets(), s.ASSET_AS_OF)
    return summary.select("userkey", "channels", user360.tier_label(F.col("channels")).alias("tier"))


def _accounts(v: StandIn) -> DataFrame:
    return v.assets().groupBy(lifetimes.account_id().alias("account_id"), "user_classification").agg(
        F.count("*").alias("assets")
    )


def _prices(v: StandIn) -> DataFrame:
    return v.assets().select("dbid", numbers.monthly_price(F.col("most_recent_size_gb") * 1.37).alias("mrr"))


def _sources(v: StandIn) -> DataFrame:
    return ql.extract_logs(v.query_logs()).groupBy(*ql.SOURCE_PARTS).agg(F.count("*").alias("n"))


def _drivers(v: StandIn) -> DataFrame:
    seen = ql.extract_logs(v.query_logs()).groupBy("driver_info", "bolt_session").agg(F.count("*").alias("n"))
    name, version = ql.parse_driver(F.col("driver_info"), F.col("bolt_session"), s.CLIENTS)
    return seen.select("driver_info", "bolt_session", name.alias("driver_name"), version.alias("driver_version"), "n").groupBy(
        "driver_info", "bolt_session", "driver_name", "driver_version"
    ).agg(F.sum("n").alias("n"))


def _annotations(v: StandIn) -> DataFrame:
    seen = ql.extract_logs(v.query_logs()).groupBy("annotationdata").agg(F.count("*").alias("n"))
    return seen.select("annotationdata", *ql.parse_annotation(F.col("annotationdata")), "n")


def _submissions(v: StandIn) -> DataFrame:
    return _log(v).groupBy("driver_name", "annotationdata", "query_submission_type", "query_submission_app").agg(
        F.count("*").alias("n")
    )


def _one_day(v: StandIn) -> DataFrame:
    day = ql.structured_log(ql.extract_logs(v.query_logs(), "2024-01-15"), s.CLIENTS)
    return day.groupBy("dbid", "event").agg(F.count("*").alias("n"), F.sum(F.length("query")).alias("chars"))


def _committed(v: StandIn) -> DataFrame:
    """The minute statistics of two days, each run as one commit, the first twice."""
    out = f"{tables.shared_folder(v.spark)}/logs_{uuid.uuid4().hex}"
    for day in ("2024-01-14", "2024-01-15", "2024-01-14"):
        logs.commit_day(v.query_logs(), day, out, s.CLIENTS)
    return commits.read(v.spark, out, "minute_stats").drop(tables.DAY)


def _retention_input(v: StandIn, build: Callable, **options) -> DataFrame:
    return build(v.assets(), s.ASSET_START, s.ASSET_AS_OF, **options)


BUILD: dict[str, Callable[[StandIn], DataFrame]] = {
    "conform_events": lambda v: ev.conform_events(v.event_tables(), s.TENANT),
    "asset_id_from_url": _url_ids,
    "identity_map": lambda v: ids.identity_map(v.event_log()),
    "identity_factors": lambda v: ids.identity_factors(v.event_log()),
    "identity_expanded": lambda v: ids.expand(ids.identity_factors(v.event_log())),
    "identity_emails": lambda v: ids.email_pairs(v.event_log()),
    "daily_interactions": _daily,
    "funnel_flags": lambda v: ev.funnel_flags(_daily(v)),
    "funnel_report": lambda v: ev.funnel_report(
        ev.funnel_flags(_daily(v)), ev.excluded_ids(ids.seen_pairs(v.event_log(), "email_address"), s.INTERNAL_DOMAINS)
    ),
    "event_pivot": lambda v: ev.event_pivot(v.nested_events(), ev.pivot_spec()),
    "event_pivot_totals": lambda v: ev.pivot_totals(ev.event_pivot(v.nested_events(), ev.pivot_spec())),
    "first_touch_by_email": lambda v: at.first_touch_by_email(user_plans.touches(v), ids.email_pairs(v.event_log())),
    "first_touch_by_device": lambda v: at.first_touch_by_device(user_plans.touches(v)),
    "touch_events": lambda v: at.touch_events([v.page_views(), v.navigation()], s.TENANT, distinct=True),
    "first_touch_channel": _first_channels,
    "last_touch_channel": _last_channels,
    "page_visitors": lambda v: _visits(v, at.visitors),
    "daily_visitors": lambda v: _visits(v, at.daily_visitors),
    "visit_registration": lambda v: at.attribute_registration(
        _visits(v, at.daily_visitors), at.registrations_by_id(v.registrants(), ids.email_pairs(v.event_log()))
    ),
    "registrations_by_day": _registrations,
    "registrant_step": lambda v: reg.registrant_step(_registrations(v), _daily(v), ids.pair_weights(v.event_log())),
    "registrant_funnel": lambda v: reg.registrant_funnel(
        _registrations(v), ev.funnel_flags(_daily(v)), ids.email_pairs(v.event_log())
    ),
    "daily_login_counts": lambda v: _day_counts(v, "login", ["distinct_id", "email"], "login_event_cnt"),
    "daily_open_counts": lambda v: _day_counts(v, "open_db", ["event_label", "distinct_id"], "open_db_cnt"),
    "activation_timeline": _timeline,
    "asset_activation": lambda v: ev.asset_activation(
        v.assets(), v.asset_minutes(), "1999-01-01", "1999-12-31", "2001-09-01"
    ),
    "initial_plan": lambda v: crm.initial_plan(v.snapshots()),
    "day_spine": lambda v: calendar.day_spine_over(v.assets(), "db_created_at", s.ASSET_AS_OF),
    "period_end_days": lambda v: calendar.period_ends_over(v.assets(), "db_created_at", s.ASSET_AS_OF, "day"),
    "period_end_months": lambda v: calendar.period_ends_over(v.assets(), "db_created_at", s.ASSET_AS_OF, "month"),
    "daily_live_assets": _live_digest,
    "size_as_of_closed": lambda v: lifetimes.size_as_of(v.billing_hours(), v.size_history(), "hour_of_day"),
    "size_as_of_long": lambda v: lifetimes.size_as_of(
        v.billing_hours(), v.size_history(), "hour_of_day", long_histories=True
    ),
    "size_as_of_open": _edges,
    "size_as_of_sorted": lambda v: asof.as_of(v.billing_hours(), v.size_history(), "hour_of_day"),
    "size_as_of_sorted_open": lambda v: asof.as_of(_moments(v), v.size_history(), "at", closed=False),
    "tenure_range": lambda v: lifetimes.tenure_range(
        v.assets().withColumn("account_id", lifetimes.account_id()), ["email", "userkey", "account_id", "user_classification"]
    ),
    "tenure_range_by_tier": lambda v: lifetimes.tenure_range(
        v.assets().withColumn("account_id", lifetimes.account_id()), ["email", "userkey", "account_id"], lifetimes.TIER_GROUPS
    ),
    "daily_usage": _usage_digest,
    "daily_usage_written": _written_usage,
    "monthly_snapshot": lambda v: lifetimes.monthly_snapshot(v.assets(), v.size_history(), s.ASSET_AS_OF),
    "mrr": _prices,
    "tier_month_usage": lambda v: lifecycle.tier_month_usage(v.assets(), v.size_history(), s.ASSET_AS_OF),
    "lifecycle_status": lambda v: lifecycle.lifecycle_status(v.assets(), v.size_history(), s.ASSET_AS_OF),
    "mrr_customer_since": lambda v: lifecycle.mrr_customer_since(v.assets(), s.ASSET_AS_OF),
    "asset_rollup": lambda v: cohorts.asset_rollup(v.assets(sequence=True), s.INTERNAL_DOMAINS),
    "new_free_cohort": lambda v: cohorts.new_free_cohort(cohorts.asset_rollup(v.assets(sequence=True), s.INTERNAL_DOMAINS)),
    "old_free_cohort": lambda v: cohorts.old_free_cohort(cohorts.asset_rollup(v.assets(sequence=True), s.INTERNAL_DOMAINS)),
    "daily_queries": lambda v: cohorts.daily_queries(v.assets(), v.asset_minutes()),
    "active_and_querying": _querying_digest,
    "payment_span": lambda v: cohorts.payment_span(v.assets(sequence=True), "Direct", s.INTERNAL_DOMAIN_NAMES),
    "starters_by_month": lambda v: cohorts.starters_by_month(
        cohorts.payment_span(v.assets(sequence=True), "Direct", s.INTERNAL_DOMAIN_NAMES)
    ),
    "create_counts": lambda v: _retention_input(v, ret.create_counts),
    "destroy_counts": lambda v: _retention_input(v, ret.destroy_counts),
    "create_destroy_log": lambda v: _retention_input(v, ret.create_destroy_log),
    "cumulative_history": _history,
    "active_months": _months,
    "retention_backward": lambda v: ret.retention_backward(_months(v)),
    "retention_forward": lambda v: ret.retention_forward(_months(v)),
    "churn_month": lambda v: ret.churn_month(ret.retention_forward(_months(v))),
    "create_destroy_log_older": lambda v: _retention_input(v, ret.create_destroy_log, from_creations=True),
    "active_users_older": lambda v: _retention_input(v, ret.active_users),
    "active_history_older": _older_history,
    "user_asset_summary": lambda v: billing.user_asset_summary(v.assets(), s.ASSET_AS_OF),
    "user_asset_summary_narrow": lambda v: billing.user_asset_summary_narrow(v.assets()),
    "hourly_usage": lambda v: billing.hourly_usage(v.billing_hours(), v.assets()),
    "billing_summary": lambda v: billing.billing_summary(billing.hourly_usage(v.billing_hours(), v.assets())),
    "first_query": lambda v: _milestone(v, "first_query"),
    "first_load": lambda v: _milestone(v, "first_load"),
    "first_tools_connection": lambda v: _milestone(v, "first_tools_connection"),
    "first_programmatic_connection": lambda v: _milestone(v, "first_programmatic_connection"),
    "first_dump_upload": lambda v: _milestone(v, "first_dump_upload"),
    "live_days": lambda v: usage.live_days(usage.usage_runs(v.assets(), v.size_history(), s.ASSET_AS_OF)),
    "crm_contacts": lambda v: crm.crm_contacts(v.contacts(), v.accounts()),
    "crm_leads": lambda v: crm.crm_leads(v.leads()),
    "tier_label": _tier_labels,
    "account_id": _accounts,
    "time_to_milestone": _gaps,
    "user_360": user_plans.stand_in_user_360,
    "user_360_written": _written_user_360,
    "user_360_narrow": user_plans.stand_in_user_360_narrow,
    "extract_logs": lambda v: ql.extract_logs(v.query_logs()),
    "split_source": _sources,
    "parse_driver": _drivers,
    "parse_annotation": _annotations,
    "submission": _submissions,
    "daily_log": _one_day,
    "minute_stats": lambda v: ql.minute_stats(_log(v)),
    "minute_rollup": lambda v: minute_rollup(_log(v)),
    "committed_minute_stats": _committed,
    "agent_minutes_start": lambda v: ql.agent_minutes(_log(v), "start"),
    "agent_minutes_commit": lambda v: ql.agent_minutes(_log(v), "commit"),
}


def _runner(build: Callable[[StandIn], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: settle(build(StandIn(spark, str(sf_dir))))


def entry(spark: SparkSession) -> DataFrame:
    """The monthly lifecycle of every user, at the smallest scale."""
    return queries()["lifecycle_status"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: _runner(build) for name, build in BUILD.items()}
    return own if corpus is None else own | corpus.QUERIES | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from oracle.statements import ORACLE

    return dict(ORACLE) if corpus is None else ORACLE | corpus_sql.ORACLE
