"""Event conforming, daily interaction counts, funnel flags and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import aggs, text

# The columns of the conformed event log.
CONFORMED = {
    "event_ts": "timestamp",
    "event_name": "string",
    "distinct_id": "string",
    "email_address": "string",
    "event_label": "string",
    "version": "string",
    "size": "string",
    "region": "string",
    "installtype": "string",
    "step": "string",
    "view": "string",
    "language": "string",
    "dbid_created": "string",
    "db_resized": "string",
    "db_destroyed": "string",
    "old_size": "string",
    "new_size": "string",
    "readytorunpushcommand": "string",
    "device_id": "string",
    "user_id": "string",
    "distinct_id_before_identity": "string",
}
EVERY_EVENT = ("distinct_id", "device_id", "user_id", "distinct_id_before_identity")


@dataclass(frozen=True)
class Shape:
    """What one event table adds to the common columns."""

    carries: Mapping[str, str] = field(default_factory=dict)  # output column -> source column
    asset_from_url: tuple[str, str] | None = None  # (output column, URL kind)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


# The event tables and the extra columns each one has.
EVENT_SHAPES: Mapping[str, Shape] = {
    "login": Shape({"email_address": "email"}),
    "navigate_to": Shape(_same("view"), ("dbid_created", "created")),
    "create_db": Shape(_same("version", "size", "region")),
    "set_import_option": Shape(_same("installtype", "readytorunpushcommand")),
    "next_step": Shape(_same("step")),
    "finish_import": Shape(),
    "open_db": Shape(_same("event_label")),
    "help_link": Shape(),
    "feedback_link": Shape(),
    "expand_resize_db": Shape(),
    "resize_db": Shape(_same("old_size", "new_size"), ("db_resized", "detail")),
    "restore_db": Shape(),
    "export_db_backup": Shape(),
    "destroy_db": Shape({}, ("db_destroyed", "detail")),
    "logout": Shape(),
    "take_snapshot_db": Shape(),
    "create_from_snapshot": Shape(),
    "change_language": Shape(_same("view", "language")),
    "terms_accepted": Shape(),
}


def conform(table: DataFrame, shape: Shape, tenant: str | None = None) -> DataFrame:
    """One event table in the conformed layout; absent columns are typed nulls."""
    if tenant is not None:
        table = table.where(F.col("project_id") == tenant)
    found: dict[str, Column] = {
        "event_ts": F.timestamp_seconds("time"),
        "event_name": F.col("raw_event_type"),
        **{c: F.col(c) for c in EVERY_EVENT},
        **{out: F.col(src) for out, src in shape.carries.items()},
    }
    if shape.asset_from_url:
        out, kind = shape.asset_from_url
        found[out] = text.asset_id_from_url(F.col("current_url"), kind)
    return table.select(*[found.get(c, F.lit(None)).cast(t).alias(c) for c, t in CONFORMED.items()])


def conform_events(
    tables: Mapping[str, DataFrame], tenant: str | None = None, shapes: Mapping[str, Shape] = EVENT_SHAPES
) -> DataFrame:
    """All event tables as one log."""
    parts = [conform(table, shapes[name], tenant) for name, table in tables.items()]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log


@dataclass(frozen=True)
class Counter:
    """A daily count: event names (lower case), and an optional predicate on one column."""

    name: str
    events: tuple[str, ...]
    column: str | None = None
    equals: str | None = None  # with a column but no value: the column is not null

    def condition(self, event: Column) -> Column:
        hit = event == self.events[0] if len(self.events) == 1 else event.isin(*self.events)
        if self.column is None:
            return hit
        c = F.col(self.column)
        return hit & (c.isNotNull() if self.equals is None else c == self.equals)


@dataclass(frozen=True)
class EventNames:
    """Names and texts that differ between deployments beyond a prefix."""

    terms: str = "terms_accepted"
    check_step: str = "Ensure admin command"
    run_step: str = "Run admin command"
    landing: str = "NAVIGATE_TO_LANDING_PAGE"


def interaction_spec(
    prefix: str = "", labels: tuple[str, str] = ("explorer", "browser"), names: EventNames = EventNames()
) -> tuple[Counter, ...]:
    """The daily counters. ``prefix`` goes before every event name; ``labels`` are the two opened apps."""
    explorer, console = labels

    def ev(name, *events, column=None, equals=None):
        return Counter(name, tuple(prefix + e for e in events), column, equals)

    return (
        ev("login_cnt", "login"),
        ev("explorer_open_cnt", "open_db", column="event_label", equals=explorer),
        ev("browser_open_cnt", "open_db", column="event_label", equals=console),
        ev("create_db_pageview_cnt", "navigate_to_create-database"),
        ev("create_db_step1_pageview_cnt", "navigate_to_step1"),
        ev("create_db_payment_pageview_cnt", "navigate_to_step2"),
        ev("db_created_cnt", "create_db"),
        ev("import_pageview_cnt", "navigate_to_import-instructions"),
        ev("import_db_select_cnt", "set_import_option", column="installtype"),
        ev("import_ensure_admin_command_pageview_cnt", "next_step", column="step", equals=names.check_step),
        ev("import_ensure_admin_command_selection", "set_import_option", column="readytorunpushcommand"),
        ev("import_run_admin_command_pageview_cnt", "next_step", column="step", equals=names.run_step),
        ev("import_complete_process_pageview_cnt", "next_step", column="step", equals="Complete the process"),
        ev("import_finish_instructions_cnt", "finish_import"),
        ev("change_language_pageview_cnt", "change_language"),
        ev("help_click_cnt", "help_link"),
        ev("feedback_click_cnt", "feedback_link"),
        ev("db_details_pageview_cnt", "navigate_to_databases/detail"),
        ev("db_details_import_pageview_cnt", "navigate_to_databases/detail/import"),
        ev("db_details_connect_pageview_cnt", "navigate_to_databases/detail/connect"),
        ev("db_details_snapshots_pageview_cnt", "navigate_to_databases/detail/snapshots"),
        ev("db_details_settings_pageview_cnt", "navigate_to_databases/detail/settings"),
        ev("db_details_settings_resize_pageview_cnt", "expand_resize_db"),
        ev("db_resize_cnt", "resize_db"),
        ev("db_restore_cnt", "restore_db"),
        ev("export_db_backup_click_cnt", "export_db_backup"),
        ev("db_destroy_cnt", "destroy_db"),
        ev("account_pageview_cnt", "navigate_to_account", "navigate_to_account/usage"),
        ev("console_dashboard_pageview_cnt", "navigate_to_", "navigate_to_databases"),
        ev("console_logout_cnt", "logout"),
        ev("take_snapshot_click_cnt", "take_snapshot_db"),
        ev("create_db_from_snapshot_cnt", "create_from_snapshot"),
        ev("console_dashboard_connect_cnt", "navigate_to_how-to-connect"),
        ev("terms_accept_cnt", names.terms),
    )


def daily_interactions(events: DataFrame, spec: Sequence[Counter]) -> DataFrame:
    """Event count and every counter of the spec per day and id."""
    event = F.lower("event_name")
    return events.groupBy(F.to_date("event_ts").alias("calendar_dt"), "distinct_id").agg(
        F.count("*").alias("event_count"),
        *[aggs.count_where(c.condition(event)).alias(c.name) for c in spec],
    )


# Flag -> the daily count it comes from.
FUNNEL_FLAGS: Mapping[str, str] = {
    "login_flag": "login_cnt",
    "console_dashboard_pageview_flag": "console_dashboard_pageview_cnt",
    "create_db_pageview_flag": "create_db_pageview_cnt",
    "create_db_step1_pageview_flag": "create_db_step1_pageview_cnt",
    "create_db_payment_pageview_flag": "create_db_payment_pageview_cnt",
    "db_created_flag": "db_created_cnt",
    "import_pageview_flag": "import_pageview_cnt",
    "help_link_flag": "help_click_cnt",
    "console_dashboard_connect_flag": "console_dashboard_connect_cnt",
    "feedback_click_flag": "feedback_click_cnt",
    "account_pageview_flag": "account_pageview_cnt",
    "terms_accept_flag": "terms_accept_cnt",
}

# The steps a daily report shows.
REPORT_STEPS = (
    "login_flag",
    "console_dashboard_pageview_flag",
    "create_db_pageview_flag",
    "create_db_payment_pageview_flag",
    "db_created_flag",
    "feedback_click_flag",
    "account_pageview_flag",
    "help_link_flag",
    "import_pageview_flag",
    "console_dashboard_connect_flag",
)


def funnel_flags(daily: DataFrame, flags: Mapping[str, str] = FUNNEL_FLAGS) -> DataFrame:
    """0/1 per step, day and id.

    Joining the identity map first would only repeat rows under a max, so it is
    left out; grouping by the daily table's own keys reuses its placement.
    """
    return daily.groupBy("calendar_dt", "distinct_id").agg(
        *[aggs.flag_where(F.col(count) > 0).alias(flag) for flag, count in flags.items()]
    )


def excluded_ids(identity: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Ids with an e-mail outside the domains: the set the daily report leaves out."""
    return identity.where(text.outside_domains(F.col("email_address"), domains)).select("distinct_id")


def without(frame: DataFrame, exclude: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Rows whose key is NOT IN ``exclude``, null rules included, as a distributed anti join.

    A null in a non-empty ``exclude`` removes everything, and a null key goes
    unless ``exclude`` is empty. Those two facts are a one-row subquery; the
    ids themselves are never gathered. ``null_safe`` takes a null as a value: it
    removes rows with a null key and no others.
    """
    if null_safe:
        keys = exclude.select(F.col(key).alias("_key")).distinct()
        return frame.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    facts = exclude.agg(F.struct(
        F.coalesce(F.max(F.col(key).isNull()), F.lit(False)).alias("has_null"), F.count("*").alias("n")
    ).alias("facts")).scalar()
    keys = exclude.where(F.col(key).isNotNull()).select(key).distinct()
    rows = frame.where(~facts["has_null"] & (F.col(key).isNotNull() | (facts["n"] == 0)))
    return rows.join(keys, key, "left_anti")


def funnel_report(
    flags: DataFrame, exclude: DataFrame | None = None, steps: Sequence[str] = REPORT_STEPS, null_safe: bool = False
) -> DataFrame:
    """Users reaching each step per day, without the excluded ids (:func:`without`)."""
    if exclude is not None:
        flags = without(flags, exclude, "distinct_id", null_safe)
    return (
        flags.groupBy("calendar_dt")
        .agg(
            *[aggs.count_where(F.col(s) > 0).alias(s) for s in steps],
            F.count("distinct_id").alias("user_cnt"),
        )
        .orderBy("calendar_dt")
    )


def pivot_spec(
    prefix: str = "", labels: tuple[str, str] = ("explorer", "browser"), names: EventNames = EventNames()
) -> tuple[Counter, ...]:
    """Flags of the nested event log; event names are compared as they are, in upper case."""
    explorer, console = labels

    def ev(name, event, equals=None):
        return Counter(name, (prefix + event,), "properties.event_label" if equals else None, equals)

    return (
        ev("landing_pageview_yn", names.landing),
        ev("signup_click_yn", "PAGE_SIGNUP_CLICK"),
        ev("console_pageview_yn", "NAVIGATE_TO_"),
        ev("login_yn", "LOGIN"),
        ev("create_db_pageview_yn", "NAVIGATE_TO_CREATE_DATABASE"),
        ev("create_db_yn", "CREATE_DB"),
        ev("db_opened_yn", "OPEN_DB"),
        ev("db_opened_browser_yn", "OPEN_DB", console),
        ev("db_opened_explorer_yn", "OPEN_DB", explorer),
        ev("email_verification_pageview_yn", "NAVIGATE_TO_EMAIL_VERIFICATION_REQUIRED"),
        ev("db_destroyed_yn", "DESTROY_DB"),
        ev("connect_pageview_yn", "NAVIGATE_TO_HOW_TO_CONNECT"),
        ev("navigate_to_db", "NAVIGATE_TO_DATABASES"),
        ev("connect_language_change_yn", "CHANGE_LANGUAGE"),
        ev("import_instructions_pageview_yn", "NAVIGATE_TO_IMPORT_INSTRUCTIONS"),
        ev("feedback_pageview_yn", "FEEDBACK_LINK"),
        ev("add_payment_pageview_yn", "NAVIGATE_TO_ADD_PAYMENT"),
        ev("add_payment_yn", "ADD_PAYMENT"),
    )


# Flags the daily totals of the nested log show.
PIVOT_TOTALS = (
    "landing_pageview_yn",
    "signup_click_yn",
    "login_yn",
    "console_pageview_yn",
    "create_db_pageview_yn",
    "create_db_yn",
    "db_opened_yn",
    "navigate_to_db",
    "connect_pageview_yn",
    "import_instructions_pageview_yn",
    "connect_language_change_yn",
    "email_verification_pageview_yn",
    "db_destroyed_yn",
    "add_payment_pageview_yn",
    "add_payment_yn",
)


def event_pivot(log: DataFrame, spec: Sequence[Counter]) -> DataFrame:
    """0/1 per event kind, day and id from a log of ``event`` and nested ``properties``."""
    day = F.to_date(F.timestamp_seconds("properties.time"))
    return log.groupBy(day.alias("calendar_date"), F.col("properties.distinct_id").alias("distinct_id")).agg(
        *[aggs.flag_where(c.condition(F.col("event"))).alias(c.name) for c in spec]
    )


def pivot_totals(pivot: DataFrame, flags: Sequence[str] = PIVOT_TOTALS) -> DataFrame:
    """Users and users per flag for each day."""
    return pivot.groupBy("calendar_date").agg(
        F.count("distinct_id").alias("total_unique_users"), *[F.sum(f).alias(f) for f in flags]
    )


def daily_event_counts(
    events: DataFrame, keys: Sequence[str], start: date | str, end: date | str, name: str
) -> DataFrame:
    """Rows per day and keys of one event table, for event days from ``start`` to ``end``."""
    day = F.to_date(F.timestamp_seconds("time"))
    low, high = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    inside = events.where(
        (F.col("time") >= F.unix_seconds(low.cast("timestamp")))
        & (F.col("time") < F.unix_seconds(F.date_add(high, 1).cast("timestamp")))
    )
    return inside.groupBy(day.alias("calendar_date"), *keys).agg(F.count("*").alias(name))


def activation_timeline(logins: DataFrame, opens: DataFrame, creations: Sequence[DataFrame]) -> DataFrame:
    """First login, first creation over all creation tables, first open per label; one row per label.

    Inputs are daily counts with a ``calendar_date``. The joined sides are
    unique per key, so no final distinct is needed. The id in the final order
    lets the sort split a busy day over tasks.
    """
    first = logins.groupBy("distinct_id", "email").agg(F.min("calendar_date").alias("first_login_dt"))
    opened = opens.groupBy("distinct_id", "event_label").agg(F.min("calendar_date").alias("first_launch_dt"))
    made = creations[0].select("distinct_id", "calendar_date")
    for more in creations[1:]:
        made = made.unionByName(more.select("distinct_id", "calendar_date"))
    made = made.groupBy("distinct_id").agg(F.min("calendar_date").alias("first_db_create_dt"))
    return (
        first.join(opened, "distinct_id", "left")
        .join(made, "distinct_id", "left")
        .select("first_login_dt", "distinct_id", "email", "first_db_create_dt", "event_label", "first_launch_dt")
        .orderBy("first_login_dt", "distinct_id")
    )


def asset_activation(
    assets: DataFrame, completions: DataFrame, start: date | str, end: date | str, as_of: date | str,
    excluded_tiers: Sequence[str] = ("enterprise",),
) -> DataFrame:
    """Per e-mail, 1 if any asset created in the range has a query record since ``start``."""
    low, high, now = (F.lit(str(d)).cast("date") for d in (start, end, as_of))
    made = (
        assets.where(F.to_date("db_created_at").between(low, high))
        .where(~F.col("db_tier").isin(*excluded_tiers))
        .select("email", "dbid")
        .distinct()
    )
    asked = completions.where(F.to_date("minute").between(low, now)).select("dbid", F.lit(1).alias("_asked")).distinct()
    return made.join(asked, "dbid", "left").groupBy("email").agg(
        F.max(F.coalesce("_asked", F.lit(0))).alias("activated_yn")
    )
