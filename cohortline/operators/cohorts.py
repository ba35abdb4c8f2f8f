"""Per-e-mail asset rollups, free-tier cohorts, payment spans and query activity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import aggs, text, times
from cohortline.functions.parts import parts_for
from cohortline.operators import intervals, lifetimes

# Tiers reported one by one, and those that are paid for.
ROLLUP_TIERS = ("gds", "direct", "gcp", "enterprise", "free")
PAID = ("direct", "gcp", "enterprise", "gds")


# The names of the reported columns below are fixed values as well: reports read them.


def asset_rollup(assets: DataFrame, internal_domains: Sequence[str]) -> DataFrame:
    """One row per external e-mail: first dates, sizes by sequence, sums, distinct-asset counts per tier.

    Distinct counts come from one row per (e-mail, asset) first, which spreads
    a hot e-mail over tasks and needs no row multiplication per counted set.
    """
    tier = F.lower("db_billing_identity")
    destroyed = F.col("db_destroyed_at").isNotNull()

    def seen(c: Column) -> Column:
        return F.max(F.coalesce(c, F.lit(False)).cast("int"))

    per_asset = (
        assets.where(text.outside_domains(F.col("email"), internal_domains))
        .groupBy("email", "dbid")
        .agg(
            F.min("db_created_at").alias("born"),
            seen(destroyed).alias("gone"),
            F.min(F.when(F.col("user_db_sequence") == 1, F.col("initial_size_gb"))).alias("size_first"),
            F.min(F.when(F.col("user_db_rsequence") == 1, F.col("most_recent_size_gb"))).alias("size_latest"),
            F.max("initial_size_gb").alias("size_before"),
            F.max("most_recent_size_gb").alias("size_after"),
            *[F.sum(c).alias(c) for c in ("resize_count", "db_lifetime_days", "total_cost_dollars", "mrr_num")],
            *[aggs.min_where(tier == t, F.col("db_created_at")).alias(f"born_{t}") for t in ROLLUP_TIERS],
            *[seen(tier == t).alias(f"is_{t}") for t in ROLLUP_TIERS],
            seen((tier == "free") & destroyed).alias("gone_free"),
            seen(tier.isin(*PAID)).alias("is_paid"),
            seen(tier.isin(*PAID) & destroyed).alias("gone_paid"),
        )
    )
    known = F.when(F.col("dbid").isNotNull(), 1).otherwise(0)
    return per_asset.groupBy("email").agg(
        F.to_date(F.min("born")).alias("first_db_create_dt"),
        F.min("born").alias("first_db_create_dt_ts"),
        F.sum(known).alias("total_db_created"),
        F.sum(F.col("gone") * known).alias("total_db_destroyed"),
        F.min("size_first").alias("first_db_size"),
        F.max("size_before").alias("max_db_size_before_resizing"),
        F.max("size_after").alias("max_db_size_after_resizing"),
        F.min("size_latest").alias("most_recent_db_size"),
        F.sum("resize_count").alias("resize_count"),
        F.sum("db_lifetime_days").alias("sum_of_all_db_lifetime"),
        F.sum("total_cost_dollars").alias("total_cost_dollars"),
        F.sum("mrr_num").alias("total_mrr_dollars"),
        *[F.min(f"born_{t}").alias(f"first_{t}_db_create_dt_ts") for t in ROLLUP_TIERS],
        *[F.sum(F.col(f"is_{t}") * known).alias(f"count_of_{t}_db_created") for t in ROLLUP_TIERS],
        F.sum(F.col("gone_free") * known).alias("count_of_free_db_destroyed"),
        F.sum(F.col("is_paid") * known).alias("count_of_paid_db_created"),
        F.sum(F.col("gone_paid") * known).alias("count_of_paid_db_destroyed"),
    )


def _yn(c: Column) -> Column:
    return F.when(c, 1).otherwise(0).cast("long")


def _cohort_parts() -> dict[str, Column]:
    first, free = F.col("first_db_create_dt_ts"), F.col("first_free_db_create_dt_ts")
    return {
        "new": first == free,
        "old": first < free,
        "active": _yn(F.col("total_db_created") != F.col("total_db_destroyed")),
        "holds_paid": F.col("count_of_paid_db_created") > F.col("count_of_paid_db_destroyed"),
        "holds_free": F.col("count_of_free_db_created") > F.col("count_of_free_db_destroyed"),
    }


def new_free_cohort(rollup: DataFrame) -> DataFrame:
    """E-mails whose first asset was free, with the paid tiers they moved to later."""
    p = _cohort_parts()
    first = F.col("first_db_create_dt_ts")

    def moved(*tiers: str) -> Column:
        return p["new"] & text.any_of(first < F.col(f"first_{t}_db_create_dt_ts") for t in tiers)

    return rollup.where(p["new"]).select(
        "email",
        p["active"].alias("active_db_yn"),
        _yn(p["new"]).alias("new_free_users"),
        _yn(moved("direct")).alias("new_free_direct_users"),
        _yn(moved("gcp")).alias("new_free_gcp_users"),
        _yn(moved("gds", "enterprise")).alias("new_free_gds_enterprise_users"),
        _yn(p["old"]).alias("old_free_users"),
        _yn(p["new"] & p["holds_paid"]).alias("new_free_users_paid_db_yn"),
        _yn(p["new"] & p["holds_free"]).alias("new_free_users_free_db_yn"),
    )


def old_free_cohort(rollup: DataFrame) -> DataFrame:
    """E-mails that held a paid asset before their first free one."""
    p = _cohort_parts()
    free = F.col("first_free_db_create_dt_ts")
    direct = free > F.col("first_direct_db_create_dt_ts")
    gcp = free > F.col("first_gcp_db_create_dt_ts")
    return rollup.where(p["old"]).select(
        "email",
        p["active"].alias("active_db_yn"),
        _yn(p["old"]).alias("old_free_users"),
        _yn(direct).alias("old_free_direct_users"),
        _yn(gcp).alias("old_free_gcp_users"),
        _yn(direct & gcp).alias("old_free_direct_gcp_users"),
        _yn(p["holds_paid"]).alias("old_free_users_paid_db_yn"),
        _yn(p["holds_free"]).alias("old_free_users_free_db_yn"),
    )


def daily_queries(assets: DataFrame, completions: DataFrame) -> DataFrame:
    """Completed queries per day and e-mail; owners without any keep one row with a null date."""
    owners = assets.select("email", "dbid").distinct()
    per_asset = completions.groupBy(F.to_date("minute").alias("calendar_dt"), "dbid").agg(
        F.sum("queries_completed").alias("queries_completed")
    )
    return (
        owners.join(per_asset, "dbid", "left")
        .groupBy("calendar_dt", "email")
        .agg(F.sum("queries_completed").alias("queries_completed"))
    )


def live_owner_days(assets: DataFrame, start: date | str, as_of: datetime | str) -> DataFrame:
    """Days on which an e-mail has a live asset, without listing asset-days."""
    spans = lifetimes.live_span(assets, start, as_of).select("email", "first", "last", F.lit(1).alias("live"))
    runs = intervals.sweep(spans, ["email"], ["live"]).where("live > 0")
    days = intervals.expand(runs, "_day", ["email"])
    return days.select(times.first_date("day", F.col("_day")).alias("calendar_dt"), "email")


def active_and_querying(
    assets: DataFrame, queries: DataFrame, start: date | str, as_of: datetime | str
) -> DataFrame:
    """Per live day and e-mail, 1 if the e-mail's assets completed queries that day.

    Lifetimes and query days go through one sweep, so owner-days are produced
    once at the end and never shuffled or joined, in parts by the number of assets.
    """
    none = F.lit(0).cast("long")
    live = lifetimes.live_span(assets, start, as_of).select(
        "email", "first", "last", F.lit(1).cast("long").alias("live"), none.alias("asked")
    )
    day = times.position("day", F.col("calendar_dt"))
    asked = queries.where("calendar_dt is not null and email is not null").select(
        "email", day.alias("first"), day.alias("last"), none.alias("live"), F.lit(1).cast("long").alias("asked")
    )
    runs = intervals.sweep(live.unionByName(asked), ["email"], ["live", "asked"], ["email"], parts_for(assets)).where("live > 0")
    days = intervals.expand(runs, "_day", ["email", "asked"])
    return days.select(
        times.first_date("day", F.col("_day")).alias("calendar_dt"), "email",
        F.when(F.col("asked") > 0, 1).otherwise(0).alias("active_user_yn"),
    )


def payment_span(assets: DataFrame, tier: str, internal_domains: Sequence[str]) -> DataFrame:
    """First created date, and the last destroyed date once every asset of the tier is gone.

    Only the two counts look at the tier; the dates span assets of all tiers.
    """
    born, died = (F.struct(F.lit(k).alias("kind"), F.col(c).alias("at")) for k, c in (("born", "db_created_at"), ("died", "db_destroyed_at")))
    outside = F.coalesce(~F.col("email_domain").isin(*internal_domains), F.lit(False))
    first_label = F.when(outside & (F.col("user_db_sequence") == 1), F.col("initial_size_label"))
    # One row per e-mail, kind and moment, so that moments are counted without a row copy per counted set.
    moments = (
        assets.select(
            "email", outside.alias("outside"), (F.col("db_billing_identity") == tier).alias("inside"), first_label.alias("label"),
            F.inline(F.array(born, died)),
        )
        .groupBy("email", "kind", "at")
        .agg(F.max("outside").alias("outside"), F.max("inside").alias("inside"), F.max("label").alias("label"))
    )
    known = F.col("at").isNotNull()

    def counted(kind: str) -> Column:
        return F.sum(F.when(F.col("inside") & known & (F.col("kind") == kind), 1).otherwise(0))

    def when_outside(kind: str) -> Column:
        return F.when(F.col("outside") & (F.col("kind") == kind), F.col("at"))

    spans = moments.groupBy("email").agg(
        F.max("outside").alias("_outside"),
        # As in a join by e-mail, a null e-mail has no counts.
        F.when(F.max("inside") & F.col("email").isNotNull(), counted("born")).alias("db_create_dts"),
        F.when(F.max("inside") & F.col("email").isNotNull(), counted("died")).alias("db_destroy_dts"),
        F.to_date(F.min(when_outside("born"))).alias("date_of_pymnt_start"),
        F.to_date(F.max(when_outside("died"))).alias("_last"),
        F.max("label").alias("initial_size_label"),
    )
    return spans.where("_outside").select(
        "email", "db_create_dts", "db_destroy_dts", "date_of_pymnt_start",
        F.when(F.col("db_create_dts") == F.col("db_destroy_dts"), F.col("_last")).alias("date_of_pymnt_stop"),
        "initial_size_label",
    )


def starters_by_month(spans: DataFrame) -> DataFrame:
    """Paying users by the month they started."""
    start = F.col("date_of_pymnt_start")
    return (
        spans.where(F.col("db_create_dts").isNotNull())
        .groupBy(F.year(start).alias("yr"), F.month(start).alias("mnth"))
        .agg(F.countDistinct("email").alias("count_of_users"))
        .orderBy("yr", "mnth")
    )
