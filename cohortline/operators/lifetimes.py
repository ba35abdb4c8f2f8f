"""Asset lifetimes: live days, sizes as of a moment, tenure, monthly snapshots.

An asset row is ``dbid, userkey, email, email_domain, user_classification,
db_billing_identity, db_created_at, db_destroyed_at`` (null end = live).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortline.functions import aggs, numbers, times
from cohortline.functions.parts import parts_for

# The metered tiers, and how tiers are grouped in reports.
METERED_TIERS = ("Free", "Direct", "GCP")
PRO_TIERS = ("Direct", "GCP")
TIER_GROUPS: Mapping[str, tuple[str, ...]] = {
    "free": ("Free",),
    "pro": PRO_TIERS,
    "gcp": ("GCP",),
    "direct": ("Direct",),
}
PRIVATE_USER = "External Private User"
INTERNAL = "Internal"
MIN_LIFE = "2 HOURS"


def account_id() -> Column:
    """Private users are their own account; everybody else belongs to their e-mail domain."""
    private = F.col("user_classification") == PRIVATE_USER
    return F.when(private, F.col("userkey").cast("string")).otherwise(F.col("email_domain"))


def end_or(as_of: datetime | str) -> Column:
    return F.coalesce(F.col("db_destroyed_at").cast("timestamp"), times.instant(as_of))


def live_span(assets: DataFrame, start: date | str, as_of: datetime | str, unit: str = "day") -> DataFrame:
    """Adds ``first``/``last``: positions on which the asset is live between ``start`` and ``as_of``.

    Assets gone before ``start`` leave. Where totals run on from here, as in
    retention, ``start`` should be no later than the first asset's day: months
    before it do not appear, so their creations are in no running total, while
    later destructions of the same assets are.
    """
    low, high = times.instant(start), times.instant(as_of)
    first = F.greatest(times.position(unit, F.col("db_created_at")), times.position(unit, low))
    last = F.least(times.position(unit, end_or(as_of)), times.position(unit, high))
    touched = (F.to_date(end_or(as_of)) >= F.to_date(low)) & (F.to_date("db_created_at") <= F.to_date(high))
    return (
        assets.where(F.col("db_created_at").isNotNull() & touched)
        .withColumns({"first": first, "last": last})
        .where(F.col("first") <= F.col("last"))
    )


def daily_live_assets(assets: DataFrame, start: date | str, as_of: datetime | str) -> DataFrame:
    """One row per asset and day it is live, both end days included.

    Assets are spread by ``dbid`` first: one input split of them can fan out
    to a thousand times its size.
    """
    days = F.explode(F.sequence("first", "last"))
    return (
        live_span(assets, start, as_of)
        .repartition("dbid")
        .select("*", days.alias("_day"))
        .select(times.first_date("day", F.col("_day")).cast("timestamp").alias("calendar_dt"), *assets.columns)
    )


def size_as_of(
    points: DataFrame,
    history: DataFrame,
    at: str,
    closed: bool = True,
    key: str = "dbid",
    long_histories: bool = False,
) -> DataFrame:
    """Adds ``db_size``: the version effective at each point, null if none.

    ``closed`` includes the version's first instant. With few versions per
    asset the join goes by asset, and AQE splits an asset with many points.
    ``long_histories`` joins by asset and month instead, which also spreads an
    asset with many versions: each version is listed once per month it spans,
    within the months the points cover, which one job over the points finds.
    """
    h = history.select(F.col(key).alias("_key"), "db_size", "ts_effective_from", "ts_effective_thru")
    begun = F.col(at) >= F.col("ts_effective_from") if closed else F.col(at) > F.col("ts_effective_from")
    hit = (F.col(key) == F.col("_key")) & begun & (F.col(at) < F.col("ts_effective_thru"))
    columns = points.columns
    if long_histories:
        month = times.month_index(F.col(at))
        covered = points.agg(F.min(month).alias("first"), F.max(month).alias("last")).first()
        # Points without a month meet no version, so none is listed for them.
        spans = h.withColumns({
            "_lo": F.greatest(times.month_index(F.col("ts_effective_from")), F.lit(covered["first"]).cast("int")),
            "_hi": F.least(times.month_index(F.col("ts_effective_thru")), F.lit(covered["last"]).cast("int")),
        }).where(F.lit(covered["first"] is not None) & (F.col("_lo") <= F.col("_hi")))
        h = spans.select("*", F.explode(F.sequence("_lo", "_hi")).alias("_bucket")).drop("_lo", "_hi")
        points = points.withColumn("_month", month)
        hit = hit & (F.col("_month") == F.col("_bucket"))
    # Versions fan out behind the scan, whose bytes say nothing of them: never broadcast.
    return points.join(h.hint("merge"), hit, "left").select(*columns, "db_size")


def tenure_range(assets: DataFrame, keys: Sequence[str], groups: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Start date and churn date per key, overall and per tier group; no churn while anything is live."""
    out = [
        F.to_date(F.min("db_created_at")).alias("start_date"),
        F.to_date(aggs.closing(F.col("db_destroyed_at"))).alias("churn_date"),
    ]
    for name, tiers in (groups or {}).items():
        inside = F.col("db_billing_identity").isin(*tiers)
        out += [
            F.to_date(aggs.min_where(inside, F.col("db_created_at"))).alias(f"{name}_start_date"),
            F.to_date(aggs.closing(F.col("db_destroyed_at"), inside)).alias(f"{name}_churn_date"),
        ]
    return assets.groupBy(*keys).agg(*out)


def snapshot_assets(assets: DataFrame, as_of: datetime | str, tiers: Sequence[str] = METERED_TIERS) -> DataFrame:
    """Qualified external assets with ``account_id`` and the month positions they appear in.

    Qualified: lived at least two hours and into a later month than it began.
    """
    end = end_or(as_of)
    lived = times.lasted(F.col("db_created_at"), end, MIN_LIFE)
    later = times.month_index(end) > times.month_index(F.col("db_created_at"))
    return (
        assets.where(F.col("db_billing_identity").isin(*tiers) & (F.col("user_classification") != INTERNAL))
        .where(lived & later)
        .select(
            "dbid", "email", "userkey", "db_billing_identity", "db_created_at", "db_destroyed_at",
            account_id().alias("account_id"),
            times.first_end_after("month", F.col("db_created_at")).alias("first"),
            F.least(times.month_index(end), F.lit(times.last_closed_position("month", as_of))).alias("last"),
        )
        .where(F.col("first") <= F.col("last"))
    )


def overlapping_versions(history: DataFrame, key: str = "dbid") -> DataFrame:
    """Size versions that begin before an earlier version of the same asset has ended; empty versions are left out.

    The swept operators count an asset once whatever its versions, and sum the
    sizes of all that apply; the joined ones repeat the asset per version. They
    agree where this frame is empty, which plans check by :func:`check_versions`.
    """
    start, end = F.col("ts_effective_from"), F.col("ts_effective_thru")
    before = Window.partitionBy(key).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    return (
        history.where(start < end)
        .withColumn("_until", F.max(end).over(before))
        .where(F.col("_until") > start)
        .drop("_until")
    )


def check_versions(history: DataFrame, key: str = "dbid") -> DataFrame:
    """The history, or an error naming an asset whose versions overlap."""
    # One job over all parts; taking a row would go through them in ever larger steps.
    found = overlapping_versions(history, key).agg(F.count("*").alias("n"), F.min(key).alias("key")).first()
    if found.n:
        raise ValueError(f"size versions of {key} {found.key} overlap")
    return history


def version_span(history: DataFrame, unit: str, closed: bool) -> DataFrame:
    """Size versions as position spans; versions effective at no period end drop out here."""
    return history.select(
        "dbid", "db_size",
        times.first_end_after(unit, F.col("ts_effective_from"), inclusive=closed).alias("v_first"),
        times.last_end_before(unit, F.col("ts_effective_thru")).alias("v_last"),
    ).where(F.col("v_first") <= F.col("v_last"))


def monthly_snapshot(
    assets: DataFrame, history: DataFrame, as_of: datetime | str, tiers: Sequence[str] = METERED_TIERS
) -> DataFrame:
    """One row per qualified asset and month end, with its size and price then.

    Assets are placed by ``dbid`` before they fan out to months, so the size
    lookup shuffles assets and versions, not asset-months; it sorts the months of
    a part, so parts are in proportion to the assets.
    """
    placed = snapshot_assets(assets, as_of, tiers).repartition(parts_for(assets), "dbid")
    months = placed.select("*", F.explode(F.sequence("first", "last")).alias("_m"))
    v = version_span(history, "month", closed=True).withColumnRenamed("dbid", "_dbid")
    hit = (F.col("dbid") == F.col("_dbid")) & F.col("_m").between(F.col("v_first"), F.col("v_last"))
    size = F.col("db_size") / 1024
    # Versions are as many as assets, whatever the scan's bytes promise: never broadcast.
    return months.join(v.hint("merge"), hit, "left").select(
        times.period_end("month", F.col("_m")).alias("calculated_date"),
        times.first_date("month", F.col("_m")).alias("as_of_date"),
        "email", "userkey", "db_billing_identity", "account_id", "dbid", "db_created_at", "db_destroyed_at",
        size.alias("db_size"),
        numbers.monthly_price(size).alias("mrr"),
    )
