"""Asset summaries, hourly usage and billing per user."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import aggs, numbers
from cohortline.operators.lifetimes import PRO_TIERS, account_id, end_or

# Tier groups with their own start and churn, and tiers with their own live counts.
SPAN_GROUPS = {"free": ("Free",), "pro": PRO_TIERS, "enterprise": ("Enterprise",), "gds": ("GDS",)}
LIVE_TIERS = {"free": "Free", "direct": "Direct", "gcp": "GCP", "enterprise": "Enterprise", "gds": "GDS"}


def _with_channels(assets: DataFrame, keys: Sequence[Column], out: Sequence[Column]) -> DataFrame:
    """The aggregates ``out`` per key, and before them the key's sorted distinct tiers; a null key is a key like any other.

    A list among the aggregates would make Spark sort every asset with the whole row of them; without it they stay in
    hash tables, and only distinct pairs of key and tier are collected.
    """
    summed = assets.groupBy(*keys).agg(*out)
    names = summed.columns[: len(keys)]
    tiers = assets.select(*keys, F.col("db_billing_identity").alias("_tier")).distinct()
    lists = tiers.groupBy(*names).agg(aggs.sorted_list(F.col("_tier")).alias("channels"))
    lists = lists.withColumnsRenamed({n: f"_{n}" for n in names})
    same = reduce(and_, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    return summed.join(lists, same).select(*names, "channels", *summed.columns[len(keys):])


def user_asset_summary(assets: DataFrame, as_of: datetime | str) -> DataFrame:
    """One row per user: channels, counts, live size, start and churn per tier group, live assets per tier."""
    tier, born, died = F.col("db_billing_identity"), F.col("db_created_at"), F.col("db_destroyed_at")
    live = died.isNull()
    megabytes = numbers.exact(F.col("most_recent_size_mb"))
    out = [
        F.countDistinct("dbid").alias("total_db_count"),
        F.count(F.when(live, F.col("dbid"))).alias("live_db_count"),
        F.min(born).alias("start_date"),
        F.round(aggs.sum_where(live, megabytes) / 1024, 2).cast("double").alias("live_gb"),
        F.max(end_or(as_of)).alias("most_recently_live"),
        aggs.closing(died).alias("churn_date"),
    ]
    for name, tiers in SPAN_GROUPS.items():
        inside = tier.isin(*tiers)
        out += [
            aggs.min_where(inside, born).alias(f"start_date_{name}"),
            aggs.closing(died, inside).alias(f"churn_date_{name}"),
        ]
    for name, value in LIVE_TIERS.items():
        inside = tier == value
        out += [
            F.bool_or(F.coalesce(inside, F.lit(False))).alias(f"{name}_dbs_detected"),
            aggs.count_where(inside & live).alias(f"live_db_count_{name}"),
            # Named for gigabytes, summed in megabytes: kept as callers know it.
            aggs.sum_where(inside & live, megabytes).cast("double").alias(f"live_gb_{name}"),
        ]
    return _with_channels(assets, [F.col("userkey")], out)


def user_asset_summary_narrow(assets: DataFrame) -> DataFrame:
    """One row per e-mail, user and account: channels, counts, start and churn of free and pro."""
    tier, born, died = F.col("db_billing_identity"), F.col("db_created_at"), F.col("db_destroyed_at")
    out = [
        F.countDistinct("dbid").alias("total_db"),
        F.count(F.when(died.isNull(), F.col("dbid"))).alias("live_db"),
    ]
    for name in ("free", "pro"):
        inside = tier.isin(*SPAN_GROUPS[name])
        out += [
            aggs.min_where(inside, born).alias(f"start_{name}_date"),
            aggs.closing(died, inside).alias(f"churn_{name}_date"),
        ]
    return _with_channels(assets, [F.col("email"), F.col("userkey"), account_id().alias("account_id")], out)


def hourly_usage(billing_hours: DataFrame, assets: DataFrame) -> DataFrame:
    """Assets and gigabytes per user, tier and hour.

    The facts have a row per asset and hour, so they join as they are (AQE splits
    a hot asset) and are summed once, before the shuffle and after it.
    """
    owner = assets.select("dbid", "userkey", "db_billing_identity")
    return (
        billing_hours.select("dbid", "hour_of_day", "memory_gb").join(owner, "dbid")
        .groupBy("userkey", "db_billing_identity", "hour_of_day")
        .agg(F.count("*").alias("db_count"), F.sum(numbers.exact(F.col("memory_gb"))).alias("memory_gb"))
    )


def billing_summary(hourly: DataFrame) -> DataFrame:
    """Live hours and gigabyte-hours per user and tier group, and the revenue of the paid group.

    Hours are summed once per user and tier; the groups' wide decimals are summed over these rows only.
    """
    tier, gb = F.col("db_billing_identity"), F.col("_gb")
    groups = {"free": ("Free",), "enterprise": ("Enterprise",), "gds": ("GDS",), "pro": PRO_TIERS}
    price = F.lit(numbers.DOLLARS_PER_GB_HOUR).cast("decimal(4,2)")
    paid = aggs.sum_where(tier.isin(*PRO_TIERS), gb).cast(numbers.EXACT)
    by_tier = hourly.groupBy("userkey", "db_billing_identity").agg(
        F.count("*").alias("_hours"), F.sum(numbers.exact(F.col("memory_gb"))).alias("_gb"))
    return by_tier.groupBy("userkey").agg(
        *[aggs.sum_where(tier.isin(*t), F.col("_hours")).alias(f"live_hours_{n}") for n, t in groups.items()],
        *[aggs.sum_where(tier.isin(*t), gb).cast("double").alias(f"total_gb_hours_{n}") for n, t in groups.items()],
        F.round(paid * price, 2).cast("double").alias("total_revenue_dollars_pro"),
    )
