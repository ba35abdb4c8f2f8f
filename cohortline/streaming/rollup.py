"""Per-minute query statistics over a stream of structured log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortline.operators.querylog import MICROS, RESOURCES, log_measures, resource_total

STATES = ("submitted", "completed")


def minute_rollup(log: DataFrame, late: str = "10 minutes", fix_errors: bool = False) -> DataFrame:
    """Every additive measure of the minute statistics and the exact number of users, per closed minute and asset.

    Two stateful steps follow each other: measures are summed per minute, asset
    and user, and when the watermark closes a minute its users are counted and
    their measures summed per asset. Append mode: a minute is emitted once, after
    the watermark passes its end; rows later than ``late`` are dropped by the
    watermark. State is one row of fixed size per open minute, asset and user,
    and a hot asset's state is spread over its users. Works on a batch frame as
    well.
    """
    measures = log_measures(fix_errors)
    stamped = log.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    per_user = (
        stamped.withWatermark("timestamp", late)
        .groupBy(F.window("timestamp", "1 minute").alias("_user_minute"), "dbid", "username")
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    rows = (
        per_user.groupBy(F.window(F.window_time("_user_minute"), "1 minute").alias("_w"), "dbid")
        .agg(*[F.sum(n).alias(n) for n in measures], F.count("username").alias("named_users"))
    )
    resources = {f"{state}_{r}" for state in STATES for r in RESOURCES}
    renamed = {f"{state}_direct": f"{state}_direct_queries" for state in STATES}
    return rows.select(
        F.col("_w.start").alias("minute"), "dbid",
        *[resource_total(n) if n in resources else F.col(n).alias(renamed.get(n, n)) for n in measures if not n.endswith(MICROS)],
        "named_users",
    )
