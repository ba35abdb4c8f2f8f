"""Calendar spines. A spine is bounded by its dates, never by the data volume."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortline.functions import times


def day_spine(spark: SparkSession, start: date | str, as_of: datetime | str) -> DataFrame:
    """``calendar_dt``: midnight of every day from ``start`` to the day of ``as_of``."""
    first, last = times.moment(start).date(), times.moment(as_of).date()
    if first > last:
        return spark.createDataFrame([], "calendar_dt timestamp")
    days = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("_d")).select(F.col("_d").cast("timestamp").alias("calendar_dt"))


def period_end_spine(spark: SparkSession, start: date | str, as_of: datetime | str, unit: str) -> DataFrame:
    """``calculated_date``: last second of each period whose closing midnight is in [start, as_of)."""
    t = times.moment(start)
    at = (t.date() - date(1970, 1, 1)).days if unit == "day" else t.year * 12 + t.month - 1
    opens = t == times.moment(t.date() if unit == "day" else t.date().replace(day=1))
    first = at - 1 if opens else at
    return spark.range(first, times.last_closed_position(unit, as_of) + 1).select(
        times.period_end(unit, F.col("id").cast("int")).alias("calculated_date")
    )


def day_spine_over(frame: DataFrame, column: str, as_of: datetime | str) -> DataFrame:
    """Day spine starting at the earliest date found in ``frame.column``."""
    first = frame.agg(F.min(F.to_date(column)).alias("first"))
    last = F.lit(times.moment(as_of).date())
    days = first.where(F.col("first") <= last).select(
        F.explode(F.sequence("first", last, F.expr("INTERVAL 1 DAY"))).alias("_d")
    )
    return days.select(F.col("_d").cast("timestamp").alias("calendar_dt"))


def period_ends_over(frame: DataFrame, column: str, as_of: datetime | str, unit: str) -> DataFrame:
    """Period-end spine starting with the period of the earliest ``frame.column``."""
    last = F.lit(times.last_closed_position(unit, as_of))
    first = frame.agg(times.position(unit, F.min(column)).alias("first"))
    positions = first.where(F.col("first") <= last).select(F.explode(F.sequence("first", last)).alias("_p"))
    return positions.select(times.period_end(unit, F.col("_p")).alias("calculated_date"))
