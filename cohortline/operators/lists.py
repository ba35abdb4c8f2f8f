"""Sorted distinct lists per key that may be very long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Values that go to one run of a list, about; a run is what one task sorts.
RUN = 100_000


def sorted_lists(frame: DataFrame, key: str, columns: Sequence[str], sep: str = ",", run: int = RUN) -> DataFrame:
    """``key`` and, for each column, its distinct non-null values, sorted and joined; null when there are none.

    Values are made distinct by key, column and value, which spreads a key of any
    size. They are dealt out in order of all three, so that each task holds a
    stretch of the order; what a task holds of one list is joined there to one
    string, and a list is its strings in order. So no task collects or sorts
    more than a stretch, and only strings meet where a list becomes one cell. A
    null key is a key like any other. Keys without values have no row.
    """
    named = F.inline(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(c).cast("string").alias("_v")) for i, c in enumerate(columns)]))
    values = frame.select(F.col(key), named).where(F.col("_v").isNotNull()).distinct()
    most = max(1, -(-values.count() // run))
    dealt = values.repartitionByRange(most, F.col(key), F.col("_c"), F.col("_v")).withColumn("_p", F.spark_partition_id())
    strings = dealt.groupBy(key, "_c", "_p").agg(F.array_sort(F.collect_list("_v")).alias("_run"))
    strings = strings.select(key, "_c", F.struct(F.col("_p"), F.array_join("_run", sep).alias("text")).alias("_s"))
    lists = strings.groupBy(key, "_c").agg(F.array_sort(F.collect_list("_s")).alias("_s"))
    whole = lists.select(key, "_c", F.array_join("_s.text", sep).alias("_l"))
    return whole.groupBy(key).agg(*[F.max(F.when(F.col("_c") == i, F.col("_l"))).alias(c) for i, c in enumerate(columns)])
