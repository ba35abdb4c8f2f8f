"""Table scans and sinks, with one rule each for what a second run does."""

from __future__ import annotations

import re
import tempfile
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

DAY = "log_date"


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def scan_tenant(spark: SparkSession, name: str, tenant: str) -> DataFrame:
    """One tenant's rows; the comparison reaches the Parquet scan."""
    return scan(spark, name).where(F.col("project_id") == tenant)


def scan_day(spark: SparkSession, name: str, day: date | str, day_column: str = DAY) -> DataFrame:
    """One day of a table partitioned by day; other partitions are not listed."""
    return scan(spark, name).where(F.col(day_column) == F.lit(str(day)).cast("date"))


def replace(frame: DataFrame, path: str) -> None:
    """Write in place of whatever was there."""
    frame.write.mode("overwrite").parquet(path)


def create(frame: DataFrame, path: str) -> None:
    """Write a new table; fails if there is one already."""
    frame.write.mode("errorifexists").parquet(path)


def create_if_absent(frame: DataFrame, path: str) -> None:
    """Write a new table; leaves an existing one as it is."""
    frame.write.mode("ignore").parquet(path)


def put_bucketed(frame: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write in place of the table ``name`` at ``path``, one file per bucket of ``key``, and return the table.

    Tables with the same number of buckets join by the key without a shuffle.
    """
    (
        frame.repartition(buckets, key)
        .write.format("parquet").mode("overwrite").option("path", path)
        .bucketBy(buckets, key).sortBy(key)
        .saveAsTable(name)
    )
    return frame.sparkSession.table(name)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="cohortline-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def put_day(frame: DataFrame, path: str, day: date | str, day_column: str = DAY) -> None:
    """Put one day in place of that day of a table partitioned by day.

    ``frame`` has no day column. The day becomes exactly ``frame``: without rows
    it is written as an empty day with its schema, and what a run before left is gone.
    """
    frame.write.mode("overwrite").parquet(f"{path}/{day_column}={day}")


def put_days(frame: DataFrame, path: str, day_column: str = DAY) -> None:
    """Add whole days to a table partitioned by day.

    Days in ``frame`` replace the same days in the table and other days stay,
    so running a day twice does not count it twice. A day without any row in
    ``frame`` is left as it was; :func:`put_day` empties it.
    """
    (
        frame.write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_column)
        .mode("overwrite")
        .parquet(path)
    )
