"""Several tables written as one commit: runs are written apart, and one manifest row makes a run's tables the day's."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cohortline.sources.tables import DAY

RUN = "run"
MANIFEST = "_manifest"
_SCHEMA = T.StructType([T.StructField(DAY, T.DateType()), T.StructField(RUN, T.StringType()), T.StructField("number", T.LongType())])


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """Every published run: day, run, and its number; empty before the first."""
    spark.createDataFrame([], _SCHEMA).write.mode("ignore").parquet(f"{out}/{MANIFEST}")
    return spark.read.schema(_SCHEMA).parquet(f"{out}/{MANIFEST}")


def current(spark: SparkSession, out: str) -> DataFrame:
    """The run of each day that was published last: one row per day."""
    newest = Window.partitionBy(DAY).orderBy(F.col("number").desc(), F.col(RUN).desc())
    return manifest(spark, out).withColumn("_n", F.row_number().over(newest)).where("_n = 1").select(DAY, RUN)


def new_run() -> str:
    return uuid.uuid4().hex


def put(frame: DataFrame, out: str, name: str, day: date | str, run: str) -> DataFrame:
    """Write one table of a run, unseen until the run is published, and return it as written."""
    path = f"{out}/{name}/{DAY}={day}/{RUN}={run}"
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def publish(spark: SparkSession, out: str, day: date | str, run: str) -> None:
    """Make the run's tables the day's, all at once: a reader finds the manifest row or does not.

    The row is one file, which Spark's writer moves into place as a whole. One
    writer per day at a time.
    """
    number = manifest(spark, out).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    row = spark.createDataFrame([(str(day), run, number)], "day string, run string, number long")
    row.select(F.col("day").cast("date").alias(DAY), RUN, "number").coalesce(1).write.mode("append").parquet(f"{out}/{MANIFEST}")


def read(spark: SparkSession, out: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A table as published: of every day the current run, and nothing of runs that failed or were replaced.

    The manifest has a row per run and is broadcast by its size, which prunes the
    folders of other runs before they are read.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, *_SCHEMA.fields[:2]]))
    return reader.parquet(f"{out}/{name}").join(current(spark, out), [DAY, RUN], "left_semi").drop(RUN)


def commit(spark: SparkSession, out: str, day: date | str, frames: Mapping[str, DataFrame]) -> str:
    """Write all tables of a day as a new run and publish it; on an error the day stays as it was."""
    run = new_run()
    for name, frame in frames.items():
        put(frame, out, name, day, run)
    publish(spark, out, day, run)
    return run
