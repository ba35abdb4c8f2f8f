"""Daily usage kept up by a run per day instead of a rebuild."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from cohortline.operators import lifetimes, usage
from cohortline.sources import commits


def run_days(assets: DataFrame, history: DataFrame, out: str, through: date | str, after: date | str | None = None) -> str:
    """Commit what the days after ``after`` and up to ``through`` change, as the run of ``through``.

    The first run has no ``after`` and loads everything; a daily run names the
    day before. Its work grows with the day's changes, not with the table. A
    repeated day replaces its earlier run, so it changes nothing.
    """
    frames = usage.usage_changes(assets, lifetimes.check_versions(history), after, through)
    return commits.commit(assets.sparkSession, out, through, frames)


def runs(spark: SparkSession, out: str, as_of: datetime | str) -> DataFrame:
    """The usage runs of all committed days, as :func:`usage.usage_runs` would give them as of that moment."""
    return usage.runs_of_changes(commits.read(spark, out, "edges"), commits.read(spark, out, "owners"), as_of)


def table(spark: SparkSession, out: str, as_of: datetime | str) -> DataFrame:
    """The daily usage table of all committed days; users of single days or months read it through their own filter."""
    return usage.expand_days(runs(spark, out, as_of))
