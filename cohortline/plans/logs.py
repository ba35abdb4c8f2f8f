"""One day of query logs: parse once, write, and summarise what was written."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from cohortline.operators import querylog as ql
from cohortline.sources import commits, tables

SUMMARIES = ("minute_stats", "agent_submissions", "agent_completions")


def summaries(log: DataFrame, fix_errors: bool = False) -> dict[str, DataFrame]:
    """The three per-minute summaries of a structured log."""
    return {
        "minute_stats": ql.minute_stats(log, fix_errors=fix_errors),
        "agent_submissions": ql.agent_minutes(log, "start"),
        "agent_completions": ql.agent_minutes(log, "commit", fix_errors=fix_errors),
    }


def run_day(
    sources: Sequence[DataFrame], day: date | str, out: str, rules: ql.ClientRules = ql.ClientRules(),
    day_column: str | None = None, version_field: str = "dbversion",
) -> None:
    """Write the day's structured log and its summaries under ``out``.

    The parse is written before it is summarised three times: it is computed
    once, and a lost executor costs a re-read instead of a re-parse. A second
    run of the same day replaces the first, also when the day now has no rows.
    """
    spark = sources[0].sparkSession
    parsed = ql.structured_log(ql.extract_logs(sources, day, day_column, version_field), rules)
    tables.put_day(parsed, f"{out}/structured_log", day)
    log = spark.read.schema(parsed.schema).parquet(f"{out}/structured_log/{tables.DAY}={day}")
    for name, frame in summaries(log).items():
        tables.put_day(frame, f"{out}/{name}", day)


def commit_day(
    sources: Sequence[DataFrame], day: date | str, out: str, rules: ql.ClientRules = ql.ClientRules(),
    day_column: str | None = None, version_field: str = "dbversion", fix_errors: bool = False,
) -> str:
    """:func:`run_day` as one commit, read by ``commits.read``: readers see all four tables of a run or none.

    A run that fails at any point leaves the day as the last published run made
    it. A second run of a day replaces the first for readers, also when the day
    now has no rows.
    """
    spark, run = sources[0].sparkSession, commits.new_run()
    parsed = ql.structured_log(ql.extract_logs(sources, day, day_column, version_field), rules)
    log = commits.put(parsed, out, "structured_log", day, run)
    for name, frame in summaries(log, fix_errors).items():
        commits.put(frame, out, name, day, run)
    commits.publish(spark, out, day, run)
    return run
