"""A day of logs as one commit, and the streamed minutes with exact users."""

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import querylog as ql
from cohortline.plans import logs
from cohortline.sources import commits, stand_in as s
from cohortline.streaming.rollup import minute_rollup

NAMES = ("structured_log", *logs.SUMMARIES)
DAY = "2024-01-15"


def state(spark, out):
    return {n: rows(commits.read(spark, out, n)) for n in NAMES}


@pytest.mark.parametrize("failing", range(5))
def test_a_run_that_fails_leaves_the_day_whole(spark, views, tmp_path, monkeypatch, failing):
    out, sources = str(tmp_path), views.query_logs()
    logs.commit_day(sources, DAY, out, s.CLIENTS)
    before = state(spark, out)
    assert all(before.values())
    written, put, publish = [], commits.put, commits.publish

    def broken(*a):
        if len(written) == failing:
            raise OSError("lost")
        written.append(a)
        return (put if len(a) == 5 else publish)(*a)

    monkeypatch.setattr(commits, "put", broken)
    monkeypatch.setattr(commits, "publish", broken)
    with pytest.raises(OSError):
        logs.commit_day([t.limit(5) for t in sources], DAY, out, s.CLIENTS)
    assert state(spark, out) == before
    monkeypatch.undo()
    logs.commit_day([t.where("false") for t in sources], DAY, out, s.CLIENTS)
    assert not any(state(spark, out).values())


def test_days_and_reruns(spark, views, tmp_path):
    out = str(tmp_path)
    runs = [logs.commit_day(views.query_logs(), day, out, s.CLIENTS) for day in ("2024-01-14", DAY, DAY)]
    assert len(set(runs)) == 3 and {(str(r[0]), r[1]) for r in commits.current(spark, out).collect()} == {("2024-01-14", runs[0]), (DAY, runs[2])}
    log = ql.structured_log(ql.extract_logs(views.query_logs(), DAY), s.CLIENTS)
    same_rows(commits.read(spark, out, "minute_stats").where(F.col("log_date") == DAY).drop("log_date"), ql.minute_stats(log))
    plan = commits.read(spark, out, "minute_stats", ql.minute_stats(log).schema)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_commit_of_any_tables(spark, tmp_path):
    out = str(tmp_path)
    for n in (3, 1):
        commits.commit(spark, out, DAY, {"a": spark.range(n), "b": spark.range(n).selectExpr("id * 2 as id")})
    assert rows(commits.read(spark, out, "a"), "id") == rows(commits.read(spark, out, "b"), "id") == [(0,)]
    assert commits.current(spark, str(tmp_path / "new")).count() == 0


def test_streamed_minutes_count_users_exactly(spark, views, tmp_path):
    log = ql.structured_log(ql.extract_logs(views.query_logs()), s.CLIENTS)
    path = str(tmp_path / "in")
    # Every row three times with names that only differ at times: repeated users must count once.
    more = log.withColumn("username", F.concat(F.coalesce("username", F.lit("x")), F.lit("2")))
    log.unionByName(log).unionByName(more).orderBy("timestamp").coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(log.schema).parquet(path)
    query = (
        minute_rollup(stream).writeStream.format("memory").queryName("exact_minutes").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).start()
    )
    query.processAllAvailable()
    query.stop()
    stored = spark.read.parquet(path)
    got, wanted = spark.table("exact_minutes"), ql.minute_stats(stored)
    assert got.count() > 0 and got.where("named_users > 1").count() > 0
    assert set(rows(got, "minute", "dbid", "named_users")) <= set(rows(wanted, "minute", "dbid", "named_users"))
    assert rows(minute_rollup(stored), "minute", "dbid", "named_users") == rows(wanted, "minute", "dbid", "named_users")
