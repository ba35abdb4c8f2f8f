from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.functions import numbers
from cohortline.operators import querylog as ql
from cohortline.sources import stand_in as s

DRIVERS = [
    ("pydriver/4.2 Python/3.8 (linux)", "s", "pydriver", "4.2"),
    ("a/b/c", "s", None, None),  # two slashes, other shape
    ("godriver/1.8", "s", "godriver", "1.8"),
    ("godriver/1.8\n", "s", None, None),  # a trailing newline is not the end of the text
    ("old driver 1.1", "s", "1.1", "1.1"),
    ("a/b/c/d e", "s", "e", "e"),
    (None, "embedded-session", "embedded-session", "NA"),
    ("plain", "embedded-session", "embedded-session", "NA"),
    ("my-service-registry", "s", "my-service-registry", "NA"),
    ("plain", "s", None, None),
    (None, None, None, None),
]
NOTES = [
    ("{type: 'user-direct', app: 'c_v1'}", ("type", "user-direct", "app", "c_v1")),
    ("{app: 'c_v1', type: 'system'}", ("app", "c_v1", "type", "system")),
    ("{}", (None,) * 4), (None, (None,) * 4), ("{type: 'x'}", (None,) * 4),
    ("{type: '', app: 'a'}", ("type", "", "app", "a")),
]


@pytest.mark.parametrize("info, session, name, version", DRIVERS)
def test_parse_driver(spark, info, session, name, version):
    frame = spark.createDataFrame([(info, session)], "info string, session string")
    assert tuple(frame.select(*ql.parse_driver(F.col("info"), F.col("session"))).first()) == (name, version)


@pytest.mark.parametrize("note, parts", NOTES)
def test_parse_annotation(spark, note, parts):
    frame = spark.createDataFrame([(note,)], "a string")
    assert tuple(frame.select(*ql.parse_annotation(F.col("a"))).first()) == parts


def test_submission(spark):
    frame = spark.createDataFrame([
        ("monitor", "0.9 beta", "{}", None, None, None, None),
        ("d", "1", "x", "type", "user-direct", "app", "c"),
        ("d", "1", "x", "app", "c", "type", "system"),
        ("d", "1", "{}", None, None, None, None),
        (None, None, None, None, None, None, None),
    ], "driver_name string, driver_version string, annotationdata string, field1_key string, field1_val string, field2_key string, field2_val string")
    kind, app = ql.submission()
    assert [tuple(r) for r in frame.select(kind, app).collect()] == [
        ("user-action", "monitor_0.9"), ("user-direct", "c"), ("system", "c"), ("user-direct", None), (None, None)]


LOG = ("timestamp timestamp, dbid long, username string, event string, query_submission_type string, query string, "
       "failurereason string, exception string, stacktrace string, elapsedtimems double, allocatedbytes double, "
       "pagehits double, pagefaults double, driver_name string, driver_version string")


def log_of(spark, *entries):
    base = dict(dbid=1, username="ann", event="start", kind="user-direct", query="MATCH (n)", failure=None, trace=None, ms=1.0)
    made = []
    for e in entries:
        r = base | e
        exception = r["trace"].split(":")[0] if r["trace"] else None
        made.append((datetime(2024, 1, 1, 0, 0, 30), r["dbid"], r["username"], r["event"], r["kind"], r["query"], r["failure"],
                     exception, r["trace"], r["ms"], 1.0, 1.0, 1.0, "d", "1"))
    return spark.createDataFrame(made, LOG)


def test_minute_stats_rounding_zero_denominator_and_names(spark):
    log = log_of(spark, {"ms": 1.25}, {"ms": 1.25, "query": "a\nb\nload CSV x", "username": None}, {"username": "bob", "query": "x match y\n"})
    r = ql.minute_stats(log).first()
    assert r["submitted_queries"] == 3 and r["submitted_millis"] == 4  # 3.5 rounds up
    assert r["imputed_submitted_query_lines"] == 6 and r["imputed_avg_lines_per_submitted_query"] == 2.0
    assert (r["completed_queries"], r["imputed_avg_lines_per_completed_query"], r["completed_millis"]) == (0, 0.0, 0)
    assert (r["named_users"], r["userlist"]) == (2, "ann,bob")
    assert (r["imputed_load_statements"], r["imputed_match_lines"]) == (1, 2)  # matched in lower case


def test_minute_stats_errors(spark):
    log = log_of(spark, {"event": "commit", "failure": "f", "trace": "E: x\ny"}, {"event": "commit", "username": None}, {"failure": "f"})
    r = ql.minute_stats(log).first()
    assert (r["completed_errors"], r["total_submit_errors"], r["exceptions"], r["stacktrace_lines"], r["error_message_characters"]) == (0, 1, 1, 2, 1)
    assert ql.minute_stats(log, fix_errors=True).first()["completed_errors"] == 1
    assert ql.agent_minutes(log, "commit").first()["completed_errors"] == 0
    assert ql.agent_minutes(log, "commit", fix_errors=True).first()["completed_errors"] == 1
    with pytest.raises(ValueError):
        ql.agent_minutes(log, "other")


def test_no_names_gives_a_null_list(spark):
    r = ql.minute_stats(log_of(spark, {"username": None})).first()
    assert (r["named_users"], r["userlist"]) == (0, None)


def test_day_filter_reaches_the_scan(spark, views, tmp_path):
    path = str(tmp_path / "log")
    views.query_logs()[0].write.parquet(path)
    log = spark.read.parquet(path)
    day = ql.extract_log(log, "2024-01-15")
    assert "PushedFilters" in day._jdf.queryExecution().executedPlan().toString()
    same_rows(day, ql.extract_log(log).where(F.to_date("timestamp") == "2024-01-15"))


def test_resources_are_summed_without_decimals(views):
    log = ql.structured_log(ql.extract_logs(views.query_logs()), s.CLIENTS)
    for frame in (ql.minute_stats(log), ql.agent_minutes(log, "start"), ql.agent_minutes(log, "commit")):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "decimal" not in plan


def test_totals_round_half_away_from_zero(spark):
    values = [[2.5], [-2.5], [1.25, 1.25], [-1.25, -1.25], [0.1] * 10, [-0.4, -0.1], [2.4999994], [1e12 + 0.5, 0.25], [-3.5, 1.0], [None, 1.5], [None]]
    frame = spark.createDataFrame([(i, x) for i, v in enumerate(values) for x in v], "k int, x double")
    whole, micros = numbers.whole_and_micros(F.col("x"))
    got = frame.groupBy("k").agg(F.sum(whole).alias("w"), F.sum(micros).alias("m")).select("k", numbers.rounded_total(F.col("w"), F.col("m")))
    assert dict(got.collect()) == {0: 3, 1: -3, 2: 3, 3: -3, 4: 1, 5: -1, 6: 2, 7: 10**12 + 1, 8: -3, 9: 2, 10: None}
