"""The sorted as-of lookup against the join, with one key holding half of all points and very many versions."""

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import asof, lifetimes

POINTS, VERSIONS = 200_000, 100_000


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("hot", [10**9, 4])
def test_equals_the_join(views, closed, hot):
    points = views.billing_hours() if closed else views.assets().select("dbid", F.col("db_created_at").alias("hour_of_day"))
    got = asof.as_of(points, views.size_history(), "hour_of_day", closed=closed, hot=hot, pieces=5)
    same_rows(got, lifetimes.size_as_of(points, views.size_history(), "hour_of_day", closed=closed))


def second(c):
    return F.timestamp_seconds(c.cast("long") + 1_600_000_000)


@pytest.fixture(scope="module")
def hot(spark):
    i = F.col("id")
    key = F.when(i % 2 == 0, 0).otherwise(1 + i % 997)
    points = spark.range(POINTS).select(i.alias("point"), key.alias("dbid"), second(i * 7919 % 1_000_003).alias("moment"))
    # The hot asset changes every 9 seconds and is without a size for 2 of them; the others have two sizes.
    many = spark.range(VERSIONS).select(F.lit(0).cast("long").alias("dbid"), i.cast("double").alias("db_size"),
                                        second(i * 9).alias("ts_effective_from"), second(i * 9 + 7).alias("ts_effective_thru"))
    few = spark.range(2 * 997).select((1 + i % 997).alias("dbid"), i.cast("double").alias("db_size"),
                                      second(F.floor(i / 997) * 500_000).alias("ts_effective_from"),
                                      second((F.floor(i / 997) + 1) * 500_000).alias("ts_effective_thru"))
    return points, many.unionByName(few)


def test_a_hot_key_is_spread(hot):
    points, versions = hot
    rows_ = asof.sequence(points, versions, "moment", "dbid", "db_size", "ts_effective_from", "ts_effective_thru", True)
    bounds = asof.piece_bounds(rows_)
    assert [r[0] for r in bounds.select("_key").collect()] == [0]
    largest = asof.place(rows_, bounds).groupBy("_key", "_piece").count().agg(F.max("count")).first()[0]
    assert largest <= 1.2 * (POINTS / 2 + VERSIONS) / asof.PIECES


def test_a_hot_key_has_the_right_versions(hot):
    points, versions = hot
    got = asof.as_of(points, versions, "moment").select(
        "dbid", (F.unix_seconds("moment") - 1_600_000_000).alias("at"), "db_size", "point")
    at, size = F.col("at"), F.col("db_size")
    change = F.floor(at / 9)
    wanted = F.when((F.col("dbid") == 0) & (change < VERSIONS) & (at % 9 < 7), change).when(
        (F.col("dbid") > 0) & (at < 1_000_000), F.floor(at / 500_000) * 997 + F.col("dbid") - 1)
    assert got.count() == POINTS and got.where(~size.eqNullSafe(wanted.cast("double"))).count() == 0
    assert got.select("point").distinct().count() == POINTS


@pytest.mark.parametrize("hot", [10**9, 3])
def test_cases(spark, hot):
    moment = lambda c: F.col(c).cast("timestamp").alias(c)
    points = spark.createDataFrame(
        [(1, "2020-01-01", "a"), (1, "2020-01-02", "b"), (1, "2020-01-02", "b"), (1, "2020-01-03", "c"), (1, "2019-01-01", "d"), (2, "2020-01-01", "e"),
         (None, "2020-01-01", "f"), (1, None, "g"), (1, "2020-02-01", "h")], "dbid long, t string, name string").select("dbid", moment("t"), "name")
    versions = spark.createDataFrame(
        [(1, 1.0, "2020-01-01", "2020-01-02"), (1, 2.0, "2020-01-02", "2020-01-03"), (1, 9.0, "2020-01-02", "2020-01-02"),
         (1, None, "2020-01-15", "2020-03-01"), (None, 5.0, "2019-01-01", "2021-01-01"), (2, 6.0, None, "2021-01-01"), (2, 7.0, "2019-01-01", None)],
        "dbid long, db_size double, a string, b string").select(
        "dbid", "db_size", F.col("a").cast("timestamp").alias("ts_effective_from"), F.col("b").cast("timestamp").alias("ts_effective_thru"))
    closed = [("a", 1.0), ("b", 2.0), ("b", 2.0), ("c", None), ("d", None), ("e", None), ("f", None), ("g", None), ("h", None)]
    assert rows(asof.as_of(points, versions, "t", hot=hot, pieces=3), "name", "db_size") == sorted(closed, key=repr)
    opened = [("a", None), ("b", 1.0), ("b", 1.0), ("c", 2.0), *closed[4:]]
    # A point at the very end of a version is past it in either form.
    opened[1:4] = [("b", None), ("b", None), ("c", None)]
    assert rows(asof.as_of(points, versions, "t", closed=False, hot=hot, pieces=3), "name", "db_size") == sorted(opened, key=repr)
    for frame in (asof.as_of(points.limit(0), versions, "t"), asof.as_of(points.limit(0), versions.limit(0), "t")):
        assert frame.count() == 0
    assert rows(asof.as_of(points, versions.limit(0), "t"), "db_size") == [(None,)] * 9


def test_long_histories_list_versions_only_within_the_points_months(spark):
    versions = spark.range(3).selectExpr("id as dbid", "id + 0.5D as db_size", "timestamp '2020-01-01' as ts_effective_from",
                                         "timestamp '9999-12-31' as ts_effective_thru")
    points = spark.createDataFrame([(0, "2020-01-01 00:00:00"), (1, "2020-04-05 00:00:00"), (2, None), (7, "2020-02-01 00:00:00")],
                                   "dbid long, c string").selectExpr("dbid", "cast(c as timestamp) as at")
    found = lifetimes.size_as_of(points, versions, "at", long_histories=True)
    assert rows(found, "dbid", "db_size") == rows(lifetimes.size_as_of(points, versions, "at"), "dbid", "db_size")
    # A few bytes to scan, but many rows per version: not to be broadcast.
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" not in found._jdf.queryExecution().toString()
    # Points without any time: an open version is not listed for every month up to the year 9999.
    lone = lifetimes.size_as_of(points.where("at is null"), versions, "at", long_histories=True)
    assert rows(lone, "dbid", "db_size") == [(2, None)]
    assert "Generate" not in lone._jdf.queryExecution().optimizedPlan().toString()
