"""One key holds a third of all rows: results against the plain form, and plans without row multiplication."""

import pytest
from pyspark.sql import functions as F

from conftest import same_rows
from cohortline.operators import attribution as at
from cohortline.operators import billing, lists, milestones, querylog as ql
from cohortline.operators import events as ev
from cohortline.operators import identity as ids

N = 30000


@pytest.fixture(scope="module")
def hot(spark):
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).otherwise(i % 500)
    return spark.range(N).select(
        key.alias("dbid"), F.concat(F.lit("d"), key).alias("distinct_id"),
        F.concat(F.lit("u"), key % 40, F.lit("@e")).alias("email_address"),
        F.concat(F.lit("n"), i % 7).alias("username"), (i % 1440 * 60).alias("time"),
        F.timestamp_seconds(i % 1440 * 60).alias("timestamp"), F.timestamp_seconds(i % 1440 * 60).alias("minute"),
        F.timestamp_seconds(F.floor(i / 1000) * 3600).alias("hour_of_day"), (i % 5).cast("double").alias("memory_gb"),
        F.concat(F.lit("v"), i).alias("value"), F.when(i % 2 == 0, "start").otherwise("commit").alias("event"),
        F.lit("user-direct").alias("query_submission_type"), F.lit("MATCH (n)").alias("query"),
        *[F.lit(None).cast("string").alias(c) for c in ("failurereason", "stacktrace", "exception", "driver_name", "driver_version")],
        *[(i % 9).cast("double").alias(c) for c in ("elapsedtimems", "allocatedbytes", "pagehits", "pagefaults")],
    )


@pytest.fixture(scope="module")
def owners(spark):
    i = F.col("id")
    return spark.range(500).select(i.alias("dbid"), (i % 20).alias("userkey"), F.when(i % 2 == 0, "Free").otherwise("GCP").alias("db_billing_identity"))


def test_first_touch_by_email(hot):
    pairs = hot.select("distinct_id", "email_address").distinct()
    got = at.first_touch_by_email(hot, pairs, ["value"])
    plain = hot.groupBy(F.col("email_address").alias("email")).agg(F.min(F.struct("time", "value")).alias("s"))
    same_rows(got, plain.select("email", F.col("s.value").alias("value")))


def test_hourly_usage(hot, owners):
    plain = hot.join(owners, "dbid").groupBy("userkey", "db_billing_identity", "hour_of_day").agg(
        F.count("*").alias("db_count"), F.sum("memory_gb").cast("decimal(38,6)").alias("memory_gb"))
    same_rows(billing.hourly_usage(hot, owners), plain)


def test_first_milestone(hot, owners):
    got = milestones.first_milestone(owners, hot, "first", F.col("event") == "commit").select("userkey", "first", "first_free")
    plain = hot.where("event = 'commit'").join(owners, "dbid").groupBy("userkey").agg(
        F.min("minute").alias("first"), F.min(F.when(F.col("db_billing_identity") == "Free", F.col("minute"))).alias("first_free"))
    same_rows(got, plain)


def test_minute_stats(hot):
    got = ql.minute_stats(hot)
    plain = hot.groupBy(F.date_trunc("MINUTE", "timestamp").alias("minute"), "dbid").agg(
        F.count(F.when(F.col("event") == "start", 1)).alias("submitted_queries"), F.countDistinct("username").alias("named_users"),
        F.array_join(F.array_sort(F.collect_set("username")), ",").alias("userlist"),
        F.sum(F.when(F.col("event") == "commit", F.col("elapsedtimems")).otherwise(0)).cast("long").alias("completed_millis"))
    same_rows(got.select(plain.columns), plain)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_identity_weights_count_map_rows(hot):
    log = hot.select("distinct_id", "email_address", F.col("username").alias("user_id"), F.col("username").alias("distinct_id_before_identity"))
    full = ids.identity_map(log)
    same_rows(ids.email_weights(full), full.groupBy("distinct_id", "email_address").agg(F.count("*").alias("weight")))


def test_exclusion_keeps_whole_results(hot):
    flags = hot.select("distinct_id", "value")
    exclude = hot.where("dbid % 2 = 0").select("distinct_id")
    got = ev.without(flags, exclude, "distinct_id")
    same_rows(got.groupBy("distinct_id").count(), hot.where("dbid % 2 = 1").groupBy("distinct_id").count())


@pytest.mark.parametrize("key", ["hot", None])
def test_a_key_with_a_million_values_has_its_whole_list(spark, key):
    i = F.col("id")
    frame = spark.range(1_000_000).select(F.lit(key).cast("string").alias("email"), F.concat(F.lit("v"), i).alias("v"), (i % 3).alias("w"))
    frame = frame.unionByName(spark.range(4000).select(F.concat(F.lit("e"), i % 10).alias("email"), F.concat(F.lit("x"), i % 40).alias("v"), F.lit(None).alias("w")))
    got = {r.email: (r.v, r.w) for r in lists.sorted_lists(frame, "email", ["v", "w"], run=70_000).collect()}
    assert got.pop(key) == (",".join(sorted(f"v{n}" for n in range(1_000_000))), "0,1,2")
    assert got == {f"e{n}": (",".join(sorted(f"x{m}" for m in range(n, 40, 10))), None) for n in range(10)}


def test_no_task_sorts_a_whole_list(spark):
    frame = spark.range(200_000).select(F.lit("hot").alias("email"), F.concat(F.lit("v"), "id").alias("v"))
    dealt = frame.distinct().repartitionByRange(20, "email", "v").groupBy(F.spark_partition_id().alias("p")).count()
    assert dealt.count() == 20 and dealt.agg(F.max("count")).first()[0] < 20_000
