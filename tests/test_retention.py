import re
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import lifetimes
from cohortline.operators import retention as ret
from cohortline.plans.retention import retention
from cohortline.sources import stand_in as s

COLUMNS = "dbid long, email string, db_created_at timestamp, db_destroyed_at timestamp"


def chain(spark, *lives, as_of="2020-12-15 00:00:00"):
    t = lambda x: datetime.fromisoformat(x) if x else None
    a = spark.createDataFrame([(i, "x@e", t(b), t(d)) for i, (b, d) in enumerate(lives)], COLUMNS)
    return retention(a, "2019-02-05", as_of)


def test_first_month_counts_even_when_everything_was_destroyed(spark):
    parts = chain(spark, ("2020-01-10", "2020-01-12"))
    assert rows(parts["months"], "visit_month") == [(11,)]
    assert rows(parts["backward"], "cust_type") == [("new",)]
    assert rows(parts["forward"], "cust_type") == [("NA",)]


def test_gap_is_churned_forward_and_reactivated_backward(spark):
    parts = chain(spark, ("2020-01-10", "2020-02-12"), ("2020-05-01", None), as_of="2020-06-15 00:00:00")
    assert rows(parts["months"], "visit_month") == [(11,), (15,), (16,)]
    assert rows(parts["backward"], "visit_month", "cust_type") == [(11, "new"), (15, "reactivated"), (16, "retained")]
    assert rows(parts["churn"], "visit_month_orig", "visit_month", "cust_type") == [
        (11, 12, "churned"), (15, 15, "retained"), (16, 16, "NA")]


def test_backward_and_forward_agree(views):
    parts = retention(views.assets(), s.ASSET_START, s.ASSET_AS_OF)
    back = parts["backward"].where("cust_type = 'retained'").selectExpr("email", "visit_month - 1 as visit_month")
    forth = parts["forward"].where("cust_type = 'retained'").select("email", "visit_month")
    assert rows(back) == rows(forth)


def test_assets_outside_the_calendar_are_left_out(spark):
    parts = chain(spark, ("2018-01-10", "2018-03-01"), ("2018-06-01", "2019-03-10"))
    assert rows(parts["log"], "yr", "mnth") == [(2019, 2), (2019, 3)]
    # Created before the calendar: no creation is counted, so only the first month is active.
    assert rows(parts["months"], "visit_month") == [(0,)]


def test_older_rule_has_no_first_month(spark):
    parts = chain(spark, ("2020-01-10", "2020-01-12"))
    assert ret.active_months(parts["history"], first_month_rule=False).count() == 0


def joined_log(assets, start, as_of):
    """The log as a join of live months, created and destroyed counts."""
    on = ["yr", "mnth", "email"]
    months = lifetimes.live_span(assets, start, as_of, "month").select("email", F.explode(F.sequence("first", "last")).alias("m")).distinct()
    months = months.select(F.floor(F.col("m") / 12).cast("int").alias("yr"), (F.col("m") % 12 + 1).alias("mnth"), "email")
    return months.join(ret.create_counts(assets, start, as_of), on, "left").join(ret.destroy_counts(assets, start, as_of), on, "left")


def test_one_stream_equals_the_joined_log(spark, views):
    bad = [(1, "a", "2020-01-05", "2020-03-01"), (1, "a", "2020-01-05", "2020-03-01"), (1, "b", "2020-01-07", None),
           (2, "a", "2020-03-09", "2020-03-02"), (None, "a", "2020-02-01", "2020-02-20"), (3, None, "2020-01-01", "2020-02-01"),
           (4, "a", "2019-01-01", "2020-01-31"), (5, "a", "2020-02-03", "2021-05-01"), (6, "c", None, None), (7, "d", "2018-01-01", "2018-02-01")]
    frame = spark.createDataFrame(bad, "dbid long, email string, c string, d string").select(
        "dbid", "email", F.col("c").cast("timestamp").alias("db_created_at"), F.col("d").cast("timestamp").alias("db_destroyed_at"))
    for assets, start, end in ((frame, "2019-12-15", "2020-04-10 00:00:00"), (views.assets(), s.ASSET_START, s.ASSET_AS_OF)):
        same_rows(ret.create_destroy_log(assets, start, end), joined_log(assets, start, end))


def test_the_history_takes_two_shuffles(views):
    history = ret.cumulative_history(ret.create_destroy_log(views.assets(), s.ASSET_START, s.ASSET_AS_OF))
    months = ret.retention_forward(ret.active_months(history))
    for frame in (history, months):
        assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2


def test_an_email_with_half_of_all_assets_is_spread(spark):
    i = F.col("id")
    assets = spark.range(20000).select(
        i.alias("dbid"), F.when(i % 2 == 0, "hot").otherwise(F.concat(F.lit("e"), i % 300)).alias("email"),
        F.timestamp_seconds(1577836800 + i % 700 * 86400).alias("db_created_at"),
        F.when(i % 3 == 0, F.timestamp_seconds(1577836800 + (i % 700 + 40) * 86400)).alias("db_destroyed_at"))
    same_rows(ret.create_destroy_log(assets, "2020-01-01", "2021-12-01 00:00:00"), joined_log(assets, "2020-01-01", "2021-12-01 00:00:00"))


def test_parts_grow_with_the_assets_and_months_are_listed_behind_them(spark):
    assets = spark.range(500_000).select(
        F.col("id").alias("dbid"), F.concat(F.lit("e"), F.col("id") % 50_000).alias("email"),
        F.lit("2020-01-05").cast("timestamp").alias("db_created_at"), F.lit("2020-02-05").cast("timestamp").alias("db_destroyed_at"))
    log = ret.create_destroy_log(assets, "2020-01-01", "2020-12-01 00:00:00")
    above, *below = log._jdf.queryExecution().executedPlan().toString().split("Exchange")
    assert "explode(sequence" in above and not any("explode(sequence" in b for b in below)
    assert log.rdd.getNumPartitions() >= 5
    assert rows(log.groupBy("yr", "mnth").agg(F.count("*"), F.sum("db_created_count"), F.sum("db_destroyed_count"))) == [
        (2020, 1, 50_000, 500_000, None), (2020, 2, 50_000, None, 500_000)]
    assert ret.active_users(assets, "2020-01-01", "2020-12-01 00:00:00").rdd.getNumPartitions() >= 5


def test_older_counts_take_parts_by_assets_at_every_step(spark, views, monkeypatch):
    """Session partitions would hold a share of all assets each, however many those are."""
    monkeypatch.setattr(ret, "parts_for", lambda assets: 7)
    for frame in (ret.create_counts(views.assets(), s.ASSET_START, s.ASSET_AS_OF), ret.destroy_counts(views.assets(), s.ASSET_START, s.ASSET_AS_OF),
                  ret.active_users(views.assets(), s.ASSET_START, s.ASSET_AS_OF)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan)) == {"7"}


def test_month_counts_take_an_asset_once(spark):
    rows = [(1, "a", 1, 2), (1, "a", 1, 2), (2, "a", 1, None), (3, None, 2, 3), (3, None, 2, 3), (None, "a", 1, 2)]
    at = [f"timestamp_ntz '2000-0{m}-05 10:00:00'" for m in (1, 2, 3)]
    moment = lambda c: F.expr(f"case {c} " + " ".join(f"when {i} then {x}" for i, x in enumerate(at, 1)) + " end").cast("timestamp")
    assets = spark.createDataFrame(rows, "dbid long, email string, b int, d int").select(
        "dbid", "email", moment("b").alias("db_created_at"), moment("d").alias("db_destroyed_at"))
    made = ret.create_counts(assets, "1999-01-01", "2001-01-01 00:00:00")
    gone = ret.destroy_counts(assets, "1999-01-01", "2001-01-01 00:00:00")
    assert {tuple(r) for r in made.collect()} == {(2000, 1, "a", 2), (2000, 2, None, 1)}
    assert {tuple(r) for r in gone.collect()} == {(2000, 2, "a", 1), (None, None, "a", 0), (2000, 3, None, 1)}
