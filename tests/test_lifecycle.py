import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import billing, calendar, cohorts, intervals, lifecycle, lifetimes, usage
from cohortline.sources import stand_in as s

ASSET = ("dbid long, userkey string, email string, email_domain string, user_classification string, "
         "db_billing_identity string, db_created_at timestamp, db_destroyed_at timestamp")
COMPANY, PRIVATE = "External Company User", "External Private User"
OPEN_END = datetime(9999, 12, 31)


def t(text):
    return datetime.fromisoformat(text) if text else None


def assets_of(spark, *lives, user="u", kind=COMPANY):
    made = [(i, user, f"{user}@e", "e", kind, tier, t(a), t(b)) for i, (tier, a, b) in enumerate(lives)]
    return spark.createDataFrame(made, ASSET)


def history_of(assets, mb=1024.0):
    return assets.select("dbid", F.lit(mb).alias("db_size"), F.col("db_created_at").alias("ts_effective_from"),
                         F.lit(OPEN_END).alias("ts_effective_thru"))


def states(spark, *lives, as_of="2020-12-01 00:00:00", group="free"):
    a = assets_of(spark, *lives)
    out = lifecycle.lifecycle_status(a, history_of(a), as_of).orderBy("as_of_date")
    return [(r["as_of_date"].month, r[f"num_{group}_db"], r[f"{group}_status"]) for r in out.collect()]


def test_new_recurring_churn(spark):
    assert states(spark, ("Free", "2020-01-10 00:00:00", "2020-03-15 00:00:00")) == [
        (1, 1, "New"), (2, 1, "Recurring"), (3, -1, "Churn")]


def test_return_next_month_is_recurring(spark):
    out = states(spark, ("Free", "2020-01-10 00:00:00", "2020-03-15 00:00:00"), ("Free", "2020-04-10 00:00:00", "2020-05-15 00:00:00"))
    assert out == [(1, 1, "New"), (2, 1, "Recurring"), (3, -1, "Churn"), (4, 1, "Recurring"), (5, -1, "Churn")]


def test_return_after_a_gap_is_reactivating_with_dormant_between(spark):
    out = states(spark, ("Free", "2020-01-10 00:00:00", "2020-02-15 00:00:00"), ("Free", "2020-05-10 00:00:00", "2020-06-15 00:00:00"))
    assert out == [(1, 1, "New"), (2, -1, "Churn"), (3, 0, "Dormant"), (4, 0, "Dormant"), (5, 1, "Reactivating"), (6, -1, "Churn")]


def test_created_in_last_two_hours_of_month_has_null_first_row(spark):
    out = states(spark, ("Free", "2020-01-31 22:30:00", "2020-03-15 00:00:00"))
    assert out[0] == (1, 0, None)
    assert out[1][:2] == (2, 1) and out[1][2] == "Recurring"


def test_same_month_assets_and_internal_users_do_not_count(spark):
    assert states(spark, ("Free", "2020-01-10 00:00:00", "2020-01-20 00:00:00")) == []
    internal = assets_of(spark, ("Free", "2020-01-10 00:00:00", None), kind="Internal")
    assert lifecycle.lifecycle_status(internal, history_of(internal), "2020-12-01 00:00:00").count() == 0


def test_live_asset_runs_to_the_last_closed_month(spark):
    out = states(spark, ("GCP", "2020-09-10 00:00:00", None), as_of="2020-12-01 00:00:00", group="gcp")
    assert [m for m, *_ in out] == [9, 10]


def test_pro_group_sums_direct_and_gcp(spark):
    a = assets_of(spark, ("GCP", "2020-01-10 00:00:00", None), ("Direct", "2020-01-11 00:00:00", None))
    feb = lifecycle.lifecycle_status(a, history_of(a), "2020-12-01 00:00:00").where("month(as_of_date) = 2").first()
    assert (feb["num_pro_db"], feb["num_gcp_db"], feb["num_direct_db"], feb["num_free_db"]) == (2, 1, 1, 0)
    assert (feb["num_pro_mrr"], feb["num_pro_gb"]) == (129.6, 2.0)


def test_two_accounts_of_one_user_fan_out(spark):
    a = assets_of(spark, ("Free", "2020-01-10 00:00:00", None)).unionByName(
        assets_of(spark, ("Free", "2020-01-10 00:00:00", None), kind=PRIVATE).withColumn("dbid", F.lit(9).cast("long")))
    out = lifecycle.lifecycle_status(a, history_of(a), "2020-12-01 00:00:00").where("month(as_of_date) = 2")
    # Two ranges meet two account rows; equal ranges double each account's count.
    assert rows(out, "account_id", "num_free_db") == [("e", 2), ("e", 2), ("u", 2), ("u", 2)]


def test_one_row_per_user_month(views):
    out = lifecycle.lifecycle_status(views.assets(), views.size_history(), s.ASSET_AS_OF)
    assert out.count() == out.select("email", "userkey", "as_of_date").distinct().count()


def test_size_as_of_bounds(spark):
    history = spark.createDataFrame([(1, 10.0, t("2020-01-01 00:00:00"), t("2020-01-02 00:00:00"))],
                                    "dbid long, db_size double, ts_effective_from timestamp, ts_effective_thru timestamp")
    points = spark.createDataFrame([(1, t("2020-01-01 00:00:00")), (1, t("2020-01-01 12:00:00")), (1, t("2020-01-02 00:00:00"))], "dbid long, at timestamp")
    sizes = lambda closed: [r["db_size"] for r in lifetimes.size_as_of(points, history, "at", closed).orderBy("at").collect()]
    assert sizes(True) == [10.0, 10.0, None]
    assert sizes(False) == [None, 10.0, None]


def test_size_as_of_by_month_equals_by_asset(views):
    points, history = views.billing_hours(), views.size_history()
    for closed in (True, False):
        same_rows(lifetimes.size_as_of(points, history, "hour_of_day", closed, long_histories=True),
                  lifetimes.size_as_of(points, history, "hour_of_day", closed))


def test_tenure_has_no_churn_while_anything_is_live(spark):
    gone = assets_of(spark, ("Free", "2020-01-01 00:00:00", "2020-02-01 00:00:00"), ("GCP", "2020-01-05 00:00:00", "2020-03-01 00:00:00"))
    r = lifetimes.tenure_range(gone, ["userkey"], lifetimes.TIER_GROUPS).first()
    assert (r["churn_date"], r["free_churn_date"], r["direct_start_date"], r["direct_churn_date"]) == (date(2020, 3, 1), date(2020, 2, 1), None, None)
    live = gone.unionByName(assets_of(spark, ("Free", "2020-01-02 00:00:00", None)))
    r = lifetimes.tenure_range(live, ["userkey"], lifetimes.TIER_GROUPS).first()
    assert (r["churn_date"], r["free_churn_date"], r["gcp_churn_date"]) == (None, None, date(2020, 3, 1))


def test_daily_live_assets_equals_the_range_join(spark, views):
    a = views.assets().where("dbid < 200")
    days = calendar.day_spine(spark, s.ASSET_START, s.ASSET_AS_OF)
    end = F.coalesce("db_destroyed_at", F.lit(s.ASSET_AS_OF).cast("timestamp"))
    joined = days.join(a, (F.col("calendar_dt") >= F.date_trunc("DAY", "db_created_at")) & (F.col("calendar_dt") <= F.date_trunc("DAY", end)))
    same_rows(lifetimes.daily_live_assets(a, s.ASSET_START, s.ASSET_AS_OF).select("calendar_dt", "dbid"), joined.select("calendar_dt", "dbid"))


def test_daily_usage_whole_rows_equal_the_exploded_form(views):
    """The sweep against a row per asset and day, without totals."""
    a = views.assets().where("dbid < 300")
    got = usage.daily_usage(a, views.size_history(), s.ASSET_AS_OF)
    live = lifetimes.daily_live_assets(a.where("db_billing_identity in ('Free', 'Direct', 'GCP')"), "1995-01-01", s.ASSET_AS_OF)
    day_end = F.col("calendar_dt") + F.expr("INTERVAL 86399 SECONDS")
    live = live.withColumn("at", day_end).where((F.col("at") > F.col("db_created_at")) & (F.to_date("calendar_dt") < "2001-08-31"))
    sized = lifetimes.size_as_of(live, views.size_history(), "at", closed=False)
    day, died = F.to_date("calendar_dt"), F.col("db_destroyed_at")
    old = F.timestamp_diff("DAY", F.col("db_created_at"), died) > 0
    kept = old & (F.to_date(died) > day)
    one = lambda c: F.sum(F.when(c, 1))
    want = sized.groupBy(day.alias("as_of_date"), "email", "userkey", lifetimes.account_id().alias("account_id"), "user_classification", "db_billing_identity").agg(
        F.count("*").alias("total_db"), one(kept).alias("qualified_db"), F.sum(F.when(kept, F.col("db_size") / 1024)).alias("qualified_gb"),
        one(old & (F.to_date(died) == day)).alias("qualified_db_deleted"), one(old & (F.to_date("db_created_at") == day)).alias("qualified_db_new"))
    same_rows(got, want)
    runs = usage.usage_runs(a, views.size_history(), s.ASSET_AS_OF)
    same_rows(usage.live_days(runs), usage.live_days(got))


def test_period_plans_have_no_nested_loops(views):
    a, h = views.assets(), views.size_history()
    for frame in (
        lifetimes.daily_live_assets(a, s.ASSET_START, s.ASSET_AS_OF), usage.daily_usage(a, h, s.ASSET_AS_OF),
        lifetimes.monthly_snapshot(a, h, s.ASSET_AS_OF), lifecycle.lifecycle_status(a, h, s.ASSET_AS_OF),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_sweep_totals_overlaps_and_hot_keys(spark):
    hot = spark.range(20000).select(F.lit("hot").alias("k"), (F.col("id") % 7).cast("int").alias("first"),
                                    (F.col("id") % 7 + 2).cast("int").alias("last"), F.lit(1).cast("long").alias("n"))
    runs = intervals.sweep(hot, ["k"], ["n"]).where("n > 0")
    want = hot.select("k", F.explode(F.sequence("first", "last")).alias("p")).groupBy("k", "p").agg(F.count("*").alias("n"))
    same_rows(intervals.expand(runs, "p", ["k", "n"]), want)


def test_mrr_customer_since(spark):
    a = assets_of(spark, ("Direct", "2020-01-31 22:30:00", "2020-03-01 00:00:00"))
    assert lifecycle.mrr_customer_since(a, "2020-12-01").first()["mrr_customer_since"] == date(2020, 2, 1)
    b = assets_of(spark, ("Direct", "2020-01-31 22:00:00", None), ("Direct", "2020-01-01 00:00:00", "2020-01-30 00:00:00"))
    assert lifecycle.mrr_customer_since(b, "2020-12-01").first()["mrr_customer_since"] == date(2020, 1, 31)


def test_active_and_querying_equals_the_joined_form(views):
    a = views.assets().where("dbid < 400")
    queries = cohorts.daily_queries(a, views.asset_minutes())
    got = cohorts.active_and_querying(a, queries, s.ASSET_START, s.ASSET_AS_OF)
    days = lifetimes.daily_live_assets(a, s.ASSET_START, s.ASSET_AS_OF).select(F.to_date("calendar_dt").alias("calendar_dt"), "email").distinct()
    same_rows(cohorts.live_owner_days(a, s.ASSET_START, s.ASSET_AS_OF), days)
    asked = queries.where("calendar_dt is not null").select("calendar_dt", "email", F.lit(1).alias("q"))
    want = days.join(asked, ["calendar_dt", "email"], "left").select("calendar_dt", "email", F.coalesce("q", F.lit(0)).alias("active_user_yn"))
    same_rows(got, want)


def test_payment_stops_only_when_all_of_the_tier_are_gone(spark):
    extra = {"user_db_sequence": F.lit(1), "initial_size_label": F.lit("1GB")}
    a = assets_of(spark, ("Direct", "2020-01-01 00:00:00", "2020-02-01 00:00:00"), ("Free", "2019-12-01 00:00:00", None)).withColumns(extra)
    r = cohorts.payment_span(a, "Direct", ["corp"]).first()
    assert (r["date_of_pymnt_start"], r["date_of_pymnt_stop"]) == (date(2019, 12, 1), date(2020, 2, 1))
    b = a.unionByName(assets_of(spark, ("Direct", "2020-01-02 00:00:00", None)).withColumns(extra))
    assert cohorts.payment_span(b, "Direct", ["corp"]).first()["date_of_pymnt_stop"] is None
    assert cohorts.payment_span(a, "Direct", ["e"]).count() == 0


def test_asset_summary_counts_repeated_rows_of_an_asset_once(spark):
    a = assets_of(spark, ("Free", "2020-01-01 00:00:00", None)).withColumn("most_recent_size_mb", F.lit(2048.0))
    r = billing.user_asset_summary(a.unionByName(a), "2020-12-01").first()
    assert (r["total_db_count"], r["live_db_count"], r["channels"]) == (1, 2, "Free")
    assert r["churn_date"] is None and r["most_recently_live"] == t("2020-12-01 00:00:00")


def summary_assets(spark):
    a = assets_of(spark, ("Free", "2020-01-01 00:00:00", None), ("Direct", "2020-02-01 00:00:00", "2020-03-01 00:00:00"))
    return a.withColumns({"most_recent_size_mb": F.lit(2048.0), "email_domain": F.lit("e"), "user_classification": F.lit("Internal")})


def test_asset_summaries_keep_users_without_key_and_tier(spark):
    a = summary_assets(spark)
    nobody = a.withColumn("userkey", F.lit(None).cast(a.schema["userkey"].dataType))
    untiered = a.withColumn("userkey", F.lit("v")).withColumn("db_billing_identity", F.lit(None).cast("string"))
    both = a.unionByName(nobody).unionByName(untiered)
    for got, n in ((billing.user_asset_summary(both, "2020-12-01"), "total_db_count"), (billing.user_asset_summary_narrow(both), "total_db")):
        user = a.first()["userkey"]
        dbs = a.select("dbid").distinct().count()
        assert {(r["userkey"], r["channels"], r[n]) for r in got.collect()} == {
            (user, "Direct,Free", dbs), (None, "Direct,Free", dbs), ("v", None, dbs)}


@pytest.mark.parametrize("build", [lambda a: billing.user_asset_summary(a, "2020-12-01"), billing.user_asset_summary_narrow])
def test_asset_summaries_collect_pairs_of_user_and_tier_not_assets(spark, build):
    plan = build(summary_assets(spark))._jdf.queryExecution().executedPlan().toString()
    lists = [line for line in plan.splitlines() if "collect_set" in line and "Aggregate" in line]
    assert lists and not any("min(" in line or "distinct" in line for line in lists)


def test_usage_reads_the_assets_once_for_days_and_once_for_sizes(views):
    plan = usage.usage_runs(views.assets(), views.size_history(), s.ASSET_AS_OF)._jdf.queryExecution().analyzed().toString()
    # The pieces of days, those of sizes, and the owners.
    assert sum("RepartitionByExpression [dbid" in line for line in plan.splitlines()) == 3


def test_hours_are_summed_per_user_and_tier_before_the_groups(spark):
    hourly = spark.createDataFrame(
        [(1, "Free", 1, 2.5), (1, "Free", 2, None), (1, "GCP", 1, 1.0), (1, "Direct", 1, 0.5), (1, None, 1, 9.0), (2, "Free", 1, None), (None, "GDS", 1, 4.0)],
        "userkey long, db_billing_identity string, hour_of_day long, memory_gb double")
    made = billing.billing_summary(hourly)
    got = {r["userkey"]: (r["live_hours_free"], r["live_hours_pro"], r["total_gb_hours_free"], r["total_gb_hours_pro"],
                          r["total_gb_hours_gds"], r["total_revenue_dollars_pro"]) for r in made.collect()}
    assert got == {1: (2, 2, 2.5, 1.5, 0.0, 0.14), 2: (1, 0, None, 0.0, 0.0, 0.0), None: (0, 0, 0.0, 0.0, 4.0, 0.0)}
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Aggregate\(keys=\[userkey#\d+L, db_billing_identity#\d+\]", plan)


@pytest.mark.parametrize("build", ["lifecycle_status", "tier_month_usage"])
def test_the_lifecycle_is_placed_by_user_once(views, build):
    made = getattr(lifecycle, build)(views.assets(), views.size_history(), s.ASSET_AS_OF)
    plan = made._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    by_user = [line for line in shuffles if re.search(r"hashpartitioning\(email#\d+, userkey#\d+L?, \d+\)", line)]
    # Two by asset (unless broadcast), the edges, the ranges, and the one placement by user.
    assert len(shuffles) <= 5 and len(by_user) == 1


def test_assets_without_an_owner_have_a_life_without_usage(spark):
    frame = spark.createDataFrame(
        [(1, None, "a@e", "e", "External Private User", "Free", "2020-01-05 00:00:00", None),
         (2, 2, "b@e", "e", "External Private User", "Free", "2020-01-05 00:00:00", None)],
        "dbid long, userkey long, email string, email_domain string, user_classification string, db_billing_identity string, "
        "db_created_at string, db_destroyed_at string",
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("db_created_at", "db_destroyed_at")})
    history = spark.createDataFrame([], "dbid long, db_size double, ts_effective_from timestamp, ts_effective_thru timestamp")
    got = lifecycle.lifecycle_status(frame, history, "2020-03-15 00:00:00").select("userkey", "as_of_date", "num_free_db").collect()
    assert {(r.userkey, str(r.as_of_date), r.num_free_db) for r in got} == {
        (None, "2020-01-01", 0), (None, "2020-02-01", 0), (2, "2020-01-01", 1), (2, "2020-02-01", 1)}


def test_payment_span_counts_moments_without_row_copies(spark, views):
    got = cohorts.payment_span(views.assets(sequence=True), "Direct", s.INTERNAL_DOMAIN_NAMES)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") == 1
    rows_ = [(1, "u", None, "e", COMPANY, "Direct", t("2020-01-01 00:00:00"), None), (2, "v", "v@e", None, COMPANY, "Direct", t("2020-01-01 00:00:00"), None),
             (3, "w", "w@e", "e", COMPANY, "Free", t("2020-01-01 00:00:00"), t("2020-02-01 00:00:00")), (4, "x", "x@e", "e", COMPANY, "Direct", None, None)]
    frame = spark.createDataFrame(rows_, ASSET).selectExpr("*", "1 as user_db_sequence", "'1GB' as initial_size_label")
    found = {r.email: (r.db_create_dts, r.db_destroy_dts, r.initial_size_label) for r in cohorts.payment_span(frame, "Direct", ["corp"]).collect()}
    assert found == {None: (None, None, "1GB"), "w@e": (None, None, "1GB"), "x@e": (0, 0, "1GB")}


def many_assets(spark, n=120_000):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("dbid"), (i % 9000).alias("userkey"), F.concat(F.lit("u"), i % 9000, F.lit("@x")).alias("email"),
        F.lit("x").alias("email_domain"), F.lit("External Company User").alias("user_classification"),
        F.lit("Free").alias("db_billing_identity"), F.lit("2020-01-05").cast("timestamp").alias("db_created_at"),
        F.lit("2020-03-05").cast("timestamp").alias("db_destroyed_at"))


@pytest.mark.parametrize("build", [lifecycle.lifecycle_status, lifecycle.tier_month_usage, lifetimes.monthly_snapshot])
def test_parts_grow_with_the_assets_and_histories_are_not_broadcast(spark, build):
    assets = many_assets(spark, 120_000 if build is not lifetimes.monthly_snapshot else 500_000)
    history = assets.select("dbid", F.lit(1024.0).alias("db_size"), F.col("db_created_at").alias("ts_effective_from"),
                            F.lit("9999-12-31").cast("timestamp").alias("ts_effective_thru"))
    made = build(assets, history, "2020-06-01 00:00:00")
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    assert made.rdd.getNumPartitions() >= 5


def test_owner_days_are_listed_in_parts_by_assets(spark):
    assets = many_assets(spark, 500_000)
    queries = assets.limit(1).select(F.lit("2020-01-06").cast("date").alias("calendar_dt"), "email", F.lit(1).alias("queries_completed"))
    days = cohorts.active_and_querying(assets, queries, "2020-01-01", "2020-06-01 00:00:00")
    assert days.rdd.getNumPartitions() >= 5
    assert rows(days.agg(F.count("*"), F.sum("active_user_yn"))) == [(9000 * 61, 1)]


def test_daily_usage_does_not_broadcast_the_history(spark):
    assets = many_assets(spark)
    history = assets.select("dbid", F.lit(1024.0).alias("db_size"), F.col("db_created_at").alias("ts_effective_from"),
                            F.lit("9999-12-31").cast("timestamp").alias("ts_effective_thru"))
    sized = usage._finished(usage._live(assets, "2020-06-01 00:00:00", None, lifetimes.METERED_TIERS), history)
    assert "Broadcast" not in sized._jdf.queryExecution().executedPlan().toString()
