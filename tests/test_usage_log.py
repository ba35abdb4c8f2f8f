"""Daily usage from a run per day against a rebuild."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import usage
from cohortline.plans import usage as plan
from cohortline.sources import commits, stand_in as s

ASSET = ("dbid long, userkey long, email string, email_domain string, user_classification string, "
         "db_billing_identity string, db_created_at string, db_destroyed_at string")
FIRST = date(2020, 1, 10)


def known(assets, day):
    """The table when the day has ended: later assets are not there, and later ends are not known."""
    after = F.lit(str(day + timedelta(days=1))).cast("timestamp")
    return assets.where(F.col("db_created_at") < after).withColumn(
        "db_destroyed_at", F.when(F.col("db_destroyed_at") < after, F.col("db_destroyed_at")))


def moment(day):
    return f"{day + timedelta(days=1)} 00:00:01"


@pytest.fixture(scope="module")
def small(spark):
    """Lives that begin and end before, on and after the days of the runs, several tiers, accounts and sizes."""
    made = []
    for i in range(120):
        born = f"2020-01-{1 + i * 7 % 40 % 31:02d} {i * 5 % 24:02d}:{i * 13 % 60:02d}:{'59.5' if i % 11 == 0 else '00'}"
        end = i * 7 % 40 % 31 + 1 + (0, 0, 1, 3, 20, 60)[i % 6]
        died = None if i % 7 == 0 else f"{date(2020, 1, 1) + timedelta(days=end - 1)} {max(i * 5 % 24, 1):02d}:{i * 13 % 60:02d}:59.9"
        user = i % 9
        kind = ("External Private User", "External Company User")[(user + i // 60) % 2]
        made.append((i, user, f"u{user}@e", "e", kind, ("Free", "Direct", "GCP", "GDS")[i % 4], born, died))
    made += [(200, 1, "u1@e", "e", "External Company User", "Free", "2020-01-12 23:59:59.3", "2020-01-12 23:59:59.8"),
             (201, 1, "u1@e", "e", "External Company User", "Free", "2020-01-12 10:00:00", "2020-01-12 11:00:00")]
    frame = spark.createDataFrame(made + made[:3], ASSET).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("db_created_at", "db_destroyed_at")})
    born = frame.distinct().select("dbid", "db_created_at")
    sizes = [born.select("dbid", F.lit(1024.0 * (n + 1)).alias("db_size"),
                         (F.col("db_created_at") + F.make_dt_interval(F.lit(5 * n))).alias("ts_effective_from"),
                         (F.col("db_created_at") + F.make_dt_interval(F.lit(5 * n + 5))).alias("ts_effective_thru")) for n in range(3)]
    return frame, sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


def test_thirty_daily_runs_equal_one_full_run(spark, small, tmp_path):
    assets, history = (f.cache() for f in small)
    out, day = str(tmp_path), FIRST
    plan.run_days(known(assets, day), history, out, day)
    same_rows(plan.table(spark, out, moment(day)), usage.daily_usage(known(assets, day), history, moment(day)))
    for n in range(30):
        day += timedelta(days=1)
        plan.run_days(known(assets, day), history, out, day, day - timedelta(days=1))
        if n in (1, 14):
            same_rows(plan.table(spark, out, moment(day)), usage.daily_usage(known(assets, day), history, moment(day)))
    whole = usage.daily_usage(known(assets, day), history, moment(day))
    before = plan.table(spark, out, moment(day))
    assert whole.count() > 500 and whole.where("qualified_gb is not null").count() > 50
    same_rows(before, whole)
    for again in (day, day - timedelta(days=9)):
        plan.run_days(known(assets, again), history, out, again, again - timedelta(days=1))
    same_rows(plan.table(spark, out, moment(day)), whole)
    assert commits.manifest(spark, out).count() == 33


def test_days_together_equal_days_apart(views):
    assets, history = views.assets().where("dbid < 400"), views.size_history()
    parts = [usage.usage_changes(assets, history, a, b) for a, b in
             ((None, "1996-01-01"), ("1996-01-01", "1996-01-02"), ("1996-01-02", "1997-05-05"), ("1997-05-05", "2001-08-31"))]
    edges, owners = (parts[0][n].unionByName(parts[1][n]).unionByName(parts[2][n]).unionByName(parts[3][n]) for n in ("edges", "owners"))
    same_rows(usage.runs_of_changes(edges, owners, s.ASSET_AS_OF).select("email", "first", "total_db", "qualified_gb", "account_id").distinct(),
              usage.runs_of_changes(*usage.usage_changes(assets, history, None, "2001-08-31").values(), s.ASSET_AS_OF).select(
                  "email", "first", "total_db", "qualified_gb", "account_id").distinct())


def test_a_day_without_changes_is_empty(spark, small):
    assets, history = small
    for frame in usage.usage_changes(assets, history, "2031-01-01", "2031-01-02").values():
        assert frame.count() == 0
