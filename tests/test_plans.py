import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import events as ev
from cohortline.operators import identity as ids
from cohortline.operators import querylog as ql
from cohortline.operators import crm, lifetimes, user360
from cohortline.plans import events as event_plans
from cohortline.plans import logs
from cohortline.plans import users as user_plans
from cohortline.sources import stand_in as s
from cohortline.sources import tables


def test_running_a_day_twice_does_not_count_twice(spark, views, tmp_path):
    out = str(tmp_path / "logs")
    for day in ("2024-01-14", "2024-01-15", "2024-01-15"):
        logs.run_day(views.query_logs(), day, out, s.CLIENTS)
    both = spark.read.parquet(f"{out}/minute_stats")
    assert {str(r[0]) for r in both.select("log_date").distinct().collect()} == {"2024-01-14", "2024-01-15"}
    day = ql.structured_log(ql.extract_logs(views.query_logs(), "2024-01-15"), s.CLIENTS)
    same_rows(tables.scan_day(spark, f"{out}/minute_stats", "2024-01-15").drop("log_date"), ql.minute_stats(day))
    plan = tables.scan_day(spark, f"{out}/minute_stats", "2024-01-15")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan


@pytest.mark.parametrize("filled", [False, True])
def test_a_day_without_rows_becomes_empty(spark, views, tmp_path, filled):
    out, day = str(tmp_path / "logs"), "2024-01-15"
    if filled:
        logs.run_day(views.query_logs(), day, out, s.CLIENTS)
        assert tables.scan_day(spark, f"{out}/minute_stats", day).count() > 0
    logs.run_day([t.where("false") for t in views.query_logs()], day, out, s.CLIENTS)
    for name in ("structured_log", *logs.SUMMARIES):
        assert tables.scan_day(spark, f"{out}/{name}", day).count() == 0


def test_foreign_event_names_are_counted(spark):
    names = ev.EventNames(terms="t&c", check_step="check it", run_step="run it", landing="NAVIGATE_TO_PRODUCT_LANDING")
    rows_ = [("X_t&c", None), ("x_next_step", "check it"), ("x_next_step", "run it")]
    log = spark.createDataFrame(rows_, "event_name string, step string").selectExpr(
        "*", "timestamp'2024-01-01' as event_ts", "'d' as distinct_id", "'' as event_label", "'' as installtype", "'' as readytorunpushcommand")
    got = ev.daily_interactions(log, ev.interaction_spec("x_", names=names)).first()
    assert (got.terms_accept_cnt, got.import_ensure_admin_command_pageview_cnt, got.import_run_admin_command_pageview_cnt) == (1, 1, 1)
    assert ev.pivot_spec("X_", names=names)[0].events == ("X_NAVIGATE_TO_PRODUCT_LANDING",)


def test_overlapping_versions_are_found(views):
    history = views.size_history()
    assert lifetimes.check_versions(history) is history
    with pytest.raises(ValueError, match="overlap"):
        lifetimes.check_versions(history.unionByName(history))


def test_leads_without_email_have_whole_lists(spark):
    leads = spark.createDataFrame(
        [("l1", "n", None, "i", "t", None), ("l3", "p", None, "h", None, None), ("l2", "m", "a@b", "i", None, None), ("l4", "z", "a@b", "i", None, "c")],
        "id string, name string, email string, industry string, title string, converted_contact_id string")
    got = {r.email: (r.name, r.lead_id_list, r.industry_list, r.titles_list) for r in crm.crm_leads(leads).collect()}
    assert got == {None: ("p", "l1,l3", "h,i", "t"), "a@b": ("m", "l2", "i", None)}


def test_funnel_plan_equals_the_lazy_chain(views, tmp_path):
    spec = ev.interaction_spec()
    report = event_plans.funnel(views.event_tables(), str(tmp_path), s.INTERNAL_DOMAINS, s.TENANT, spec)
    log = ev.conform_events(views.event_tables(), s.TENANT)
    flags = ev.funnel_flags(ev.daily_interactions(log, spec))
    same_rows(report, ev.funnel_report(flags, ev.excluded_ids(ids.identity_map(log), s.INTERNAL_DOMAINS)))


def test_sinks(spark, tmp_path):
    path, one, two = str(tmp_path / "t"), spark.range(1), spark.range(2)
    tables.create(one, path)
    with pytest.raises(Exception, match="(?i)exists"):
        tables.create(two, path)
    tables.create_if_absent(two, path)
    assert tables.scan(spark, path).count() == 1
    tables.replace(two, path)
    assert tables.scan(spark, path).count() == 2
    one.select("id", F.lit("t1").alias("project_id")).write.mode("overwrite").parquet(path)
    tenant = tables.scan_tenant(spark, path, "t1")
    assert tenant.count() == 1
    assert "EqualTo(project_id,t1)" in tenant._jdf.queryExecution().executedPlan().toString()


def test_user_360_has_one_row_per_user(views):
    wide = user_plans.stand_in_user_360(views)
    assert wide.count() == views.users().count()
    assert user360.duplicate_keys(views.users(), ["userkey"]).count() == 0


@pytest.mark.parametrize("channels, tier", [
    ("Free", "Free"), ("GCP", "Professional"), ("GDS", "GDS"), ("Direct,Free", "Free & Professional"),
    ("Direct,Enterprise", "Enterprise & Professional"), ("Enterprise,Free", "Free & Enterprise"),
    ("Direct,GCP", None), ("Enterprise,Free,GCP", "Free & Professional"), (None, None),
])
def test_tier_label(spark, channels, tier):
    frame = spark.createDataFrame([(channels,)], "c string")
    assert frame.select(user360.tier_label(F.col("c"))).first()[0] == tier
