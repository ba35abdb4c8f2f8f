"""The wide user table from written parts, and all milestones in one pass."""

import ast
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import milestones
from cohortline.operators.milestones import Facts
from cohortline.plans import users as plans


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(frame, table):
    return len(re.findall(rf"(?m)^.*FileScan parquet .*{table}\.parquet", frame._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture(scope="module")
def written(spark, views, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("user360"))
    return plans.write_user_360(views.user_tables(), views.user_rules(), out, "wide_test", buckets=4), out


def test_written_table_equals_the_lazy_one(spark, views, written):
    same_rows(written[0], plans.stand_in_user_360(views))
    assert written[0].count() == views.users().count()


def test_nothing_is_shuffled_above_the_written_parts(spark, written):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = written[0].select("*")
        text = plan(wide)
        assert "Exchange" not in text and text.count("SortMergeJoin") >= len(plans.USER_PARTS)
        email_side = plans.user360.with_email_parts(
            spark.table("wide_test_users"), **{n: spark.table(f"wide_test_{n}") for n in plans.EMAIL_PARTS})
        text = plan(email_side)
        assert "Exchange" not in text and text.count("SortMergeJoin") == len(plans.EMAIL_PARTS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_a_duplicated_part_raises(views, tmp_path):
    tables = views.user_tables()
    twice = tables._replace(subjects=tables.subjects.unionByName(tables.subjects.limit(1)),
                            helpdesk=tables.helpdesk.unionByName(tables.helpdesk.limit(1)))
    with pytest.raises(ValueError, match=r"helpdesk \(u.*subjects \("):
        plans.write_user_360(twice, views.user_rules(), str(tmp_path), "wide_twice", buckets=2)


def test_overlapping_versions_raise(views):
    tables = views.user_tables()
    with pytest.raises(ValueError, match="overlap"):
        plans.user_parts(tables._replace(size_history=tables.size_history.unionByName(tables.size_history)), views.user_rules())


def test_null_keys_are_no_duplicates(spark):
    frame = spark.createDataFrame([(None,), (None,), ("a",)], "email string")
    plans.check_keys({"leads": (frame, "email")})


def test_a_second_run_replaces_the_first(spark, views, tmp_path):
    tables = views.user_tables()
    for users in (tables.users, tables.users.limit(3)):
        wide = plans.write_user_360(tables._replace(users=users), views.user_rules(), str(tmp_path), "wide_again", buckets=2)
    assert wide.count() == 3


def test_the_plan_takes_tables_only():
    tree = ast.parse(open(plans.__file__).read())
    named = {a.name for n in ast.walk(tree) if isinstance(n, (ast.Import, ast.ImportFrom)) for a in n.names}
    assert "stand_in" not in named


def one_by_one(v):
    """The same five milestones by :func:`first_milestone`, a scan each."""
    rules, first, assets = v.user_rules(), milestones.first_milestone, v.assets()
    return {
        "first_query": first(assets, v.asset_minutes(), "first_query", F.col("imputed_net_user_queries") > 0),
        "first_load": first(assets, v.asset_minutes(), "first_load", F.col("imputed_load_statements") > 0),
        "first_programmatic_connection": first(
            assets, v.agent_facts(), "first_programmatic_connection", milestones.programmatic_connection(rules.not_programmatic)),
        "first_tools_connection": first(
            assets, v.agent_facts(), "first_tools_connection", milestones.tools_connection(rules.tool_agents)),
        "first_dump_upload": first(assets, v.dump_uploads(), "first_dump_upload", on=("email", "owner"), time="timestamp"),
    }


def test_one_pass_equals_a_scan_per_milestone(views):
    rules = views.user_rules()
    got = plans.milestone_parts(views.assets(), views.asset_minutes(), views.agent_facts(), views.dump_uploads(),
                                rules.tool_agents, rules.not_programmatic)
    wanted = one_by_one(views)
    assert set(got) == set(wanted)
    for name, frame in got.items():
        same_rows(frame, wanted[name])


def test_each_fact_table_is_scanned_once(views):
    rules = views.user_rules()
    by_asset, by_owner = plans.milestone_facts(
        views.asset_minutes(), views.agent_facts(), views.dump_uploads(), rules.tool_agents, rules.not_programmatic)
    every = milestones.first_milestones(views.assets(), by_asset, by_owner)
    # Minutes and agents both stand in lineitem.
    assert scans(every, "lineitem") == 2 and scans(every, "events") == 1 and scans(every, "orders") == 1


def test_milestone_cases(spark):
    assets = spark.createDataFrame(
        [(1, "a@e", 10, "Free"), (1, "a@e", 11, "GCP"), (2, "b@e", 12, None), (None, "c@e", 13, "Free"), (3, None, 14, "GDS"), (4, "d@e", None, "Free")],
        "userkey long, email string, dbid long, db_billing_identity string")
    facts = spark.createDataFrame(
        [(10, "2024-01-02", 1), (10, "2024-01-01", 0), (11, "2024-01-03", 1), (12, "2024-01-05", 1), (13, "2024-01-06", 1),
         (None, "2020-01-01", 1), (14, None, 1), (99, "2020-01-01", 1)], "dbid long, minute string, hit int")
    owners = spark.createDataFrame([("a@e", "2023-01-01"), ("d@e", "2023-02-01"), (None, "2020-01-01")], "owner string, timestamp string")
    out = milestones.first_milestones(
        assets, [Facts(facts, "dbid", "minute", {"asked": F.col("hit") > 0, "seen": None})],
        [Facts(owners, "owner", "timestamp", {"sent": None})])
    day = lambda c: F.to_date(c).cast("string").alias(c)
    got = rows(out.select("userkey", *[day(c) for c in ("asked", "asked_free", "asked_pro", "seen", "sent", "sent_free", "sent_pro")]))
    assert got == sorted([
        (1, "2024-01-02", "2024-01-02", "2024-01-03", "2024-01-01", "2023-01-01", "2023-01-01", "2023-01-01"),
        (2, "2024-01-05", None, None, "2024-01-05", None, None, None),
        (4, None, None, None, None, "2023-02-01", "2023-02-01", None),
        (None, "2024-01-06", "2024-01-06", None, "2024-01-06", None, None, None)], key=repr)
    with pytest.raises(ValueError, match="named twice"):
        milestones.first_milestones(assets, [Facts(facts, "dbid", "minute", {"asked": None})] * 2)
