from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import rows, same_rows
from cohortline.operators import events as ev
from cohortline.operators import identity as ids
from cohortline.operators import registrations as reg

LOG = "distinct_id string, user_id string, email_address string, distinct_id_before_identity string"


def test_identity_map_combines_attributes_and_keeps_bare_ids(spark):
    log = spark.createDataFrame([
        ("a", "U1", None, None), ("a", "U2", None, None), ("a", None, "x@e", None), ("a", None, "y@e", None),
        ("b", None, None, None), (None, "U9", "n@e", None), ("c", None, None, "p"),
    ], LOG)
    assert rows(ids.identity_map(log)) == sorted([
        ("a", "U1", "x@e", None), ("a", "U1", "y@e", None), ("a", "U2", "x@e", None), ("a", "U2", "y@e", None),
        ("b", None, None, None), (None, None, None, None), ("c", None, None, "p"),
    ], key=repr)
    same_rows(ids.email_pairs(log), ids.identity_map(log).select("distinct_id", "email_address").distinct())


def test_flags_equal_the_joined_and_united_form(views):
    daily = ev.daily_interactions(views.event_log(), ev.interaction_spec())
    mapping = ids.identity_map(views.event_log())
    parts = []
    for key in ("distinct_id", "user_id", "distinct_id_before_identity"):
        other = mapping.select(F.col(key).alias("_k"))
        joined = daily.join(other, daily.distinct_id == F.col("_k"), "left")
        parts.append(ev.funnel_flags(joined.select(daily.columns)))
    united = parts[0].unionByName(parts[1]).unionByName(parts[2])
    again = united.groupBy("calendar_dt", "distinct_id").agg(*[F.max(f).alias(f) for f in ev.FUNNEL_FLAGS])
    same_rows(ev.funnel_flags(daily), again)


def test_not_in_follows_null_rules(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "distinct_id string")
    def out(excluded):
        return rows(ev.without(frame, spark.createDataFrame(excluded, "distinct_id string"), "distinct_id"))
    assert out([("a",)]) == [("b",)]
    assert out([("a",), (None,)]) == []
    assert out([(None,)]) == []
    assert out([]) == sorted([("a",), ("b",), (None,)], key=repr)


def test_not_in_is_not_broadcast_nested_loop(views, spark):
    daily = ev.daily_interactions(views.event_log(), ev.interaction_spec())
    report = ev.funnel_report(ev.funnel_flags(daily), ids.identity_map(views.event_log()).select("distinct_id"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_conform_fills_missing_columns_and_filters_the_tenant(spark):
    base = "time long, raw_event_type string, distinct_id string, device_id string, user_id string, distinct_id_before_identity string, project_id string"
    login = spark.createDataFrame([(0, "LOGIN", "a", "v", None, None, "t1", "x@e"), (60, "LOGIN", "b", "v", None, None, "t2", "y@e")], base + ", email string")
    nav = spark.createDataFrame([(86400, "nav", "a", "v", None, None, "t1", "home", "https://h/#databases/abcd1234/created")], base + ", view string, current_url string")
    log = ev.conform_events({"login": login, "navigate_to": nav}, "t1")
    assert log.columns == list(ev.CONFORMED) and len(log.columns) == 21
    assert rows(log, "event_name", "email_address", "view", "dbid_created") == [
        ("LOGIN", "x@e", None, None), ("nav", None, "home", "abcd1234")]


def test_all_event_tables_have_a_shape():
    assert len(ev.EVENT_SHAPES) == 19
    assert len(ev.interaction_spec()) == 34 and len(ev.pivot_spec()) == 18 and len(ev.FUNNEL_FLAGS) == 12


def test_registrant_step_repeats_per_map_row(spark):
    day = date(2024, 1, 1)
    regs = spark.createDataFrame([(day, "x@e", 1, 0), (day, "z@e", 1, 0)], "user_create_dt date, email_address string, registrants long, db_creators long")
    daily = spark.createDataFrame([(day, "a", 2)], "calendar_dt date, distinct_id string, terms_accept_cnt long")
    mapping = spark.createDataFrame([("a", "U1", "x@e", None), ("a", "U2", "x@e", None)], LOG)
    assert rows(reg.registrant_step(regs, daily, ids.email_weights(mapping))) == [(day, 3, 4)]


def test_activation_timeline_one_row_per_label(spark):
    d = [date(2024, 1, i) for i in range(1, 6)]
    logins = spark.createDataFrame([("a", "x@e", d[1]), ("a", "x@e", d[0]), ("b", None, d[2])], "distinct_id string, email string, calendar_date date")
    opens = spark.createDataFrame([("a", "browser", d[3]), ("a", "explorer", d[2])], "distinct_id string, event_label string, calendar_date date")
    one = spark.createDataFrame([("a", d[4])], "distinct_id string, calendar_date date")
    two = spark.createDataFrame([("a", d[3])], "distinct_id string, calendar_date date")
    assert rows(ev.activation_timeline(logins, opens, [one, two])) == [
        (d[0], "a", "x@e", d[3], "browser", d[3]), (d[0], "a", "x@e", d[3], "explorer", d[2]), (d[2], "b", None, None, None, None)]


def test_factors_give_the_map_and_its_weights(spark, views):
    log = views.event_log()
    factors = ids.identity_factors(log)
    same_rows(ids.expand(factors), ids.identity_map(log))
    same_rows(ids.factor_weights(factors), ids.email_weights(ids.identity_map(log)).where("email_address is not null"))
    asked = log.select("distinct_id").limit(7)
    same_rows(ids.expand(factors, ids=asked), ids.identity_map(log).join(asked.distinct(), "distinct_id", "left_semi"))
    same_rows(ids.expand(factors, ["email_address"]), ids.email_pairs(log))
    for a in ids.ATTRIBUTES:
        same_rows(ids.factor(factors, a), ids.seen_pairs(log, a))
    plan = factors._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_an_id_shared_by_ten_thousand_people(spark):
    i = F.col("id")
    log = spark.range(10_000).select(
        F.lit("shared").alias("distinct_id"), F.concat(F.lit("u"), i % 100).alias("user_id"),
        F.concat(F.lit("e"), i).alias("email_address"), F.concat(F.lit("p"), i).alias("distinct_id_before_identity"))
    log = log.unionByName(spark.createDataFrame([(None, "u", "e", "p"), ("lone", None, None, None)], LOG))
    factors = ids.identity_factors(log)
    assert factors.count() == 20_100 + 3
    weights = ids.factor_weights(factors)
    assert weights.count() == 10_000 and weights.where("weight <> 1000000").count() == 0
    assert ids.expand(factors, ["email_address", "user_id"]).count() == 1_000_000 + 2
    assert rows(ids.expand(factors, ids=spark.createDataFrame([("lone",)], "distinct_id string"))) == [("lone", None, None, None)]


@pytest.mark.parametrize("excluded, plain, safe", [
    ([], ["a", "b", None], ["a", "b", None]), (["a"], ["b"], ["b", None]), (["a", None], [], ["b"]), ([None], [], ["a", "b"])])
def test_exclusion_with_nulls(spark, excluded, plain, safe):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "distinct_id string")
    exclude = spark.createDataFrame([(x,) for x in excluded], "distinct_id string")
    for null_safe, wanted in ((False, plain), (True, safe)):
        got = ev.without(frame, exclude, "distinct_id", null_safe)
        assert sorted((r[0] for r in got.collect()), key=repr) == sorted(wanted, key=repr)
        assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
