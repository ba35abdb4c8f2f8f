"""From base tables to the per-user tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from cohortline.operators import (
    attribution,
    billing,
    crm,
    identity,
    lifecycle,
    lifetimes,
    milestones,
    usage,
    user360,
)
from cohortline.operators.milestones import Facts
from cohortline.sources import tables as sinks

#: Buckets of a written part. At 100 TB of facts the user list itself is the largest part; keep a bucket near 256 MB.
BUCKETS = 200
EMAIL_PARTS = ("helpdesk", "touched", "leads", "contacts")
USER_PARTS = ("subjects", "first_assets", "plans", "summary", "billing", "milestones", "live_days", "mrr")


class UserTables(NamedTuple):
    """The tables that the wide user table is made of."""

    users: DataFrame
    helpdesk: DataFrame
    subjects: DataFrame
    assets: DataFrame
    first_assets: DataFrame
    size_history: DataFrame
    billing_hours: DataFrame
    minute_stats: DataFrame
    agent_minutes: DataFrame
    dump_uploads: DataFrame
    snapshots: DataFrame
    touch_tables: Sequence[DataFrame]
    event_log: DataFrame
    leads: DataFrame
    contacts: DataFrame
    accounts: DataFrame


class UserRules(NamedTuple):
    """What belongs to one deployment."""

    as_of: datetime | str
    tenant: str
    tool_agents: Sequence[str]
    not_programmatic: Sequence[str]
    own: attribution.OwnSites = attribution.OwnSites()


def milestone_facts(
    minute_stats: DataFrame, agent_minutes: DataFrame, dump_uploads: DataFrame, tool_agents: Sequence[str], not_programmatic: Sequence[str]
) -> tuple[list[Facts], list[Facts]]:
    """The milestones of each fact table: those keyed by asset, and those keyed by the owner's e-mail."""
    return [
        Facts(minute_stats, "dbid", "minute", {
            "first_query": F.col("imputed_net_user_queries") > 0, "first_load": F.col("imputed_load_statements") > 0}),
        Facts(agent_minutes, "dbid", "minute", {
            "first_programmatic_connection": milestones.programmatic_connection(not_programmatic),
            "first_tools_connection": milestones.tools_connection(tool_agents)}),
    ], [Facts(dump_uploads, "owner", "timestamp", {"first_dump_upload": None})]


def milestone_parts(
    assets: DataFrame,
    minute_stats: DataFrame,
    agent_minutes: DataFrame,
    dump_uploads: DataFrame,
    tool_agents: Sequence[str],
    not_programmatic: Sequence[str],
) -> dict[str, DataFrame]:
    """The five first milestones per user, each as a part of its own, out of one pass over the facts."""
    by_asset, by_owner = milestone_facts(minute_stats, agent_minutes, dump_uploads, tool_agents, not_programmatic)
    every = milestones.first_milestones(assets, by_asset, by_owner)
    return {
        n: every.where(F.col(n).isNotNull()).select("userkey", n, *[f"{n}_{g}" for g in milestones.MILESTONE_GROUPS])
        for f in (*by_asset, *by_owner) for n in f.named
    }


def user_parts(t: UserTables, rules: UserRules) -> dict[str, DataFrame]:
    """Every part of the wide user table, one row per e-mail (EMAIL_PARTS) or user (USER_PARTS)."""
    assets = t.assets
    history = lifetimes.check_versions(t.size_history)
    by_asset, by_owner = milestone_facts(t.minute_stats, t.agent_minutes, t.dump_uploads, rules.tool_agents, rules.not_programmatic)
    return {
        "helpdesk": t.helpdesk,
        "touched": attribution.first_touch_by_email(
            attribution.touch_events(list(t.touch_tables), rules.tenant), identity.email_pairs(t.event_log)),
        "leads": crm.crm_leads(t.leads),
        "contacts": crm.crm_contacts(t.contacts, t.accounts),
        "subjects": t.subjects,
        "first_assets": t.first_assets.where("user_db_sequence = 1"),
        "plans": crm.initial_plan(t.snapshots).withColumn("userkey", F.col("userkey").cast("long")),
        "summary": billing.user_asset_summary(assets, rules.as_of),
        "billing": billing.billing_summary(billing.hourly_usage(t.billing_hours, assets)),
        "milestones": milestones.first_milestones(assets, by_asset, by_owner),
        "live_days": usage.live_days(usage.usage_runs(assets, history, rules.as_of)),
        "mrr": lifecycle.mrr_customer_since(assets, rules.as_of),
    }


def _wide(people: DataFrame, parts: dict[str, DataFrame], rules: UserRules) -> DataFrame:
    named = {n: parts[n] for n in USER_PARTS if n != "milestones"}
    return user360.with_user_parts(people, **named, milestone_parts={"milestones": parts["milestones"]}, own=rules.own)


def user_360(t: UserTables, rules: UserRules) -> DataFrame:
    """The wide user table as one lazy plan."""
    parts = user_parts(t, rules)
    return _wide(user360.with_email_parts(t.users, **{n: parts[n] for n in EMAIL_PARTS}), parts, rules)


def check_keys(parts: dict[str, tuple[DataFrame, str]]) -> None:
    """An error that names every part with a key on more than one row; null keys join nothing and are let be.

    One job; over bucketed parts nothing is shuffled but the handful of names.
    """
    twice = [
        user360.duplicate_keys(frame.where(F.col(key).isNotNull()), [key]).agg(F.min(F.col(key).cast("string")).alias("key")).where(
            F.col("key").isNotNull()).select(F.lit(name).alias("part"), "key")
        for name, (frame, key) in parts.items()
    ]
    found = reduce(DataFrame.unionByName, twice).collect()
    if found:
        raise ValueError("more than one row per key: " + ", ".join(f"{r.part} ({r.key})" for r in sorted(found)))


def write_user_360(t: UserTables, rules: UserRules, out: str, name: str = "user_360", buckets: int = BUCKETS) -> DataFrame:
    """The wide user table over parts that are written once, bucketed by their key, under ``out``.

    Users and the parts keyed by e-mail are bucketed by e-mail and joined in
    place; what comes out is bucketed by user and joined in place with the other
    parts, so above the written tables nothing is shuffled. Each part is one
    written table: a lost executor costs a re-read, and a failed run is repeated
    over the same names. The keys of every part are checked before it is joined.
    """
    parts = user_parts(t, rules)
    keys = {n: "email" for n in ("users", *EMAIL_PARTS)} | {n: "userkey" for n in USER_PARTS}

    def put(part: str, frame: DataFrame, key: str) -> DataFrame:
        return sinks.put_bucketed(frame, f"{name}_{part}", f"{out}/{part}", key, buckets)

    written = {n: put(n, frame, keys[n]) for n, frame in {"users": t.users, **parts}.items()}
    check_keys({n: (frame, keys[n]) for n, frame in written.items() if n != "users"})
    people = user360.with_email_parts(written["users"], **{n: written[n] for n in EMAIL_PARTS})
    return _wide(put("people", people, "userkey"), written, rules)


def user_360_narrow(
    users: DataFrame, assets: DataFrame, history: DataFrame, minute_stats: DataFrame, touched: DataFrame, rules: UserRules
) -> DataFrame:
    """The short user table. The minute statistics are scanned once for both milestones."""
    keys, groups = ("email", "userkey"), {g: milestones.MILESTONE_GROUPS[g] for g in ("free", "pro")}
    named = {"first_query": F.col("imputed_net_user_queries") > 0, "first_load": F.col("imputed_load_statements") > 0}
    both = milestones.first_milestones(assets, [Facts(minute_stats, "dbid", "minute", named)], keys=keys, groups=groups)
    first = {n: both.select(*keys, n, *[f"{n}_{g}" for g in groups]) for n in named}
    return user360.user_360_narrow(
        users,
        touched=touched,
        summary=billing.user_asset_summary_narrow(assets),
        **first,
        live_days=usage.active_days(usage.usage_runs(assets, lifetimes.check_versions(history), rules.as_of)),
        mrr=lifecycle.mrr_customer_since(assets, rules.as_of),
        own=rules.own,
    )


def touches(v) -> DataFrame:
    """The touches of a source of tables (``sources.stand_in.StandIn`` or alike)."""
    return attribution.touch_events([v.page_views(), v.navigation()], v.user_rules().tenant)


def stand_in_user_360(v) -> DataFrame:
    return user_360(v.user_tables(), v.user_rules())


def stand_in_user_360_narrow(v) -> DataFrame:
    touched = attribution.first_touch_by_email(touches(v), identity.email_pairs(v.event_log()))
    return user_360_narrow(v.users_narrow(), v.assets(), v.size_history(), v.asset_minutes(), touched, v.user_rules())
