"""First milestones per user, and the time between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import aggs, times
from cohortline.operators.lifetimes import PRO_TIERS

# Tier groups a milestone is split by.
MILESTONE_GROUPS: Mapping[str, tuple[str, ...]] = {"free": ("Free",), "gds": ("GDS",), "pro": PRO_TIERS}
# Client versions of builds under development.
DEV_VERSIONS = ("dev", "0.0.0-dev")


def first_milestone(
    assets: DataFrame,
    facts: DataFrame,
    name: str,
    predicate: Column | None = None,
    on: tuple[str, str] = ("dbid", "dbid"),
    time: str = "minute",
    keys: Sequence[str] = ("userkey",),
    groups: Mapping[str, Sequence[str]] = MILESTONE_GROUPS,
) -> DataFrame:
    """Earliest matching fact per user, overall and per tier group.

    ``on`` names the join column of the assets and of the facts. Facts are cut
    to one minimum per join key before they meet the assets.
    """
    asset_key, fact_key = on
    if predicate is not None:
        facts = facts.where(predicate)
    earliest = facts.groupBy(F.col(fact_key).alias("_on")).agg(F.min(time).alias("_t"))
    tier, t = F.col("db_billing_identity"), F.col("_t")
    owned = assets.select(*keys, "db_billing_identity", F.col(asset_key).alias("_on"))
    # One row per owner, tier and join key is all the minimum needs.
    return (
        owned.distinct().join(earliest, "_on")
        .groupBy(*keys)
        .agg(
            F.min(t).alias(name),
            *[aggs.min_where(tier.isin(*ts), t).alias(f"{name}_{g}") for g, ts in groups.items()],
        )
    )


class Facts(NamedTuple):
    """Moments of one fact table: its key (an asset, or an owner's e-mail), its time, and a condition per milestone (None: every row)."""

    frame: DataFrame
    key: str
    time: str
    named: Mapping[str, Column | None]


def _earliest(tables: Sequence[Facts]) -> tuple[DataFrame, list[str]]:
    """One row per key with the first moment of every milestone of all the tables; each is scanned once."""
    names = [n for f in tables for n in f.named]
    if len(set(names)) < len(names):
        raise ValueError(f"milestones named twice: {sorted(n for n in set(names) if names.count(n) > 1)}")
    kind = "timestamp"

    def moments(f: Facts) -> DataFrame:
        t = F.col(f.time).cast(kind)
        found = {n: t if c is None else F.when(c, t) for n, c in f.named.items()}
        wanted = F.lit(False) if not found else reduce(or_, [F.lit(True) if c is None else c for c in f.named.values()])
        return f.frame.where(F.col(f.key).isNotNull() & wanted).select(
            F.col(f.key).alias("_on"), *[found.get(n, F.lit(None).cast(kind)).alias(n) for n in names])

    rows = reduce(DataFrame.unionByName, [moments(f) for f in tables])
    return rows.groupBy("_on").agg(*[F.min(n).alias(n) for n in names]), names


def first_milestones(
    assets: DataFrame,
    by_asset: Sequence[Facts],
    by_owner: Sequence[Facts] = (),
    keys: Sequence[str] = ("userkey",),
    groups: Mapping[str, Sequence[str]] = MILESTONE_GROUPS,
) -> DataFrame:
    """All milestones of :func:`first_milestone` in one row per user: ``name`` and ``name_group`` for each.

    Every fact table is read once and becomes one row per key, whatever the
    number of milestones; these meet the assets once per kind of key. Assets
    are cut to one row per user, e-mail and tier in between. Users without any
    milestone have no row.
    """
    tier, place = F.col("db_billing_identity"), [*dict.fromkeys([*keys, "email"])]
    facts, names = _earliest(by_asset)
    rows = assets.select(*place, "db_billing_identity", F.col("dbid").alias("_on")).join(facts, "_on", "left")
    rows = rows.groupBy(*place, "db_billing_identity").agg(*[F.min(n).alias(n) for n in names])
    if by_owner:
        facts, more = _earliest(by_owner)
        rows = rows.join(facts.withColumnRenamed("_on", "_owner"), F.col("email") == F.col("_owner"), "left")
        names = names + more
    reached = F.coalesce(*[F.col(n) for n in names]).isNotNull()
    return rows.where(reached).groupBy(*keys).agg(*[
        c for n in names for c in (
            F.min(n).alias(n), *[aggs.min_where(tier.isin(*ts), F.col(n)).alias(f"{n}_{g}") for g, ts in groups.items()])
    ])


def tools_connection(agents: Sequence[str], versions: Sequence[str] = DEV_VERSIONS) -> Column:
    """Connections made by the product's own tools, or by development builds."""
    return F.col("user_agent_name").isin(*agents) | F.col("user_agent_version").isin(*versions)


def programmatic_connection(not_agents: Sequence[str], versions: Sequence[str] = DEV_VERSIONS) -> Column:
    """Connections made by a driver: neither a tool nor a development build."""
    return ~F.col("user_agent_name").isin(*not_agents) & ~F.col("user_agent_version").isin(*versions)


def milestone_gaps(registered: Column, first_asset: Column, milestones: Mapping[str, Column]) -> list[Column]:
    """Seconds and days from registration to the first asset, and from there to each milestone."""
    steps = {"register_to_first_db": (registered, first_asset)}
    steps |= {f"first_db_to_{name}": (first_asset, reached) for name, reached in milestones.items()}
    seconds = [times.elapsed("second", a, b).alias(f"seconds_from_{n}") for n, (a, b) in steps.items()]
    days = [F.datediff(F.to_date(b), F.to_date(a)).alias(f"days_from_{n}") for n, (a, b) in steps.items()]
    return seconds + days


def time_to_milestone(
    frame: DataFrame, registered: str, first_asset: str, milestones: Mapping[str, str], keys: Sequence[str] = ("userkey",)
) -> DataFrame:
    """:func:`milestone_gaps` over a frame holding the moments as columns."""
    reached = {n: F.col(c) for n, c in milestones.items()}
    return frame.select(*keys, *milestone_gaps(F.col(registered), F.col(first_asset), reached))
