"""From event tables to the funnel reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from cohortline.operators import events as ev
from cohortline.operators import identity as ids
from cohortline.sources import tables


def funnel(
    event_tables: Mapping[str, DataFrame], out: str, internal_domains: Sequence[str],
    tenant: str | None = None, spec: Sequence[ev.Counter] | None = None,
) -> DataFrame:
    """Write the event log, identity factors, daily counts and flags under ``out``; return the report.

    The conformed log is written once and read back three times with a few
    columns each, which is cheaper than conforming nineteen tables again. The
    identity map is written as its factors (``identity.expand`` makes its rows
    on demand), since an id shared by many people has their product in the map.
    """
    spark = next(iter(event_tables.values())).sparkSession
    tables.replace(ev.conform_events(event_tables, tenant), f"{out}/event_log")
    log = tables.scan(spark, f"{out}/event_log")
    tables.replace(ids.identity_factors(log), f"{out}/identity_factors")
    tables.replace(ev.daily_interactions(log, spec or ev.interaction_spec()), f"{out}/daily_interactions")
    tables.replace(ev.funnel_flags(tables.scan(spark, f"{out}/daily_interactions")), f"{out}/funnel_flags")
    # Ids without an e-mail are never excluded, so the pairs are enough.
    exclude = ev.excluded_ids(ids.factor(tables.scan(spark, f"{out}/identity_factors"), "email_address"), internal_domains)
    return ev.funnel_report(tables.scan(spark, f"{out}/funnel_flags"), exclude)
