"""Per-e-mail CRM contacts and leads, and the initial plan from snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from cohortline.functions import text
from cohortline.operators import lists

DEFAULT_PLAN = "self_serve"


def crm_contacts(contacts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Contacts per e-mail with their accounts; lists are distinct, sorted and whole."""
    owner = accounts.select(
        F.col("id").alias("account_id"), F.col("name").alias("_account"), "industry", "type", "annual_revenue"
    )
    held = contacts.where(F.col("email").isNotNull()).join(owner, "account_id", "left")
    single = held.groupBy("email").agg(
        F.max("name").alias("contact_name"), F.max("_account").alias("account_name"), F.max("annual_revenue").alias("approx_annual_revenue")
    )
    named = {"title": "titles_list", "id": "contact_id_list", "account_id": "account_id_list", "industry": "industry_list",
             "type": "account_type_list"}
    return _with_lists(held, single, "Contact", named)


def crm_leads(leads: DataFrame) -> DataFrame:
    """Leads per e-mail that have not become contacts; those without an e-mail share one row, with whole lists as well."""
    open_ = leads.where(F.col("converted_contact_id").isNull())
    single = open_.groupBy("email").agg(F.max("name").alias("name"))
    return _with_lists(open_, single, "Lead", {"id": "lead_id_list", "industry": "industry_list", "title": "titles_list"})


def _with_lists(rows: DataFrame, single: DataFrame, kind: str, named: Mapping[str, str]) -> DataFrame:
    """One row per e-mail, null included, of its single values and its lists."""
    listed = lists.sorted_lists(rows, "email", list(named)).withColumnsRenamed(named)
    both = single.unionByName(listed, allowMissingColumns=True)
    rest = [c for c in both.columns if c != "email"]
    return both.groupBy("email").agg(F.first(F.lit(kind)).alias("crm_type"), *[F.max(c).alias(c) for c in rest])


def initial_plan(snapshots: DataFrame, path: str = "__key__.path", default: str = DEFAULT_PLAN) -> DataFrame:
    """Plan at the earliest snapshot per user; the user key is the last part of the key path.

    Snapshots tied on the earliest time are settled by plan name, null first.
    """
    key = F.replace(text.extract_or_null(F.col(path), r"(?d).*, (.*)"), F.lit('"'), F.lit(""))
    earliest = snapshots.groupBy(key.alias("userkey")).agg(
        F.min(F.struct("snapshottime", "PlanType")).alias("_first")
    )
    return earliest.where(F.col("userkey").isNotNull()).select(
        "userkey", F.coalesce(F.col("_first.PlanType"), F.lit(default)).alias("initial_plan_type")
    )
