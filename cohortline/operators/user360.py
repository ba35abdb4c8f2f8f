"""One wide row per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions.text import has
from cohortline.operators import milestones
from cohortline.operators.attribution import OwnSites, first_touch_channel
from cohortline.operators.lifetimes import account_id

FIRST_DB = {"db_created_at": "first_db_created_at", "db_billing_identity": "joined_tier"}
# Milestone names, and the word each uses in "from first asset to ...".
MILESTONES = {
    "first_tools_connection": "first_tools_connection",
    "first_query": "first_query",
    "first_load": "first_load",
    "first_dump_upload": "first_upload",
    "first_programmatic_connection": "first_programmatic_connection",
}


def tier_label(channels: Column) -> Column:
    """Plain name of a user's mix of tiers, from the comma-separated channels."""
    pro = has(channels, "Direct", "GCP")
    return (
        F.when(channels == "Free", "Free")
        .when(channels.isin("GCP", "Direct"), "Professional")
        .when(channels.isin("Enterprise", "GDS"), channels)
        .when(has(channels, "Free") & pro, "Free & Professional")
        .when(has(channels, "Enterprise") & pro, "Enterprise & Professional")
        .when(has(channels, "Free") & has(channels, "Enterprise"), "Free & Enterprise")
    )


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; empty for a frame fit to be joined one-to-one."""
    return frame.groupBy(*keys).count().where("count > 1")


def _known(c: Column) -> Column:
    return F.when(c.isNotNull(), 1).otherwise(0)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))


def _touch_columns() -> list[Column]:
    return [
        F.col("device_id"), F.col("mp_country"), F.col("mp_region"),
        F.col("initial_referrer").alias("first_touch_referrer"),
        F.col("initial_referring_domain").alias("first_touch_referring_domain"),
        *[F.col(c).alias(f"first_touch_{c}") for c in ("utm_source", "utm_medium", "utm_campaign")],
    ]


def with_email_parts(
    users: DataFrame, *, helpdesk: DataFrame, touched: DataFrame, leads: DataFrame, contacts: DataFrame
) -> DataFrame:
    """The users with every part that is keyed by e-mail."""
    return (
        users.withColumnRenamed("createdat", "user_created_at")
        .join(helpdesk.select("email", F.col("id").alias("helpdesk_id"), F.col("tags").alias("helpdesk_tags")), "email", "left")
        .join(touched, "email", "left")
        .join(leads.select("email", F.struct("crm_type", "titles_list", "industry_list").alias("lead")), "email", "left")
        .join(
            contacts.select(
                "email", "approx_annual_revenue", F.struct("crm_type", "titles_list", "industry_list").alias("contact")
            ),
            "email", "left",
        )
    )


def user_360(
    users: DataFrame,
    *,
    helpdesk: DataFrame,
    subjects: DataFrame,
    assets: DataFrame,
    plans: DataFrame,
    summary: DataFrame,
    billing: DataFrame,
    touched: DataFrame,
    milestone_parts: dict[str, DataFrame],
    live_days: DataFrame,
    mrr: DataFrame,
    leads: DataFrame,
    contacts: DataFrame,
    own: OwnSites = OwnSites(),
) -> DataFrame:
    """Every part left-joined onto the users.

    Parts keyed by e-mail are joined first and parts keyed by user after, so
    the user list moves once per key; parts come out of aggregates already
    placed by their key. Sizes decide broadcasts, not hints.
    """
    return with_user_parts(
        with_email_parts(users, helpdesk=helpdesk, touched=touched, leads=leads, contacts=contacts),
        subjects=subjects, first_assets=assets.where("user_db_sequence = 1"), plans=plans, summary=summary, billing=billing,
        milestone_parts=milestone_parts, live_days=live_days, mrr=mrr, own=own,
    )


def with_user_parts(
    by_email: DataFrame,
    *,
    subjects: DataFrame,
    first_assets: DataFrame,
    plans: DataFrame,
    summary: DataFrame,
    billing: DataFrame,
    milestone_parts: dict[str, DataFrame],
    live_days: DataFrame,
    mrr: DataFrame,
    own: OwnSites = OwnSites(),
) -> DataFrame:
    """The wide row: :func:`with_email_parts` with every part that is keyed by user."""
    first_asset = first_assets.select("userkey", *[F.col(c).alias(n) for c, n in FIRST_DB.items()])
    rows = by_email
    for part in (
        subjects.select("userkey", "subject_id", "short_subject_id"),
        first_asset,
        plans,
        summary,
        billing,
        *milestone_parts.values(),
        live_days,
        mrr.select("userkey", "mrr_customer_since"),
    ):
        rows = rows.join(part, "userkey", "left")

    def crm(name):
        return F.coalesce(F.col(f"contact.{name}"), F.col(f"lead.{name}"))

    born = F.col("first_db_created_at")
    reached = {word: F.col(name) for name, word in MILESTONES.items()}
    out = [
        F.col("user_created_at"), F.col("userkey"), F.col("email"), F.col("user_classification"),
        crm("crm_type").alias("crm_type"),
        crm("titles_list").alias("crm_titles_list"),
        crm("industry_list").alias("crm_industry_list"),
        F.col("approx_annual_revenue"),
        F.col("initial_plan_type"),
        F.col("PlanType").alias("current_plan_type"),
        account_id().alias("account_id"),
        F.col("helpdesk_id"), F.col("helpdesk_tags"), F.col("subject_id"), F.col("short_subject_id"),
        F.col("joined_tier"),
        *milestones.milestone_gaps(F.col("user_created_at"), born, reached),
        F.col("channels"), tier_label(F.col("channels")).alias("tier"),
        F.col("total_live_days"),
        *_touch_columns(),
        first_touch_channel(own).alias("first_touch_channel"),
        _known(F.col("total_db_count")).alias("status_db_created"),
        _known(F.col("first_query")).alias("status_activation"),
        _known(F.col("first_load")).alias("status_load_data"),
        _known(F.col("first_dump_upload")).alias("status_load_dumpfile"),
        _known(F.col("first_programmatic_connection")).alias("status_programmatic_connection"),
        _known(F.col("first_tools_connection")).alias("status_tools_connection"),
        _or_zero("total_db_count").alias("total_db_count"),
        _or_zero("live_db_count").alias("live_db_count"),
        F.col("start_date"), F.col("churn_date"),
    ]
    live_counts = {"free": ("free",), "pro": ("direct", "gcp"), "enterprise": ("enterprise",), "gds": ("gds",)}
    for group, tiers in live_counts.items():
        out += [_or_zero(f"live_db_count_{t}").alias(f"live_db_count_{t}") for t in tiers]
        out += [F.col(f"start_date_{group}"), F.col(f"churn_date_{group}")]
        out += [_or_zero(f"{m}_{group}").alias(f"{m}_{group}") for m in ("live_days", "live_hours")]
        out.append(F.coalesce(F.col(f"total_gb_hours_{group}"), F.lit(0.0)).alias(f"total_gb_hours_{group}"))
        if group == "pro":
            revenue = F.coalesce(F.col("total_revenue_dollars_pro"), F.lit(0.0))
            out.append(revenue.alias("total_revenue_dollars_pro"))
        if group != "enterprise":  # no query logs exist for that tier
            for m in MILESTONES:
                at = F.col(f"{m}_{group}")
                out += [F.to_date(at).alias(f"{m}_{group}_date"), _known(at).alias(f"status_{m}_{group}")]
    out.append(F.col("mrr_customer_since"))
    return rows.select(*out).distinct()


def user_360_narrow(
    users: DataFrame,
    *,
    touched: DataFrame,
    summary: DataFrame,
    first_query: DataFrame,
    first_load: DataFrame,
    live_days: DataFrame,
    mrr: DataFrame,
    own: OwnSites = OwnSites(),
) -> DataFrame:
    """The short version: six parts, keyed by e-mail and user. Users bring
    ``total_db_count``, ``first_query`` and ``first_load`` themselves.
    """
    on = ["email", "userkey"]
    rows = users.join(touched, "email", "left")
    for part in (summary, first_query.drop("first_query"), first_load.drop("first_load"), live_days, mrr):
        rows = rows.join(part, on, "left")
    tiers = []
    for group in ("free", "pro"):
        tiers += [F.col(f"start_{group}_date"), F.col(f"churn_{group}_date"), F.col(f"active_days_{group}")]
        for m in ("first_query", "first_load"):
            at = F.col(f"{m}_{group}")
            tiers += [F.to_date(at).alias(f"{m}_{group}_date"), _known(at).alias(f"status_{m}_{group}")]
    return rows.select(
        *on, "user_classification", "account_id", "channels", tier_label(F.col("channels")).alias("tier"),
        "user_created_at", *_touch_columns(), first_touch_channel(own).alias("first_touch_channel"),
        F.when(F.col("total_db_count") == 0, 0).otherwise(1).alias("status_db_created"),
        _known(F.col("first_query")).alias("status_activation"),
        _known(F.col("first_load")).alias("status_load_data"),
        "total_db", "live_db", "active_days", *tiers, "mrr_customer_since",
    ).distinct()
