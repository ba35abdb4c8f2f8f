"""Registrant funnels: from sign-up to terms, first asset and the steps between."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortline.functions import text

# The steps of the registrant funnel.
REGISTRANT_STEPS = (
    "create_db_pageview_flag",
    "create_db_step1_pageview_flag",
    "create_db_payment_pageview_flag",
    "db_created_flag",
    "import_pageview_flag",
    "help_link_flag",
    "feedback_click_flag",
    "account_pageview_flag",
    "console_dashboard_connect_flag",
)


def registrations_by_day(users: DataFrame, assets: DataFrame, internal_domains: Sequence[str]) -> DataFrame:
    """External registrants per day, and whether they created their first asset that same day."""
    def external(frame):
        return frame.where(text.outside_domains(F.col("email"), internal_domains))

    joined = external(users.where(F.col("user_created_at").isNotNull())).select(
        F.to_date("user_created_at").alias("user_create_dt"), F.col("email").alias("email_address")
    ).distinct()
    made = external(assets.where((F.col("user_db_sequence") == 1) & F.col("db_created_at").isNotNull())).select(
        F.to_date("db_created_at").alias("user_create_dt"), F.col("email").alias("email_address"),
        F.lit(1).alias("_made"),
    ).distinct()
    return joined.join(made, ["user_create_dt", "email_address"], "left").select(
        "user_create_dt", "email_address",
        F.lit(1).cast("long").alias("registrants"),
        F.coalesce("_made", F.lit(0)).cast("long").alias("db_creators"),
    )


def registrant_step(registrations: DataFrame, daily: DataFrame, weights: DataFrame, count: str = "terms_accept_cnt") -> DataFrame:
    """Registrants and their count of one step on the registration day, newest day first.

    Each map row of the registrant repeats the registrant, as joining the map
    would; the repeats are carried as weights (``identity.pair_weights`` of the
    events, or ``identity.email_weights`` of a map that is there already).
    """
    steps = (
        daily.select(F.col("calendar_dt").alias("user_create_dt"), "distinct_id", F.col(count).alias("_n"))
        .join(weights, "distinct_id")
        .groupBy("user_create_dt", "email_address")
        .agg(F.sum("weight").alias("_rows"), F.sum(F.col("weight") * F.col("_n")).alias("_total"))
    )
    return (
        registrations.join(steps, ["user_create_dt", "email_address"], "left")
        .groupBy("user_create_dt")
        .agg(
            F.sum(F.col("registrants") * F.coalesce("_rows", F.lit(1))).alias("registrants"),
            F.sum("_total").alias("terms_accept"),
        )
        .orderBy(F.desc("user_create_dt"))
    )


def registrant_funnel(registrations: DataFrame, flags: DataFrame, identity: DataFrame) -> DataFrame:
    """Registrants reaching each step on their registration day, newest day first."""
    pairs = identity.select("distinct_id", "email_address").distinct()
    steps = ("terms_accept_flag", *REGISTRANT_STEPS)
    reached = (
        flags.withColumnRenamed("calendar_dt", "user_create_dt")
        .join(pairs, "distinct_id")
        .groupBy("user_create_dt", "email_address")
        .agg(*[F.max(s).alias(s) for s in steps])
    )
    per_email = registrations.groupBy("user_create_dt", "email_address").agg(
        F.max("registrants").alias("registrants"), F.max("db_creators").alias("db_creators")
    )
    return (
        per_email.join(reached, ["user_create_dt", "email_address"], "left")
        .groupBy("user_create_dt")
        .agg(*[F.sum(c).alias(c) for c in ("registrants", "db_creators", *steps)])
        .orderBy(F.desc("user_create_dt"))
    )
