"""Month-by-month retention per e-mail."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortline.functions import times
from cohortline.functions.parts import parts_for
from cohortline.operators import intervals, lifetimes

# Fixed value: month 0 of the visit index is February 2019.
ORIGIN = (2019, 2)
#: Parts that one e-mail's assets are dealt to before its months are summed.
SPREAD = 64


def create_counts(assets: DataFrame, start: date | str, as_of: datetime | str) -> DataFrame:
    """Distinct assets created per month and e-mail, for assets live inside the calendar."""
    seen = lifetimes.live_span(assets, start, as_of)
    return _month_counts(seen, F.col("db_created_at"), F.col("dbid"), "db_created_count", parts_for(assets))


def destroy_counts(assets: DataFrame, start: date | str, as_of: datetime | str) -> DataFrame:
    """Distinct assets destroyed per month and e-mail; still-live assets form a null month with count 0."""
    seen = lifetimes.live_span(assets, start, as_of)
    gone = F.when(F.col("db_destroyed_at").isNotNull(), F.col("dbid"))
    return _month_counts(seen, F.col("db_destroyed_at"), gone, "db_destroyed_count", parts_for(assets))


def _month_counts(seen: DataFrame, at: Column, dbid: Column, name: str, parts: int) -> DataFrame:
    """Distinct assets per month of ``at`` and e-mail, placed by both in ``parts`` parts.

    Assets are spread by month, e-mail and a part of their own first, and counted
    there: a month of an e-mail arrives behind it as at most SPREAD rows.
    """
    on = ("yr", "mnth", "email")
    spread = seen.select(
        F.year(at).alias("yr"), F.month(at).alias("mnth"), "email", dbid.alias("_dbid"),
        F.pmod(F.xxhash64("dbid"), F.lit(SPREAD)).alias("part"),
    ).repartition(parts, *on, "part")
    per_part = spread.groupBy(*on, "part").agg(F.countDistinct("_dbid").alias(name))
    return per_part.repartition(parts, *on).groupBy(*on).agg(F.sum(name).alias(name))


def create_destroy_log(
    assets: DataFrame, start: date | str, as_of: datetime | str, from_creations: bool = False
) -> DataFrame:
    """Counts for every month in which an e-mail has a live asset.

    ``from_creations`` keeps only months with a creation (the older variant).
    """
    if from_creations:
        created, destroyed = create_counts(assets, start, as_of), destroy_counts(assets, start, as_of)
        return created.join(destroyed, ["yr", "mnth", "email"], "left")
    return _live_months(assets, start, as_of).select(
        F.floor(F.col("_m") / 12).cast("int").alias("yr"), (F.col("_m") % 12 + 1).alias("mnth"), "email",
        "db_created_count", "db_destroyed_count",
    )


def _live_months(assets: DataFrame, start: date | str, as_of: datetime | str) -> DataFrame:
    """Every month ``_m`` in which an e-mail has a live asset, with the assets created and destroyed in it, placed by e-mail.

    An asset is not listed per month: it leaves an edge where its months begin
    and one where they have ended, and marks for its creation and its end. Assets
    are spread by e-mail and a part of their own first, where edges are summed
    and repeated marks of an asset become one, then each part's changes are
    placed by e-mail and swept: an e-mail that owns a third of all assets arrives
    there as at most SPREAD rows per month. Both placements take parts in
    proportion to the assets, as months are listed behind them. Months without
    creations or ends have null counts, as have those of assets without an
    e-mail.
    """
    low, high = times.instant(start), times.instant(as_of)
    day_first = F.greatest(times.position("day", F.col("db_created_at")), times.position("day", low))
    day_last = F.least(times.position("day", lifetimes.end_or(as_of)), times.position("day", high))
    seen = (day_first <= day_last) & F.col("email").isNotNull()
    n = parts_for(assets)
    placed = lifetimes.live_span(assets, start, as_of, "month").select(
        "email", "dbid", "first", "last", F.pmod(F.xxhash64("dbid"), F.lit(SPREAD)).alias("part"),
        F.when(seen, times.month_index(F.col("db_created_at"))).alias("made"),
        F.when(seen, times.month_index(F.col("db_destroyed_at"))).alias("gone"),
    ).repartition(n, "email", "part")

    def change(at: Column, live: int, mark: str | None = None) -> Column:
        dbid = F.when(F.lit(mark is not None), F.col("dbid"))
        return F.struct(at.cast("int").alias("at"), F.lit(live).cast("long").alias("live"), F.lit(mark).cast("string").alias("mark"), dbid.alias("_dbid"))

    def inside(month: str) -> Column:
        return F.when(F.col(month).between(F.col("first"), F.col("last")), F.col(month))

    changes = placed.select("email", "part", F.inline(F.array(
        change(F.col("first"), 1), change(F.col("last") + 1, -1), change(inside("made"), 0, "made"), change(inside("gone"), 0, "gone")
    ))).where(F.col("at").isNotNull())
    once = changes.groupBy("email", "part", "at", "mark", "_dbid").agg(F.sum("live").alias("live"))
    one = F.col("_dbid").isNotNull().cast("long")
    marks = {"db_created_count": "made", "db_destroyed_count": "gone"}
    per_part = once.groupBy("email", "part", "at").agg(
        F.sum("live").alias("live"), *[F.sum(F.when(F.col("mark") == m, one)).alias(c) for c, m in marks.items()])
    turns = per_part.repartition(n, "email").groupBy("email", "at").agg(*[F.sum(c).alias(c) for c in ("live", *marks)])
    runs = intervals.runs(turns, ["email"], ["live"], carry=tuple(marks)).where("live > 0")
    months = runs.select("email", "first", *marks, F.explode(F.sequence("first", "last")).alias("_m"))
    return months.select("email", "_m", *[F.when(F.col("_m") == F.col("first"), F.col(c)).alias(c) for c in marks])


def active_users(assets: DataFrame, start: date | str, as_of: datetime | str) -> DataFrame:
    """Older variant of the log: live months, with counts only where the month has a creation."""
    on, n = ["yr", "mnth", "email"], parts_for(assets)
    counted = create_destroy_log(assets, start, as_of, from_creations=True)
    months = create_destroy_log(assets, start, as_of).select(*on).repartition(n, *on)
    made = counted.withColumns({"db_create_yr": F.col("yr"), "db_create_mnth": F.col("mnth")})
    order = Window.partitionBy("email").orderBy("yr", "mnth")
    return months.join(made, on, "left").repartition(n, "email").select(
        "yr", "mnth", "email", "db_create_yr", "db_create_mnth", "db_created_count",
        F.coalesce("db_destroyed_count", F.lit(0)).alias("db_destroyed_count"),
        F.rank().over(order).alias("user_order"),
    )


def cumulative_history(log: DataFrame) -> DataFrame:
    """Running created and destroyed totals per e-mail, and the month's rank."""
    order = Window.partitionBy("email").orderBy("yr", "mnth")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("long")
    return log.select(
        "yr", "mnth", "email",
        F.coalesce("db_created_count", zero).alias("db_created_count"),
        F.coalesce("db_destroyed_count", zero).alias("db_destroyed_count"),
        F.sum("db_created_count").over(so_far).alias("total_db_created_till_dt"),
        F.coalesce(F.sum("db_destroyed_count").over(so_far), zero).alias("total_db_destroyed_till_dt"),
        F.rank().over(order).alias("user_order"),
    )


def mark_active(history: DataFrame, first_month_rule: bool = True) -> DataFrame:
    """Adds the active year and month: more created than destroyed so far, or the first month."""
    active = F.col("total_db_created_till_dt") > F.col("total_db_destroyed_till_dt")
    if first_month_rule:
        active = active | (F.col("user_order") == 1)
    return history.select(
        "*",
        F.when(active, F.col("yr")).alias("user_active_yr"),
        F.when(active, F.col("mnth")).alias("user_active_mnth"),
    )


def active_months(history: DataFrame, first_month_rule: bool = True) -> DataFrame:
    """Active months per e-mail with their month index."""
    year, month = ORIGIN
    return (
        mark_active(history, first_month_rule)
        .where(F.col("user_active_yr").isNotNull())
        .select(
            "user_active_yr", "user_active_mnth", "email",
            ((F.col("user_active_yr") - year) * 12 + (F.col("user_active_mnth") - month)).alias("visit_month"),
        )
    )


def retention_backward(months: DataFrame) -> DataFrame:
    """new / retained / reactivated, by the gap to the previous active month."""
    gap = F.col("visit_month") - F.lag("visit_month").over(Window.partitionBy("email").orderBy("visit_month"))
    kind = F.when(gap == 1, "retained").when(gap > 1, "reactivated").when(gap.isNull(), "new")
    return months.select("email", "visit_month", gap.alias("time_diff"), kind.alias("cust_type"))


def retention_forward(months: DataFrame) -> DataFrame:
    """retained / churned / NA, by the gap to the next active month."""
    gap = F.lead("visit_month").over(Window.partitionBy("email").orderBy("visit_month")) - F.col("visit_month")
    kind = F.when(gap == 1, "retained").when(gap > 1, "churned").when(gap.isNull(), "NA")
    return months.select("email", "visit_month", gap.alias("time_diff"), kind.alias("cust_type"))


def churn_month(forward: DataFrame) -> DataFrame:
    """Books a churn on the month after the last active one, keeping the original month."""
    shift = F.when(F.col("cust_type") == "churned", 1).otherwise(0)
    return forward.select(
        "email", F.col("visit_month").alias("visit_month_orig"), "cust_type",
        (F.col("visit_month") + shift).alias("visit_month"),
    )


def older_history(users: DataFrame) -> DataFrame:
    """Older variant of the history, over :func:`active_users`: no first-month rule, null counts kept."""
    order = Window.partitionBy("email").orderBy("yr", "mnth")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = users.select(
        "yr", "mnth", "email", "db_create_yr", "db_create_mnth", "db_created_count", "db_destroyed_count",
        F.sum("db_created_count").over(so_far).alias("total_db_created_till_dt"),
        F.coalesce(F.sum("db_destroyed_count").over(so_far), F.lit(0)).alias("total_db_destroyed_till_dt"),
        F.lit(0).alias("user_order"),
    )
    return mark_active(totals, first_month_rule=False).drop("user_order")
