"""Monthly lifecycle of each user in each tier group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortline.functions import aggs, numbers, times
from cohortline.functions.parts import parts_for
from cohortline.operators import intervals, lifetimes

USER = ("email", "userkey")
MEASURES = ("present", "assets", "sized", "micro_mb", "cents")
# Fixed value: the tier group that is never charged.
UNPRICED = ("free",)
#: Assets a task takes where their months are listed, met with tenures and sorted by user.
MOST = 25_000


def _group_tags(tier: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Names of the tier groups a tier belongs to, as an array."""
    return F.array_compact(F.array(*[F.when(tier.isin(*t), F.lit(g)) for g, t in groups.items()]))


def tier_month_usage(
    assets: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    groups: Mapping[str, Sequence[str]] = lifetimes.TIER_GROUPS,
) -> DataFrame:
    """Usage per user, tier group and month end, with the neighbouring appearances.

    Only assets that outlive the month end's day and are two hours old by then
    count; a month in which none does keeps its row with null measures. Size
    versions of one asset must not overlap.
    """
    tiers = sorted({t for ts in groups.values() for t in ts})
    live = lifetimes.snapshot_assets(assets, as_of, tiers)
    ranges = lifetimes.tenure_range(live, [*USER, "account_id"], groups)
    month, previous, following = (times.first_date("month", F.col(c)) for c in ("_m", "_previous", "_next"))
    return _usage(live, ranges, history, as_of, groups, parts_for(assets, MOST)).where(F.col("tier_group").isNotNull()).select(
        times.period_end("month", F.col("_m")).alias("calculated_date"),
        month.alias("as_of_date"),
        *USER, "account_id", "tier_group", "tier_start_date", "tier_churn_date", "num_db", "num_gb", "num_mrr",
        previous.alias("previous_appearance"), following.alias("next_appearance"),
    )


def _usage(live, ranges, history, as_of, groups, parts: int, life: Column | None = None) -> DataFrame:
    """Usage per user, account, tier group and month, placed by user.

    The tenure ranges travel as tagged rows among the summed edges, so one
    placement by user serves the sweep, the meeting of usage and ranges, and all
    that follows, in ``parts`` parts. ``life`` gives a range's months; each of them is then a row
    without tier group that holds the range as ``spine``.
    """
    keys = [*USER, "account_id", "tier_group"]

    def tag(frame: DataFrame) -> DataFrame:
        tags = F.explode(_group_tags(F.col("db_billing_identity"), groups))
        return frame.select("*", tags.alias("tier_group"))

    lo, hi, born = F.col("first"), F.col("last"), F.col("db_created_at")
    of_age = times.lasted(born, times.period_end("month", lo), lifetimes.MIN_LIFE)
    live = live.withColumns({
        "from_month": lo + F.when(of_age, 0).otherwise(1),
        "to_month": F.least(hi, times.month_index(lifetimes.end_or(as_of)) - 1),
    })
    from_month, to_month = F.col("from_month"), F.col("to_month")
    counted = intervals.emit(tag(live), keys, [
        intervals.piece(lo, hi, {"present": 1}, MEASURES),
        intervals.piece(from_month, to_month, {"assets": 1}, MEASURES),
    ])
    # Only assets and their versions move by dbid; tier groups and pieces fan out after.
    sized = live.repartition(parts, "dbid").join(lifetimes.version_span(history, "month", closed=True).hint("merge"), "dbid")
    size = F.col("db_size")
    sized = sized.where(size.isNotNull()).withColumns({
        "micro_mb": numbers.micros(size), "cents": numbers.cents(numbers.monthly_price(size / 1024)),
    })
    sizes = intervals.emit(tag(sized), keys, [
        intervals.piece(
            F.greatest(from_month, F.col("v_first")), F.least(to_month, F.col("v_last")),
            {"sized": 1, "micro_mb": F.col("micro_mb"), "cents": F.col("cents")}, MEASURES,
        )
    ])
    turns = intervals.edge_sums(counted.unionByName(sizes), keys, MEASURES)
    tenure = F.struct(*[c for c in ranges.columns if c not in USER])
    tagged = turns.unionByName(ranges.select(*USER, tenure.alias("tenure")), allowMissingColumns=True).repartition(parts, *USER)
    every = F.collect_list("tenure").over(Window.partitionBy(*USER))
    runs = intervals.runs(tagged.withColumn("tenures", every), keys, MEASURES, carry=("tenure", "tenures"))

    # As in a join by user, rows without an e-mail or user meet no range.
    whole = F.col("email").isNotNull() & F.col("userkey").isNotNull() & (F.col("present") > 0)
    used = F.when(whole & (F.col("first") <= F.col("last")), F.sequence("first", "last"))
    is_range = F.col("tenure").isNotNull()
    months = runs.select(
        *keys, "assets", "sized", "micro_mb", "cents", "tenure",
        F.when(is_range, F.array("tenure")).otherwise(F.col("tenures")).alias("met"),
        F.explode(used if life is None else F.when(is_range, life).otherwise(used)).alias("_m"),
    )

    def of_group(suffix):
        picks = [F.when(F.col("tier_group") == g, F.col(f"met.{g}_{suffix}")) for g in groups]
        return F.coalesce(*picks)

    # A user with two accounts meets two ranges; equal ranges add up, as they would in a joined form.
    joined = months.withColumn("met", F.explode("met")).select(
        *keys, "_m", "assets", "sized", "micro_mb", "cents", F.col("tenure").alias("spine"),
        of_group("start_date").alias("tier_start_date"), of_group("churn_date").alias("tier_churn_date"),
    )
    totals = joined.groupBy(*keys, "_m", "tier_start_date", "tier_churn_date", "spine").agg(
        *[F.sum(m).alias(m) for m in ("assets", "sized", "micro_mb", "cents")]
    )
    order = Window.partitionBy(*USER, "tier_group").orderBy("_m", "account_id", "tier_start_date", "tier_churn_date")
    has_size = F.col("sized") > 0
    free = F.col("tier_group").isin(*UNPRICED)
    return totals.select(
        *keys, "_m", "tier_start_date", "tier_churn_date", "spine",
        F.when(F.col("assets") > 0, F.col("assets")).alias("num_db"),
        F.when(has_size, numbers.from_micros(F.col("micro_mb")) / 1024).alias("num_gb"),
        F.when(free, F.lit(0.0)).when(has_size, F.col("cents") / 100).alias("num_mrr"),
        F.lag("_m").over(order).alias("_previous"),
        F.lead("_m").over(order).alias("_next"),
    )


def status(count: Column, gap: Column, last_day: Column, start: Column, churn_or_now: Column) -> Column:
    """Lifecycle state of one tier group in one month; null when none applies.

    ``gap`` is the number of months since the previous appearance, null if there was none.
    """
    return (
        F.when((count > 0) & gap.isNull(), "New")
        .when((count > 0) & (gap == 1), "Recurring")
        .when((count > 0) & (gap > 1), "Reactivating")
        .when(count.isNull() & (gap == 1), "Churn")
        .when(count.isNull() & gap.isNull() & (start < last_day) & (last_day < churn_or_now), "Dormant")
    )


def lifecycle_status(
    assets: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    groups: Mapping[str, Sequence[str]] = lifetimes.TIER_GROUPS,
) -> DataFrame:
    """One row per user and month of the user's life: measures and status per tier group.

    A month in which a measure is gone shows minus the previous month's value.
    """
    tiers = sorted({t for ts in groups.values() for t in ts})
    live = lifetimes.snapshot_assets(assets, as_of, tiers)
    ranges = lifetimes.tenure_range(live, [*USER, "account_id"], groups)
    now = F.lit(times.moment(as_of).date())
    tenure = F.col("tenure")
    first = times.month_index(tenure["start_date"])
    last = F.least(
        times.month_index(F.coalesce(tenure["churn_date"], now)), F.lit(times.last_closed_position("month", as_of))
    )
    life = F.when(first <= last, F.sequence(first, last))
    usage = _usage(live, ranges, history, as_of, groups, parts_for(assets, MOST), life)

    # One list per tier group: a single entry unless the user has several accounts.
    entry = F.struct("account_id", "tier_start_date", "tier_churn_date", "num_db", "num_gb", "num_mrr", "_previous")
    by_month = usage.groupBy(*USER, "_m").agg(
        F.collect_list("spine").alias("_spine"),
        *[F.collect_list(F.when(F.col("tier_group") == g, entry)).alias(f"_{g}") for g in groups],
    )
    rows = by_month.select(
        *USER, "_m", *[f"_{g}" for g in groups], F.inline("_spine"),
    ).withColumn("_day", F.date_sub(times.first_date("month", F.col("_m") + 1), 1))
    for g in groups:
        rows = rows.withColumn(f"_{g}", F.explode_outer(f"_{g}"))
    ties = [F.col(f"_{g}")["account_id"] for g in groups]
    order = Window.partitionBy(*USER).orderBy("_m", "account_id", *ties)

    def shown(value: Column) -> Column:
        return F.coalesce(value, -F.lag(value).over(order), F.lit(0).cast("long"))

    out = []
    for g in groups:
        at = F.col(f"_{g}")
        out += [
            shown(at["num_db"]).alias(f"num_{g}_db"),
            shown(at["num_gb"]).alias(f"num_{g}_gb"),
            shown(at["num_mrr"]).alias(f"num_{g}_mrr"),
            status(
                at["num_db"], F.col("_m") - at["_previous"], F.col("_day"),
                F.col(f"{g}_start_date"), F.coalesce(f"{g}_churn_date", now),
            ).alias(f"{g}_status"),
        ]
    return rows.select(
        times.first_date("month", F.col("_m")).alias("as_of_date"),
        times.period_end("month", F.col("_m")).alias("calculated_date"),
        *USER, "account_id", *out,
    )


def mrr_customer_since(assets: DataFrame, as_of: datetime | str, tiers: Sequence[str] = lifetimes.PRO_TIERS) -> DataFrame:
    """First day a user counts as a paying customer: first paid asset that lived past its month.

    An asset created less than two hours before midnight counts from the next day.
    """
    born = F.col("db_created_at")
    midnight = F.date_add(F.to_date(born), 1)
    late = ~times.lasted(born, midnight.cast("timestamp"), lifetimes.MIN_LIFE)
    end = lifetimes.end_or(as_of)
    return (
        assets.where(F.col("db_billing_identity").isin(*tiers))
        .where(times.lasted(born, end, lifetimes.MIN_LIFE))
        .where(times.month_gap(born, end) > 0)
        .groupBy(*USER)
        .agg(F.min(F.when(late, midnight).otherwise(F.to_date(born))).alias("mrr_customer_since"))
    )
