"""Daily usage per user and tier, swept rather than exploded."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from cohortline.functions import numbers, times
from cohortline.functions.parts import parts_for
from cohortline.operators import intervals, lifetimes

KEYS = ("email", "userkey", "db_billing_identity")
OWNER = ("email", "userkey", "account_id", "user_classification")
MEASURES = ("total", "kept", "gone", "fresh", "sized", "micro_mb")


def usage_runs(
    assets: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    start: date | str | None = None,
    tiers: Sequence[str] = lifetimes.METERED_TIERS,
) -> DataFrame:
    """Stretches of days over which a user's usage of one tier does not change.

    "Qualified" needs a destroy time at least a day after creation, so assets
    still live never qualify. Size versions of one asset must not overlap.
    """
    live = _live(assets, as_of, start, tiers)
    pieces = _finished(live, history, _whole_life())
    runs = intervals.sweep(pieces, KEYS, MEASURES, home=("email", "userkey"))
    owners = lifetimes.tenure_range(
        live.withColumns({"db_created_at": F.col("born"), "db_destroyed_at": F.col("died")}), [*OWNER]
    )
    return _with_owners(runs, owners, times.moment(as_of).date())


def _live(assets: DataFrame, as_of: datetime | str, start: date | str | None, tiers: Sequence[str]) -> DataFrame:
    """Assets of the tiers with the days ``lo`` to ``hi`` on whose ends they count; repeated rows of an asset are one."""
    end = lifetimes.end_or(as_of)
    first = times.first_end_after("day", F.col("db_created_at"))
    if start is not None:
        first = F.greatest(first, times.position("day", times.instant(start)))
    gone_on = times.position("day", F.col("db_destroyed_at"))
    return (
        assets.where(F.col("db_billing_identity").isin(*tiers))
        .select(
            "dbid", *KEYS, "user_classification", lifetimes.account_id().alias("account_id"),
            F.col("db_created_at").alias("born"), F.col("db_destroyed_at").alias("died"),
            first.alias("lo"),
            F.least(times.position("day", end), F.lit(times.last_closed_position("day", as_of))).alias("hi"),
            F.coalesce(
                times.lasted(F.col("db_created_at"), F.col("db_destroyed_at"), "1 DAY"), F.lit(False)
            ).alias("counts"),
            gone_on.alias("gone_on"),
        )
        .where(F.col("lo") <= F.col("hi"))
        .repartition("dbid")
        .distinct()
    )


def _whole_life() -> Column:
    return intervals.piece(F.col("lo"), F.col("hi"), {"total": 1}, MEASURES)


def _finished(live: DataFrame, history: DataFrame, *more: Column) -> DataFrame:
    """Pieces of everything that only an asset's end decides: qualified days, sizes, first and last day.

    ``more`` pieces of each asset are emitted with these, so the assets are read once for them.
    """
    lo, hi, gone = F.col("lo"), F.col("hi"), F.col("gone_on")
    none = F.lit(-1)
    born_on = times.position("day", F.col("born"))
    kept_to = F.when(F.col("counts"), F.least(hi, gone - 1)).otherwise(lo - 1)

    def single(day, wanted):
        inside = F.col("counts") & day.between(lo, hi)
        return intervals.piece(
            F.when(inside, day).otherwise(F.lit(0)), F.when(inside, day).otherwise(none), {wanted: 1}, MEASURES
        )

    counted = intervals.emit(live, KEYS, [
        *more,
        intervals.piece(lo, kept_to, {"kept": 1}, MEASURES),
        single(gone, "gone"),
        single(born_on, "fresh"),
    ])
    sized = live.join(lifetimes.version_span(history, "day", closed=False).hint("merge"), "dbid")
    sizes = intervals.emit(sized.where(F.col("db_size").isNotNull()), KEYS, [
        intervals.piece(
            F.greatest(lo, F.col("v_first")), F.least(kept_to, F.col("v_last")),
            {"sized": 1, "micro_mb": numbers.micros(F.col("db_size"))}, MEASURES,
        )
    ])
    return counted.unionByName(sizes)


def _with_owners(runs: DataFrame, owners: DataFrame, today: date) -> DataFrame:
    """The runs of each user between the first and last day of every account of the user's."""
    from_day = F.greatest("first", F.unix_date("start_date"))
    to_day = F.least("last", F.unix_date(F.coalesce("churn_date", F.lit(today))))
    return (
        runs.where("total > 0")
        .join(owners, ["email", "userkey"])
        .select(
            "email", "userkey", "account_id", "user_classification", "db_billing_identity",
            from_day.alias("first"), to_day.alias("last"),
            F.col("total").alias("total_db"),
            F.when(F.col("kept") > 0, F.col("kept")).alias("qualified_db"),
            F.when(F.col("sized") > 0, numbers.from_micros(F.col("micro_mb")) / 1024).alias("qualified_gb"),
            F.when(F.col("gone") > 0, F.col("gone")).alias("qualified_db_deleted"),
            F.when(F.col("fresh") > 0, F.col("fresh")).alias("qualified_db_new"),
        )
        .where("first <= last")
    )


def usage_changes(
    assets: DataFrame,
    history: DataFrame,
    after: date | str | None,
    through: date | str,
    tiers: Sequence[str] = lifetimes.METERED_TIERS,
) -> dict[str, DataFrame]:
    """What the days after ``after`` (None: all) and up to ``through`` add to the usage, as ``edges`` and ``owners``.

    ``assets`` is the table as known when ``through`` has ended. An asset enters
    on the first day whose end it sees and opens a run; when it is destroyed, it
    closes the run and adds what only then is known, such as its qualified days,
    which may lie long before. Changes of different days add up to the whole, by
    sums per user, tier and position, and per owner. Only assets that entered or
    ended on these days are read on from the scan, and only the size versions of
    those that ended.
    """
    known = f"{times.moment(str(through)).date() + timedelta(days=1)} 00:00:01"
    last = times.last_closed_position("day", known)
    low = -(1 << 31) if after is None else times.moment(str(after)).date().toordinal() - date(1970, 1, 1).toordinal()
    recent = assets
    if after is not None:
        # Plain comparisons with the moments reach the scan.
        since = times.instant(str(after))
        recent = assets.where((F.col("db_created_at") >= since) | (F.col("db_destroyed_at") >= since))
    live = _live(recent, known, None, tiers)
    entered, ended = F.col("lo").between(low + 1, last), F.col("gone_on").between(low + 1, last)
    begin = live.where(entered).select(*KEYS, F.col("lo").alias("at"), F.lit(1).cast("long").alias("total"))
    finish = live.where(ended).select(*KEYS, (F.col("gone_on") + 1).alias("at"), F.lit(-1).cast("long").alias("total"))
    later = intervals.edge_sums(_finished(live.where(ended), history), KEYS, MEASURES)
    edges = later.unionByName(begin.unionByName(finish), allowMissingColumns=True)
    owner = live.where(entered | ended).select(
        *OWNER, F.when(entered, F.col("born")).alias("born"), F.when(ended, F.col("died")).alias("died"),
        (entered.cast("long") - F.coalesce(ended, F.lit(False)).cast("long")).alias("open"),
    )
    return {"edges": _sum_edges(edges), "owners": _sum_owners(owner)}


def _sum_edges(edges: DataFrame) -> DataFrame:
    sums = edges.groupBy(*KEYS, F.col("at").cast("int").alias("at")).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES])
    return sums.where(" or ".join(f"{m} <> 0" for m in MEASURES))


def _sum_owners(owners: DataFrame) -> DataFrame:
    return owners.groupBy(*OWNER).agg(F.min("born").alias("born"), F.max("died").alias("died"), F.sum("open").alias("open"))


def runs_of_changes(edges: DataFrame, owners: DataFrame, as_of: datetime | str) -> DataFrame:
    """:func:`usage_runs` as of a moment after the last day of the changes, from their rows alone."""
    last = F.lit(times.last_closed_position("day", as_of))
    runs = intervals.runs(_sum_edges(edges).repartition("email", "userkey"), KEYS, MEASURES)
    runs = runs.withColumn("last", F.least(F.coalesce("last", last), last))
    ranges = _sum_owners(owners).select(
        *OWNER, F.to_date("born").alias("start_date"), F.when(F.col("open") == 0, F.to_date("died")).alias("churn_date")
    )
    return _with_owners(runs, ranges, times.moment(as_of).date())


def expand_days(runs: DataFrame) -> DataFrame:
    """One row per day of each run."""
    columns = [c for c in runs.columns if c not in ("first", "last")]
    days = intervals.expand(runs, "_day", columns)
    return days.select(times.first_date("day", F.col("_day")).alias("as_of_date"), *columns)


def daily_usage(
    assets: DataFrame,
    history: DataFrame,
    as_of: datetime | str,
    start: date | str | None = None,
    tiers: Sequence[str] = lifetimes.METERED_TIERS,
) -> DataFrame:
    """One row per user, tier and day with a live asset; counts are null, not 0, when nothing qualifies."""
    return expand_days(usage_runs(assets, history, as_of, start, tiers))


def live_days(usage: DataFrame) -> DataFrame:
    """Live days per user, total and per tier group, from daily rows or from runs.

    The total counts user-and-tier rows, so a day with two tiers counts twice.
    """
    length = F.col("last") - F.col("first") + 1 if "first" in usage.columns else F.lit(1)
    on = F.when(F.col("total_db") > 0, length).otherwise(0)
    tier = F.col("db_billing_identity")
    groups = {
        "live_days_pro": lifetimes.PRO_TIERS,
        "live_days_free": ("Free",),
        "live_days_enterprise": ("Enterprise",),
        "live_days_gds": ("GDS",),
    }
    return usage.groupBy("userkey").agg(
        F.sum(on).alias("total_live_days"),
        *[F.sum(F.when(tier.isin(*t), on).otherwise(0)).alias(n) for n, t in groups.items()],
    )


def active_days(usage: DataFrame) -> DataFrame:
    """Short form of :func:`live_days`, per e-mail and user."""
    length = F.col("last") - F.col("first") + 1 if "first" in usage.columns else F.lit(1)
    on = F.when(F.col("total_db") > 0, length).otherwise(0)
    tier = F.col("db_billing_identity")
    return usage.groupBy("email", "userkey").agg(
        F.sum(on).alias("active_days"),
        F.sum(F.when(tier.isin(*lifetimes.PRO_TIERS), on).otherwise(0)).alias("active_days_pro"),
        F.sum(F.when(tier == "Free", on).otherwise(0)).alias("active_days_free"),
    )
