"""Time arithmetic with one meaning in every operator.

Elapsed differences count whole units; calendar differences count boundaries.
A *position* is an integer on the day or month axis, which is what the
interval operators sweep over.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

UNITS = ("day", "month")


def moment(as_of: datetime | date | str) -> datetime:
    """Parse an ``as_of`` argument into a naive UTC datetime."""
    if isinstance(as_of, str):
        return datetime.fromisoformat(as_of)
    if isinstance(as_of, datetime):
        return as_of.replace(tzinfo=None)
    return datetime(as_of.year, as_of.month, as_of.day)


def instant(as_of: datetime | date | str) -> Column:
    """``as_of`` as a timestamp literal."""
    return F.lit(moment(as_of).isoformat(sep=" ")).cast("timestamp")


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units from ``start`` to ``end`` (negative if reversed)."""
    return F.timestamp_diff(unit.upper(), start, end)


def lasted(start: Column, end: Column, interval: str) -> Column:
    """At least ``interval`` passed from ``start`` to ``end``, in whole units of it."""
    return end >= start + F.expr(f"INTERVAL {interval}")


def month_index(t: Column) -> Column:
    """Months since year 0, so a difference counts month boundaries."""
    return F.year(t) * 12 + F.month(t) - 1


def month_gap(start: Column, end: Column) -> Column:
    """Calendar months from ``start`` to ``end``: 31 January to 1 February is 1."""
    return month_index(end) - month_index(start)


def position(unit: str, t: Column) -> Column:
    """Position of the day or month holding ``t``."""
    return F.unix_date(F.to_date(t)) if unit == "day" else month_index(t)


def first_date(unit: str, pos: Column) -> Column:
    """First calendar date of a position."""
    if unit == "day":
        return F.date_from_unix_date(pos)
    return F.add_months(F.lit(date(1970, 1, 1)), pos - 1970 * 12)


def period_end(unit: str, pos: Column) -> Column:
    """Last whole second of a position, as a timestamp."""
    return first_date(unit, pos + 1).cast("timestamp") - F.expr("INTERVAL 1 SECOND")


def first_end_after(unit: str, t: Column, inclusive: bool = False) -> Column:
    """First position whose end second is after ``t`` (or equal, if inclusive).

    An end second lies one second before the next position, so this is the
    position ``t`` has a second later.
    """
    ahead = "INTERVAL '0.999999' SECOND" if inclusive else "INTERVAL 1 SECOND"
    return position(unit, t + F.expr(ahead))


def last_end_before(unit: str, t: Column) -> Column:
    """Last position whose end second is strictly before ``t``."""
    return first_end_after(unit, t, inclusive=True) - 1


def last_closed_position(unit: str, as_of: datetime | date | str) -> int:
    """Last position that ended, by its closing midnight, strictly before ``as_of``."""
    t = moment(as_of) - timedelta(microseconds=1)
    if unit == "day":
        return (t.date() - date(1970, 1, 1)).days - 1
    return t.year * 12 + t.month - 2
