"""Aggregate shapes shared by the operators. All combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_where(condition: Column) -> Column:
    """Rows where the condition holds; 0 when there are none."""
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of the value over matching rows; other rows count 0."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def flag_where(condition: Column) -> Column:
    """1 if the condition holds on any row, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def min_where(condition: Column, value: Column) -> Column:
    return F.min(F.when(condition, value))


def closing(end: Column, condition: Column | None = None) -> Column:
    """Latest end, but null while any (matching) row is still open."""
    inside = F.lit(True) if condition is None else condition
    still_open = flag_where(inside & end.isNull())
    return F.when(still_open == 0, F.max(F.when(inside, end)))


def sorted_list(value: Column, sep: str = ",") -> Column:
    """Distinct non-null values, sorted and joined; null when there are none."""
    values = F.array_sort(F.collect_set(value))
    return F.when(F.size(values) > 0, F.array_join(values, sep))
