"""Interval sweep: totals over overlapping intervals without exploding them.

Each interval becomes two signed edges. Edges are summed per key and position
before the shuffle, so a key holding a third of all intervals still reaches
its task as at most one row per position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def emit(frame: DataFrame, keys: Sequence[str], pieces: Sequence[Column]) -> DataFrame:
    """One row per struct in ``pieces`` (each with ``first``, ``last``, measures); empty ones dropped."""
    return frame.select(*keys, F.inline(F.array(*pieces))).where(F.col("first") <= F.col("last"))


def piece(first: Column, last: Column, measures: dict[str, Column | int], names: Sequence[str]) -> Column:
    """A struct for :func:`emit` with every measure in ``names`` as a long; those not given are 0."""
    filled = [F.lit(measures.get(m, 0)).cast("long").alias(m) for m in names]
    return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"), *filled)


def edge_sums(pieces: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key and position ``at`` where a piece begins or has ended, with the change of every measure."""
    up = F.struct(F.col("first").alias("at"), *[F.col(m) for m in measures])
    down = F.struct((F.col("last") + 1).alias("at"), *[(-F.col(m)).alias(m) for m in measures])
    edges = pieces.select(*keys, F.inline(F.array(up, down)))
    return edges.groupBy(*keys, "at").agg(*[F.sum(m).alias(m) for m in measures])


def runs(turns: DataFrame, keys: Sequence[str], measures: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Runs between the positions of :func:`edge_sums`, with the totals over them and the carried columns."""
    ordered = Window.partitionBy(*keys).orderBy("at")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return turns.select(
        *keys,
        F.col("at").alias("first"),
        (F.lead("at").over(ordered) - 1).alias("last"),
        *[F.sum(m).over(so_far).alias(m) for m in measures],
        *carry,
    )


def sweep(pieces: DataFrame, keys: Sequence[str], measures: Sequence[str], home: Sequence[str] | None = None, parts: int | None = None) -> DataFrame:
    """Runs ``(keys, first, last, totals)`` over which the sum of covering pieces is constant.

    ``home`` is a subset of ``keys`` to place the summed edges by, so later
    windows and aggregates on supersets of it need no further shuffle; ``parts`` is
    the number of parts then, for runs that fan out behind it.
    """
    turns = edge_sums(pieces, keys, measures)
    placed = [parts, *home] if home and parts else home
    return runs(turns.repartition(*placed) if placed else turns, keys, measures)


def expand(runs: DataFrame, name: str, keep: Sequence[str | Column]) -> DataFrame:
    """One row per position of each run."""
    return runs.where(F.col("first") <= F.col("last")).select(
        *keep, F.explode(F.sequence("first", "last")).alias(name)
    )
