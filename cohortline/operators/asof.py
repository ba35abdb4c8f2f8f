"""As-of lookup as one sorted sequence of versions and points, where a hot key is cut into pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Pieces that a hot key's sequence is cut into.
PIECES = 64
#: A key is hot above this part of all rows; so there are fewer hot keys than this, and what is broadcast has at most HOT * PIECES rows.
HOT = 1000


def sequence(
    points: DataFrame, versions: DataFrame, at: str, key: str, value: str, start: str, end: str, closed: bool
) -> DataFrame:
    """Points and versions in one frame: ``_key``, ``_t``, ``_order`` among equal times, and ``_row`` or ``_version``.

    A point without key or time, and a version that is empty or has no key, start or end, can meet nothing and is left out.
    """
    begin, stop = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    effective = versions.where(F.col(key).isNotNull() & (begin < stop)).select(
        F.col(key).alias("_key"), begin.alias("_t"), F.lit(0 if closed else 2).alias("_order"),
        F.struct(stop.alias("until"), F.col(value).alias("value")).alias("_version"))
    asked = points.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.col(key).alias("_key"), F.col(at).cast("timestamp").alias("_t"), F.lit(1).alias("_order"),
        F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_row"))
    return asked.unionByName(effective, allowMissingColumns=True)


def piece_bounds(rows: DataFrame, pieces: int = PIECES, hot: int = HOT) -> DataFrame | None:
    """Hot keys with the times (microseconds) at which their pieces begin; None without hot keys."""
    total = rows.count()
    many = rows.groupBy("_key").count().where(F.col("count") > total / hot).select("_key")
    if many.isEmpty():
        return None
    shares = [i / pieces for i in range(1, pieces)]
    times = rows.select("_key", F.unix_micros("_t").alias("_at")).join(F.broadcast(many), "_key")
    return times.groupBy("_key").agg(F.array_distinct(F.percentile_approx("_at", shares, 10_000)).alias("_bounds"))


def place(rows: DataFrame, bounds: DataFrame | None) -> DataFrame:
    """Adds ``_piece``; rows of equal key and time are in the same piece, and pieces follow each other in time."""
    if bounds is None:
        return rows.withColumn("_piece", F.lit(0))
    begun = F.size(F.filter("_bounds", lambda b: b <= F.unix_micros("_t")))
    return rows.join(F.broadcast(bounds), "_key", "left").withColumn(
        "_piece", F.when(F.col("_bounds").isNull(), 0).otherwise(begun)).drop("_bounds")


def carries(placed: DataFrame, bounds: DataFrame) -> DataFrame:
    """For each piece of a hot key, the last version that began in an earlier piece: at most HOT * PIECES rows."""
    last = placed.where(F.col("_version").isNotNull()).join(F.broadcast(bounds.select("_key")), "_key", "left_semi")
    last = last.groupBy("_key", "_piece").agg(F.max(F.struct("_t", "_version")).alias("_last"))
    every = bounds.select("_key", F.explode(F.sequence(F.lit(0), F.size("_bounds"))).alias("_piece"))
    before = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    found = every.join(last, ["_key", "_piece"], "left")
    return found.select("_key", "_piece", F.last("_last", ignorenulls=True).over(before).alias("_last")).select(
        "_key", "_piece", F.col("_last._version").alias("_carried"))


def as_of(
    points: DataFrame,
    versions: DataFrame,
    at: str,
    key: str = "dbid",
    value: str = "db_size",
    start: str = "ts_effective_from",
    end: str = "ts_effective_thru",
    closed: bool = True,
    pieces: int = PIECES,
    hot: int = HOT,
) -> DataFrame:
    """The points with ``value`` of the version effective at each, null if there is none.

    Points and versions are sorted together by key and time and the last version
    is carried forward, so rows are never paired: neither many points nor many
    versions of a key multiply. A key with more than one part in ``hot`` of all
    rows is cut into ``pieces`` by quantiles of its times, each sorted on its
    own; the last version of the pieces before comes from a small table. Where
    versions overlap, the one that began last counts (see
    ``lifetimes.check_versions``). ``closed`` includes a version's first
    instant. Points without key or time keep their row, with null.
    """
    rows = sequence(points, versions, at, key, value, start, end, closed)
    bounds = piece_bounds(rows, pieces, hot)
    placed = place(rows, bounds)
    so_far = Window.partitionBy("_key", "_piece").orderBy("_t", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = placed.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far)).where(F.col("_row").isNotNull())
    version: Column = F.col("_found")
    if bounds is not None:
        found = found.join(F.broadcast(carries(placed, bounds)), ["_key", "_piece"], "left")
        version = F.coalesce("_found", "_carried")
    kept = [c for c in points.columns if c != value]
    met = found.withColumn("_met", version).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in kept],
        F.when(F.col("_t") < F.col("_met.until"), F.col("_met.value")).alias(value))
    kind = versions.schema[value].dataType
    lone = points.where(F.col(key).isNull() | F.col(at).isNull())
    return met.unionByName(lone.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast(kind).alias(value)))
