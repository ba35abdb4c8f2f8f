"""Mixing sources to target weights by systematic sampling, in DataFrame operations only."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window as W, functions as F

WORDS = r"[^\x20\x09-\x0D]+"
#: Rows of a source and size band that one task ranks.
CHUNK = 20_000
#: Rows of the per-chunk table that may be broadcast (about 8 MB); beyond it the tables join by a shuffle.
BROADCAST_ROWS = 100_000


def offset(seed: int) -> float:
    """The one random offset of a mix, in [0, 1)."""
    return random.Random(seed).random()


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeat: float) -> DataFrame:
    """source, source_size, target: `share` of all words dealt out by weight, none above `repeat` times its source.

    `sizes` has a row per source. Sources that would go above their limit get it,
    and the others share the rest by weight. With sources in order of limit /
    weight, each row's `level` is what a unit of weight gets if all earlier
    sources are at their limits; the first level that its own source can take is
    the common one.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select("source", "source_size", weight.cast("long").alias("weight"))
    ranked = ranked.withColumn("ratio", repeat * F.col("source_size") / F.col("weight"))
    up = W.orderBy("ratio", F.col("source").asc_nulls_last())
    every = W.partitionBy()
    ranked = ranked.select(
        "*", (share * F.sum("source_size").over(every)).alias("all_words"),
        F.coalesce(F.sum("source_size").over(up.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("full"),
        F.sum("weight").over(up.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("open"))
    ranked = ranked.withColumn("level", (F.col("all_words") - repeat * F.col("full")) / F.col("open"))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(every)
    return ranked.select("source", "source_size", F.least(
        repeat * F.col("source_size"), F.coalesce(level * F.col("weight"), repeat * F.col("source_size"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, repeat: float = 2.0,
        seed: int = 17, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, and the carried columns, of every document.

    Within a source every document is expected target / source_size times. Its
    expected copies are summed along the source in order of size, the one offset
    is added, and a copy is emitted for each whole number that the sum passes, so
    neighbours in size are taken evenly and the words taken stay near the target.
    Order: bit length of the size, doc_id modulo the number of chunks of that
    band, size, doc_id. Places are counted per chunk and chunks are placed by
    their totals, so no task ranks a whole source. Cases: null and empty texts
    have size 0; a null source is a source of its own, the last; sources without
    words have target 0 and no copies; equal rows are told apart by place only;
    null ids share their band's first chunk; an empty table gives an empty
    result. `repeat` above 2 is allowed; no document is emitted more than
    ceil(repeat) times.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        *[F.col(c).alias(f"carried_{c}") for c in carry])
    sized = sized.withColumn("band", F.length(F.bin("size")))
    bands = sized.groupBy("source", "band").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / CHUNK)).cast("long")
    targets = source_targets(bands.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, repeat)
    bands = bands.select("source", "band", salts.alias("salts"))

    def with_band(frame: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
        table = table.select("*", F.col("source").alias("own_source")).drop("source")
        same = F.col("source").eqNullSafe(F.col("own_source"))
        for k in keys:
            table = table.withColumnRenamed(k, f"own_{k}")
            same = same & (F.col(k) == F.col(f"own_{k}"))
        small = table.count() <= BROADCAST_ROWS
        joined = frame.join(F.broadcast(table) if small else table, same)
        return joined.drop("own_source", *[f"own_{k}" for k in keys])

    salt: Column = F.coalesce(F.pmod("doc_id", "salts"), F.lit(0))
    chunked = with_band(sized, bands, ["band"]).withColumn("salt", salt).drop("salts")
    chunks = chunked.groupBy("source", "band", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(
        W.partitionBy("source").orderBy("band", "salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    places = chunks.select("source", "band", "salt", before.alias("before")).join(
        targets.withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source"))
    ).drop("target_source")
    ranked = with_band(chunked, places, ["band", "salt"])
    place = F.col("before") + F.row_number().over(
        W.partitionBy("source", "band", "salt").orderBy("size", F.col("doc_id").asc_nulls_first()))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = offset(seed)
    ranked = ranked.withColumn("place", place).withColumn("rate", rate)
    copies = (F.floor(u + F.col("rate") * F.col("place")) - F.floor(u + F.col("rate") * (F.col("place") - 1))).cast("long")
    return ranked.select(
        "doc_id", "source", "size", "source_size", "target", F.least(copies, F.ceil(F.lit(repeat))).alias("copies"),
        *[F.col(f"carried_{c}").alias(c) for c in carry])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row once per copy, with its `size` and `copy` counting from 1.

    Columns of docs named size or copy are replaced; others are carried unread, whatever their names.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("size", "copy")]
    rows = mix(docs.select("doc_id", "source", "text", F.struct(*kept).alias("row")), carry=("row",), **options)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return rows.where("copies > 0").select("row.*", "size", copies)
