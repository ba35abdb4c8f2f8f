"""Helpers that the corpus operators share: written cuts, hashed words, connected components."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

# The separators of `[^\x20\x09-\x0D]+`.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
# The separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing A-Z.
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

#: Bytes of text that are worked on at once in a task; some fifty times as much memory is taken, and kept by the worker.
SLICE_BYTES = 1 << 18
_U = np.uint64
_STEP, _MIX1, _MIX2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which the caller's cluster shares and clears.

    A local session, as in tests, gets a folder of its own where none is set; it
    goes when the process ends. On a cluster an unset folder is an error, since
    executors could not see the driver's. What is written there is read by the
    lazy results, so it stays until the caller has written those.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="cohortline-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named


def cut(frame: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back, so that later steps survive lost executors."""
    path = f"{shared_folder(frame.sparkSession).rstrip('/')}/cohortline-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = x + _STEP
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(256, dtype=_U))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers = (both[0], both[1])
    return _powers


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], raw[at[0]: at[-1]]


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first text, last text + 1) of short runs of whole texts of a string column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i, n = 0, len(ends)
    while i < n:
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield i, j
        i = j


def _split(data: np.ndarray, offsets: np.ndarray, separators: bytes):
    """Word hashes, starts, ends and words per text of a short run of texts."""
    is_sep = np.zeros(256, bool)
    is_sep[list(separators)] = True
    low = _LOWER[data]
    word = ~is_sep[low]
    n = len(low)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    heads, tails = offsets[:-1], offsets[1:] - 1
    filled = offsets[1:] > heads
    heads, tails = heads[filled], tails[filled]
    first[heads] = word[heads]
    last[tails] = word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_BYTE_VALUE[low] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    return hashes, starts, ends, np.diff(np.searchsorted(starts, offsets))


def _long_text(data: np.ndarray, separators: bytes):
    """One text of any length, split at separators so that memory stays in proportion to a slice."""
    is_sep = np.zeros(256, bool)
    is_sep[list(separators)] = True
    parts, begin = [], 0
    while begin < len(data):
        end = min(begin + SLICE_BYTES, len(data))
        while end < len(data):
            gaps = np.flatnonzero(is_sep[_LOWER[data[begin:end]]])
            if len(gaps):
                end = begin + int(gaps[-1]) + 1
                break
            end = min(end + SLICE_BYTES, len(data))
        h, s, e, _ = _split(data[begin:end], np.array([0, end - begin]), separators)
        parts.append((h, s + begin, e + begin))
        begin = end
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def word_slices(column: pa.Array, separators: bytes) -> Iterator[tuple]:
    """(first text, last text + 1, word hashes, starts, ends, first word of each text, bytes) by short runs of whole texts.

    Words are hashed after lower-casing A-Z, on the UTF-8 bytes; starts and ends
    are positions in the given bytes.
    """
    offsets, data = texts(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, "right")) - 1)
        part, at = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        if j == i + 1 and len(part) > SLICE_BYTES:
            hashes, starts, ends = _long_text(part, separators)
            counts = np.array([len(hashes)])
        else:
            hashes, starts, ends, counts = _split(part, at, separators)
        yield i, j, hashes, starts, ends, np.concatenate([[0], np.cumsum(counts)]), part
        i = j


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node of the edges (a, b); component is the smallest id that links reach.

    Alternates the large-star and small-star steps until nothing changes. Each
    round's edges are written to the shared folder; only three numbers a round
    come back to the driver. Null ids carry no edge.
    """
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e if small else e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        joined = both.join(least, "a")
        if small:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b"))
            )
        else:
            moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where(F.col("a") > F.col("b")).distinct()

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()

    now = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut(now)
    before = state(now)
    for _ in range(rounds):
        if not before[0]:
            break
        now = cut(star(star(now, small=False), small=True))
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
