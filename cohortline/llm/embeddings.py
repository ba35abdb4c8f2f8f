"""Near duplicates among embeddings by cross-polytope hashing.

A hash rotates the vector at random (three rounds of random signs and a fast
Hadamard transform) and takes the largest coordinate with its sign. Two such
hashes make a bucket of a table. Every vector also enters the buckets of its
next best choices (multiprobe), and pairs that meet are verified by cosine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, cut

TABLES = 10
HASHES = 2
PROBES = 3
#: Vectors in a block of one bucket.
BLOCK = 1_024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of 2."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def buckets(x: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = 11) -> np.ndarray:
    """(rows, tables, probes) bucket numbers, best first; the same seed gives the same rotations everywhere."""
    n, d = x.shape
    width = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :d] = x
    out = np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        firsts, seconds, losses = [], [], []
        for k in range(HASHES):
            random = np.random.default_rng([seed, t, k])
            y = padded
            for _ in range(3):
                y = hadamard(y * random.choice((-1.0, 1.0), width))
            size = np.abs(y)
            best = np.argmax(size, 1)
            at = np.arange(n)
            top = size[at, best].copy()
            size[at, best] = -1
            second = np.argmax(size, 1)
            losses.append(top - size[at, second])
            firsts.append(2 * best + (y[at, best] < 0))
            seconds.append(2 * second + (y[at, second] < 0))
        code = lambda a, b: (t * 2 * width + a) * 2 * width + b
        one = np.where(losses[0] <= losses[1], code(seconds[0], firsts[1]), code(firsts[0], seconds[1]))
        other = np.where(losses[0] <= losses[1], code(firsts[0], seconds[1]), code(seconds[0], firsts[1]))
        out[:, t] = np.stack([code(firsts[0], firsts[1]), one, other], 1)[:, :probes]
    return out


def _valid(embeddings: DataFrame) -> DataFrame:
    """vec_id and v (doubles) of vectors whose components are all finite and not all 0."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embeddings.select(F.col("vec_id").cast("long"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & fine & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0]: offsets[-1]].reshape(len(column), -1)


def _directions(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def near_duplicates(embeddings: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vec_id, embedding.

    Pairs found that have a cosine of `threshold` or more, in double precision,
    are links; labels play no part. Equal vectors form one class first and all
    link with each other. Classes that share a bucket are compared in blocks; a
    pair is counted in the first table where it meets, so that no pair leaves a
    task: links are summed per class, and components take spanning links.
    Vectors of different lengths do not link. Cases: vectors that are null, zero
    or hold null or non-finite components, and rows with a null vec_id, have no
    links and are their own component; repeated ids are one class per vector;
    an empty table gives an empty result.
    """
    valid = _valid(embeddings)
    classes = valid.groupBy("v").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
    classes = cut(classes)
    member = valid.join(classes, "v").select("vec_id", "class_id", "copies")
    rows = classes.select("class_id", "copies", "v", F.size("v").alias("d"))

    def hashed(batches):
        for batch in batches:
            ids, d = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for width in np.unique(d):
                at = np.flatnonzero(d == width)
                codes = buckets(_directions(_matrix(batch.column(2).take(pa.array(at)))))
                flat = codes.reshape(len(at), -1)
                ends = np.arange(len(at) + 1, dtype=np.int32) * flat.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(d[at]), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))], ["class_id", "d", "codes"])

    codes = cut(rows.select("class_id", "d", "v").mapInArrow(hashed, "class_id long, d int, codes array<long>"))
    met = codes.select("class_id", "d", F.explode("codes").alias("bucket"))
    full = met.groupBy("d", "bucket").agg(F.count("*").alias("m")).where("m > 1")
    blocks = f"(m + {BLOCK - 1}) div {BLOCK}"
    placed = met.join(full, ["d", "bucket"]).select(
        "class_id", "d", "bucket", F.expr(f"cast({blocks} as int)").alias("b"),
        F.expr(f"cast(pmod(xxhash64(class_id), {blocks}) as int)").alias("own"))
    units = placed.select("class_id", "d", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("other"))
    units = units.select("class_id", "d", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                         (F.col("own") <= F.col("other")).alias("left"), (F.col("own") >= F.col("other")).alias("right"))
    sent = units.join(rows.select("class_id", "copies", "v").join(codes.select("class_id", "codes"), "class_id"), "class_id")
    found = (sent.select("d", "bucket", "lo", "hi", "class_id", "copies", "left", "right", "v", "codes")
             .repartition("d", "bucket", "lo", "hi").sortWithinPartitions("d", "bucket", "lo", "hi", "class_id")
             .mapInArrow(lambda batches: _compare(batches, threshold), "a long, b long, n long"))
    found = cut(found)
    degrees = found.where("b is null").groupBy(F.col("a").alias("class_id")).agg(F.sum("n").alias("n"))
    linked = components(found.where("b is not null").select("a", "b")).withColumnRenamed("id", "class_id")
    member = member.join(degrees, "class_id", "left").join(linked, "class_id", "left").select(
        F.col("vec_id").alias("own"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "class_id").alias("component_id")).groupBy("own").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = embeddings.select(F.col("vec_id").cast("long")).join(member, F.col("vec_id") == F.col("own"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def _compare(batches, threshold: float):
    """Sums of links (a, null, n) and spanning links (a, b, null) of each unit of at most two blocks."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4, 8)]
        out: list[tuple] = []
        begin = 0
        for i in range(len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                if i > begin:
                    if keys[begin] != key:
                        out += _unit(held, threshold)
                        key, held = keys[begin], []
                    size = i - begin
                    held.append((*[c[begin:i].copy() for c in cols], _matrix(batch.column(8).slice(begin, size)).copy(),
                                 _matrix(batch.column(9).slice(begin, size)).copy(), keys[begin][1]))
                begin = i
        if out:
            yield _links(out)
    if out := _unit(held, threshold):
        yield _links(out)


def _links(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(3)], ["a", "b", "n"])


def _unit(held: list[tuple], threshold: float) -> list[tuple]:
    if not held:
        return []
    ids, copies, left, right, v, codes = (np.concatenate([h[i] for h in held]) for i in range(6))
    bucket = held[0][6]
    x = _directions(v)
    rows, cols = np.flatnonzero(left), np.flatnonzero(right)
    near = x[rows] @ x[cols].T
    i, j = np.nonzero(near > threshold - 1e-9)
    i, j, cosine = rows[i], cols[j], near[i, j]
    both = left & right
    keep = np.where(both[i] & both[j], i < j, i != j)
    i, j, cosine = i[keep], j[keep], cosine[keep]
    for k in np.flatnonzero(np.abs(cosine - threshold) < 1e-9):
        a, b = v[i[k]], v[j[k]]
        cosine[k] = math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))
    keep = cosine >= threshold
    i, j = i[keep], j[keep]
    # the pair belongs to the first bucket, in the order of the codes' tables, that both are in
    mine = np.zeros(len(i), bool)
    shape = (len(ids), TABLES, PROBES)
    c = codes.reshape(shape)
    for s in range(0, len(i), 4096):
        a, b = c[i[s: s + 4096]], c[j[s: s + 4096]]
        same = (a[:, :, :, None] == b[:, :, None, :]).any(3)
        shared = np.where(same, a, np.iinfo(np.int64).max)
        mine[s: s + 4096] = shared.reshape(len(a), -1).min(1) == bucket
    i, j = i[mine], j[mine]
    if not len(i):
        return []
    n = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    up = np.arange(len(ids))
    while True:
        before = up.copy()
        np.minimum.at(up, i, up[j])
        np.minimum.at(up, j, up[i])
        up = up[up]
        if (up == before).all():
            break
    out = [(int(ids[k]), None, int(n[k])) for k in np.flatnonzero(n)]
    return out + [(int(ids[k]), int(ids[up[k]]), None) for k in np.flatnonzero(up != np.arange(len(ids)))]
