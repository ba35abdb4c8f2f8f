"""Ranked lexical search: bundles of items pass the owners of terms one after the other, rarest terms first."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import NOT_ALNUM, cut, shared_folder, word_slices

#: A term's owner is the number of these shares of all documents that its own share is above.
OWNERS = (0.02, 0.08, 0.25)
#: Documents of one block, and items of one bundle: what one call of a stage holds.
BLOCK, BUNDLE = 2048, 256
#: Terms of items that are sent to every task at once (20 bytes each). More items are searched in several groups.
SENT_TERMS = 500_000

_INDEX = "owner int, block long, term long, places array<int>, impacts array<int>, best int, ids array<long>"
_SUMS = "block long, bundle int, item long, sums array<struct<place:int,score:bigint>>, best array<bigint>"


def _asked(benchmark: DataFrame) -> DataFrame:
    """item, item_id, term, asked (times) of every term of every item; items equal in id and text are one."""
    def run(batches):
        for batch in batches:
            for i, j, hashes, _, _, at, _ in word_slices(batch.column(2), NOT_ALNUM):
                rows = [np.unique(hashes[at[d]: at[d + 1]].view(np.int64), return_counts=True) for d in range(j - i)]
                back = pa.array(np.repeat(np.arange(i, j), [len(t) for t, _ in rows]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(back), batch.column(1).take(back), pa.array(np.concatenate([t for t, _ in rows])),
                     pa.array(np.concatenate([n for _, n in rows]))], ["item", "item_id", "term", "asked"])

    items = benchmark.select(F.xxhash64(F.col("item_id").cast("string"), "text").alias("item"), "item_id", "text").distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    return items.mapInArrow(run, f"item long, item_id {kind}, term long, asked long")


def _postings(column: pa.Array, terms: np.ndarray):
    """(texts, their terms, place, number of the term, tf) by short runs of texts; places count from the run's first text."""
    for i, j, hashes, _, _, at, data in word_slices(column, NOT_ALNUM):
        words = hashes.view(np.int64)
        number = np.searchsorted(terms, words)
        number[number == len(terms)] = 0
        hit = terms[number] == words
        place = np.repeat(np.arange(j - i), np.diff(at))[hit]
        pairs, tf = np.unique(place * len(terms) + number[hit], return_counts=True)
        yield i, np.diff(at), pairs // len(terms), pairs % len(terms), tf, len(data)


def _term_counts(docs: DataFrame, sent) -> tuple[np.ndarray, int, int]:
    """Documents that hold each term, documents with any term, and terms of all documents. One short row per task and term is shuffled."""
    def run(batches):
        terms = sent.value
        df, n_docs, n_terms = np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for _, n, _, number, _, _ in _postings(batch.column(0), terms):
                df += np.bincount(number, minlength=len(terms))
                n_docs += int((n > 0).sum())
                n_terms += int(n.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, [-1, -2])), pa.array(np.append(df[held], [n_docs, n_terms]))], ["number", "n"])

    counted = docs.select("text").mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    found = dict(zip(counted["number"].to_pylist(), counted["n"].to_pylist()))
    df = np.zeros(len(sent.value), np.int64)
    for number, n in found.items():
        if number >= 0:
            df[number] = n
    return df, found.get(-1, 0), found.get(-2, 0)


def _index(docs: DataFrame, sent, weights: np.ndarray, owners: np.ndarray, n_docs: int, n_terms: int, block: int) -> DataFrame:
    """Inverted lists by owner, block and term, and the ids of each block's documents (owner -1), written in a folder per owner."""
    def run(batches):
        terms, partition, blocks = sent.value, TaskContext.get().partitionId(), 0
        held, ids, size = [], [], 0

        def flush():
            nonlocal held, ids, size, blocks
            key = (partition << 32) + blocks
            place, number, impact = (np.concatenate([h[k] for h in held]) for k in range(3))
            order = np.lexsort((place, number))
            place, number, impact = place[order], number[order], impact[order]
            starts = np.flatnonzero(np.diff(number, prepend=-1))
            best = np.maximum.reduceat(impact, starts) if len(starts) else impact
            cuts = np.append(starts, len(number))
            own, rows = number[starts], len(starts)
            ints = lambda x: pa.array(np.append(x, 0), pa.int32())
            lists = lambda x: pa.ListArray.from_arrays(
                pa.array(np.append(cuts, cuts[-1]), pa.int32()), pa.array(x, pa.int32()))
            mine = pa.ListArray.from_arrays(pa.array([0] * (rows + 1) + [len(ids)], pa.int32()), pa.array(ids, pa.int64()))
            blocks, held, ids, size = blocks + 1, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(owners[own], -1), pa.int32()), pa.array(np.full(rows + 1, key)), pa.array(np.append(terms[own], 0)),
                 lists(place), lists(impact), ints(best), mine], ["owner", "block", "term", "places", "impacts", "best", "ids"])

        for batch in batches:
            for i, n, place, number, tf, n_bytes in _postings(batch.column(1), terms):
                m = np.array([25 + (75 * x * n_docs) // n_terms if n_terms else 25 for x in n.tolist()], np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[place])
                worth = weights[number] > 0
                # A run of very many short texts is more than one block.
                for a in range(0, len(n), block):
                    if ids and (len(ids) + min(block, len(n) - a) > block or size > 1 << 24):
                        yield flush()
                    here = worth & (place >= a) & (place < a + block)
                    held.append((place[here] - a + len(ids), number[here], impact[here]))
                    ids += batch.column(0).slice(i + a, min(block, len(n) - a)).to_pylist()
                    size += n_bytes
        if ids:
            yield flush()

    path = f"{shared_folder(docs.sparkSession).rstrip('/')}/cohortline-{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _INDEX)
    rows.write.partitionBy("owner").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


def _stage(top: int):
    """Adds one owner's contributions to the sums of one bundle over one block."""
    def run(key, sums: pa.Table, lists: pa.Table) -> pa.Table:
        block, bundle = (k.as_py() for k in key)
        who = [np.asarray(x.values) for x in lists["who"]]
        items = np.unique(np.concatenate([np.asarray(sums["item"], np.int64), *who]))
        places = [np.asarray(x.values) for x in lists["places"]]
        before = [(np.asarray(x.values.field(0)), np.asarray(x.values.field(1))) for x in sums["sums"]]
        width = 1 + max([int(p.max()) for p in [*places, *(b[0] for b in before)] if len(p)], default=0)
        total, live = np.zeros((len(items), width), np.int64), np.zeros((len(items), width), bool)
        for row, (place, score) in zip(np.searchsorted(items, np.asarray(sums["item"], np.int64)), before):
            total[row, place], live[row, place] = score, True
        for here, names, weights, impacts in zip(places, who, lists["weights"], lists["impacts"]):
            weights, impacts = np.asarray(weights.values, np.int64), np.asarray(impacts.values, np.int64)
            rows = np.searchsorted(items, names)
            # A negative weight marks an item that takes no new documents: none could still be among its best.
            old = live[np.ix_(rows, here)] | (weights > 0)[:, None]
            total[np.ix_(rows, here)] += np.abs(weights)[:, None] * impacts * old
            live[np.ix_(rows, here)] = old
        rows, place = np.nonzero(live)
        score = total[rows, place]
        kept, starts = np.unique(rows, return_index=True)
        cuts = np.append(starts, len(rows))
        best = [np.sort(score[a:b])[::-1][:top] for a, b in zip(cuts[:-1], cuts[1:])]
        cells = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(score, pa.int64())], ["place", "score"])
        return pa.Table.from_arrays(
            [pa.array(np.full(len(kept), block, np.int64)), pa.array(np.full(len(kept), bundle), pa.int32()),
             pa.array(items[kept], pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), cells), pa.array(best, pa.list_(pa.int64()))],
            ["block", "bundle", "item", "sums", "best"])

    return run


def _search(docs: DataFrame, asked: DataFrame, n_items: int, top: int, owners: Sequence[float], block: int, bundle: int) -> DataFrame:
    spark = docs.sparkSession
    terms = np.sort(asked.select("term").distinct().toArrow()["term"].to_numpy().astype(np.int64))
    sent = spark.sparkContext.broadcast(terms if len(terms) else np.zeros(1, np.int64))
    df, n_docs, n_terms = _term_counts(docs, sent)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    owner = np.searchsorted(np.array(owners), df / max(n_docs, 1), "left").astype(np.int32)
    index = _index(docs, sent, weight, owner, n_docs, n_terms, block)
    known = spark.createDataFrame(pa.table([sent.value, weight, owner], ["term", "weight", "owner"]))
    best = index.where("owner >= 0").groupBy("term").agg(F.max("best").alias("best"))
    wanted = asked.join(known, "term").join(best, "term").select(
        "item", F.pmod("item", F.lit(math.ceil(n_items / bundle))).cast("int").alias("bundle"), "term", "owner",
        (F.col("asked") * F.col("weight")).alias("weight"), "best").where("weight > 0")
    wanted = cut(wanted)
    stages = range(len(owners) + 1)
    rest = wanted.groupBy("item").agg(*[
        F.sum(F.when(F.col("owner") >= s, F.col("weight") * F.col("best")).otherwise(0)).alias(f"rest{s}") for s in [*stages, len(stages)]])
    sums = spark.createDataFrame([], _SUMS)
    state = rest.withColumn("least", F.lit(0).cast("long"))
    for s in stages:
        open_ = F.col(f"rest{s}") >= F.col("least")
        asks = wanted.where(F.col("owner") == s).join(state, "item").groupBy("term", "bundle").agg(
            F.sort_array(F.collect_list(F.struct("item", F.when(open_, F.col("weight")).otherwise(-F.col("weight")).alias("weight")))).alias("asks"))
        lists = index.where(F.col("owner") == s).join(asks, "term").select(
            "block", "bundle", F.col("asks.item").alias("who"), F.col("asks.weight").alias("weights"), "places", "impacts")
        sums = cut(sums.groupBy("block", "bundle").cogroup(lists.groupBy("block", "bundle")).applyInArrow(_stage(top), _SUMS))
        scores = sums.select("item", F.explode("best").alias("score"))
        place = F.row_number().over(W.partitionBy("item").orderBy(F.col("score").desc()))
        least = scores.withColumn("place", place).where(F.col("place") <= top).groupBy("item").agg(
            F.when(F.count("*") >= top, F.min("score")).otherwise(0).alias("least"))
        state = cut(rest.join(least, "item", "left").withColumn("least", F.coalesce("least", F.lit(0))))
        after = state.select("item", (F.col("least") - F.col(f"rest{s + 1}")).alias("needed"))
        sums = sums.drop("best").join(after, "item").withColumn("sums", F.filter("sums", lambda x: x["score"] >= F.col("needed")))
        sums = sums.where("size(sums) > 0").select("block", "bundle", "item", "sums")
    ids = index.where("owner = -1").select("block", "ids")
    return sums.select("block", "item", F.inline("sums")).where("score > 0").join(ids, "block").select(
        "item", F.get("ids", F.col("place")).alias("doc_id"), "score")


def ranked(docs: DataFrame, benchmark: DataFrame, top: int = 10, owners: Sequence[float] = OWNERS, block: int = BLOCK,
           bundle: int = BUNDLE, sent_terms: int = SENT_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's `top` highest-scoring documents with a score above 0.

    Terms are runs of letters, digits and characters from U+0080 with A-Z lower;
    weights and scores are integers as the library's contract for this search
    states them. Terms belong to owners by the share of documents that hold them.
    Each owner's inverted lists are cut into blocks of documents. A bundle of
    items passes the owners, rarest terms first, and carries the sparse sums of
    a block's documents; each stage is a cogroup of bundles and lists by (block,
    bundle), so no task holds a whole list. After a stage, sums that cannot reach
    the item's `top` best even with the highest contributions still to come are
    left, and items whose remaining terms alone cannot reach them take no new
    documents. Both are exact. Cases: null and empty texts have no terms; each
    row of docs is a document, also repeated ones and those with a null id (last
    among equals); items equal in id and text are one; items without terms, or
    with none that any document holds, have no rows; empty tables give an empty
    result; extra columns are not read. Terms are compared by 64-bit hashes.
    """
    asked = cut(_asked(benchmark))
    n_rows, n_items = asked.agg(F.count("*"), F.count_distinct("item")).first()
    groups = max(1, math.ceil(n_rows / sent_terms))
    found = None
    for g in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        one = _search(docs, mine, max(1, n_items), top, owners, block, bundle)
        found = one if found is None else found.unionByName(one)
    place = F.row_number().over(W.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    best = found.withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(asked.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
