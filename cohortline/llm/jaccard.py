"""N-gram Jaccard join by T-occurrence search.

Documents are sets of hashed word shingles. Equal sets form one class. A class
of n shingles has a slack d = n - T, T the least overlap that any
partner needs. Two linked classes share at least (the smaller) d + 1 of the
2d + 1 smallest hashes of each, as in prefix filters with longer prefixes. Those
hashes are counted over all classes; a class with too few shared ones has no
partner and leaves. For the rest, the lists of a class's rarest hashes are its
short lists: one of them holds every partner. Classes that meet in a short list
are compared in blocks by DivideSkip (`search_block`): short lists are merged,
long ones are probed by binary search, and pairs that reach the overlap link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import SPACES, components, cut, mix, slices, word_slices

_U = np.uint64
_C1, _C2 = _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB)
#: Ids of living classes that may be broadcast (16 MB); beyond it they join by a shuffle.
BROADCAST_IDS = 1_000_000
#: Classes in a block of one list, and candidates of a query up to which long lists are probed.
BLOCK = 512
MOST_PROBED = 16
#: Classes and shingles (32 MB) of a candidate group that one task searches whole; larger groups go list by list, in blocks.
GROUP_CLASSES = 4_096
GROUP_SHINGLES = 4_000_000


def least_overlap(n, percent: int):
    """T: the least overlap of a set of n with any partner at this similarity."""
    return -((-percent * n) // 100)


def shingle_sets(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes; shorter texts are one shingle."""
    if not len(words):
        return np.zeros(0, np.int64)
    width = min(k, len(words))
    span = len(words) - width + 1
    h = np.full(span, width, _U)
    for i in range(width):
        h = mix(h * _C1 + words[i: i + span])
    return np.unique(h.view(np.int64))


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for i, j, hashes, _, _, at, _ in word_slices(column, SPACES):
        for d in range(i, j):
            yield d, shingle_sets(hashes[at[d - i]: at[d - i + 1]], k)


def _signatures(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n, digest of the set (two longs), and its 2d + 1 smallest hashes."""
    def run(batches):
        for batch in batches:
            for i, j in slices(batch.column(1)):
                rows = ([], [], [], [])
                for _, s in _sets(batch.column(1).slice(i, j - i), k):
                    n = len(s)
                    u = s.view(_U)
                    rows[0].append(n)
                    rows[1].append(int(mix(u ^ _C1).sum(dtype=_U).view(np.int64)) if n else 0)
                    rows[2].append(int(mix(u ^ _C2).sum(dtype=_U).view(np.int64)) if n else 0)
                    rows[3].append(s[: 2 * (n - least_overlap(n, percent)) + 1])
                ends = np.concatenate([[0], np.cumsum([len(x) for x in rows[3]])]).astype(np.int32)
                heads = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows[3])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[pa.array(x, pa.int64()) for x in rows[:3]], heads], ["doc_id", "n", "d1", "d2", "head"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, d1 long, d2 long, head array<long>")


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Elements of sorted a in sorted b, by binary probes of the longer one."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def search_block(ids: list[int], sets: list[np.ndarray], queries: np.ndarray, indexed: np.ndarray,
                 least: np.ndarray, needed) -> list[tuple[int, int]]:
    """Links that join `queries` to `indexed` (positions in ids), as a spanning forest of what links here.

    needed(x) gives the overlap at which x links with each set, and least[x] is
    one that no link of x falls below. DivideSkip: with T = least[x], its longest lists, T - 1
    of them, are set aside. The other, short lists are merged, which counts how
    often each indexed set occurs in them (sets of a block are numbered densely,
    so an array of counts takes the heap's place). A set that could still reach
    the overlap that the pair's own sizes ask for is probed in the long lists by
    binary search of its sorted hashes. Sets already in the query's component
    need no more links and are passed over.
    """
    linked, found = _Union(len(ids)), []

    def join(x: int, y: int) -> None:
        if linked.join(x, y):
            found.append((ids[x], ids[y]))

    if not len(queries) or not len(indexed):
        return found
    if len(ids) == 2:
        if _overlap(*sets) >= needed(0)[1]:
            join(0, 1)
        return found
    every = np.concatenate([sets[y] for y in indexed])
    owner = np.repeat(indexed, [len(sets[y]) for y in indexed])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    size = np.array([len(s) for s in sets])
    root = np.array([linked.find(i) for i in range(len(ids))])
    for x in queries:
        s = sets[x]
        low = np.searchsorted(every, s, "left")
        lengths = np.searchsorted(every, s, "right") - low
        by_length = np.argsort(lengths, kind="stable")
        aside = max(0, int(least[x]) - 1)
        short, long = by_length[: len(s) - aside], by_length[len(s) - aside:]
        runs = [owner[low[i]: low[i] + lengths[i]] for i in short if lengths[i]]
        if not runs:
            continue
        counts = np.bincount(np.concatenate(runs), minlength=len(ids))
        want = needed(x)
        may = np.flatnonzero((counts > 0) & (counts + len(long) >= want) & (size >= want) & (root != root[x]))
        if not len(long):
            exact = may
        elif len(may) > MOST_PROBED:  # then merging the long lists as well costs less than probing them
            counts += np.bincount(np.concatenate([owner[low[i]: low[i] + lengths[i]] for i in long]), minlength=len(ids))
            exact = may[counts[may] >= want[may]]
        else:
            probes = np.sort(s[long])
            exact = [y for y in may if counts[y] + _overlap(probes, sets[y]) >= want[y]]
        for y in exact:
            if root[y] != root[x]:
                join(x, y)
                a, b = root[x], root[y]
                root[root == max(a, b)] = min(a, b)
    return found


def jaccard_join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id of every document.

    Two documents link when 100 * overlap >= percent * union of their sets of
    k-word shingles. component_id is the smallest doc_id that links reach;
    class_id is the smallest doc_id with the same set. Cases: null and empty
    texts, and texts of separators only, have no shingles and link with nothing;
    texts of fewer than k words are one shingle; equal texts and repeated rows
    are one class, and each keeps its row; rows of one doc_id are one node; a
    null doc_id keeps its row and n_shingles and links with nothing (its class
    and component are null); extra columns are not read; an empty table gives an
    empty result. Only spanning links leave a block, so a group of near copies
    gives rows in proportion to its size.
    """
    signed = cut(_signatures(docs, k, percent))
    full = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = full.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class_id"))
    member = signed.select("doc_id", "n", "d1", "d2").join(classes, ["n", "d1", "d2"], "left")
    overlap = f"(({percent} * n + 99) div 100)"  # the least overlap, which is also the smallest partner's size
    least = F.expr(f"{overlap} - (({percent} * {overlap} + 99) div 100) + 1")
    # the other members of a class leave; their ids are few against the texts, and broadcast where that holds
    others = full.select("doc_id", "n", "d1", "d2").join(classes, ["n", "d1", "d2"]).where("doc_id <> class_id").select("doc_id").distinct()
    heads = full.join(_small(others), "doc_id", "left_anti").select(F.col("doc_id").alias("id"), "n", F.explode("head").alias("token"))
    living = _shared(heads).groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    living = living.withColumn("least", least).where(F.size("tokens") >= F.col("least"))
    # A partner shares `least` of a class's shared hashes, so it shares one of those left after the `least` - 1
    # most frequent ones. Hashes that no other class has come first in that order and are left out already.
    living = cut(living.select("id", "n", "least", F.sort_array(F.col("tokens.token")).alias("shared"), F.expr(
        "slice(tokens, 1, size(tokens) - cast(least as int) + 1)").getField("token").alias("short")))
    lists = living.select("id", F.explode("short").alias("token"))
    seen = lists.groupBy("token").agg(
        F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x1"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x2")).where("m > 1")
    # lists with the same classes are searched once
    once = seen.groupBy("m", "x1", "x2").agg(F.min("token").alias("token")).select("token", "m")
    met = cut(lists.join(once, "token"))
    # first on the shared hashes alone: pairs with too few of them cannot link
    sent = _blocks(met).join(living.select("id", "n", "least", "shared"), "id").select(
        "unit", "id", "query", "indexed", "n", "least", F.col("shared").alias("hashes"))
    groups = components(_searched(sent, percent, whole=False))
    # classes that such pairs connect are one candidate group; a group of bounded size is one unit of work
    members = groups.join(living.select("id", "n"), "id")
    sizes = members.groupBy("component").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    bounded = (F.col("classes") <= GROUP_CLASSES) & (F.col("shingles") <= GROUP_SHINGLES)
    members = cut(members.join(sizes, "component").select("id", "component", bounded.alias("bounded")))
    units = members.where("bounded").select(
        "id", F.xxhash64("component").alias("unit"), F.lit(True).alias("query"), F.lit(True).alias("indexed"))
    # larger groups go list by list
    units = units.unionByName(_blocks(met.join(members.where("not bounded").select("id"), "id", "left_semi")))
    wanted = cut(units.groupBy("id").agg(F.collect_list(F.struct("unit", "query", "indexed")).alias("units")))
    source = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(_small(wanted.select("id")), "id", "left_semi")
    sent = source.join(wanted, "id").mapInArrow(
        lambda batches: _send(batches, k, percent),
        "unit long, id long, query boolean, indexed boolean, n long, least long, hashes array<long>")
    found = components(_searched(sent, percent, whole=True))
    linked = member.join(found, member.class_id == found.id, "left")
    known = F.col("doc_id").isNotNull()
    return linked.select("doc_id", F.col("n").alias("n_shingles"),
                         F.when(known, F.coalesce("class_id", "doc_id")).alias("class_id"),
                         F.when(known, F.coalesce("component", "class_id", "doc_id")).alias("component_id"))


def _shared(heads: DataFrame) -> DataFrame:
    """The rows (id, n, token) whose hash others have too, and how many rows have it (df).

    Rows move once: they are counted where those of a hash meet.
    """
    return heads.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")


def _small(ids: DataFrame) -> DataFrame:
    """Ids to be broadcast if a count shows that they are few; otherwise they join by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _blocks(met: DataFrame) -> DataFrame:
    """unit, id, query, indexed: lists dealt into blocks by a hash of the class; every pair of blocks is one unit of work."""
    blocks = f"(m + {BLOCK - 1}) div {BLOCK}"
    placed = met.select("id", "token", F.expr(f"cast({blocks} as int)").alias("b"),
                        F.expr(f"cast(pmod(xxhash64(id), {blocks}) as int)").alias("own"))
    pairs = placed.select("id", "token", "own", F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("other"))
    return pairs.select("id", F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
                        (F.col("own") <= F.col("other")).alias("query"), (F.col("own") >= F.col("other")).alias("indexed"))


def _searched(sent: DataFrame, percent: int, whole: bool) -> DataFrame:
    """a, b: spanning links of each unit; on whole sets by similarity, otherwise by the shared hashes that links need."""
    return sent.repartition(F.col("unit")).sortWithinPartitions("unit", "id").mapInArrow(
        lambda batches: _search(batches, percent, whole), "a long, b long")


def _send(batches, k: int, percent: int):
    """A row for each unit of a class, with its whole set."""
    for batch in batches:
        name = batch.schema.get_field_index
        ids, units = batch.column(name("id")).to_pylist(), batch.column(name("units")).to_pylist()
        out: list[tuple] = []
        held = 0
        for d, s in _sets(batch.column(name("text")), k):
            for u in units[d]:
                out.append((u["unit"], ids[d], u["query"], u["indexed"], len(s), least_overlap(len(s), percent), s))
                held += len(s)
            if held > 1 << 18:
                yield _sent(out)
                out, held = [], 0
        if out:
            yield _sent(out)


def _sent(out: list[tuple]) -> pa.RecordBatch:
    ends = np.concatenate([[0], np.cumsum([len(x[6]) for x in out])]).astype(np.int32)
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [*[pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)],
         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([x[6] for x in out])))],
        ["unit", "id", "query", "indexed", "n", "least", "hashes"])


def _search(batches, percent: int, whole: bool):
    """Search each unit; units come one after another, and one at a time is held."""
    unit, held = None, []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        ids, query, indexed, n, least = (batch.column(i).to_pylist() for i in range(1, 6))
        offsets, values = batch.column(6).offsets.to_numpy(), batch.column(6).values.to_numpy()
        found: list[tuple[int, int]] = []
        for i, key in enumerate(keys):
            if key != unit:
                found += _search_unit(held, percent, whole)
                unit, held = key, []
            held.append((ids[i], query[i], indexed[i], n[i], least[i], values[offsets[i]: offsets[i + 1]].copy()))
        if found:
            yield _pairs(found)
    if found := _search_unit(held, percent, whole):
        yield _pairs(found)


def _search_unit(held: list[tuple], percent: int, whole: bool) -> list[tuple[int, int]]:
    held = [h for h in held if len(h[5])]
    if len(held) < 2:
        return []
    n, least = (np.array([h[i] for h in held]) for i in (3, 4))
    spare = n - least_overlap(n, percent) + 1

    def needed(x: int) -> np.ndarray:
        if whole:  # 100 o >= p (|x| + |y| - o), solved for the overlap o
            return -((-percent * (n[x] + n)) // (100 + percent))
        return np.minimum(spare[x], spare)

    where = [np.array([i for i, h in enumerate(held) if h[side]], np.int64) for side in (1, 2)]
    return search_block([h[0] for h in held], [h[5] for h in held], *where, least, needed)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])


def without_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest doc_id of each component; the columns of docs.

    Of rows that share a doc_id one stays. Rows with a null doc_id stay, as do
    those without words. Only ids that go or repeat are joined to the texts.
    """
    joined = cut(jaccard_join(docs, k, percent).where("doc_id is not null").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count("*").alias("n")))
    gone = joined.where("component_id <> doc_id").select(F.col("doc_id").alias("__gone"))
    again = joined.where("component_id = doc_id and n > 1").select(F.col("doc_id").alias("__again"))

    left = docs.join(_small(gone), docs.doc_id.cast("long") == F.col("__gone"), "left_anti")
    if again.take(1):
        repeats = _small(again)
        same = docs.doc_id.cast("long") == F.col("__again")
        left = left.join(repeats, same, "left_anti").unionByName(
            left.join(repeats, same, "left_semi").dropDuplicates(["doc_id"]))
    return left
