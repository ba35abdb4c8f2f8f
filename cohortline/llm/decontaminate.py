"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import NOT_ALNUM, texts, word_slices

#: Words of the test items in one automaton, which is broadcast (about 1 KB a word at most). More items make more automata.
AUTOMATON_WORDS = 200_000


class SuffixAutomaton:
    """All runs of consecutive words of the items; each state holds runs that end at the same places."""

    def __init__(self, window: int, parts: dict | None = None):
        self.window = window
        self.length, self.link, self.next = [0], [-1], [{}]
        self.items: list[set] = [set()]
        self.short: dict[int, list[tuple[int, str]]] = {}
        vars(self).update(parts or {})

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        self.items.append(set())
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state for the runs that p extends by word: q, or the part of q that is no longer than p's."""
        if self.length[q] == self.length[p] + 1:
            return q
        part = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = part
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = part
            p = self.link[p]
        return part

    def add(self, item: str, words: list[int]) -> None:
        at = 0
        for word in words:
            if word in self.next[at]:
                at = self._split(at, self.next[at][word], word)
            else:
                new, p = self._state(self.length[at] + 1, 0, {}), at
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, self.next[p][word], word)
                at = new
            if len(words) >= self.window:
                self.items[at].add(item)
        if 0 < len(words) < self.window:
            self.short.setdefault(at, []).append((len(words), item))

    def finish(self) -> None:
        """Hand each state's items to the shorter runs that it contains; find the next state with short items."""
        order = sorted(range(1, len(self.length)), key=lambda s: -self.length[s])
        for s in order:
            if self.length[self.link[s]] >= self.window:
                self.items[self.link[s]] |= self.items[s]
        # states cloned after short items ended in them
        ends: dict[int, list[tuple[int, str]]] = {}
        for s, found in self.short.items():
            for length, item in found:
                while self.length[self.link[s]] >= length:
                    s = self.link[s]
                ends.setdefault(s, []).append((length, item))
        self.short = ends
        self.marked = [-1] * len(self.length)
        for s in reversed(order):
            self.marked[s] = s if s in ends else self.marked[self.link[s]]

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set, int]:
        """(merged hit spans, items, longest match) of a run of words."""
        at = matched = longest = 0
        spans: list[tuple[int, int]] = []
        items: set = set()
        for i, word in enumerate(words):
            while at and word not in self.next[at]:
                at = self.link[at]
                matched = self.length[at]
            if word not in self.next[at]:
                continue
            at = self.next[at][word]
            matched += 1
            longest = max(longest, matched)
            hit = 0
            if matched >= self.window:
                s = at
                while self.length[self.link[s]] >= self.window:
                    s = self.link[s]
                items |= self.items[s]
                hit = self.window
            s = self.marked[at]
            while s > 0:
                for length, item in self.short[s]:
                    if length <= matched:
                        items.add(item)
                        hit = max(hit, length)
                s = self.marked[self.link[s]]
            if hit:
                begin = i + 1 - hit
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, i + 1))
        return spans, items, longest


def _item_words(benchmark: DataFrame, most: int):
    """Items as word hashes, in parts of at most `most` words (an item larger than that is a part)."""
    def run(batches):
        for batch in batches:
            for i, j, hashes, _, _, at, _ in word_slices(batch.column(1), NOT_ALNUM):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([hashes[at[d]: at[d + 1]].view(np.int64) for d in range(j - i)], pa.list_(pa.int64()))],
                    ["item", "words"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(F.col("item").isNotNull()).mapInArrow(
        run, "item string, words array<long>").where("size(words) > 0")
    held, n = [], 0
    for row in items.toLocalIterator(prefetchPartitions=True):
        if held and n + len(row.words) > most:
            yield held
            held, n = [], 0
        held.append((row.item, row.words))
        n += len(row.words)
    if held:
        yield held


def _automaton(items: list, window: int):
    vocabulary = np.unique(np.concatenate([np.array(w, np.int64) for _, w in items]).view(np.uint64))
    automaton = SuffixAutomaton(window)
    for item, words in sorted(items):
        automaton.add(item, np.searchsorted(vocabulary, np.array(words, np.int64).view(np.uint64)).tolist())
    automaton.finish()
    return vocabulary, vars(automaton), min(window, min(len(w) for _, w in items))


def _matches(vocabulary, automaton, least, hashes, at, memo: dict) -> dict[int, list]:
    """Hit spans in words, items and longest match of each text with a hit, of a run of texts."""
    found: dict[int, list] = {}
    if not len(hashes):
        return found
    ids = np.searchsorted(vocabulary, hashes)
    ids[ids == len(vocabulary)] = 0
    known = vocabulary[ids] == hashes
    edge = np.zeros(len(known) + 1, bool)
    edge[at] = True
    edge[1:-1] |= known[1:] != known[:-1]
    edges = np.flatnonzero(edge)
    begin, end = edges[:-1], edges[1:]
    keep = known[begin] & (end - begin >= least)
    for b, e in zip(begin[keep].tolist(), end[keep].tolist()):
        run = ids[b:e]
        key = run.tobytes()
        if key not in memo:
            if len(memo) > 20_000:
                memo.clear()
            memo[key] = automaton.scan(run.tolist())
        spans, items, longest = memo[key]
        if spans:
            d = int(np.searchsorted(at, b, "right")) - 1
            mine = found.setdefault(d, [[], set(), 0])
            mine[0] += [(b - int(at[d]) + s, b - int(at[d]) + t) for s, t in spans]
            mine[1] |= items
            mine[2] = max(mine[2], longest)
    return found


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, t in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(t, out[-1][1]))
        else:
            out.append((s, t))
    return out


_NEW = ("n_words", "hits", "items", "longest")


def _overlaps(docs: DataFrame, benchmark: DataFrame, window: int, most_words: int, finish=None) -> DataFrame:
    """The rows of docs with the columns of _NEW; finish(batch, hits, starts, at, bytes) may change a run of them.

    All that is done to a text is done in one pass of Python, by short runs of
    texts, so a task holds one worker and what a run takes, whatever the size of
    an Arrow batch and the number of automata.
    """
    columns = [c for c in docs.columns if c not in _NEW]
    spark = docs.sparkSession
    out = docs.select(*[f"`{c}`" for c in columns], F.lit(0).cast("long").alias("n_words"),
                      F.expr("cast(array() as array<struct<s:bigint,t:bigint>>)").alias("hits"),
                      F.expr("cast(array() as array<string>)").alias("items"), F.lit(0).cast("long").alias("longest"))
    sent = [spark.sparkContext.broadcast(_automaton(part, window)) for part in _item_words(benchmark, most_words)]

    def run(batches):
        each = [(vocabulary, SuffixAutomaton(window, parts), least, {}) for vocabulary, parts, least in (b.value for b in sent)]
        for batch in batches:
            for i, j, hashes, starts, _, at, data in word_slices(batch.column(batch.schema.get_field_index("text")), NOT_ALNUM):
                hits, items, longest = [[] for _ in range(i, j)], [[] for _ in range(i, j)], [0] * (j - i)
                for vocabulary, automaton, least, memo in each:
                    for d, (spans, names, most) in _matches(vocabulary, automaton, least, hashes, at, memo).items():
                        hits[d] = _merge(spans + hits[d])
                        items[d] = sorted({*names, *items[d]})
                        longest[d] = max(most, longest[d])
                rows = batch.slice(i, j - i)
                made = dict(zip(_NEW, (np.diff(at), [[{"s": s, "t": t} for s, t in x] for x in hits], items, longest)))
                rows = pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) if f.name in made else rows.column(k) for k, f in enumerate(rows.schema)],
                    schema=rows.schema)
                yield finish(rows, hits, starts, at, data) if finish else rows

    return out.mapInArrow(run, out.schema)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10,
                  most_words: int = AUTOMATON_WORDS) -> DataFrame:
    """The rows of docs with n_words, hits (from, to in words, merged), items (sorted ids) and longest (match in words).

    Words are runs of letters, digits and characters from U+0080, with A-Z lower.
    A window is `window` consecutive words of an item, or a shorter item whole; a
    word inside any occurrence of a window is hit. The automaton of the items is
    broadcast; more items than `most_words` words make several automata, which
    each run of texts passes one after the other. Cases: null texts have no
    words; null items and items without words have no window; a null item_id
    takes no part; repeated items give their id once; rows, columns and order are
    kept. Columns of docs that are named like the new ones are replaced.
    """
    return _overlaps(docs, benchmark, window, most_words)


def summary(docs: DataFrame, benchmark: DataFrame, window: int = 10, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest of every document."""
    found = find_overlaps(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, window, **options)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["t"] - x["s"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"), "longest")


def remove_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5,
                    most_words: int = AUTOMATON_WORDS) -> DataFrame:
    """docs without the hit spans; documents of which more than `max_coverage` of the words are hit go.

    A span goes with what follows it up to the next word. n_chars, where there is
    such a column, is counted anew for changed texts. Other rows are unchanged.
    """
    def finish(rows, hits, starts, at, data):
        n_hit = np.array([sum(t - s for s, t in x) for x in hits], np.int64)
        if n_hit.any():
            k = rows.schema.get_field_index("text")
            (offsets, _), cleaned = texts(rows.column(k)), rows.column(k).to_pylist()
            for d in np.flatnonzero(n_hit).tolist():
                raw = data[offsets[d]: offsets[d + 1]]
                edges = np.append(starts[at[d]: at[d + 1]] - offsets[d], len(raw))
                keep = np.ones(len(raw), bool)
                for s, t in hits[d]:
                    keep[edges[s]: edges[t]] = False
                cleaned[d] = raw[keep].tobytes().decode()
            rows = rows.set_column(k, rows.schema.field(k), pa.array(cleaned, rows.schema.field(k).type))
        return rows.filter(pa.array(n_hit <= max_coverage * np.diff(at)))

    cleaned = _overlaps(docs, benchmark, window, most_words, finish)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.size("hits") > 0, F.length("text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*[f"`{c}`" for c in docs.columns])
