"""N-gram scores from a log-frequency Bloom filter.

The filter holds, for an n-gram of count c, the pairs (n-gram, 1) ... (n-gram, q)
with q = 1 + floor(log_b c). Its level is read back by probing 1, 2, ... until
one is absent. The filter has a fixed number of bits and is broadcast; what it
holds is chosen from exact counts over all training texts: all words and
bigrams of at least the least count at which they fit. The rarer words stay in a
table, and texts meet them there in joins. The rarer bigrams stay where they
were counted: counts are dealt by ranges of the bigrams' hashes, as sorted runs,
and the texts' bigrams follow them there once, at the same quantised counts.
"""

from __future__ import annotations

import math
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACES, cut, mix, word_slices

_U = np.uint64
#: The hash that stands for the end of a text.
END = _U(0x2545F4914F6CDD1D)
_PAIR = _U(0xA0761D6478BD642F)

BITS = 1 << 27
BASE = 1.5
PROBES = 2
#: Entries per bit of the filter; with two probes about 5 % of absent pairs seem present.
FILL = 1 / 8
#: Most frequent words whose exact counts are broadcast (16 MB); the others' counts are joined.
HEAD_WORDS = 1 << 20
#: Tokens of the training texts for each part of the counts of bigrams, and parts of the filter while it is made.
PART_TOKENS = 1 << 20
REGIONS = 16
#: Bigrams, and texts, whose counts a task asks for at once; rows of texts that are put together at once.
ASKED, ASKED_TEXTS, BLOCK_ROWS = 1 << 19, 1 << 16, 1 << 10
#: Weight of the word's own probability against the counts after the word before.
PRIOR = 200.0


def level(counts: np.ndarray) -> np.ndarray:
    """Quantised log counts: 1 + floor(log_b c), with room for rounding at whole powers."""
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def _estimate(levels: np.ndarray) -> np.ndarray:
    """The geometric middle of the counts of a level (0 for level 0)."""
    return np.where(levels > 0, np.maximum(1.0, BASE ** (levels - 0.5)), 0.0)


def _positions(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    h = mix(keys + mix(levels.astype(_U)))
    return np.stack([mix(h + _U(i)) & _U(BITS - 1) for i in range(PROBES)])


def probe(bits: np.ndarray, keys: np.ndarray, most: int = 64) -> np.ndarray:
    """The level of each key: probes (key, 1), (key, 2), ... until one is absent."""
    found = np.zeros(len(keys), np.int64)
    alive = np.arange(len(keys))
    for q in range(1, most + 1):
        at = _positions(keys[alive], np.full(len(alive), q))
        there = np.ones(len(alive), bool)
        for p in at:
            there &= (bits[(p >> _U(6)).astype(np.int64)] >> (p & _U(63))) & _U(1) == _U(1)
        alive = alive[there]
        if not len(alive):
            break
        found[alive] = q
    return found


def _tokens(column: pa.Array):
    """(first text, last text + 1, hashes of each text's words and end, first token of each text)."""
    for i, j, hashes, _, _, at, _ in word_slices(column, SPACES):
        n = at[-1] + (j - i)
        ends = at[1:] + np.arange(j - i)
        tokens = np.empty(n, _U)
        inner = np.ones(n, bool)
        inner[ends] = False
        tokens[inner], tokens[ends] = hashes, END
        yield i, j, tokens, np.concatenate([[0], ends + 1])


def _pairs(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bigrams inside texts, and the places of their second tokens."""
    second = np.ones(len(tokens), bool)
    second[at[:-1]] = False
    places = np.flatnonzero(second)
    return mix(tokens[places - 1] * _PAIR + tokens[places]), places


class _Counts:
    """Counts of keys, merged in sorted arrays up to a size and then handed on."""

    def __init__(self, most: int = 1 << 19):
        self.most, self.held, self.n = most, [], 0

    def add(self, keys: np.ndarray):
        found = np.unique(keys, return_counts=True)
        self.held.append(found)
        self.n += len(found[0])
        if self.n >= 2 * self.most:
            self._merge()
            if self.n >= self.most:
                yield self._batch()

    def _merge(self) -> None:
        keys = np.concatenate([k for k, _ in self.held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in self.held])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.held = [(keys[first], np.add.reduceat(counts, first))]
        self.n = len(first)

    def _batch(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = self.held[0]
        self.held, self.n = [], 0
        return keys, counts.astype(np.int64)

    def rest(self):
        if self.n:
            self._merge()
            yield self._batch()


def _counted(batches, keys_of):
    """(sorted keys, counts) of the keys that keys_of(tokens, at) gives in the texts; a key may come again later."""
    counts = _Counts()
    for batch in batches:
        for _, _, tokens, at in _tokens(batch.column(0)):
            keys = keys_of(tokens, at)
            if len(keys):
                yield from counts.add(keys)
    yield from counts.rest()


def _count(docs: DataFrame, keys_of) -> DataFrame:
    """h, c: how often each key that keys_of(tokens, at) gives occurs in the texts."""
    def run(batches):
        for keys, counts in _counted(batches, keys_of):
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["h", "c"])

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of integers from 0 as compressed bytes: the lowest bytes of a column, then the next ones, up to its highest."""
    out = []
    for x in columns:
        width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        out += [bytes([width]), np.ascontiguousarray(x.astype(_U)).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    whole = b"".join(out)
    return len(columns[0]).to_bytes(8, "little") + len(whole).to_bytes(8, "little") + pa.compress(whole, "zstd", asbytes=True)


def _unpack(packed: bytes, columns: int) -> list[np.ndarray]:
    """:func:`_pack` undone."""
    n, size = (int.from_bytes(packed[i: i + 8], "little") for i in (0, 8))
    whole, at, out = pa.decompress(packed[16:], size, "zstd", asbytes=True), 0, []
    for _ in range(columns):
        width = whole[at]
        each = np.zeros((n, 8), np.uint8)
        each[:, :width] = np.frombuffer(whole, np.uint8, n * width, at + 1).reshape(width, n).T
        out.append(each.view(_U).ravel())
        at += 1 + n * width
    return out


def _steps(keys: np.ndarray, base: int) -> np.ndarray:
    """Sorted keys as the first one's distance from base and the distances from one to the next."""
    return np.diff(keys, prepend=_U(base))


def _part(key: int) -> int:
    return key


def _bases(parts: int) -> list[int]:
    """The first hash of each part."""
    return [-(-(p << 32) // parts) << 32 for p in range(parts)]


def _dealt(keys: np.ndarray, parts: int):
    """(part, its first hash, from, to) of sorted keys."""
    bases = _bases(parts)
    at = [*np.searchsorted(keys, np.array(bases, _U)).tolist(), len(keys)]
    return [(p, bases[p], at[p], at[p + 1]) for p in range(parts) if at[p] < at[p + 1]]


def _placed(frame: DataFrame, parts: int) -> RDD:
    """(part, kind, bytes) of the columns part and kind and packed, each at its part."""
    return frame.select("part", "kind", "packed").rdd.map(lambda r: (r[0], (r[1], bytes(r[2])))).partitionBy(parts, _part)


_PLACED = "part int, kind int, packed binary"
_COUNTS, _ASKED, _OWN, _WORDS, _LOST = range(5)


def _placed_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["part", "kind", "packed"])


def _count_in_parts(docs: DataFrame, keys_of, parts: int) -> RDD:
    """:func:`_count`, with each key at the part of its hash, in sorted runs; kept as a shuffle, which later jobs read again."""
    def run(batches):
        for keys, counts in _counted(batches, keys_of):
            yield _placed_batch([(p, _COUNTS, _pack(_steps(keys[i:j], base), counts[i:j] - 1)) for p, base, i, j in _dealt(keys, parts)])

    return _placed(docs.select("text").mapInArrow(run, _PLACED), parts)


def _merged(runs: list[bytes], base: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys of a part and their counts over all runs."""
    if not runs:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    both = [_unpack(x, 2) for x in runs]
    keys = np.concatenate([np.cumsum(k, dtype=_U) + _U(base) for k, _ in both])
    counts = np.concatenate([c.view(np.int64) + 1 for _, c in both])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def _by_part(rows) -> dict[int, dict[int, list[bytes]]]:
    """What has come to a task, by part and kind."""
    found: dict[int, dict[int, list[bytes]]] = {}
    for part, (kind, packed) in rows:
        found.setdefault(part, {}).setdefault(kind, []).append(packed)
    return found


class Model:
    """Broadcast parts of a model: the filter, the most frequent words' exact counts, totals, and the least levels in the filter.

    A least level of 1 says that all words, or all bigrams, of the training texts are in the filter.
    """

    def __init__(self, bits, head, head_counts, tokens: int, distinct: int, word_level: int, pair_level: int):
        self.bits, self.head, self.head_counts = bits, head, head_counts
        self.tokens, self.distinct = tokens, distinct
        self.word_level, self.pair_level = word_level, pair_level

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Counts of keys among the most frequent words, -1 for others."""
        if not len(self.head):
            return np.full(len(keys), -1)
        at = np.searchsorted(self.head, keys)
        at[at == len(self.head)] = 0
        return np.where(self.head[at] == keys, self.head_counts[at], -1)

    def _held(self, keys: np.ndarray, least: int) -> np.ndarray:
        """Levels of keys; what seems to be below the least level in the filter is not in it (0)."""
        found = probe(self.bits, keys)
        return np.where(found >= least, found, 0)

    def word_levels(self, words: np.ndarray, exact: np.ndarray) -> np.ndarray:
        """Levels of words by the filter, or by their exact counts where it has left them out; 0 for others."""
        found = self._held(words, self.word_level)
        return np.where((found == 0) & (exact > 0), level(np.maximum(exact, 1)), found)

    def pair_levels(self, pairs: np.ndarray) -> np.ndarray:
        """Levels of bigrams by the filter, 0 for others."""
        return self._held(pairs, self.pair_level)


def _filter(words: DataFrame, least_word: int, bigrams: RDD, least_pair: int, parts: int) -> np.ndarray:
    """The filter's words: bits are set on the workers, met by regions of the filter and sent as such."""
    size = BITS // REGIONS

    def places(keys: np.ndarray, counts: np.ndarray):
        for i in range(0, len(keys), ASKED):
            q = level(counts[i: i + ASKED])
            each = np.repeat(keys[i: i + ASKED], q)
            levels = np.arange(len(each)) - np.repeat(np.cumsum(q) - q, q) + 1
            at = np.unique(_positions(each, levels))
            edges = np.searchsorted(at, np.arange(REGIONS + 1, dtype=_U) * _U(size)).tolist()
            for r in range(REGIONS):
                if edges[r] < edges[r + 1]:
                    yield r, _pack(_steps(at[edges[r]: edges[r + 1]], r * size))

    def of_words(batches):
        for batch in batches:
            found = places(batch.column(0).to_numpy().view(_U), batch.column(1).to_numpy())
            if rows := [(r, _COUNTS, x) for r, x in found]:
                yield _placed_batch(rows)

    def of_bigrams(rows):
        for p, found in _by_part(rows).items():
            keys, counts = _merged(found[_COUNTS], _bases(parts)[p])
            yield from places(keys[counts >= least_pair], counts[counts >= least_pair])

    def met(rows):
        there: dict[int, np.ndarray] = {}
        for r, x in rows:
            there.setdefault(r, np.zeros(size, bool))[np.cumsum(_unpack(x, 1)[0], dtype=_U).astype(np.int64)] = True
        return [(r, np.packbits(x, bitorder="little").tobytes()) for r, x in there.items()]

    table = words.where(F.col("c") >= least_word).select("h", "c").mapInArrow(of_words, _PLACED)
    both = table.rdd.map(lambda r: (r[0], bytes(r[2]))).union(bigrams.mapPartitions(of_bigrams))
    filled = np.zeros(BITS // 64, _U)
    for r, x in both.partitionBy(REGIONS, _part).mapPartitions(met).collect():
        filled[r * size // 64: (r + 1) * size // 64] = np.frombuffer(x, _U)
    return filled


def _least_count(entries: dict[int, int], room: float) -> tuple[int, float]:
    """The least count at which all keys of at least that count fit in `room` entries (1 if all do), and the entries they take."""
    least, taken = 10_001, 0.0
    for count in sorted(entries, reverse=True):
        if taken + entries[count] > room:
            return least, taken
        least, taken = count, taken + entries[count]
    return 1, taken


def _entries(bigrams: RDD, parts: int) -> dict[int, int]:
    """Entries that the keys of each count (of 10,000 and more: together) would take."""
    def run(rows):
        for p, found in _by_part(rows).items():
            counts, n = np.unique(_merged(found[_COUNTS], _bases(parts)[p])[1], return_counts=True)
            yield from zip(np.minimum(counts, 10_000).tolist(), (n * level(counts)).tolist())

    return dict(bigrams.mapPartitions(run).reduceByKey(add).collect())


def _level(count: Column) -> Column:
    """:func:`level` of a column."""
    return F.floor(F.log(count.cast("double")) / math.log(BASE) + 1e-9) + 1


def _middle(levels: Column) -> Column:
    """:func:`_estimate` of a column; 0 for null."""
    return F.when(levels > 0, F.greatest(F.lit(1.0), F.pow(F.lit(BASE), levels - 0.5))).otherwise(F.lit(0.0))


class Counts(NamedTuple):
    """Exact counts of the training texts: h, c of all words, and the bigrams' at their parts."""

    words: DataFrame
    bigrams: RDD
    parts: int


def learn(training: DataFrame) -> tuple[Model, Counts]:
    """A model of the texts (column text), and the exact counts of all their tokens and bigrams.

    All words are counted in a written table, all bigrams in a shuffle by ranges
    of their hashes, whose parts grow with the texts. The filter takes the most
    frequent ones; every other is met by the texts at its own count. Cases: a
    null or empty text is one end; without training texts every count is 0.
    """
    words = cut(_count(training, lambda tokens, at: tokens))
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    top = words.orderBy(F.desc("c"), "h").limit(HEAD_WORDS).toArrow()
    head = top["h"].to_numpy().view(_U)
    order = np.argsort(head)
    head, head_counts = head[order], top["c"].to_numpy()[order]
    by_count = words.groupBy(F.least(F.col("c"), F.lit(10_000)).alias("c")).agg(F.sum(_level(F.col("c"))).alias("entries")).collect()
    least_word, taken = _least_count({r.c: r.entries for r in by_count}, BITS * FILL / 2)
    parts = max(int(training.sparkSession.conf.get("spark.sql.shuffle.partitions")), (total.n or 0) // PART_TOKENS)
    bigrams = _count_in_parts(training, lambda tokens, at: _pairs(tokens, at)[0], parts)
    least_pair, _ = _least_count(_entries(bigrams, parts), BITS * FILL - taken)
    bits = _filter(words, least_word, bigrams, least_pair, parts)
    levels = [int(level(np.array([c]))[0]) for c in (least_word, least_pair)]
    return Model(bits, head, head_counts, total.n or 0, total.v, *levels), Counts(words, bigrams, parts)


_TYPES = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "known": pa.int64(), "plain": pa.float64(),
          "full": pa.float64(), "h": pa.int64(), "times": pa.int32(), "alone": pa.int32(), "before": pa.int32(), "pair": pa.int64(),
          "pair_level": pa.int8(), "level1": pa.int8(), "level2": pa.int8(), "word1": pa.int64(), "word2": pa.int64()}
#: Columns of a text, of its words that leave it, and of its bigrams that leave it with a word.
_KINDS = {
    _OWN: ("row", "doc_id", "held_out", "n_tokens", "known", "plain", "full"),
    _WORDS: ("row", "h", "times", "alone", "before"),
    _LOST: ("row", "pair", "times", "pair_level", "level1", "level2", "word1", "word2"),
}
_ASKS = ("row", "pair", "times", "pair_level", "level1", "level2")
_SQL = {pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double", pa.int32(): "int", pa.int8(): "tinyint"}


def _schema(columns) -> str:
    return ", ".join(f"{c} {_SQL[_TYPES[c]]}" for c in columns)


def _stream(batches: list[pa.RecordBatch]) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        for batch in batches:
            writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _streamed(packed: RDD, spark, columns) -> DataFrame:
    """The rows of Arrow streams."""
    def run(batches):
        for batch in batches:
            for x in batch.column(0):
                yield from pa.ipc.open_stream(x.as_buffer())

    return spark.createDataFrame(packed.map(lambda x: (x,)), "packed binary", verifySchema=False).mapInArrow(run, _schema(columns))


def _asked(asks: list[dict], parts: int) -> list[tuple]:
    """Rows of _PLACED that ask for the counts of bigrams, those of a row together; asks come by ascending rows."""
    x = {c: np.concatenate([np.asarray(a[c]) for a in asks]) for c in asks[0]}
    keys = x["pair"].view(_U)
    order = np.argsort(keys, kind="stable")
    x, keys = {c: v[order] for c, v in x.items()}, keys[order]
    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (x["row"][1:] != x["row"][:-1])])[:len(keys)])
    times = np.add.reduceat(x["times"], first)
    keys, x = keys[first], {c: v[first] for c, v in x.items()}
    least = int(x["row"].min())
    return [(p, _ASKED, least.to_bytes(8, "little") + _pack(
        _steps(keys[i:j], base), x["row"][i:j] - least, times[i:j] - 1, *(x[c][i:j] for c in _ASKS[3:]))) for p, base, i, j in _dealt(keys, parts)]


def _gains(rows, parts: int, base: int):
    """(block of rows, (part, rows and gains)): what a part's bigrams add to their texts, from their counts.

    Texts and words that were placed here go on, by blocks of rows as part -1 and by this part as -2.
    """
    for p, found in _by_part(rows).items():
        for packed in found.get(_OWN, ()):
            yield from _blocks(packed)
        yield from ((p, (-2, packed)) for packed in found.get(_WORDS, ()))
        keys, counts = _merged(found.get(_COUNTS, []), _bases(parts)[p])
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        for x in found.get(_ASKED, ()):
            steps, row, times, pair_level, level1, level2 = _unpack(x[8:], len(_ASKS))
            asked = np.cumsum(steps, dtype=_U) + _U(_bases(parts)[p])
            at = np.searchsorted(keys, asked)
            at[at == len(keys)] = 0
            count = np.where(keys[at] == asked, counts[at], 0) if len(keys) else np.zeros(len(asked), np.int64)
            known = pair_level.view(np.int64)
            known = np.where((known == 0) & (count > 0), level(np.maximum(count, 1)), known)
            there = np.flatnonzero(known)
            before, alone = (_estimate(c.view(np.int64)[there]) for c in (level1, level2))
            gain = np.log10(1 + np.minimum(_estimate(known[there]), before) * float(base) / (PRIOR * (alone + 1)))
            own, back = np.unique(row.view(np.int64)[there] + int.from_bytes(x[:8], "little"), return_inverse=True)
            if len(own):
                sums.append((own, np.bincount(back, (times.view(np.int64)[there] + 1) * gain)))
        if not sums:
            continue
        row, gain = (np.concatenate([s[i] for s in sums]) for i in (0, 1))
        order = np.argsort(row, kind="stable")
        row, gain = row[order], gain[order]
        edges = np.flatnonzero(np.concatenate([[True], row[1:] // BLOCK_ROWS != row[:-1] // BLOCK_ROWS])).tolist()
        for i, j in zip(edges, [*edges[1:], len(row)]):
            block = int(row[i]) // BLOCK_ROWS
            yield block, (p, _pack(_steps(row[i:j].view(_U), block * BLOCK_ROWS)) + gain[i:j].tobytes())


def _put_together(rows):
    """Arrow streams of the texts of a task, with what their bigrams have added; sums go by part, so that reruns agree."""
    own: list[pa.RecordBatch] = []
    gains: list[tuple[int, int, bytes]] = []
    for block, (p, packed) in rows:
        if p == -1:
            own += pa.ipc.open_stream(packed)
        elif p >= 0:
            gains.append((p, block, packed))
    if not own:
        return
    table = pa.Table.from_batches(own).combine_chunks()
    row, full = (table[c].to_numpy().copy() for c in ("row", "full"))
    order = np.argsort(row)
    for _, block, packed in sorted(gains):
        n = int.from_bytes(packed[:8], "little")
        at = np.cumsum(_unpack(packed[: len(packed) - 8 * n], 1)[0], dtype=_U).view(np.int64) + block * BLOCK_ROWS
        np.add.at(full, order[np.searchsorted(row, at, sorter=order)], np.frombuffer(packed, np.float64, n, len(packed) - 8 * n))
    table = table.set_column(table.schema.get_field_index("full"), "full", pa.array(full))
    yield _stream(table.to_batches())


def _by_row(rows: np.ndarray, keys: np.ndarray):
    """An order by row and key, and where each (row, key) begins in it."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    return order, np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])])[:len(keys)])


def _measure(m: Model, tokens: np.ndarray, at: np.ndarray, base: int):
    """Of a run of texts: counts, known tokens, plain and full scores as far as they are at hand, and what leaves to meet its counts.

    The probability of a token after another is (seen + PRIOR * alone) / (before
    + PRIOR). Its log is a sum: the token's alone, the one before's, and, for
    bigrams that training texts hold, the log of 1 + seen / (PRIOR * alone).
    Words that are not at hand add to the first two, and bigrams that are not,
    or whose words are not, to the last; so each leaves on its own.
    """
    own, back = np.unique(tokens, return_inverse=True)
    counts = m.exact(own)
    levels = m.word_levels(own, counts)
    exact, held = counts[back], _estimate(levels)[back]
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    plain = np.where(exact >= 0, np.log10((np.maximum(exact, 0) + 1) / base), 0.0)
    full = np.log10((held + 1) / base)
    pairs, places = _pairs(tokens, at)
    keys, one, of = np.unique(pairs, return_index=True, return_inverse=True)
    first, second = back[places - 1], back[places]
    pair_level = m.pair_levels(keys)
    seen = np.minimum(_estimate(pair_level)[of], held[places - 1])
    full[places] += np.log10(PRIOR / (held[places - 1] + PRIOR))
    # a word that the filter may have left out, and so no part of any sum yet
    lost = (levels == 0) & (m.word_level > 1)
    away = np.where(pair_level == 0, m.pair_level > 1, lost[first[one]] | lost[second[one]])[of]
    full[places] += np.where(away, 0.0, np.log10(1 + seen * base / (PRIOR * (held[places] + 1))))

    begins = np.zeros(len(tokens), np.int32)
    begins[places - 1] = 1
    out = np.flatnonzero(exact < 0)
    order, heads = _by_row(row[out], tokens[out])
    out = out[order]
    missing, n = lost[back[out]].astype(np.int32), len(heads)
    leaving = {}
    if n:
        leaving[_WORDS] = {
            "row": row[out[heads]], "h": tokens[out[heads]].view(np.int64), "times": np.diff(np.append(heads, len(out))).astype(np.int32),
            "alone": np.add.reduceat(missing, heads), "before": np.add.reduceat(missing * begins[out], heads)}

    def bigrams(i):
        return {"row": row[places[i]], "pair": pairs[i].view(np.int64), "times": np.ones(len(i), np.int32), "pair_level": pair_level[of[i]].astype(np.int8),
                "level1": levels[first[i]].astype(np.int8), "level2": levels[second[i]].astype(np.int8)}

    alone = lost[first] | lost[second]
    if len(i := np.flatnonzero(away & ~alone)):
        leaving[_ASKED] = bigrams(i)
    if len(i := np.flatnonzero(away & alone)):
        leaving[_LOST] = bigrams(i) | {
            "word1": pa.array(own[first[i]].view(np.int64), mask=~lost[first[i]]),
            "word2": pa.array(own[second[i]].view(np.int64), mask=~lost[second[i]])}
    sums = [np.add.reduceat(x, at[:-1]) for x in ((exact > 0).astype(np.int64), plain, full)]
    return (np.diff(at), *sums), leaving


def score(docs: DataFrame, model: Model, counts: Counts) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of doc_id, held_out, text.

    base_score takes exact counts: those of the most frequent words are at hand;
    a text's other words leave as (word, row, times) and meet their counts in a
    join, whose keys are rare words and so never hot. score takes the levels of
    the filter; words and bigrams that are not in it, and may be too rare for it,
    leave as well and meet `counts`: bigrams ask for theirs at the part of their
    hash, from where each part sends one sum a text. Cases: a null or empty text is one
    end; repeated rows and null ids keep their rows; extra columns are not read.
    """
    spark, parts = docs.sparkSession, counts.parts
    sent = spark.sparkContext.broadcast(tuple(vars(model).values()))
    base = model.tokens + model.distinct + 1

    def run(batches):
        m = Model(*sent.value)
        key, n = TaskContext.get().partitionId() << 40, 0
        held: dict[int, list] = {}

        def flush(n: int):
            rows = _asked(held.pop(_ASKED), parts) if _ASKED in held else []
            for kind, found in held.items():
                rows.append(((key // BLOCK_ROWS + n) % parts, kind, _stream(found)))
            held.clear()
            return _placed_batch(rows)

        for batch in batches:
            for i, j, tokens, at in _tokens(batch.column(2)):
                own, leaving = _measure(m, tokens, at, base)
                own = dict(zip(_KINDS[_OWN], (np.arange(i, j) + key, batch.column(0)[i:j], batch.column(1)[i:j], *own)))
                for kind, columns in {_OWN: own, **leaving}.items():
                    if kind != _OWN:
                        columns["row"] = columns["row"] + (i + key)
                    held.setdefault(kind, []).append(columns if kind == _ASKED else pa.RecordBatch.from_arrays(
                        [pa.array(columns[c], _TYPES[c]) for c in _KINDS[kind]], list(_KINDS[kind])))
                if sum(len(x["row"]) for x in held.get(_ASKED, ())) >= ASKED or sum(len(x) for kind in held if kind != _ASKED for x in held[kind]) >= ASKED_TEXTS:
                    yield flush(n := n + 1)
            key += len(batch)
        if held:
            yield flush(n + 1)

    placed = _placed(docs.select(F.col("doc_id").cast("long"), "held_out", "text").mapInArrow(run, _PLACED), parts)

    def of(kind: int) -> RDD:
        return placed.filter(lambda x: x[1][0] == kind).map(lambda x: x[1][1])

    words, own, away = counts.words, of(_OWN), of(_WORDS)
    if max(model.word_level, model.pair_level) > 1:
        met = counts.bigrams.union(placed)
        if model.word_level > 1:
            met = met.union(_named(_streamed(of(_LOST), spark, _KINDS[_LOST]), words, parts))
        met = met.mapPartitions(lambda rows: _gains(rows, parts, base)).partitionBy(parts)
        own, away = met.mapPartitions(_put_together), met.filter(lambda x: x[1][0] == -2).map(lambda x: x[1][1])
    rows = _streamed(own, spark, _KINDS[_OWN])
    middle = _middle(_level(F.col("c")))
    more = _streamed(away, spark, _KINDS[_WORDS]).join(words, "h", "left").select(
        "row", F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(base)))).alias("plain"),
        (F.col("alone") * F.log10(middle + 1) - F.col("before") * F.log10(middle / PRIOR + 1)).alias("full"))
    more = more.groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("known", "plain", "full")])
    return rows.join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("plain") + F.coalesce("more_plain", F.lit(0.0))).alias("base_score"),
        (F.col("full") + F.coalesce("more_full", F.lit(0.0))).alias("score"))


def _blocks(packed: bytes):
    """The texts of an Arrow stream by blocks of rows, which are together in it."""
    table = pa.ipc.open_stream(packed).read_all()
    block = table["row"].to_numpy() // BLOCK_ROWS
    edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])[:len(block)]).tolist()
    for i, j in zip(edges, [*edges[1:], len(block)]):
        yield int(block[i]), (-1, _stream(table.slice(i, j - i).combine_chunks().to_batches()))


def _named(left: DataFrame, words: DataFrame, parts: int) -> RDD:
    """Bigrams that left with a word, with the levels of its count, as they ask for their own."""
    for i in (1, 2):
        # rows without this word get keys of their own, which meet nothing and spread
        word = words.select(F.col("h").alias("_w"), F.col("c").alias("_c"))
        on = (F.coalesce(f"word{i}", F.xxhash64("row", "pair")) == F.col("_w")) & F.col(f"word{i}").isNotNull()
        left = left.join(word, on, "left").withColumn(f"level{i}", F.coalesce(_level(F.col("_c")).cast("tinyint"), f"level{i}")).drop("_w", "_c")

    def run(batches):
        for batch in batches:
            if len(batch):
                order = np.argsort(batch.column("row").to_numpy(), kind="stable")
                yield _placed_batch(_asked([{c: batch.column(c).to_numpy()[order] for c in _ASKS}], parts))

    return _placed(left.select(*_ASKS).mapInArrow(run, _PLACED), parts)
