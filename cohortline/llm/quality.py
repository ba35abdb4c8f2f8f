"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SPACES, slices, texts, word_slices
from .toxicity import labelled_sample

WORD_BITS = 13
BINS = 10
RANK = 4
#: Most labelled documents that a model is fitted on.
MOST_LABELLED = 6_000

STATS = ("length", "words", "word_length", "upper", "digits", "punctuation", "signs", "spaces", "high_bytes",
         "lines", "line_length", "repeated_words", "repeated_lines", "commonest_word", "stops", "given_length")
# Byte classes of the structure statistics.
_CLASSES = {
    "upper": bytes(range(65, 91)), "digits": bytes(range(48, 58)), "punctuation": b".,;:!?'\"()-",
    "signs": b"|#$%&*+/<=>@[\\]^_`{}~", "spaces": bytes([32, *range(9, 14)]), "high_bytes": bytes(range(128, 256)),
    "newlines": b"\n", "stops": b".!?",
}


def _line_repeats(text: bytes) -> float:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return 1 - len(set(lines)) / len(lines) if lines else 0.0


def features(column: pa.Array, given: np.ndarray):
    """(word buckets, weights) and the structure statistics of each text; `given` is the metadata length (nan if null)."""
    offsets, data = texts(column)
    n = len(offsets) - 1
    stats = np.zeros((n, len(STATS)))
    words: list[np.ndarray] = []
    tables = {k: np.isin(np.arange(256), list(v)) for k, v in _CLASSES.items()}
    for i, j, hashes, starts, ends, at, part in word_slices(column, SPACES):
        rel = offsets[i: j + 1] - offsets[i]
        size = np.maximum(1, np.diff(rel))
        share = {k: np.diff(np.concatenate([[0], np.cumsum(t[part], dtype=np.int64)])[rel]) for k, t in tables.items()}
        buckets = (hashes & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
        for d in range(i, j):
            k = d - i
            own = hashes[at[k]: at[k + 1]]
            distinct, counts = np.unique(own, return_counts=True)
            n_words, lines = max(1, len(own)), share["newlines"][k] + 1
            words.append(np.unique(buckets[at[k]: at[k + 1]]))
            stats[d] = (
                np.log1p(rel[k + 1] - rel[k]), np.log1p(len(own)), (size[k] - share["spaces"][k]) / n_words,
                share["upper"][k] / size[k], share["digits"][k] / size[k], share["punctuation"][k] / size[k], share["signs"][k] / size[k],
                share["spaces"][k] / size[k], share["high_bytes"][k] / size[k], np.log1p(lines), np.log1p(size[k] / lines),
                1 - len(distinct) / n_words, _line_repeats(part[rel[k]: rel[k + 1]].tobytes()),
                (counts.max() if len(counts) else 0) / n_words, share["stops"][k] / n_words,
                np.log1p(max(0.0, given[d])) if given[d] == given[d] else -1.0)
    return words, stats


class Machine:
    """w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, by the sum-of-squares identity."""

    def __init__(self, edges: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.edges, self.w0, self.w, self.v = edges, w0, w, v

    def rows(self, words: list[np.ndarray], stats: np.ndarray):
        """Indices, values and row starts of the texts' features."""
        base = 1 << WORD_BITS
        bins = np.stack([np.searchsorted(self.edges[s], stats[:, s], "right") for s in range(len(STATS))], 1)
        bins += base + (BINS + 1) * np.arange(len(STATS))
        n = np.array([len(x) for x in words], np.int64)
        ends = np.cumsum(n + len(STATS))
        index, value = np.empty(ends[-1] if len(ends) else 0, np.int64), np.empty(ends[-1] if len(ends) else 0)
        starts = ends - n - len(STATS)
        for i, x in enumerate(words):
            s = starts[i]
            index[s: s + len(STATS)], value[s: s + len(STATS)] = bins[i], 1 / np.sqrt(len(STATS))
            index[s + len(STATS): ends[i]], value[s + len(STATS): ends[i]] = x, 1 / np.sqrt(max(1, len(x)))
        return index, value, starts

    def raw(self, index, value, starts):
        if not len(starts):
            return np.zeros(0), np.zeros((0, RANK))
        vx = self.v[index] * value[:, None]
        sums = np.add.reduceat(vx, starts)
        pairs = 0.5 * (sums ** 2 - np.add.reduceat(vx ** 2, starts)).sum(1)
        return self.w0 + np.add.reduceat(self.w[index] * value, starts) + pairs, sums

    def score(self, words, stats):
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.rows(words, stats))[0], -30, 30)))


def fit(words: list[np.ndarray], stats: np.ndarray, y: np.ndarray, epochs: int = 15, batch: int = 128, rate: float = 0.03,
        decay: float = 1e-5, seed: int = 3) -> Machine:
    """A machine fitted by Adam on log loss; bin edges are the sample's quantiles."""
    random = np.random.default_rng(seed)
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    edges = np.concatenate([edges, stats.max(0)[:, None] + 1], 1)
    size = (1 << WORD_BITS) + (BINS + 1) * len(STATS)
    mean = np.clip(y.mean(), 0.01, 0.99)
    m = Machine(edges, float(np.log(mean / (1 - mean))), np.zeros(size), random.normal(0, 0.05, (size, RANK)))
    index, value, starts = m.rows(words, stats)
    ends = np.append(starts[1:], len(index))
    theta = np.concatenate([m.w[:, None], m.v], 1)
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(epochs):
        order = random.permutation(len(y))
        for b in range(0, len(y), batch):
            rows = order[b: b + batch]
            n = ends[rows] - starts[rows]
            at = np.repeat(starts[rows] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            idx, val, own = index[at], value[at], np.concatenate([[0], np.cumsum(n)[:-1]])
            m.w, m.v = theta[:, 0], theta[:, 1:]
            raw, sums = m.raw(idx, val, own)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[rows]) / len(rows)
            each = np.repeat(g, n) * val
            inner = np.repeat(sums, n, axis=0) - m.v[idx] * val[:, None]
            grad = np.stack([np.bincount(idx, each, size), *[np.bincount(idx, each * inner[:, f], size) for f in range(RANK)]], 1)
            grad += decay * theta
            m.w0 -= rate * g.sum()
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad ** 2
            theta = theta - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    m.w, m.v = theta[:, 0].copy(), theta[:, 1:].copy()
    return m


def _given(docs: DataFrame):
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("double")


def learn(docs: DataFrame, labels: DataFrame, held_out, most_labelled: int = MOST_LABELLED) -> Machine:
    """A machine for labels.quality, from the bounded sample of labelled documents that are not held out.

    Texts are turned into features on the workers; features of at most
    `most_labelled` documents come to the driver. Without labels of both kinds
    every document scores the labels' mean (0.9 without any).
    """
    def run(batches):
        for batch in batches:
            words, stats = features(batch.column(0), batch.column(2).to_numpy(zero_copy_only=False).astype(float))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.astype(np.int16) for w in words], pa.list_(pa.int16())), pa.array(list(stats), pa.list_(pa.float64())), batch.column(1)],
                ["words", "stats", "label"])

    sample = labelled_sample(docs.withColumn("__given", _given(docs)), labels, "quality", held_out, most_labelled,
                             ("text", "__given"))
    rows = sample.select("text", "label", "__given").mapInArrow(
        run, "words array<smallint>, stats array<double>, label int").toArrow()
    y = rows["label"].to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        mean = float(np.clip(y.mean() if len(y) else 0.9, 0.05, 0.95))
        size = (1 << WORD_BITS) + (BINS + 1) * len(STATS)
        return Machine(np.zeros((len(STATS), BINS)), float(np.log(mean / (1 - mean))), np.zeros(size), np.zeros((size, RANK)))
    words = [np.array(w, np.int64) for w in rows["words"].to_pylist()]
    return fit(words, np.array(rows["stats"].to_pylist()), y)


def scores(machine: Machine, column: pa.Array, given: np.ndarray) -> np.ndarray:
    """The machine's scores of the texts, by runs of them: a run's features take some twenty times its bytes."""
    found = [np.zeros(0), *(machine.score(*features(column[i:j], given[i:j])) for i, j in slices(column))]
    return np.concatenate(found)


def score(docs: DataFrame, machine: Machine, column: str = "quality_score") -> DataFrame:
    """docs with the machine's score from 0 to 1 in `column` (replaced if there).

    Cases: null and empty texts have structure features only; a null or missing
    n_chars counts as unknown; every row and column is kept; texts are read whole.
    """
    kept = [c for c in docs.columns if c != column]
    out = docs.select(*[f"`{c}`" for c in kept], F.lit(0.0).alias(column), _given(docs).alias("__given"))
    sent = docs.sparkSession.sparkContext.broadcast((machine.edges, machine.w0, machine.w, machine.v))
    result = out.drop("__given")

    def run(batches):
        model = Machine(*sent.value)
        for batch in batches:
            name = batch.schema.get_field_index
            given = batch.column(name("__given")).to_numpy(zero_copy_only=False).astype(float)
            found = scores(model, batch.column(name("text")), given)
            scored = pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(found, pa.float64())], names=batch.schema.names[:-1])
            yield from (scored.slice(i, j - i) for i, j in slices(batch.column(name("text"))))

    return out.mapInArrow(run, result.schema)
