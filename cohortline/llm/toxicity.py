"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding disguises."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices

# Letters that look like Latin ones, and digits and signs that stand for letters. i and l share the
# letter i, since 1, | and ! stand for both.
_LOOKS = {
    "а": "a", "ɑ": "a", "α": "a", "@": "a", "4": "a",
    "в": "b", "β": "b", "8": "b",
    "с": "c", "ϲ": "c", "¢": "c",
    "ԁ": "d",
    "е": "e", "ё": "e", "є": "e", "ε": "e", "3": "e", "€": "e",
    "ɡ": "g", "9": "g", "6": "g",
    "һ": "h", "н": "h",
    "і": "i", "ї": "i", "ı": "i", "ι": "i", "l": "i", "1": "i", "|": "i", "!": "i", "ӏ": "i", "ł": "i",
    "ј": "j",
    "к": "k", "κ": "k",
    "м": "m",
    "п": "n", "η": "n",
    "о": "o", "ο": "o", "σ": "o", "0": "o", "ø": "o",
    "р": "p", "ρ": "p",
    "ѕ": "s", "5": "s", "$": "s",
    "т": "t", "τ": "t", "7": "t", "+": "t",
    "υ": "u", "ц": "u", "μ": "u",
    "ѵ": "v", "ν": "v",
    "ԝ": "w", "ω": "w",
    "х": "x", "χ": "x",
    "у": "y", "γ": "y",
    "2": "z",
}
# Signs that stand for letters only between letters; elsewhere they are punctuation.
_SIGNS = "@$|!+¢€"
_TABLE = str.maketrans({k: v for k, v in _LOOKS.items() if k not in _SIGNS})
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_SIGN = re.compile(rf"(?<=[^\W_])[{re.escape(_SIGNS)}](?=[^\W_])|(?<![^\s])[@$](?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")

#: Phrases in which listed words are harmless; given in plain spelling.
EXCEPTIONS = ("clown fish", "clown car", "circus clown", "trash can", "trash bin", "trash bag", "idiot proof", "scum line")

#: Words that mark abuse as long as the labelled texts say nothing about them; given in plain spelling.
SEEDS = ("idiot", "moron", "imbecile", "cretin", "stupid", "dumb", "loser", "scum", "vermin", "filth", "trash", "worthless",
         "pathetic", "disgusting", "clown", "bastard", "asshole", "bitch", "jerk", "scumbag", "retard", "dumbass")
#: Weight of a seed that the labelled texts say nothing about, and the log odds that a learned term is above.
SEED_WEIGHT, LEAST_ODDS = 4.0, 3.0

#: Most labelled documents that a model is fitted on; they bound the candidate terms as well.
MOST_LABELLED = 20_000


def fold(text: str) -> str:
    """Words of the text with disguises undone, each between single spaces."""
    text = text.lower()
    if not text.isascii():
        text = _HIDDEN.sub("", text)
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    text = _SIGN.sub(lambda m: _LOOKS[m[0]], text)
    return " " + " ".join(_WORD.findall(text.translate(_TABLE))) + " "


def marked(text: str) -> str:
    """The words of :func:`fold` with their accents kept, since accents tell words apart in many languages; empty for plain texts."""
    if text.isascii():
        return ""
    text = _SIGN.sub(lambda m: _LOOKS[m[0]], unicodedata.normalize("NFC", _HIDDEN.sub("", text.lower())))
    return " " + " ".join(_WORD.findall(text.translate(_TABLE))) + " "


def _terms(text: str) -> set[str]:
    """Whole words (` word `) and word beginnings of 4 to 6 letters (` word`), folded; and beginnings of 3 to 6 letters with accents."""
    words, others = set(fold(text).split()), {w for w in marked(text).split() if not w.isascii()}
    return ({f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in (4, 5, 6) if len(w) > n}
            | {f" {w[:n]}" for w in others for n in (3, 4, 5, 6) if len(w) > n and not w[:n].isascii()})


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, held_out, most: int, keep=("text",)) -> DataFrame:
    """The kept columns and label of at most `most` labelled documents that are not held out, picked by a hash of doc_id.

    Only the picked ids come to the driver and are broadcast: their number is bounded.
    """
    ids = (labels.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("label"))
           .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out).dropDuplicates(["doc_id"])
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    picked = docs.sparkSession.createDataFrame(ids.toArrow())
    return docs.select(F.col("doc_id").cast("long"), *keep).join(F.broadcast(picked), "doc_id").select(*keep, "label")


class Lexicon:
    """Weighted terms and a calibration; scores a text from 0 to 1."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...], coefficients=(0.0, 0.0, -4.0)):
        self.weights, self.exceptions, self.coefficients = weights, exceptions, coefficients

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight, term.isascii()))
        for phrase in self.exceptions:
            found.add_word(fold(phrase), (len(fold(phrase)), None, True))
        if len(found):
            found.make_automaton()
        return found

    def measures(self, text: str, automaton) -> tuple[float, float]:
        """Log of the matched weight, and of the matched weight per 100 words; the heaviest match of a word counts."""
        if not len(automaton) or not text:
            return 0.0, 0.0
        folded = fold(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (n, weight, plain) in automaton.iter(folded + marked(text)):
            if plain and end >= len(folded):
                continue  # a plain word was met in the folded text already
            if weight is None:
                spared.append((end + 1 - n, end))
            elif weight > best.get(end + 1 - n, 0.0):
                best[end + 1 - n] = weight
        if not best:
            return 0.0, 0.0
        for s, t in spared:
            for at in [b for b in best if s <= b < t]:
                best.pop(at)
        total = sum(best.values())
        return float(np.log1p(total)), float(np.log1p(100 * total / max(1, folded.count(" ") - 1)))

    def score(self, text: str, automaton) -> float:
        a, b = self.measures(text, automaton)
        p, q, r = self.coefficients
        return float(1 / (1 + np.exp(-(p * a + q * b + r))))


def learn(docs: DataFrame, labels: DataFrame, held_out, exceptions: tuple[str, ...] = EXCEPTIONS,
          most_labelled: int = MOST_LABELLED, least_support: int = 3, marks_wanted: int = 2,
          seeds: tuple[str, ...] = SEEDS) -> Lexicon:
    """A lexicon from labelled documents: terms that mark toxic texts, by their log odds.

    Document frequencies of words and word beginnings are counted by label in
    Spark. Of the candidates (in `least_support` toxic texts at least, with log
    odds above LEAST_ODDS) the one that is in most texts that still want marks is taken, a
    text wanting `marks_wanted`, until it marks fewer than `least_support`; so
    words that only go along with toxic ones are left out. `seeds` are entries
    from the start: with their log odds where `least_support` labelled texts hold
    them, which may be low, or leave them out when it is not above 0, and with
    SEED_WEIGHT elsewhere. The two measures
    of a text are then calibrated by a logistic fit. All of it uses the bounded
    sample of labelled_sample. Without labelled toxic texts the seeds remain.
    """
    sample = labelled_sample(docs, labels, "toxic", held_out, most_labelled)

    def frequencies(batches):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(_terms(text or ""))
                counts[label][""] += 1
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[0][x] for x in names], pa.int64()), pa.array([counts[1][x] for x in names], pa.int64())],
            ["term", "clean", "toxic"])

    counted = sample.mapInArrow(frequencies, "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    given = {fold(w): SEED_WEIGHT for w in seeds}
    wanted_terms = F.expr(f"term = '' or toxic >= {least_support} and toxic > 20 * clean") | F.col("term").isin(*given)
    rows = {r.term: r for r in counted.where(wanted_terms).collect()}
    total = rows.pop("", None)
    if total is None or not total.toxic:
        return Lexicon(given, exceptions)
    odds = {t: float(np.log((r.toxic + 0.5) / (total.toxic + 1) * (total.clean + 1) / (r.clean + 0.5))) for t, r in rows.items()}
    given |= {t: odds[t] for t, r in rows.items() if t in given and r.toxic + r.clean >= least_support}
    weights = {t: odds[t] for t, r in rows.items() if r.toxic >= least_support and r.toxic > 20 * r.clean and odds[t] > LEAST_ODDS}

    def marks(batches):
        for batch in batches:
            found = [sorted(_terms(t or "") & weights.keys()) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], ["terms"])

    texts_of: dict[str, set[int]] = {}
    wanted: dict[int, int] = {}
    for i, row in enumerate(sample.where("label = 1").mapInArrow(marks, "terms array<string>").toLocalIterator()):
        wanted[i] = marks_wanted
        for term in row.terms:
            texts_of.setdefault(term, set()).add(i)
    chosen: dict[str, float] = {}

    def take(term: str, weight: float) -> None:
        chosen[term] = weight
        done = set()
        for i in texts_of.pop(term, ()):
            wanted[i] -= 1
            if not wanted[i]:
                done.add(i)
        for t in list(texts_of):
            # longer and shorter forms of a term mark the same words
            if t.strip().startswith(term.strip()) or not t.endswith(" ") and term.startswith(t):
                texts_of.pop(t)
            elif done:
                texts_of[t] -= done

    for term, weight in given.items():
        if weight > LEAST_ODDS:
            take(term, weight)
        elif weight > 0:
            chosen[term] = weight
    while texts_of:
        term = min(texts_of, key=lambda t: (-len(texts_of[t]), not t.endswith(" "), len(t), t))
        if len(texts_of[term]) < least_support:
            break
        take(term, float(weights[term]))
    return calibrated(Lexicon(chosen, exceptions), sample)


def calibrated(lexicon: Lexicon, sample: DataFrame) -> Lexicon:
    """The lexicon with logistic coefficients fitted to the bounded sample's two measures."""
    def measure(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            both = [lexicon.measures(t or "", automaton) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in both], pa.float64()), pa.array([x[1] for x in both], pa.float64()), batch.column(1)], ["a", "b", "label"])

    rows = sample.mapInArrow(measure, "a double, b double, label int").toArrow()
    x = np.column_stack([rows["a"].to_numpy(), rows["b"].to_numpy(), np.ones(len(rows))])
    y = rows["label"].to_numpy()
    c = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ c))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3), x.T @ (y - p) - 0.1 * c)
        c = c + np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return Lexicon(lexicon.weights, lexicon.exceptions, tuple(float(v) for v in c))


def score(docs: DataFrame, lexicon: Lexicon, column: str = "toxicity") -> DataFrame:
    """docs with a score from 0 to 1 in `column` (replaced if there).

    Cases: null and empty texts score like texts without matches; every row and
    column is kept; texts are scored whole. Nothing but the text is read.
    """
    kept = [c for c in docs.columns if c != column]
    out = docs.select(*[f"`{c}`" for c in kept], F.lit(0.0).alias(column))

    def run(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for i, j in slices(batch.column(at)):
                rows = batch.slice(i, j - i)
                scores = [lexicon.score(t or "", automaton) for t in rows.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(scores, pa.float64())], schema=batch.schema)

    return out.mapInArrow(run, out.schema)
