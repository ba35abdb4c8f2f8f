"""Empty tables, nulls, ties, repeated rows, very long texts and clashing column names."""

import math
import os
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortline.llm import chat, common, decontaminate, embeddings, fixity, jaccard, lm, mixing, quality, token_counts, toxicity

LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
ROWS = [
    (1, "a b c d e f g", "s", "en", 13), (2, "a b c d e f g", "s", "en", 13), (2, "a b c d e f g", "s", "en", 13),
    (3, None, None, None, None), (4, "", "s", None, 0), (5, " \t\n", "t", "en", 3), (6, "one", "t", "en", 3),
    (None, "a b c d e f g", None, None, None), (None, None, None, None, None), (7, LONG, "s", "en", len(LONG)),
    (8, LONG + " end", "t", "en", len(LONG) + 4), (9, "x" * 200_000, "t", "en", 200_000), (10, "1 2 3 ! éа \U0001F600", "", "xx", 11),
]
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long"
CLASHES = ("id", "n", "size", "copies", "component_id", "class_id", "score", "hits", "words", "n_words", "token", "target")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit("extra").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([("q1", "b c d e"), ("q2", None), ("q3", ""), ("q1", "b c d e")], "item_id string, text string")


def test_jaccard_cases(docs, none):
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_join(docs).collect()]
    assert len(rows) == len(ROWS)
    assert {(1, 5, 1), (2, 5, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (8, 5001, 7), (9, 1, 9)} <= set(rows)
    assert jaccard.jaccard_join(none).count() == 0


def test_without_copies_cases(docs, none):
    left = jaccard.without_copies(docs)
    ids = sorted(r.doc_id for r in left.where("doc_id is not null").collect())
    assert left.columns == docs.columns and ids == [1, 3, 4, 5, 6, 7, 9, 10]
    assert left.where("doc_id is null").count() == 2
    assert jaccard.without_copies(none).count() == 0


def test_embedding_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n_links", F.lit("extra"))
    found = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    assert found[1].n_links >= 1 and found[2].component_id == 1 and found[1].kept
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_token_count_cases(docs, none):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(path)
    found = token_counts.token_counts(docs, path).collect()
    wanted = sorted((str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False))) for r in ROWS)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == wanted
    assert token_counts.token_counts(none, path).count() == 0


def test_mixing_cases(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["copies"] <= 2 for r in rows)
    assert mixing.mix(none).count() == 0
    out = mixing.mixed(docs)
    assert out.count() == sum(r["copies"] for r in rows)


def test_chat_parts(spark):
    rows = [(1, 1, "assistant", [("text", "see </s>", None, None), ("image", None, "i.png", 2), ("audio", None, "a.wav", 3)]),
            (1, 0, "user", None), (2, 0, None, [("text", None, None, None), ("film", None, "f", None)]), (None, None, "user", [])]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    frame = frame.withColumn("segment", F.lit("extra")).withColumn("tokens", F.lit("extra"))
    found = {(r.conv_id, r.turn): r for r in chat.format_turns(frame, {"image": 10, "audio": 5}).collect()}
    turn = found[1, 1]
    assert [(a.kind, a.ref, a.tokens) for a in turn.attachments] == [("image", "i.png", 20), ("audio", "a.wav", 15)]
    assert turn.tokens == 35 and "<|image:0|>" in turn.segment and "</s>" not in turn.segment
    assert chat.parse(found[1, 0].segment + turn.segment)[0] == ("user", "")
    assert chat.conversation_digests(chat.format_turns(frame)).count() == 3
    assert chat.format_turns(frame.limit(0)).count() == 0


def test_classifier_cases(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (7, 1, None), (4, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        for known in (labels, labels.limit(0)):
            scored = module.score(docs, module.learn(docs, known, F.lit(False)), "score")
            assert sorted(scored.columns) == sorted(docs.columns)
            scores = [r["score"] for r in scored.collect()]
            assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
        assert module.score(none, module.learn(none, labels, F.lit(False)), "score").count() == 0


def test_toxic_disguises():
    assert toxicity.fold("1d1оt") == toxicity.fold("idiot")


def test_labels_lower_seeds(spark):
    rows = [(i, "old trash on the road" if i % 2 else "plain words here", 0) for i in range(40)]
    rows += [(100 + i, "you absolute moron go away", 1) for i in range(10)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn(docs, labels, F.lit(False))
    assert " trash " not in lexicon.weights and lexicon.weights[" moron "] > 3 and lexicon.weights[" idiot "] == toxicity.SEED_WEIGHT
    assert toxicity.learn(docs, labels, F.lit(False), seeds=()).weights.keys().isdisjoint({" idiot "})
    automaton = lexicon.automaton()
    assert lexicon.score("the trash is full", automaton) < 0.5 < lexicon.score("what a m0r\u043en", automaton)


def test_matches_are_the_same_as_by_plain_search():
    weights = {" idiot ": 2.0, " idio": 1.0, " scum ": 3.0, " scumb": 2.5}
    lexicon = toxicity.Lexicon(weights, ("scum line",))
    weights[" été"] = 1.5
    lexicon = toxicity.Lexicon(weights, ("scum line",))
    for text in ("étés et ete", "un idiot en été", "an idiot, an idiotic id10t", "scum line and scum", "scumbag scum", "", "clean", "idiot idiot", "the scum line idiots"):
        folded, marked, phrase = toxicity.fold(text), toxicity.marked(text), toxicity.fold("scum line")
        spared = [(m, m + len(phrase) - 1) for m in range(len(folded)) if folded.startswith(phrase, m)]
        best = {}
        for term, weight in weights.items():
            where = folded if term.isascii() else marked
            for at in range(len(where)):
                if where.startswith(term, at) and not (where is folded and any(a <= at < b for a, b in spared)):
                    best[where is folded, at] = max(best.get((where is folded, at), 0), weight)
        assert math.isclose(lexicon.measures(text, lexicon.automaton())[0], math.log1p(sum(best.values())))


def test_fixity_cases(spark):
    rows = [(1, "u", "body"), (2, None, None), (3, "u", "body"), (3, "u", "body"), (None, "u", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("hash", F.lit("extra"))
    empty = pages.limit(0)
    assert fixity.audit(fixity.records(pages), fixity.records(pages)).count() == 0
    assert fixity.audit(fixity.records(empty), fixity.records(empty)).count() == 0
    assert fixity.audit(fixity.records(pages), fixity.records(empty)).count() == len(rows)
    struck = pages.withColumn("html", F.when(F.col("page_id") == 1, F.lit("bodx")).otherwise(F.col("html")))
    assert fixity.audit(fixity.records(pages), fixity.records(struck)).count() == 1


def test_shared_hashes_move_once(spark):
    heads = spark.createDataFrame([(1, 9, 5), (2, 9, 5), (2, 9, 6), (3, 9, 7), (4, 9, 5)], "id long, n long, token long")
    shared = jaccard._shared(heads)
    assert sorted(tuple(r) for r in shared.select("id", "n", "token", "df").collect()) == [(1, 9, 5, 3), (2, 9, 5, 3), (4, 9, 5, 3)]
    assert shared._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


def test_quality_scores_hold_one_run_of_texts_at_a_time():
    some = np.random.default_rng(1)
    column = pa.array([" ".join(f"w{x}" for x in some.integers(0, 100_000, 300)) for _ in range(3000)] + [None, "", "x" * (2 << 20)])
    given = np.where(np.arange(len(column)) % 3 == 0, np.nan, np.arange(len(column)) * 1.0)
    size = (1 << quality.WORD_BITS) + (quality.BINS + 1) * len(quality.STATS)
    machine = quality.Machine(np.sort(some.random((len(quality.STATS), quality.BINS)), 1), 0.1, some.normal(size=size), some.normal(size=(size, quality.RANK)))
    whole = machine.score(*quality.features(column, given))
    tracemalloc.start()
    found = quality.scores(machine, column, given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(found, whole)
    assert peak < 100 << 20
    assert len(quality.scores(machine, column[:0], given[:0])) == 0


def test_lm_cases(docs, none):
    marked = docs.withColumn("held_out", F.lit(False))
    for training in (docs, none):
        model, counts = lm.learn(training.select("text"))
        rows = lm.score(marked, model, counts).collect()
        assert len(rows) == len(ROWS) and all(r["n_tokens"] >= 1 and r["score"] <= 0 for r in rows)
        assert lm.score(marked.limit(0), model, counts).count() == 0


@pytest.mark.parametrize("head, entries", [(3, 0), (1 << 20, 6), (0, 40)])
def test_lm_scores_take_every_bigram_whatever_the_filter_holds(spark, monkeypatch, head, entries):
    """Against a plain computation; what does not fit into the filter meets its counts in joins."""
    monkeypatch.setattr(lm, "HEAD_WORDS", head)
    monkeypatch.setattr(lm, "FILL", min(lm.FILL, 2 * entries / lm.BITS))
    training = ["a b c a b d", "a b e f", "e f g", "a", "", None, "a b"] * 3 + ["rare words once", "rare words twice", "h a b h"]
    texts = [*dict.fromkeys(training), "unseen a b c", "rare a once unseen unseen words", "once rare words", "g g a b g", "h a b"]

    def tokens(text):
        return [*(text or "").split(), None]

    words, pairs = Counter(), Counter()
    for t in map(tokens, training):
        words.update(t)
        pairs.update(zip(t, t[1:]))
    base = words.total() + len(words) + 1

    def middle(count):
        return max(1.0, lm.BASE ** (math.floor(math.log(count, lm.BASE) + 1e-9) + 0.5)) if count else 0.0

    def expected(text):
        total, last = 0.0, None
        for i, t in enumerate(tokens(text)):
            p = (middle(words[t]) + 1) / base
            if i:
                before = middle(words[last])
                p = (min(before, middle(pairs[last, t])) + lm.PRIOR * p) / (before + lm.PRIOR)
            total, last = total + math.log10(p), t
        return total

    model, counts = lm.learn(spark.createDataFrame([(t,) for t in training], "text string"))
    asked = spark.createDataFrame([(i, False, t) for i, t in enumerate(texts)], "doc_id long, held_out boolean, text string")
    found = {r.doc_id: r for r in lm.score(asked, model, counts).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        assert found[i].score == pytest.approx(expected(t), rel=1e-9)
        assert found[i].base_score == pytest.approx(sum(math.log10((words[x] + 1) / base) for x in tokens(t)), rel=1e-9)
        assert found[i].n_known == sum(words[x] > 0 for x in tokens(t))


def test_lm_bigrams_are_moved_once_and_packed(spark, monkeypatch):
    """Only the words are written as a table; a bigram of a run takes less than its hash."""
    monkeypatch.setattr(lm, "FILL", 0.0)
    folder = common.shared_folder(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    docs = spark.createDataFrame([(i, False, f"a{i % 7} b{i % 5} c{i % 3} d") for i in range(200)], "doc_id long, held_out boolean, text string")
    model, counts = lm.learn(docs.select("text"))
    assert lm.score(docs, model, counts).count() == 200
    assert sum(name.startswith("cohortline-") for name in set(os.listdir(folder)) - there) == 1
    some = np.random.default_rng(1)
    keys, n = np.unique(some.integers(0, 1 << 64, 100_000, np.uint64)), some.integers(1, 4, 100_000)
    runs = [lm._pack(lm._steps(keys[i::2], 0), n[i::2] - 1) for i in (0, 1)]
    assert sum(map(len, runs)) < 7 * len(keys)
    merged = lm._merged([*runs, runs[0]], 0)
    assert np.array_equal(merged[0], keys) and np.array_equal(merged[1], n * np.where(np.arange(len(n)) % 2, 1, 2))


def test_decontamination_cases(docs, none, bench):
    rows = decontaminate.summary(docs, bench).collect()
    assert len(rows) == len(ROWS)
    assert {(r.doc_id, r.n_hit, r.n_items) for r in rows} >= {(1, 4, 1), (2, 4, 1), (3, 0, 0), (4, 0, 0), (7, 0, 0), (None, 4, 1)}
    assert decontaminate.summary(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.summary(none, bench).count() == 0
    left = decontaminate.remove_overlaps(docs, bench, max_coverage=0.9)
    assert left.columns == docs.columns and left.count() == len(ROWS)
    assert left.where("doc_id = 1").first()["text"].split() == ["a", "f", "g"]
    assert decontaminate.remove_overlaps(docs, bench).count() == len(ROWS) - 4


def test_overlaps_are_removed_in_one_pass_whatever_the_number_of_automata(spark):
    """Over many texts in one Arrow batch, some with hits of two automata; a task needs one Python worker."""
    items = [("q1", "alpha beta gamma"), ("q2", "delta epsilon"), ("q3", "mu nu")]
    said = ["one alpha beta gamma two", "delta Epsilon, three four mu nu five", None, "", "éа six mu  nu", "mu nu"]
    docs = spark.createDataFrame([(i, said[i % 6], 7) for i in range(9_000)] + [(9_000, "x " * 900_000 + "mu nu y", 7)],
                                 "doc_id long, text string, n_chars long").coalesce(1)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for most in (2, 1000):
        left = decontaminate.remove_overlaps(docs, bench, window=3, max_coverage=0.6, most_words=most)
        assert left._jdf.queryExecution().sparkPlan().toString().count("MapInArrow") == 1
        rows = {r.doc_id: (r.text, r.n_chars) for r in left.collect()}
        assert [rows.get(i) for i in range(6)] == [("one two", 7), ("three four five", 15), (None, 7), ("", 7), ("éа six ", 7), None]
        assert len(rows) == 7_501 and all(rows.get(i) == rows.get(i % 6) for i in range(9_000))
        assert rows[9_000][0] == "x " * 900_000 + "y"
