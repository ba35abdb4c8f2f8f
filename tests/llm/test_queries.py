"""Registered corpus queries over whole tables, against brute force."""

import collections
import hashlib
import math
import os
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from cohortline.llm import chat, oracle, queries

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
LEARN = os.environ.get("TEST_LEARN_DIR", "/root/testdata/sf0.01")
LETTERS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").encode().lower()


def table(sf_dir, name):
    return pq.read_table(f"{sf_dir}/{name}.parquet").to_pylist()


def result(spark, sf_dir, name, key):
    rows = queries.QUERIES[name](spark, sf_dir).collect()
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found


def linked(n, links):
    """Smallest position that each position reaches."""
    at = list(range(n))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, j in links:
        a, b = sorted((root(i), root(j)))
        at[b] = a
    return [root(i) for i in range(n)]


def jaccard_links(sets, percent):
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in holders[x] if j > i)
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                yield i, j


def shingles(text, k):
    words = SPACED.findall(low(text))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name).group(1)) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))


def test_jaccard_join(spark, sf_dir):
    docs = sorted(table(sf_dir, "documents"), key=lambda d: d["doc_id"])
    sets = [shingles(d["text"], 3) for d in docs]
    smallest = linked(len(docs), jaccard_links(sets, 90))
    found = result(spark, sf_dir, "op1_jaccard_join", "doc_id")
    for i, d in enumerate(docs):
        assert found[d["doc_id"]]["n_shingles"] == len(sets[i])
        assert found[d["doc_id"]]["component_id"] == docs[smallest[i]]["doc_id"]


def test_embedding_dedup(spark, sf_dir):
    rows = sorted(table(sf_dir, "embeddings"), key=lambda r: r["vec_id"])
    x = np.array([r["embedding"] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    found = result(spark, sf_dir, "op2_embedding_dedup", "vec_id")
    assert set(found) == {r["vec_id"] for r in rows}
    got = np.array([found[r["vec_id"]]["n_links"] for r in rows])
    assert (got <= near.sum(axis=1)).all()
    assert got.sum() >= 0.9 * near.sum()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


def test_token_counts(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    found = result(spark, sf_dir, "op3_token_counts", "doc_id")
    for d in table(sf_dir, "documents"):
        n = len(tokenizer.encode(d["text"] or "", add_special_tokens=False))
        r = found[d["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((d["text"] or "").encode()), n, n > 512)


def test_mixing(spark, sf_dir):
    docs = {d["doc_id"]: d for d in table(sf_dir, "documents")}
    found = result(spark, sf_dir, "op4_mixing", "doc_id")
    assert set(found) == set(docs)
    assert queries.op4_mixing(spark, sf_dir).exceptAll(queries.op4_mixing(spark, sf_dir)).count() == 0
    sizes, taken, target = collections.Counter(), collections.Counter(), {}
    for i, r in found.items():
        size, source = len(SPACED.findall((docs[i]["text"] or "").encode())), docs[i]["source"]
        assert r["size"] == size and 0 <= r["taken"] <= 2 * size and (not size or r["taken"] % size == 0)
        sizes[source] += size
        taken[source] += r["taken"]
        target[source] = r["target"]
    assert all(target[s] <= 2 * sizes[s] + 1e-6 for s in sizes)
    assert math.isclose(sum(target.values()), 1.5 * sum(sizes.values()), rel_tol=1e-9)
    largest = max(r["size"] for r in found.values())
    assert all(abs(taken[s] - target[s]) <= max(0.05 * target[s], 2 * largest) for s in sizes)


def test_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    turns = collections.defaultdict(list, {-1: [(0, "user", said), (1, "assistant", said)]})
    for r in table(sf_dir, "conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    found = result(spark, sf_dir, "op5_chat_format", "conv_id")
    assert set(found) == set(turns)
    for conv, rows in turns.items():
        rows.sort(key=lambda t: t[0])
        loss = "".join(t for _, role, t in rows if role == "assistant")
        r = found[conv]
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in rows).encode()).hexdigest()
        assert (r["n_turns"], r["loss_chars"]) == (len(rows), len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("name, label, n, held, least", [
    ("op6_toxicity", "toxic", 5, 0, 0.5), ("op7_quality", "quality", 4, 2, 0.7)])
def test_held_out_accuracy(spark, name, label, n, held, least):
    sf_dir = LEARN
    labels = {r["doc_id"]: r[label] for r in table(sf_dir, "labels") if r[label] is not None}
    found = result(spark, sf_dir, name, "doc_id")
    right = total = 0
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % n == held)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= least)
        if r["held_out"] and i in labels:
            total += 1
            right += r["predicted"] == labels[i]
    assert total and right >= 0.9 * total


def test_held_out_toxic_documents_are_caught(spark):
    """Recall and precision, where there are enough labelled documents to tell."""
    sf_dir = os.environ.get("TEST_MORE_DIR", "/root/testdata/sf0.1")
    toxic = {r["doc_id"]: r["toxic"] for r in table(sf_dir, "labels") if r["toxic"] is not None}
    found = [(r.predicted, toxic[r.doc_id]) for r in queries.op6_toxicity(spark, sf_dir).where("held_out").collect() if r.doc_id in toxic]
    caught = sum(p and t for p, t in found)
    assert sum(t for _, t in found) > 10
    assert caught >= 0.85 * sum(t for _, t in found) and caught >= 0.95 * sum(p for p, _ in found)


def test_fixity_audit_finds_every_changed_page(spark, sf_dir):
    struck = {p["page_id"] for p in table(sf_dir, "pages") if p["html"]
              and hashlib.md5(str(p["page_id"]).encode()).hexdigest()[:2] < "04"}
    assert queries.op8_fixity_audit(spark, sf_dir).count() == len(struck)


def test_lm_scores(spark, sf_dir):
    docs = table(sf_dir, "documents")
    tokens = {d["doc_id"]: [*SPACED.findall(low(d["text"])), None] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = collections.Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    total = sum(counts.values())
    base = math.log10(total + len(counts) + 1)
    found = result(spark, sf_dir, "op9_lm_scores", "doc_id")
    for i, ts in tokens.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(ts), total)
        assert r["n_known"] == sum(counts[t] > 0 for t in ts)
        assert math.isclose(r["base_score"], sum(math.log10(counts[t] + 1) - base for t in ts), rel_tol=1e-9)
        assert r["score"] <= 0


def test_lm_scores_beat_the_base_on_held_out_texts(spark):
    """A statement about learning, so it is made where there is enough to learn from."""
    found = queries.op9_lm_scores(spark, LEARN).where("held_out").groupBy().sum("score", "base_score").first()
    assert found["sum(score)"] > found["sum(base_score)"]


def benchmark_windows(sf_dir, window):
    at = collections.defaultdict(set)
    for item in table(sf_dir, "benchmark"):
        words = LETTERS.findall(low(item["text"]))
        n = min(window, len(words))
        for j in range(len(words) - n + 1 if n else 0):
            at[tuple(words[j:j + n])].add(str(item["item_id"]))
    return at, {len(w) for w in at}


def hit_words(text, at, lengths):
    words, hit, items = LETTERS.findall(low(text)), set(), set()
    for n in lengths:
        for j in range(len(words) - n + 1):
            if found := at.get(tuple(words[j:j + n])):
                hit.update(range(j, j + n))
                items |= found
    return len(words), hit, items


def test_decontaminate(spark, sf_dir):
    at, lengths = benchmark_windows(sf_dir, 10)
    found = result(spark, sf_dir, "op10_decontaminate", "doc_id")
    for d in table(sf_dir, "documents"):
        n, hit, items = hit_words(d["text"], at, lengths)
        r = found[d["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, len(hit), len(items), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def test_pipeline_stages(spark, sf_dir, tmp_path):
    """Each stage against brute force on its own input, or against its operator's scores."""
    docs = queries.read(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        assert name == "mixing" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = before, [(r["doc_id"], r["text"]) for r in docs.collect()]

    before, after = kept["jaccard_join"]
    ids = sorted(before)
    smallest = linked(len(ids), jaccard_links([shingles(before[i], 5) for i in ids], 80))
    assert sorted(i for i, _ in after) == [i for n, i in enumerate(ids) if smallest[n] == n]

    before, after = kept["decontamination"]
    at, lengths = benchmark_windows(sf_dir, 10)
    left = dict(after)
    for i, text in before.items():
        n, hit, _ = hit_words(text, at, lengths)
        assert (i in left) == (len(hit) <= 0.5 * n)
        if i in left and not hit:
            assert left[i] == text

    before, after = kept["mixing"]
    assert {i for i, _ in after} <= set(before) and max(collections.Counter(i for i, _ in after).values()) <= 2


def test_sql_names_registered_queries():
    assert set(oracle.ORACLE) <= set(queries.QUERIES)
    assert chat.unescape(chat.escape("a<|b|> <~|c [/INST] </s>")) == "a<|b|> <~|c [/INST] </s>"
