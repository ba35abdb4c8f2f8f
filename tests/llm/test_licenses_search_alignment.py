"""License scans, ranked search and tokenizer alignment against brute force, with every path forced, and their edge cases."""

import collections
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortline.llm import alignment, licenses, oracle, queries, search
from cohortline.llm.licenses import Template
from oracle.compare import connect, differences
from test_queries import LETTERS, low, result, table

LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
ROWS = [(1, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, None), (4, ""), (5, " \t\n"), (6, "CC by"), (None, "x all rights RESERVED"),
        (None, None), (7, LONG), (8, "x" * 100_000), (9, "\u212a all  rights, reserved\x1c\x85b é\U0001F600 ▁ <|endoftext|> </s>"), (10, "cc by cc by")]
CLASHES = ("words", "n_words", "Item", "SCORE", "rank", "doc", "pairs", "spans", "k", "template")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").select("*", *[F.lit("extra").alias(c) for c in CLASHES])


@pytest.mark.parametrize("name", ["op11_license_scan", "op12_ranked_search"])
def test_matches_sql(spark, sf_dir, name):
    con = connect(sf_dir)
    assert differences(queries.QUERIES[name](spark, sf_dir), con, oracle.ORACLE[name]) == []


def test_licenses_against_brute_force(spark, sf_dir):
    phrases = [LETTERS.findall(low(t.text)) for t in licenses.BASE]
    found = result(spark, sf_dir, "op11_license_scan", "doc_id")
    for d in table(sf_dir, "documents"):
        words = LETTERS.findall(low(d["text"]))
        places = [(i, t.label) for t, p in zip(licenses.BASE, phrases) for i in range(len(words)) if words[i: i + len(p)] == p]
        r = found[d["doc_id"]]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted({p for _, p in places})))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))


@pytest.mark.parametrize("broadcast_words", [0, 10**6])
def test_license_cases(docs, broadcast_words):
    rows = licenses.labelled(docs, broadcast_words=broadcast_words).collect()
    assert len(rows) == len(ROWS)
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert got[2, 4, 0, None, None, ""] == 2 and got[3, 0, 0, None, None, ""] == got[4, 0, 0, None, None, ""] == 1
    assert got[6, 2, 1, 0, 0, "cc-by"] == got[None, 4, 1, 1, 1, "reserved"] == got[10, 4, 2, 0, 2, "cc-by"] == 1
    assert got[9, 9, 1, 1, 1, "reserved"] == 1, "other letters are not lower-cased to A-Z"
    assert licenses.labelled(docs.limit(0)).count() == 0
    assert licenses.scan(docs, []).where("size(spans) > 0").count() == 0
    assert licenses.scan(docs, [Template("none", "none", "!")]).where("size(spans) > 0").count() == 0


def test_damaged_licenses_are_found_on_neighbouring_diagonals(spark):
    random.seed(5)
    text = next(t.text for t in licenses.NOTICES if t.name == "mit text").split()
    noise = [f"n{random.randrange(300)}" for _ in range(400)]
    dropped = [w for i, w in enumerate(text) if i % 17 != 5]
    added = [x for i, w in enumerate(text) for x in ([w, "extra"] if i % 19 == 3 else [w])]
    half = text[: len(text) // 4]
    shuffled = random.sample(text, len(text))
    cases = [text, dropped, added, half, shuffled, noise, text + noise + text]
    rows = [(i, " ".join(noise[:100] + c + noise[100:200])) for i, c in enumerate(cases)]
    found = {r.doc_id: r.spans for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    whole = lambda i: [s for s in found[i] if s.template == "mit text"]
    assert [len(whole(i)) for i in range(7)] == [1, 1, 1, 0, 0, 0, 2]
    assert whole(0)[0].coverage == 1.0 and (whole(0)[0].start, whole(0)[0].stop) == (100, 100 + len(LETTERS.findall(low(" ".join(text)))))
    assert 0.5 <= whole(1)[0].coverage < 1 and whole(1)[0].start == 100


def brute_search(rows, items, top):
    held = [(i, collections.Counter(LETTERS.findall(low(t)))) for i, t in rows]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, all_terms = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // all_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in LETTERS.findall(low(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block": 3, "bundle": 2}, {"sent_terms": 120}, {"owners": ()}, {"owners": (0.01, 0.02, 0.05, 0.1, 0.5), "top": 3}])
def test_search_paths(spark, sf_dir, options):
    rows = [(d["doc_id"], d["text"]) for d in table(sf_dir, "documents")]
    items = [(d["item_id"], d["text"]) for d in table(sf_dir, "benchmark")]
    if options.get("block") or "sent_terms" in options:
        rows, items = rows[:60], items[:9]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = search.ranked(frame, spark.createDataFrame(items, "item_id long, text string"), **options)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_search(rows, items, options.get("top", 10))


def test_search_cases(spark, docs):
    items = [("q1", "a b w7"), ("q1", "a b w7"), ("q2", None), ("q3", ""), ("q4", "unheard"), (None, "CC BY b"), ("q5", "a a d")]
    bench = spark.createDataFrame(items, "item_id string, text string").withColumn("term", F.lit("extra"))
    got = sorted((tuple(r) for r in search.ranked(docs, bench, top=3).collect()), key=repr)
    assert got == brute_search(ROWS, sorted(set(items), key=repr), 3)
    assert search.ranked(docs.limit(0), bench).count() == search.ranked(docs, bench.limit(0)).count() == 0


def brute_alignment(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    table_ = alignment._byte_level()
    out, held = [], []
    for i, text in rows:
        raw = f" {text or ''}".encode()
        first, second = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        parts = [bytes(table_[c] for c in a.id_to_token(x)) for x in first]
        pieces = [b.id_to_piece(x) for x in second]
        others = [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(second, pieces)]
        if not text or b"".join(parts) != raw or b"".join(others) != raw:
            out.append([i, 0, 0, 0, 0, ""])
            held.append([])
            continue
        groups, left, right, x, y, s, t = [], [], [], 0, 0, 0, 0
        while x < len(parts) or y < len(others):
            if s <= t and x < len(parts):
                left.append(first[x])
                s += len(parts[x])
                x += 1
            else:
                right.append(second[y])
                t += len(others[y])
                y += 1
            if s == t:
                groups.append((left, right))
                left, right = [], []
        links = [(p, q) for g in groups for p in g[0] for q in g[1]]
        text_ = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append([i, len(first), len(second), len(groups), len(links), hashlib.sha256(text_.encode()).hexdigest()])
        held.append(links)
    n = collections.Counter(p for links in held for p in set(links))
    highest = collections.defaultdict(int)
    for (p, _), c in n.items():
        highest[p] = max(highest[p], c)
    return sorted(((*r[:5], sum(n[p] == highest[p[0]] for p in links), sum(n[p] for p in links), r[5]) for r, links in zip(out, held)), key=repr)


def paths():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return [str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def test_alignment_against_brute_force(spark, sf_dir):
    rows = [(d["doc_id"], d["text"]) for d in table(sf_dir, "documents")]
    got = sorted((tuple(r) for r in queries.op13_token_alignment(spark, sf_dir).collect()), key=repr)
    assert got == brute_alignment(rows)


@pytest.mark.parametrize("sent_pairs", [0, 40, alignment.SENT_PAIRS])
def test_alignment_cases(docs, sent_pairs):
    rows = alignment.aligned(docs, *paths())
    got = sorted((tuple(r) for r in alignment.digests(rows, sent_pairs=sent_pairs).collect()), key=repr)
    assert got == brute_alignment(ROWS)
    assert alignment.digests(alignment.aligned(docs.limit(0), *paths())).count() == 0


def test_pieces_add_up_to_whole_texts(monkeypatch):
    random.seed(3)
    marks = [" ", "  ", "\n", " \n", "\t", "a", "é", "don't", ".", "12", "　", "\x1c", "\x85", "▁", "<s>", "<|endoftext|>", "\U0001F600", "\n\n"]
    rows = [(i, "".join(random.choice(marks) for _ in range(random.randrange(40)))) for i in range(300)]
    monkeypatch.setattr(alignment, "KEPT_PIECES", 5)
    monkeypatch.setattr(alignment, "KEPT_CHARS", 2)
    files = paths()
    aligner = alignment.Aligner(open(files[0], encoding="utf-8").read(), open(files[1], "rb").read())
    wanted = {r[0]: r for r in brute_alignment(rows)}
    for i, text in rows:
        sums, digests, *_ = aligner.columns([text])
        aligner.trim()
        assert (i, *[x[0] for x in sums], digests[0]) == (*wanted[i][:5], wanted[i][7])


def test_align_cuts_at_every_shared_end():
    for seed in range(200):
        rng = random.Random(seed)
        n = rng.randrange(1, 60)
        a, b = (sorted({n, *rng.sample(range(1, n + 1), rng.randrange(1, n + 1))}) for _ in range(2))
        shared = sorted(set(a) & set(b))
        groups = alignment.align(a, b)
        assert [a[j - 1] for _, j, _, _ in groups] == [b[m - 1] for *_, m in groups] == shared
        assert [g[0] for g in groups] == [0, *[g[1] for g in groups[:-1]]] and groups[-1][1] == len(a)
