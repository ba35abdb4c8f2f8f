"""Alignment of two tokenizers' tokens over the same text, by dividing at shared cuts."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import cut

#: Before a space or line end between two other characters, and before a mark after a letter, the byte-level tokenizer
#: begins a new token; so does the other where no entry of its vocabulary spans such a place (see UNSAFE).
SAFE = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[.,;:!?])")
UNSAFE = re.compile("[^▁]▁|\n.|.\n|[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]")
#: Distinct pieces that a task remembers, and the longest of them in characters.
KEPT_PIECES, KEPT_CHARS = 500_000, 64
#: Commonest id pairs whose counts are sent to every task (17 bytes each); the counts of all others are joined.
SENT_PAIRS = 500_000
#: Characters that are encoded and aligned together.
CHUNK = 1 << 20

_ALIGNED = ("doc long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
            "pairs array<bigint>, times array<int>")


def align(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """Groups (from, to in a, from, to in b) of two lists of ends of the same bytes, cut at every end they share.

    Looks for a shared end from the middle of a outwards, by bisection in b, and
    does the same on both sides of it; an interval without one is a group.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if j - i == 1 or m - k == 1:
            out.append((i, j, k, m))
            continue
        middle = (i + j) // 2
        for step in range(j - i + 1):
            at = middle + (step + 1) // 2 * (1 if step % 2 else -1)
            if not i <= at < j - 1:
                continue
            found = bisect_left(b, a[at], k, m)
            if found < m - 1 and b[found] == a[at]:
                todo += [(at + 1, j, found + 1, m), (i, at + 1, k, found + 1)]
                break
        else:
            out.append((i, j, k, m))
    return out


def _byte_level() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [x for x in range(256) if x not in set(plain)]
    return {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(other)}


class Aligner:
    """Encodes pieces with both tokenizers and aligns them; remembers short ones."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a_json), sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        table = _byte_level()
        entries = json.loads(a_json)["model"]["vocab"]
        self.a_bytes: list[bytes] = [b""] * (max([*entries.values(), self.a.get_vocab_size() - 1]) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(table[c] for c in entry) if all(c in table for c in entry) else entry.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.width = len(self.b_bytes)
        self.a_names, self.b_names = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(self.width)]
        pieces = [self.b.id_to_piece(i) for i in range(self.width)]
        # A line end is a token of its own, and so is the space that is put before it.
        self.apart = self.b.encode("\n")
        self.divisible = not any(UNSAFE.search(p) for p in pieces)
        self.forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def forget(self) -> None:
        """Start anew: a number for each piece, and by number the groups' text, sizes, and a run of distinct pairs."""
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        self.sizes = [array("q") for _ in range(5)]
        self.begins, self.pairs, self.times = array("q", [0]), array("q"), array("q")

    def _learn(self, piece: str, a: list[int], b: list[int]) -> None:
        """Tokens, groups, links, whether the bytes differ, the groups' text and the distinct pairs of one piece."""
        raw = piece.encode("utf-8", "surrogatepass")
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        text, links = [], []
        same = b"".join(a_parts) == raw and b"".join(b_parts) == raw
        if same:
            if len(a) == 1 or len(b) == 1:
                groups = [(0, len(a), 0, len(b))]
            else:
                groups = align([*accumulate(map(len, a_parts))], [*accumulate(map(len, b_parts))])
            a_names, b_names, width = self.a_names, self.b_names, self.width
            for i, j, k, m in groups:
                if j - i == 1 and m - k == 1:
                    text.append(f"{a_names[a[i]]}|{b_names[b[k]]}")
                    links.append(a[i] * width + b[k])
                else:
                    text.append(f"{','.join([a_names[x] for x in a[i:j]])}|{','.join([b_names[y] for y in b[k:m]])}")
                    links += [x * width + y for x in a[i:j] for y in b[k:m]]
        self.texts.append(";".join(text))
        own = (len(a), len(b), len(text), len(links), 0) if same else (0, 0, 0, 0, 1)
        for column, n in zip(self.sizes, own):
            column.append(n)
        distinct = set(links)
        if len(distinct) == len(links):
            self.pairs.extend(links)
            self.times.extend([1] * len(links))
        else:
            times = Counter(links)
            self.pairs.extend(times)
            self.times.extend(times.values())
        self.begins.append(len(self.pairs))

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; new ones are encoded together. Call :meth:`trim` between chunks."""
        known = self.known
        new = [p for p in dict.fromkeys(pieces) if p not in known]
        if new:
            # The second tokenizer puts a space before each text. It stands for the piece's own, or is kept apart by a
            # line end and both are taken off again.
            spaced = [p[0] == " " for p in new]
            firsts = self.a.encode_batch_fast(new, add_special_tokens=False)
            seconds = self.b.encode([p[1:] if own else "\n" + p for p, own in zip(new, spaced)], num_threads=1)
            for piece, own, first, second in zip(new, spaced, firsts, seconds):
                if not own:
                    second = second[len(self.apart):]
                known[piece] = len(self.texts)
                self._learn(piece, first.ids, second)
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def trim(self) -> None:
        """Forget all when there is much; else long pieces, whose numbers stay unused."""
        if len(self.known) > KEPT_PIECES or len(self.pairs) > 8 * KEPT_PIECES:
            self.forget()
            return
        for piece in self.long:
            self.texts[self.known.pop(piece)] = ""

    def columns(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links, the digests, and the ends, pairs and times of each text's distinct pairs."""
        split = [(SAFE.split(f" {t}") if self.divisible else [f" {t}"]) if t else [] for t in texts]
        flat = [p for pieces in split for p in pieces]
        numbers = self.numbers(flat)
        self.long = {p for p in flat if len(p) > KEPT_CHARS}
        ends = np.cumsum([0, *map(len, split)])
        sums = []
        for column in self.sizes:
            totals = np.append(0, np.cumsum(np.frombuffer(column, np.int64)[numbers] if len(numbers) else numbers))
            sums.append(totals[ends[1:]] - totals[ends[:-1]])
        whole = (sums[4] == 0) & (np.diff(ends) > 0)
        sums = [np.where(whole, x, 0) for x in sums[:4]]
        own, digests = numbers.tolist(), []
        for begin, end, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), whole.tolist()):
            text = ";".join([self.texts[k] for k in own[begin:end]]) if ok else None
            digests.append(hashlib.sha256(text.encode()).hexdigest() if ok else "")

        text_of = np.repeat(np.arange(len(texts)), np.diff(ends))
        kept = whole[text_of]
        both, repeats = np.unique((text_of[kept] << 32) | numbers[kept], return_counts=True)
        text_of, numbers = both >> 32, both & 0xFFFFFFFF
        begins = np.frombuffer(self.begins, np.int64)
        lengths = begins[numbers + 1] - begins[numbers]
        cells = np.arange(lengths.sum()) + np.repeat(begins[numbers] - np.append(0, np.cumsum(lengths))[:-1], lengths)
        pairs = np.frombuffer(self.pairs, np.int64)[cells] if len(cells) else cells
        times = np.frombuffer(self.times, np.int64)[cells] * np.repeat(repeats, lengths) if len(cells) else cells
        text_of = np.repeat(text_of, lengths)
        order = np.lexsort((pairs, text_of))
        text_of, pairs, times = text_of[order], pairs[order], times[order]
        first = np.flatnonzero((np.diff(text_of, prepend=-1) != 0) | (np.diff(pairs, prepend=-1) != 0))
        times = np.add.reduceat(times, first) if len(first) else times
        counted = np.append(0, np.cumsum(np.bincount(text_of[first], minlength=len(texts))))
        return sums, digests, counted, pairs[first], times


def aligned(docs: DataFrame, a_json: str, b_model: str) -> DataFrame:
    """doc, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times of every document, written to the shared folder.

    a_json is a byte-level vocabulary of `tokenizers`, b_model one of
    `sentencepiece`; both are read on the driver and sent along (vocabularies,
    whose size does not depend on the data). Texts are cut where both tokenizers
    begin a new token in any case; pieces are encoded and aligned by
    :func:`align`, short ones once per task as long as they are remembered, and
    added up. A pair is id of a times the size of b's vocabulary, plus id of b;
    `times` is how often it is linked in the document, and `doc` numbers the
    rows. Cases: texts that are null, empty, or not the same bytes again under
    both tokenizers have no tokens and an empty digest; repeated rows and null
    ids keep their rows; a long text without cuts is encoded whole; an empty
    table gives an empty result; extra columns are not read.
    """
    with open(a_json, encoding="utf-8") as f, open(b_model, "rb") as g:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner, n = Aligner(*sent.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, begin = batch.column(1).to_pylist(), 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size < CHUNK):
                    size += len(texts[end] or "")
                    end += 1
                sums, digests, ends, pairs, times = aligner.columns(texts[begin:end])
                aligner.trim()
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n, n + end - begin)), batch.column(0).slice(begin, end - begin),
                     *[pa.array(x) for x in sums], pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(ends, pa.array(pairs)), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))],
                    ["doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                n += end - begin
                begin = end

    return cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ALIGNED))


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (n is the highest of the pair's first id) of every linked pair."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            keys, back = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, back, np.concatenate([c for _, c in held]))
            return keys, n

        for batch in batches:
            column = batch.column(0)
            held.append(np.unique(column.flatten().to_numpy(zero_copy_only=False), return_counts=True))
            if len(held) > 8:
                held = [merged()]
                if len(held[0][0]) > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], ["pair", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], ["pair", "n"])

    counts = rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = cut(counts.withColumn("a", F.expr(f"pair div {width}")))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return cut(counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")))


def _common(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Pairs, counts and best marks of the commonest pairs, at most `most`, and the count from which on they are all of them."""
    sizes = counts.groupBy(F.floor(F.log2("n") * 8).cast("int").alias("size")).agg(
        F.count("*").alias("pairs"), F.min("n").alias("least")).orderBy(F.desc("size")).collect()
    least, total = 1 << 62, 0
    for row in sizes:
        total += row.pairs
        if total > most:
            break
        least = row.least
    table = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(table["pair"].to_numpy())
    return (*[table[c].to_numpy()[order] for c in ("pair", "n", "best")], least)


def digests(rows: DataFrame, width: int = 32_000, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of :func:`aligned`.

    n_best counts the links whose pair is in as many documents as the commonest
    pair of its first id, ties included; count_sum sums the pairs' counts over
    the links. The counts of the commonest pairs go to every task; the others are
    joined, and only those are shuffled.
    """
    counts = pair_counts(rows, width)
    *sent, least = _common(counts, sent_pairs)
    sent = rows.sparkSession.sparkContext.broadcast(tuple(sent))

    def run(batches):
        pairs, n, best = sent.value
        for batch in batches:
            name = batch.schema.get_field_index
            column = batch.column(name("pairs"))
            keys, times = column.flatten().to_numpy(zero_copy_only=False), batch.column(name("times")).flatten().to_numpy(zero_copy_only=False)
            lengths = np.diff(column.offsets.to_numpy())
            row = np.repeat(np.arange(len(batch)), lengths)
            at = np.searchsorted(pairs, keys)
            at[at == len(pairs)] = 0
            known = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
            sums = np.zeros((2, len(batch)), np.int64)
            if known.any():
                np.add.at(sums[0], row[known], times[known] * best[at[known]])
                np.add.at(sums[1], row[known], times[known] * n[at[known]])
            cuts = pa.array(np.append(0, np.cumsum(np.bincount(row[~known], minlength=len(batch)))), pa.int32())
            rare = pa.StructArray.from_arrays([pa.array(keys[~known]), pa.array(times[~known], pa.int32())], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(name(c)) for c in kept] + [pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(cuts, rare)],
                [*kept, "n_best", "count_sum", "rare"])

    kept = [c for c in rows.columns if c not in ("pairs", "times")]
    plain = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)
    part = cut(rows.mapInArrow(run, f"{plain}, n_best long, count_sum long, rare array<struct<pair:bigint,times:int>>"))
    rare = part.select("doc", F.inline("rare")).join(counts.where(F.col("n") < least), "pair").groupBy("doc").agg(
        F.sum(F.col("times") * F.col("best").cast("int")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return part.join(rare, "doc", "left").select(
        *[c for c in kept if c != "doc" and c != "groups_sha256"],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
