"""Token counts of whole texts with a public tokenizer, without keeping any token."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import texts

#: A space or line end between two other characters: byte-level pre-tokenizers always begin a new piece there.
BOUNDARY = r"(?<=\S)(?=[ \n]\S)"
#: Distinct pieces whose counts a task remembers, and the longest of them in characters.
KEPT_PIECES, KEPT_CHARS = 400_000, 64


def _byte_batches(pieces: Iterable[str], size: int) -> Iterator[list[str]]:
    held, n = [], 0
    for piece in pieces:
        held.append(piece)
        n += len(piece)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _chunks(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `size` characters, at least one text each."""
    begin, n = 0, 0
    for i, text in enumerate(texts):
        n += len(text)
        if n >= size:
            yield begin, i + 1
            begin, n = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def token_counts(docs: DataFrame, tokenizer_json: str, limit: int = 512, batch_bytes: int = 1 << 18,
                 chunk_chars: int = 1 << 20, boundary: str = BOUNDARY) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text.

    `tokenizer_json` is the path of a tokenizer file, read once on the driver and
    sent along (a vocabulary, whose size does not depend on the data). Texts are
    cut where the tokenizer begins a new piece anyway, so the counts of the
    pieces add up to the whole text's. Each distinct piece is encoded once as
    long as a task remembers it, in batches of about `batch_bytes`, whatever the
    rows' lengths. Special strings inside texts are treated as the library does
    by default; nothing is added, padded or truncated. Cases: null and empty
    texts have 0 bytes and 0 tokens; a long text without a boundary is encoded
    whole; repeated rows and null ids keep their rows; extra columns are not
    read; an empty table gives an empty result.
    """
    with open(tokenizer_json, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer, cut, known = Tokenizer.from_str(sent.value), re.compile(boundary), {}
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for batch in batches:
            offsets, _ = texts(batch.column(1))
            whole, counts = [t or "" for t in batch.column(1).to_pylist()], np.zeros(len(batch), np.int64)
            for begin, end in _chunks(whole, chunk_chars):
                split = [cut.split(t) if t else [] for t in whole[begin:end]]
                new = (p for p in dict.fromkeys(chain.from_iterable(split)) if p not in known)
                for group in _byte_batches(list(new), batch_bytes):
                    encoded = tokenizer.encode_batch_fast(group, add_special_tokens=False)
                    known.update(zip(group, map(len, encoded)))
                counts[begin:end] = [sum(map(known.__getitem__, pieces)) for pieces in split]
                if len(known) > KEPT_PIECES:
                    known.clear()
                for piece in [p for pieces in split for p in pieces if len(p) > KEPT_CHARS]:
                    known.pop(piece, None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
