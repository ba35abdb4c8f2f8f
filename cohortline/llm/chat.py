"""Chat formatting of typed content parts, with a template that can be read back.

A turn is `<|turn:ROLE|>` + content + `<|end|>` + newline. Control strings in texts
(`<|`, `<s>`, `</s>`, `[INST]`, `[/INST]`) get a `~` after their first character,
and those that have some already get one more, so that taking one away restores
any text. Attachments stand as `<|image:N|>` and so on, N counting from 0 in the turn.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

PART = "struct<type:string,text:string,ref:string,units:bigint>"
_ESCAPE = re.compile(r"(<|\[)(~*)(?=\||/?s>|/?INST\])")
_UNESCAPE = re.compile(r"(<|\[)~(~*)(?=\||/?s>|/?INST\])")
_TURN = re.compile(r"<\|turn:([^|]*)\|>(.*?)<\|end\|>\n", re.S)
_PLACE = re.compile(r"<\|(?:image|audio|document|other):\d+\|>")
_OPEN = "<|turn:"

SEGMENT = ("segment string, loss_start long, loss_end long, tokens long, "
           "attachments array<struct<kind:string,ref:string,place:long,tokens:long>>")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1~\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def _role(role: str) -> str:
    return role.replace("%", "%25").replace("|", "%7C").replace("<", "%3C")


def _unrole(role: str) -> str:
    return role.replace("%3C", "<").replace("%7C", "|").replace("%25", "%")


class Flattener:
    """Visits a turn's parts in order: texts are escaped, attachments become numbered placeholders.

    `per_unit` gives what one unit of an attachment (image tile, audio second,
    document page) expands to in tokens; an unknown kind counts as `other`.
    """

    def __init__(self, per_unit: dict[str, int]):
        self.per_unit, self.out, self.attachments, self.tokens = per_unit, [], [], 0

    def visit(self, part: dict) -> None:
        kind = (part["type"] or "text").lower()
        if kind == "text":
            self.visit_text(part)
        else:
            self.visit_attachment(kind if kind in self.per_unit else "other", part)

    def visit_text(self, part: dict) -> None:
        self.out.append(escape(part["text"] or ""))

    def visit_attachment(self, kind: str, part: dict) -> None:
        tokens = self.per_unit.get(kind, 0) * (1 if part["units"] is None else part["units"])
        self.attachments.append({"kind": kind, "ref": part["ref"], "place": len(self.attachments), "tokens": tokens})
        self.out.append(f"<|{kind}:{len(self.attachments) - 1}|>")
        self.tokens += tokens


def text_part(text: Column) -> Column:
    """A plain text as the one part of its turn."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), null.cast("string").alias("ref"),
                            null.cast("long").alias("units")))


def format_turns(turns: DataFrame, per_unit: dict[str, int] | None = None) -> DataFrame:
    """conv_id, turn, role and the formatted turn of each row of conv_id, turn, role, parts.

    The formatted conversation is its segments in order of turn. loss_start and
    loss_end mark the assistant's content in the segment (null for other roles);
    attachments list kind, reference, place and expanded tokens in order; tokens
    is their sum. Rows are formatted one by one, so a conversation of any length
    takes no more memory than a turn. Cases: null text is empty; null parts are
    no content; a null role is the empty role; unknown kinds are `other`.
    """
    per_unit = per_unit or {"image": 256, "audio": 25, "document": 512}

    def run(batches):
        for batch in batches:
            rows = []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                visitor = Flattener(per_unit)
                for part in parts or ():
                    if part is not None:
                        visitor.visit(part)
                head, body = f"{_OPEN}{_role(role or '')}|>", "".join(visitor.out)
                lossy = role == "assistant"
                rows.append((head + body + "<|end|>\n", len(head) if lossy else None,
                             len(head) + len(body) if lossy else None, visitor.tokens, visitor.attachments))
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("place", pa.int64()), ("tokens", pa.int64())]))
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), *[pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]],
                ["conv_id", "turn", "role", "segment", "loss_start", "loss_end", "tokens", "attachments"])

    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", F.col("parts").cast(f"array<{PART}>")
                        ).mapInArrow(run, f"conv_id long, turn long, role string, {SEGMENT}")


def parse(segment: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in formatted text, read back; placeholders stay as they are."""
    return [(_unrole(m[1]), "".join(
        unescape(t) if i % 2 == 0 else t for i, t in enumerate(re.split(f"({_PLACE.pattern})", m[2]))))
        for m in _TURN.finditer(segment)]


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        for role, text in parse(segment):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        if start is not None:
            text = unescape(segment[start:end])
            self.loss.update(text.encode())
            self.loss_chars += len(text)
        self.chars += len(segment)


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted turns: counts and SHA-256 of its turns and of its loss text.

    Turns of a conversation are sorted to one task and pass through running
    digests, one row at a time; no conversation is held in memory. Equal
    (conv_id, turn) rows are ordered by their segments. Null conv_ids are one
    conversation, null turns come first.
    """
    def run(batches):
        now, key, begun = _Digest(), None, False

        def row():
            return (key, now.n, now.turns.hexdigest(), now.loss_chars, now.loss.hexdigest(), now.chars)

        for batch in batches:
            done = []
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if begun and conv != key:
                    done.append(row())
                    now = _Digest()
                key, begun = conv, True
                now.add(segment, start, end)
            if done:
                yield table(done)
        if begun:
            yield table([row()])

    def table(rows):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    return (segments.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "segment")
            .select("conv_id", "segment", "loss_start", "loss_end")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                             "formatted_chars long"))
