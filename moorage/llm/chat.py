"""Chat formatting: typed content parts flattened into one reversible text, with attachments and a loss mask.

A turn's content is a list of typed parts. A visitor walks them in order: text is escaped, any other part becomes a
numbered placeholder and a reference, and every part adds the tokens it will expand to.

Template: ``### role: content</turn>`` and a line break for each turn. In roles and texts a backslash is put before
each backslash and each control string, so that reading takes away one backslash before any character.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import tasks

OPEN, NAMED, CLOSE, SLOT = "### ", ": ", "</turn>", "<|"
_CONTROL = re.compile(r"\\|###|</turn>|<\|")
_ROLE = re.compile(r"\\|###|</turn>|<\||:")
_ESCAPED = re.compile(r"\\(.)", re.S)
_HEADER = re.compile(r"### ((?:\\.|[^\\:])*): ", re.S)
_BODY = re.compile(r"((?:\\.|(?!</turn>)[^\\])*+)</turn>\n", re.S)
_SLOT = re.compile(r"\\.|<\|(\w+):(\d+)\|>", re.S)

# Tokens that attachments expand to: an image by tiles of its pixels, audio by seconds, a document by pages.
TILE, TILE_TOKENS, AUDIO_TOKENS, PAGE_TOKENS = 512, 256, 25, 512

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
FORMATTED = (
    "conv_id long, position int, turn long, role string, formatted string, start long, loss_start int, loss_end int, "
    "n_tokens long, attachments array<struct<number:int,type:string,ref:string,n_tokens:long>>"
)


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of a conversation; numbers of attachments run through it."""

    def __init__(self, count: Callable[[str], int]):
        self.count, self.number = count, 0

    def visit(self, parts: list[dict]) -> tuple[str, int, list[dict]]:
        out, total, attachments = [], 0, []
        for part in parts:
            kind = part.get("type") or "text"
            text, tokens = getattr(self, f"visit_{kind}", self.visit_other)(part)
            if kind != "text":
                attachments.append({"number": self.number, "type": kind, "ref": part.get("ref") or "", "n_tokens": tokens})
                text = f"{SLOT}{re.sub(r'[^0-9A-Za-z_]', '_', kind)}:{self.number}|>"
                self.number += 1
            out.append(text)
            total += tokens
        return "".join(out), total, attachments

    def visit_text(self, part: dict) -> tuple[str, int]:
        text = part.get("text") or ""
        return escape(text), self.count(text)

    def visit_image(self, part: dict) -> tuple[str, int]:
        across, down = (-(-max(part.get(side) or 1, 1) // TILE) for side in ("width", "height"))
        return "", across * down * TILE_TOKENS

    def visit_audio(self, part: dict) -> tuple[str, int]:
        return "", int(-(-(part.get("seconds") or 0.0) * AUDIO_TOKENS // 1))

    def visit_document(self, part: dict) -> tuple[str, int]:
        return "", max(part.get("pages") or 1, 1) * PAGE_TOKENS

    def visit_other(self, part: dict) -> tuple[str, int]:
        return "", 1


def word_count(text: str) -> int:
    return len(text.split())


def text_parts(rows: DataFrame, text: str = "text") -> DataFrame:
    """Plain texts as one text part each; null becomes the empty text."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"),
        F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("int").alias("pages"),
    )
    return rows.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def format_chat(turns: DataFrame, count: Callable[[str], int] = word_count, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Each turn of ``turns`` (conv_id, turn, role, parts) as formatted text with its place in the conversation.

    The formatted conversation is its turns joined in ``position`` order; ``start`` is a turn's first code point
    there, and ``loss_start`` to ``loss_end`` are the trained code points inside the turn (equal if none). Turns are
    sorted by turn, then role and parts, so ties and repeated rows have one order; null turns come first, null roles
    are empty, null parts are none. A null ``conv_id`` is a conversation like any other. No conversation is held in
    memory: sorted rows stream through, with a counter kept from row to row.
    """
    columns = ["conv_id", "turn", "role", "parts"]
    ordered = (
        turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"), "parts")
        .repartition(tasks(turns), "conv_id")
        .sortWithinPartitions(*columns)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, position, start, flat = (), 0, 0, Flattener(count)
        schema = _arrow()
        for batch in batches:
            rows = []
            for conv, turn, role, parts in zip(*(batch.column(c).to_pylist() for c in columns)):
                if last != (conv,):
                    last, position, start, flat = (conv,), 0, 0, Flattener(count)
                body, tokens, attachments = flat.visit(parts or [])
                head = OPEN + escape(role, _ROLE) + NAMED
                whole = head + body + CLOSE + "\n"
                loss = (len(head), len(head) + len(body)) if role in trained else (0, 0)
                rows.append((conv, position, turn, role, whole, start, *loss, tokens, attachments))
                position, start = position + 1, start + len(whole)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

    return ordered.mapInArrow(run, FORMATTED)


def _arrow() -> pa.Schema:
    attachment = pa.struct([("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int64())])
    return pa.schema(
        [
            ("conv_id", pa.int64()), ("position", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
            ("start", pa.int64()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("n_tokens", pa.int64()),
            ("attachments", pa.list_(attachment)),
        ]
    )


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and contents of a formatted text, unescaped; placeholders stay as they are."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEADER.match(formatted, at)
        body = head and _BODY.match(formatted, head.end())
        if not body:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(head[1]), unescape(body[1])))
        at = body.end()
    return turns


def chat_digest(formatted: DataFrame) -> DataFrame:
    """One row a conversation, read back from formatted turns: counts and digests of turns and trained text."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = formatted.repartition(tasks(formatted), "conv_id").sortWithinPartitions("conv_id", "position")
    columns = ["conv_id", "formatted", "loss_start", "loss_end"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = schema.replace(" long", "").replace(" string", "").split(", ")
        last, state = (), None

        def closed(conv, turns, told, chars, loss, length):
            return (conv, turns, told.hexdigest(), chars, loss.hexdigest(), length)

        def table(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=names)

        for batch in batches:
            done = []
            for conv, text, a, b in zip(*(batch.column(c).to_pylist() for c in columns)):
                if last != (conv,):
                    if state:
                        done.append(closed(*state))
                    last, state = (conv,), [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in read_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{content}\n".encode())
                trained = unescape(text[a:b])
                state[3] += len(trained)
                state[4].update(trained.encode())
                state[5] += len(text)
            yield table(done)
        if state:
            yield table([closed(*state)])

    return ordered.select(*columns).mapInArrow(run, schema)
