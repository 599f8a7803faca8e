"""Chat formatting that is proven by reading it back.

A turn is rendered as ``<|im_start|>`` role newline text ``<|im_end|>`` newline. A
deterministic parser reads the rendered turn; where it does not give back exactly the one
turn that went in, the conflicting part is escaped and the turn is rendered and read
again, until the two are identical. Only turns in conflict are escaped.

Grammar: ``turn = "<|im_start|>" role "\\n" body "<|im_end|>" "\\n"``; a conversation is its
turns in a row. In a body ``<``, n + 1 backslashes and ``|`` stand for ``<``, n backslashes
and ``|``, so an escaped body holds no control string at all. In a role ``%HH`` stands for
one character. The loop ends after one round of escapes, as those undo exactly.

A turn is rendered and checked by itself. A digest over a whole conversation has to see its
turns in order, so turns are dealt by conversation, sorted by Spark, and read as a stream
that keeps one hash state and no turns: a conversation of any length needs no more memory.

Defined results: a null text or role is empty; a null turn sorts first; equal turns are all
kept, ordered by role and text; rows with a null conversation id form one conversation; an
empty table gives the extra conversations alone; other columns are not read.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape_body(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape_body(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return re.sub("[%\n<]", lambda m: f"%{ord(m[0]):02X}", role)


def unescape_role(role: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), role)


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """The turns of a rendered string, or None where the grammar does not fit."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            return None
        line = rendered.find("\n", at)
        end = rendered.find(END, line)
        if line < 0 or end < 0 or not rendered.startswith("\n", end + len(END)):
            return None
        role, body = rendered[at + len(START) : line], rendered[line + 1 : end]
        if START in body or START in role or END in role:
            return None
        turns.append((unescape_role(role), unescape_body(body)))
        at = end + len(END) + 1
    return turns


def render(role: str, text: str) -> str:
    """One turn, escaped only as far as reading it back asks for."""
    body, name = text, role
    while parse(turn := f"{START}{name}\n{body}{END}\n") != [(role, text)]:
        if unescape_body(body) == text and START not in body and END not in body:
            name = escape_role(role)
        elif body == text:
            body = escape_body(text)
        else:
            raise ValueError(f"a turn does not survive its format: {turn!r}")
    return turn


def render_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered): every turn with its rendered form. The
    formatted conversation is its ``rendered`` values in order of (turn, role, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            rendered = pa.array([render(role, text) for role, text in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rendered], [*batch.schema.names, "rendered"])

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, rendered string")


class _Reader:
    """Digests of one conversation, from its rendered turns."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == LOSS_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(rendered: DataFrame) -> DataFrame:
    """One row per conversation, all of it parsed from the rendered turns: digests of its
    turns and of the text under the loss mask (the assistant's), and the sizes."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    types = [pa.string() if " string" in part else pa.int64() for part in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            done = []
            for conv_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if reader is None or reader.conv_id != conv_id:
                    if reader:
                        done.append(reader.row())
                    reader = _Reader(conv_id)
                reader.read(text)
            if done:
                yield _batch(done)
        if reader:
            yield _batch([reader.row()])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "rendered").mapInArrow(run, SCHEMA)
