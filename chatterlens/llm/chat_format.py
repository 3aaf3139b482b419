"""Chat formatting: layouts are recognised by a hash of their nested field paths.

A record's or table's field paths (``messages[].role``) that any layout knows are sorted and hashed. The
fingerprint selects a declarative mapping, which turns the record into canonical turns (role, text). Adding a layout
means adding a ``Mapping``; a record whose fingerprint no mapping has comes back without turns and with its fingerprint.

Turns are formatted one segment each: ``<|turn|>`` role newline text ``<|end|>``; a conversation is its segments in order of
turn. Control strings inside roles and texts are escaped by a backslash after their first character (one more
where some are there already), so the markers cannot be forged and reading back is exact. The loss mask of a
segment is the span of an assistant's text.

Defined results: null texts and roles are empty; equal turn numbers are ordered by role, then text; repeated rows are repeated
turns; a null conversation id is a conversation of its own; null, malformed or empty records have no turns. Extra columns and
fields are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns.

    Either ``turns`` names an array whose items hold ``role`` and ``text``, or ``parts`` lists (role, fields) of a
    single exchange, the fields of a part joined by a blank line. ``optional`` fields may be absent.
    """

    name: str
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        if self.turns:
            return [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"]
        return [field for _, fields in self.parts for field in fields]


RECORDS = [
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("messages_text", turns="messages", role="role", text="text"),
    Mapping("conversations", turns="conversations", role="from", text="value"),
    Mapping("instruction", parts=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input")),
    Mapping("prompt_response", parts=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Mapping("prompt_completion", parts=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("question_answer", parts=(("user", ("context", "question")), ("assistant", ("answer",))), optional=("context",)),
]
#: Tables with one row per turn: (conversation, turn, role, text).
ROWS = [("conv_id", "turn", "role", "text"), ("conversation_id", "turn", "role", "content"), ("id", "position", "from", "value")]

ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths, vocabulary) -> str:
    """A hash of the known field paths; unknown ones do not count."""
    return hashlib.sha256("\n".join(sorted(set(paths) & set(vocabulary))).encode()).hexdigest()[:16]


def schema_paths(kind: T.DataType, prefix: str = "") -> Iterator[str]:
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from schema_paths(field.dataType, f"{prefix}.{field.name}" if prefix else field.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, prefix + "[]")
    else:
        yield prefix


def value_paths(value, prefix: str = "") -> Iterator[str]:
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from value_paths(inner, f"{prefix}.{key}" if prefix else key)
    elif isinstance(value, list):
        for inner in value:
            yield from value_paths(inner, prefix + "[]")
    else:
        yield prefix


RECORD_PATHS = {path for mapping in RECORDS for path in mapping.paths()}
ROW_PATHS = {path for layout in ROWS for path in layout}


def _known_records() -> dict[str, Mapping]:
    known = {}
    for mapping in RECORDS:
        for n in range(len(mapping.optional) + 1):
            for absent in itertools.combinations(mapping.optional, n):
                known.setdefault(fingerprint([p for p in mapping.paths() if p not in absent], RECORD_PATHS), mapping)
    return known


BY_RECORD = _known_records()
BY_ROWS = {fingerprint(layout, ROW_PATHS): layout for layout in ROWS}


def turns_of_rows(table: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` of a table with one row per turn, by its schema's fingerprint."""
    found = fingerprint(schema_paths(table.schema), ROW_PATHS)
    if found not in BY_ROWS:
        raise ValueError(f"no mapping for the layout {found}: {sorted(schema_paths(table.schema))}")
    names = BY_ROWS[found]
    conversation, turn, role, text = (F.col(f"`{name}`") for name in names)
    role = F.coalesce(role.cast("string"), F.lit(""))  # as given, so that it can be read back
    return table.select(
        conversation.cast("long").alias("conv_id"), turn.cast("long").alias("turn"), role.alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )


def turns_of_record(record) -> tuple[str, list[tuple[str, str]]]:
    """The fingerprint of one parsed record and its turns."""
    found = fingerprint(value_paths(record), RECORD_PATHS)
    mapping = BY_RECORD.get(found)
    if mapping is None or not isinstance(record, dict):
        return found, []
    def plain(value):
        return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    if mapping.turns:
        items = [item for item in record[mapping.turns] if isinstance(item, dict)]
        named = [(plain(item.get(mapping.role)), plain(item.get(mapping.text))) for item in items]
        return found, [(ROLES.get(role, role), text) for role, text in named]
    out = []
    for role, fields in mapping.parts:
        given = [plain(record[f]) for f in fields if f in record]
        if given and (role == "assistant" or any(given)):
            out.append((role, "\n\n".join(x for x in given if x)))
    return found, out


_TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


@F.arrow_udf(T.StructType([T.StructField("layout", T.StringType()), T.StructField("turns", T.ArrayType(_TURN))]))
def _turns(payload: pa.Array) -> pa.Array:
    layouts, turns = [], []
    for line in payload.to_pylist():
        try:
            layout, found = turns_of_record(json.loads(line)) if line else (None, [])
        except ValueError:
            layout, found = None, []
        layouts.append(layout)
        turns.append([{"role": role, "text": text} for role, text in found])
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    return pa.StructArray.from_arrays([pa.array(layouts, pa.string()), pa.array(turns, kind)], ["layout", "turns"])


def turns_of_records(records: DataFrame, id_column: str = "conv_id", payload: str = "payload") -> DataFrame:
    """``(conv_id, layout, turn, role, text)`` of JSON records; a record without turns gives one row with null turn."""
    found = records.select(F.col(id_column).cast("long").alias("conv_id"), _turns(payload).alias("found"))
    return found.select("conv_id", "found.layout", F.posexplode_outer("found.turns").alias("turn", "t")).select(
        "conv_id", "layout", F.col("turn").cast("long").alias("turn"), "t.role", "t.text"
    )


# Control strings by first character and rest; no rest holds a first character, so occurrences never overlap.
TURN, END, NEWLINE = "<|turn|>", "<|end|>", "<|nl|>"
_REST = r"(s>|/s>|SYS>>|/SYS>>|\|turn\|>|\|end\|>|\|nl\|>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|INST\]|/INST\])"
ESCAPE = r"([<\[])(\\*)" + _REST
UNESCAPE = r"([<\[])\\(\\*)" + _REST


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, r"$1$2\\$3")


def unescape(text: str) -> str:
    return re.sub(UNESCAPE, r"\1\2\3", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, segment, loss_start, loss_end)``; the mask in code points of the segment, null outside."""
    head = F.concat(F.lit(TURN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
    body = escaped(F.col("text"))
    spoken = F.col("role").isin("assistant", *[other for other, role in ROLES.items() if role == "assistant"])
    return turns.select(
        "conv_id", "turn", "role", "text", F.concat(head, body, F.lit(END)).alias("segment"),
        F.when(spoken, F.length(head).cast("long")).alias("loss_start"),
        F.when(spoken, (F.length(head) + F.length(body)).cast("long")).alias("loss_end"),
    )


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    role, _, text = segment.removeprefix(TURN).removesuffix(END).partition("\n")
    return unescape(role.replace(NEWLINE, "\n")), unescape(text)


class _Conversation:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start, end) -> None:
        role, text = read_segment(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        if not pd.isna(start):
            masked = unescape(segment[int(start): int(end)])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current = None
    for batch in batches:
        done = []
        for conv_id, segment, start, end in zip(*(c.to_pylist() for c in batch.columns)):
            if current is None or current.conv_id != conv_id:
                if current:
                    done.append(current.row())
                current = _Conversation(conv_id)
            current.add(segment, start, end)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _DIGEST.types)], schema=_DIGEST)
    if current:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(current.row(), _DIGEST.types)], schema=_DIGEST)


def read_back(segments: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted segments and masks alone.

    A digest is a chain over the conversation, so its segments pass through one task in order; they are sorted with
    spilling and streamed in bounded memory, never gathered, however long the conversation is.
    """
    # a number of partitions, so that adaptive execution keeps it
    n = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text"]
    rows = segments.repartition(n, "conv_id").sortWithinPartitions(*order)
    return rows.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(_stream, DIGEST)
