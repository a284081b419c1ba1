"""Chat formatting by event-sourced reconstruction.

A log has events of conversations: conv_id, message (its number in the conversation), rank (among messages of one
number; a log without the column has 0), seq (order of events), kind, role and text. A message is known by (conv_id,
message, rank), and its number may be null, which comes first. ``start`` opens a message (role, first text), ``delta`` appends text, ``edit`` replaces the whole text,
``regenerate`` empties the message so that later deltas build it anew, ``delete`` takes it away until a later start.
Events of one message are folded in order of seq (ties: kind, then text); a message that no start has opened has role
"assistant"; null roles and texts are empty, events with a null conversation, seq or kind are dropped, or with a null message in a log
without ranks; unknown kinds are ignored.

Format of a message: ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles ``<|``, ``<\\|``, ... get one more
backslash after ``<``, so that no control string can stand in them; in roles a backslash and a line break are written as
``\\\\`` and ``\\n``. The formatted output of a conversation is the concatenation of its messages in order, one row each,
with the character range of the loss mask (the assistant's text), so a long conversation never meets in one row.

Both steps stream sorted partitions: events are dealt by (conversation, message, rank), so a long conversation's messages are
folded by many tasks; only the digest of ``read_back``, sequential by nature, passes a conversation's rows through one
task, a row at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
MESSAGES = "conv_id bigint, message bigint, rank bigint, formatted string, loss_start bigint, loss_end bigint"
DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int | None, int | None]:
    """The formatted message and the range of its loss mask."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    loss = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
    return f"{head}{body}{END}\n", *loss


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted message."""
    if not formatted.startswith(START) or not formatted.endswith(END + "\n"):
        raise ValueError("not a formatted message")
    role, _, body = formatted[len(START) : -len(END) - 1].partition("\n")
    return unescape_role(role), unescape(body)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


class _Message:
    def __init__(self, key: tuple):
        self.key, self.role, self.parts, self.open = key, "assistant", [], False

    def fold(self, kind: str, role: str | None, text: str | None) -> None:
        if kind == "start":
            self.role, self.parts, self.open = role or "", [text or ""], True
        elif kind == "delta":
            self.parts.append(text or "")
            self.open = True
        elif kind == "edit":
            self.parts, self.open = [text or ""], True
        elif kind == "regenerate":
            self.parts = []
        elif kind == "delete":
            self.parts, self.open = [], False

    def row(self) -> tuple:
        return (*self.key, *render(self.role, "".join(self.parts)))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Message | None = None
    for batch in batches:
        out = []
        for conv, message, rank, kind, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if now is None or now.key != (conv, message, rank):
                if now is not None and now.open:
                    out.append(now.row())
                now = _Message((conv, message, rank))
            now.fold(kind, role, text)
        yield _batch(out, MESSAGES)
    if now is not None and now.open:
        yield _batch([now.row()], MESSAGES)


def format_log(events: DataFrame) -> DataFrame:
    """Formatted messages of a log: conv_id, message, rank, formatted, loss_start, loss_end (offsets in ``formatted``)."""
    ranked = "rank" in events.columns
    log = events.select(
        F.col("conv_id").cast("bigint"), F.col("message").cast("bigint"), (F.col("rank") if ranked else F.lit(0)).cast("bigint").alias("rank"),
        F.col("seq").cast("bigint"), F.col("kind").cast("string"), F.col("role").cast("string"), F.col("text").cast("string"),
    ).dropna(subset=["seq", "kind", "rank"] if ranked else ["conv_id", "message", "seq", "kind"])
    dealt = log.repartition("conv_id", "message", "rank").sortWithinPartitions("conv_id", "message", "rank", "seq", "kind", "text", "role")
    return dealt.select("conv_id", "message", "rank", "kind", "role", "text").mapInArrow(_fold, MESSAGES)


class _Digest:
    def __init__(self, conv: int):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        role, text = parse(formatted)
        self.turns += 1
        self.chars += len(formatted)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if start is not None:
            masked = unescape(formatted[start:end])
            self.loss_chars += len(masked)
            self.loss.update(masked.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: _Digest | None = None
    for batch in batches:
        out = []
        for conv, formatted, start, end in zip(*[c.to_pylist() for c in batch.columns]):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.row())
                now = _Digest(conv)
            now.add(formatted, start, end)
        yield _batch(out, DIGESTS)
    if now is not None:
        yield _batch([now.row()], DIGESTS)


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked texts read from formatted messages, as digests of each conversation."""
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "message", "rank", "formatted")
    return dealt.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_read, DIGESTS)


def events_of(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) as a log: a start event for each, an assistant's text streamed as two deltas.

    Turns that repeat a number are messages of their own, ranked in order of role and text; null numbers come first.
    """
    rank = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) - 1
    turns = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("message", F.col("turn")).withColumn("rank", rank)
    half = F.floor(F.length("text") / 2).cast("int")
    whole = F.array(F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.col("role").alias("role"), F.col("text").alias("text")))
    streamed = F.array(
        F.struct(F.lit(0).alias("seq"), F.lit("start").alias("kind"), F.col("role").alias("role"), F.lit("").alias("text")),
        F.struct(F.lit(1).alias("seq"), F.lit("delta").alias("kind"), F.col("role").alias("role"), F.substring(F.col("text"), F.lit(1), half).alias("text")),
        F.struct(F.lit(2).alias("seq"), F.lit("delta").alias("kind"), F.col("role").alias("role"), F.substring(F.col("text"), half + 1, F.length("text")).alias("text")),
    )
    each = F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(whole))
    return turns.select("conv_id", "message", "rank", each.alias("e")).select("conv_id", "message", "rank", "e.*")
