"""Chat formatting with a grammar round trip: render, reparse, compare, escape until identical."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.common import parts, scratch_path, task

# The control strings, and how a turn of each role begins and ends. A blank or a line
# end stands before every closing mark, so no text's last character touches one.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<TURN ")
OPEN = {"user": "[INST] ", "system": "<<SYS>>\n", "assistant": "<s>"}
CLOSE = {"user": " [/INST]", "system": "\n<</SYS>>\n", "assistant": " </s>"}
OTHER = ("<<TURN {}>>\n", " </s>")
#: Characters of a stored part of a conversation, about; turns are never split.
PART = 1 << 20

_CONTROL = re.compile(r"(\\*)(" + "|".join(map(re.escape, CONTROLS)) + ")")
_OPENING = re.compile(r"\[INST\] |<<SYS>>\n|<s>|<<TURN ([^>]*)>>\n")
_KIND = {v: k for k, v in OPEN.items()}
_ESCAPED = re.compile(r"\\(\\*(?:" + "|".join(map(re.escape, CONTROLS)) + "))")


def escape(text: str) -> str:
    """One more backslash before every control string and the backslashes before it."""
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _render(role: str, body: str) -> tuple[str, int, int]:
    """A turn, and where its body begins and ends in it."""
    begin = OPEN[role] if role in OPEN else OTHER[0].format(quote(role, safe=""))
    end = CLOSE.get(role, OTHER[1])
    return begin + body + end, len(begin), len(begin) + len(body)


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """Turns as role, unescaped text and the body's place; None where the grammar doesn't hold.

    After a turn's opening the first control string without a backslash has to belong to its closing.
    """
    turns, at = [], 0
    while at < len(formatted):
        opening = _OPENING.match(formatted, at)
        if not opening:
            return None
        kind = _KIND.get(opening[0])
        close = CLOSE.get(kind, OTHER[1])
        mark = next((m for m in _CONTROL.finditer(formatted, opening.end()) if not m[1]), None)
        end = mark.start() - 1 if mark else -1
        if end < opening.end() or not formatted.startswith(close, end):
            return None
        turns.append((kind or unquote(opening[1]), unescape(formatted[opening.end() : end]), opening.end(), end))
        at = end + len(close)
    return turns


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered turns and the places of what assistants say.

    All texts are first rendered as they are. While the parser recovers something else, the texts
    that don't survive the trip by themselves, or else all that aren't escaped yet, are escaped.
    """
    bodies, escaped = [t for _, t in turns], [False] * len(turns)

    def trip(i: int) -> bool:
        whole, begin, end = _render(turns[i][0], bodies[i])
        return parse(whole) == [(*turns[i], begin, end)]

    while True:
        made, loss, at = [], [], 0
        for (role, _), body in zip(turns, bodies):
            whole, begin, end = _render(role, body)
            made.append(whole)
            if role == "assistant":
                loss.append((at + begin, at + end))
            at += len(whole)
        text = "".join(made)
        if [t[:2] for t in parse(text) or []] == turns:
            return text, loss
        wrong = [i for i in range(len(turns)) if not escaped[i] and not trip(i)] or [i for i in range(len(turns)) if not escaped[i]]
        if not wrong:
            raise ValueError("a turn doesn't survive its own escaping")
        for i in wrong:
            bodies[i], escaped[i] = escape(turns[i][1]), True


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations from sorted turns; a part is all that is held."""
    now: object = ...
    part, size, turns = 0, 0, []
    made: list[tuple] = []

    def close() -> None:
        text, loss = format_turns(turns)
        made.append((now, part, text, [{"begin": a, "end": b} for a, b in loss]))

    def packed() -> pa.RecordBatch:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        kinds = (pa.int64(), pa.int64(), pa.string(), span)
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["conv_id", "part", "formatted", "loss"])

    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if turns and (conv != now or size >= PART):
                close()
                part, size, turns = (part + 1 if conv == now else 0), 0, []
                if len(made) >= 1000 or size >= PART:
                    yield packed()
                    made = []
            elif not turns and conv != now:
                part = 0
            now = conv
            turns.append((role or "", text or ""))
            size += len(turns[-1][1])
    if turns:
        close()
    if made:
        yield packed()


def write_chats(turns: DataFrame, out: str) -> None:
    """Writes ``conv_id, part, formatted, loss`` (Parquet) below ``out``; loss: places of code points.

    Turns of a conversation are ordered by ``turn`` (null last), role and text; rows that repeat a
    turn are turns of their own. Null text and role are empty; rows without ``conv_id`` are one
    conversation. A conversation above ``PART`` characters goes on in further parts, so none is held
    whole. Other columns are ignored; an empty table writes nothing.
    """
    own = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        "text",
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text")]
    sorted_turns = own.repartition(parts(turns.sparkSession), "conv_id").sortWithinPartitions(*order)
    loss = "array<struct<begin:bigint,end:bigint>>"
    sorted_turns.select("conv_id", "role", "text").mapInArrow(
        task(_write), f"conv_id long, part long, formatted string, loss {loss}"
    ).write.parquet(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from sorted parts; only running hashes are held."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    now: object = ...
    state: list = []
    made: list[tuple] = []

    def close() -> None:
        n, whole, chars, masked, size = state
        made.append((now, n, whole.hexdigest(), chars, masked.hexdigest(), size))

    for batch in batches:
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            if conv != now or not state:
                if state:
                    close()
                now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            found = parse(formatted)
            if found is None:
                raise ValueError(f"conversation {conv} can't be read back")
            for role, text, *_ in found:
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            for span in loss:
                text = unescape(formatted[span["begin"] : span["end"]])
                state[2] += len(text)
                state[3].update(text.encode("utf-8", "surrogatepass"))
            state[4] += len(formatted)
        if len(made) >= 5000:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)
            made = []
    if state:
        close()
    if made:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)


def read_chats(spark: SparkSession, out: str) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` by parsing ``out``."""
    stored = spark.read.parquet(out).repartition(parts(spark), "conv_id").sortWithinPartitions("conv_id", "part")
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return stored.select("conv_id", "formatted", "loss").mapInArrow(task(_read), kinds)


def chat_round_trip(turns: DataFrame) -> DataFrame:
    """:func:`write_chats` to the shared folder, and what :func:`read_chats` reads back."""
    out = scratch_path(turns.sparkSession, "chats")
    write_chats(turns, out)
    return read_chats(turns.sparkSession, out)
