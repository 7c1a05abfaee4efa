"""Fill-in-middle: every byte of a batch gets its shift from summed differences, and is scattered there."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import task

# The marks before prefix, suffix and middle, and in which order a form has the parts.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
WIDTH = 3
PARTS = ("prefix", "middle", "suffix")  # as they stand in the text
#: Bytes of the texts that are moved at once; a longer text is moved alone.
BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def marks_in(data: np.ndarray) -> np.ndarray:
    """Where one of the marks begins."""
    if len(data) < WIDTH:
        return np.empty(0, dtype=np.int64)
    middle = np.isin(data[1:-1], [m[1] for m in MARKS.values()])
    return np.flatnonzero((data[:-2] == ord("<")) & middle & (data[2:] == ord(">")))


def unit_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the units of all texts in one run, and how many of them lie before each text.

    A unit is a word with the blanks before it; blanks at the end of a text are one unit more.
    """
    last = np.zeros(len(data), dtype=bool)
    last[ends[ends > starts] - 1] = True
    blank = _BLANK[data]
    over = np.append(blank[1:], True) & ~blank
    found = np.flatnonzero(over | last) + 1
    return found, np.searchsorted(found, starts, side="right")


def shifts(size: int, starts: np.ndarray, cuts: dict[str, np.ndarray], places: dict[str, np.ndarray]) -> np.ndarray:
    """For each byte of the texts how far it moves.

    ``cuts`` has the place at which each part begins, ``places`` where it goes. A part's start takes the
    difference to the part before it; the running sum is the shift.
    """
    steps = np.zeros(size + 1, dtype=np.int64)
    before = 0
    for name in PARTS:
        shift = places[name] - cuts[name]
        np.add.at(steps, cuts[name], shift - before)
        before = shift
    np.add.at(steps, np.append(starts[1:], size), -before)
    return np.cumsum(steps[:-1])


def _places(form: np.ndarray, begins: np.ndarray, sizes: dict[str, np.ndarray]) -> tuple[dict, dict]:
    """Where parts and marks of each output go; a plain text's parts follow each other without marks."""
    at, marks = {p: np.zeros(len(form), dtype=np.int64) for p in PARTS}, {p: np.zeros(len(form), dtype=np.int64) for p in PARTS}
    for name, order in (("plain", PARTS), *ORDER.items()):
        own, width = form == name, 0 if name == "plain" else WIDTH
        place = begins[own]
        for part in order:
            marks[part][own], at[part][own] = place, place + width
            place = place + width + sizes[part][own]
    return at, marks


def transform(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, draws: np.ndarray, rate: int, spm: int) -> tuple:
    """Outputs of texts that lie one behind the other: bytes, ends, forms, units, and parts' sizes in characters.

    ``draws`` holds four numbers a text: two cuts, whether it is cut at all, and the order.
    """
    found, first = unit_ends(data, starts, ends)
    n = np.append(first[1:], len(found)) - first
    cut = np.sort(draws[:, :2] % (n[:, None] + 1), axis=1)
    fenced = np.append(0, found)
    cuts = [np.where(c > 0, fenced[np.minimum(first + c, len(found))], starts) for c in (cut[:, 0], cut[:, 1])]
    marked = np.searchsorted(marks_at := marks_in(data), starts)
    # A mark over the border of two texts is in neither.
    inside = marks_at + WIDTH <= ends[np.searchsorted(starts, marks_at, side="right") - 1] if len(marks_at) else np.empty(0, dtype=bool)
    held = np.append(0, np.cumsum(inside))
    holds = held[np.searchsorted(marks_at, ends)] > held[marked]
    plain = (ends == starts) | holds | (draws[:, 2] % 100 >= rate)
    form = np.where(plain, "plain", np.where(draws[:, 3] % 100 < spm, "spm", "psm"))
    begins = {"prefix": starts, "middle": cuts[0], "suffix": cuts[1]}
    sizes = {"prefix": cuts[0] - starts, "middle": cuts[1] - cuts[0], "suffix": ends - cuts[1]}
    out_ends = np.cumsum(ends - starts + np.where(plain, 0, 3 * WIDTH))
    at, marks = _places(form, np.append(0, out_ends[:-1]), sizes)
    moved = np.arange(len(data)) + shifts(len(data), starts, begins, at)
    out = np.empty(out_ends[-1] if len(out_ends) else 0, dtype=np.uint8)
    out[moved] = data
    for part, mark in MARKS.items():
        for i, byte in enumerate(mark):
            out[marks[part][~plain] + i] = byte
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    return out, out_ends, form, n, chars[cuts[0]] - chars[starts], chars[cuts[1]] - chars[cuts[0]]


def restore(out: np.ndarray, starts: np.ndarray, ends: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs that lie one behind the other, from bytes and forms alone, and their ends."""
    marked = form != "plain"
    places = marks_in(out)
    text = np.searchsorted(starts, places, side="right") - 1
    own = marked[text] & (places + WIDTH <= ends[text])
    if not (np.bincount(text[own], minlength=len(starts))[marked] == len(MARKS)).all():
        raise ValueError("an output without its three marks")
    places = places[own].reshape(-1, len(MARKS))
    begins = {p: starts.copy() for p in PARTS}  # of a plain output all is suffix
    stops = {"prefix": starts.copy(), "middle": starts.copy(), "suffix": ends.copy()}
    for name, order in ORDER.items():
        own = form == name
        at = places[(form == name)[marked]]
        edges = np.column_stack([at, ends[own]])
        for i, part in enumerate(order):
            begins[part][own], stops[part][own] = edges[:, i] + WIDTH, edges[:, i + 1]
    sizes = {p: stops[p] - begins[p] for p in PARTS}
    text_ends = np.cumsum(sum(sizes.values()))
    text_starts = np.append(0, text_ends[:-1])
    cuts = {"prefix": text_starts, "middle": text_starts + sizes["prefix"], "suffix": text_starts + sizes["prefix"] + sizes["middle"]}
    size = int(text_ends[-1]) if len(text_ends) else 0
    return out[np.arange(size) + shifts(size, text_starts, cuts, begins)], text_ends


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    return np.frombuffer(b"".join(texts), dtype=np.uint8), np.append(0, ends[:-1]).astype(np.int64), ends


def _apart(data: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[b:e].decode() for b, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _some(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of a batch's texts, of ``BYTES`` or one text."""
    begin, held, size = 0, [], 0
    for i, text in enumerate(texts):
        own = (text or "").encode()
        if held and size + len(own) > BYTES:
            yield begin, held
            begin, held, size = i, [], 0
        held.append(own)
        size += len(own)
    if held:
        yield begin, held


def _forward(rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in _some(batch["text"].to_pylist()):
                rows = batch.slice(begin, len(texts))
                draws = np.array([[int(d[i : i + 8], 16) for i in (0, 8, 16, 24)] for d in rows["draws"].to_pylist()], dtype=np.int64)
                out, ends, form, n, prefix, middle = transform(*_joined(texts), draws, rate, spm)
                plain = form == "plain"
                columns = [pa.array(n), pa.array(form.tolist()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain), pa.array(_apart(out, ends))]
                yield pa.record_batch([rows["doc_id"], *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return run


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, texts in _some(batch["output"].to_pylist()):
            rows = batch.slice(begin, len(texts))
            data, ends = restore(*_joined(texts), np.array(rows["form"].to_pylist()))
            yield rows.append_column("restored", pa.array(_apart(data, ends), pa.string()))


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    A text is cut into ``n`` units: words with the ASCII blanks before them, and the blanks at its end.
    Four numbers from the SHA-256 of ``seed:doc_id`` draw two cuts between units, whether the text is
    cut (``rate`` percent) and in which order it is written: ``spm`` percent have the suffix first. A text
    that is empty or holds a mark stays ``plain``.

    A null text is empty; a null id draws as if it were empty text; rows that repeat an id draw alike.
    Sizes in characters are null for plain texts. Other columns are ignored; an empty table gives no
    row. No row needs another: nothing is shuffled, and a task moves ``BYTES`` of texts at a time, or one
    text.
    """
    draws = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    kind = f"doc_id {dict(docs.dtypes)['doc_id']}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text", draws.alias("draws")).mapInArrow(task(_forward(rate, spm)), kind)


def restored(outputs: DataFrame) -> DataFrame:
    """Adds ``restored``, the text, to rows of :func:`fill_in_middle`; from ``output`` and ``form`` alone."""
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return outputs.mapInArrow(task(_back), f"{kind}, restored string")
