"""Language ID: script ranges narrow the candidates, Viterbi over word scores labels the spans."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import task
from lakestar.llm.shingles import U, mix

#: Labelled documents per language that the model is fitted on, about: those of lowest hash.
SAMPLE = 2_000
#: More distinct languages than this stop the job.
LANGUAGES = 256
#: Slots of the hashed model per language.
SLOTS = 1 << 16
#: Log probability that a change of language between words costs.
SWITCH = 8.0
#: Log probability added for a word in a script that a language was never seen in.
FOREIGN = -20.0
#: Code points worked on at once.
STEP = 1 << 19
UNKNOWN = "und"

# First code points of script ranges, and a number per script; 0 is for all others.
SCRIPTS = (
    (0x0041, 1, "Latin"), (0x0370, 2, "Greek"), (0x0400, 3, "Cyrillic"), (0x0530, 4, "Armenian"),
    (0x0590, 5, "Hebrew"), (0x0600, 6, "Arabic"), (0x0700, 0, "other"), (0x0900, 7, "Devanagari"),
    (0x0980, 8, "Indic"), (0x0E00, 9, "Thai"), (0x0E80, 0, "other"), (0x10A0, 10, "Georgian"),
    (0x1100, 11, "Hangul"), (0x1200, 0, "other"), (0x1E00, 1, "Latin"), (0x1F00, 2, "Greek"),
    (0x2000, 0, "other"), (0x3040, 12, "Kana"), (0x3100, 0, "other"), (0x3400, 13, "Han"),
    (0xA000, 0, "other"), (0xAC00, 11, "Hangul"), (0xD7B0, 0, "other"), (0xF900, 13, "Han"),
    (0xFB00, 1, "Latin"), (0xFB1D, 5, "Hebrew"), (0xFB50, 6, "Arabic"), (0xFF00, 0, "other"),
    (0x20000, 13, "Han"), (0x32000, 0, "other"),
)
KINDS = 14


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its lower case, or 0 where it is no letter; and its script."""
    points = range(0x110000)
    lower = np.zeros(len(points), dtype=np.uint32)
    for c in points:
        if chr(c).isalpha():
            small = chr(c).lower()
            lower[c] = ord(small) if len(small) == 1 else c
        elif unicodedata.category(chr(c)) == "Mn":
            lower[c] = c
    begins = np.array([s[0] for s in SCRIPTS])
    kinds = np.array([0, *(s[1] for s in SCRIPTS)], dtype=np.uint8)
    return lower, kinds[np.searchsorted(begins, np.arange(len(points)), side="right")]


@dataclass
class Words:
    """The words of a stretch: where they begin and end, their script, and the slots of their features."""

    begins: np.ndarray
    ends: np.ndarray
    script: np.ndarray
    slots: np.ndarray  # features x letters; a word's features stand from its first letter to its last
    first: np.ndarray  # of the words in the letters
    name: np.ndarray  # slot of the whole word


def words_of(points: np.ndarray) -> Words:
    """Splits code points into runs of letters; features are letter runs of 2 to 4 and the word."""
    lower, kinds = _tables()
    low = lower[points]
    solid = low > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]])))
    begins, ends = edges[::2], edges[1::2]
    now = low.astype(U)
    one = np.concatenate([[U(0)], now[:-1]])
    two = np.where(one > 0, np.concatenate([[U(0)], one[:-1]]), U(0))
    three = np.where(two > 0, np.concatenate([[U(0)], two[:-1]]), U(0))
    after = np.concatenate([now[1:], [U(0)]])
    pair = now * U(0x9E3779B97F4A7C15) + one * U(0xC2B2AE3D27D4EB4F)
    runs = (pair, pair + after * U(0x165667B19E3779F9), pair + two * U(0x27D4EB2F165667C5) + after * U(0x85EBCA77C2B2AE63),
            pair + two * U(0x27D4EB2F165667C5) + three * U(0xFF51AFD7ED558CCD))
    slots = np.stack([mix(r[solid] + U(i + 1)) & U(SLOTS - 1) for i, r in enumerate(runs)]).astype(np.int32)
    sizes = ends - begins
    first = np.cumsum(sizes) - sizes
    name = np.zeros(len(sizes), dtype=np.int32)
    if len(sizes):
        letter = now[solid] * mix((np.arange(len(slots[0])) - np.repeat(first, sizes)).astype(U) + U(99))
        name = (mix(np.add.reduceat(letter, first)) & U(SLOTS - 1)).astype(np.int32)
    return Words(begins, ends, kinds[points[begins]] if len(begins) else np.zeros(0, np.uint8), slots, first, name)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _steps(points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Stretches of a text that end where no letter stands, at ``STEP`` or soon after."""
    lower = _tables()[0]
    begin = 0
    while begin < len(points):
        end = min(begin + STEP, len(points))
        while end < len(points) and lower[points[end]]:
            end += 1
        yield begin, points[begin:end]
        begin = end


@dataclass
class Model:
    """Log probabilities per slot and language of letter runs and of words, and scripts seen."""

    names: list[str]
    runs: np.ndarray
    words: np.ndarray
    scripts: np.ndarray  # scripts x languages: 0 or FOREIGN
    unseen: np.ndarray  # scripts that no language was seen in

    @classmethod
    def fit(cls, names: list[str], runs: np.ndarray, words: np.ndarray, scripts: np.ndarray) -> Model:
        def log(counts: np.ndarray) -> np.ndarray:
            return np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * SLOTS)).astype(np.float32)

        seen = scripts > 0.01 * scripts.sum(axis=0)
        return cls(names, log(runs), log(words), np.where(seen | ~seen.any(axis=1, keepdims=True), 0, FOREIGN).astype(np.float32), ~scripts.any(axis=1))

    def scores(self, found: Words) -> np.ndarray:
        """Log probability of every word in every language, and the scripts' say."""
        total = self.words[found.name] + self.scripts[found.script]
        letters = sum(self.runs[s] for s in found.slots)
        if len(found.first):
            total += np.add.reduceat(letters, found.first, axis=0)
        return total


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best language of every word of every text; all texts move on one word at a time."""
    sizes = np.array([len(s) for s in scores], dtype=np.int64)
    if not sizes.sum():
        return [np.zeros(0, dtype=np.int16) for _ in scores]
    n = scores[0].shape[1]
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate([scores[i] for i in order]).astype(np.float64)
    ranked = sizes[order]
    first = np.cumsum(ranked) - ranked
    longest = int(ranked[0])
    active = len(ranked) - np.searchsorted(ranked[::-1], np.arange(longest), side="right")  # texts longer than t
    back = np.empty((len(flat), n), dtype=np.int16)
    own = np.arange(n, dtype=np.int16)
    best = flat[first[: active[0]]]
    for t in range(1, longest):
        best = best[: active[t]]
        top = best.argmax(axis=1).astype(np.int16)[:, None]
        value = np.take_along_axis(best, top.astype(np.int64), axis=1) - switch
        moved = value > best
        at = first[: active[t]] + t
        back[at] = np.where(moved, top, own)
        best = np.where(moved, value, best) + flat[at]
        best -= best.max(axis=1, keepdims=True)
        done = active[t + 1] if t + 1 < longest else 0
        if done < active[t]:
            back[at[done:] - t, 0] = best[done:].argmax(axis=1)  # kept in the unused first row
    ones = np.flatnonzero(ranked == 1)
    back[first[ones], 0] = flat[first[ones]].argmax(axis=1)
    path = np.empty(len(flat), dtype=np.int16)
    now = back[first[: active[0]], 0].astype(np.int64)
    for t in range(longest - 1, -1, -1):
        live = int(active[t])
        at = first[:live] + t
        path[at] = now[:live]
        if t:
            now[:live] = back[at, now[:live]]
    found: list[np.ndarray] = [np.zeros(0, dtype=np.int16)] * len(scores)
    for i, begin, size in zip(order.tolist(), first.tolist(), ranked.tolist()):
        found[i] = path[begin : begin + size]
    return found


def _count(names: list[str]):
    at = {n: i for i, n in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, words = np.zeros((SLOTS, len(names))), np.zeros((SLOTS, len(names)))
        scripts = np.zeros((KINDS, len(names)))
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                k = at[lang.as_py()]
                for _, points in _steps(_points(text.as_py())):
                    found = words_of(points)
                    runs[:, k] += np.bincount(found.slots.ravel(), minlength=SLOTS)
                    words[:, k] += np.bincount(found.name, minlength=SLOTS)
                    scripts[:, k] += np.bincount(found.script, minlength=KINDS)
        for kind, table in enumerate((runs, words, scripts)):
            slot, lang = np.nonzero(table)
            if len(slot):
                columns = [np.full(len(slot), kind), slot, lang, table[slot, lang]]
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["kind", "slot", "lang", "n"])

    return run


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def fit_languages(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the languages in ``text, lang`` rows; rows without either teach nothing.

    Fitted on about ``sample`` rows per language, chosen by a hash of the text, whole texts each; the
    counts that reach the driver are ``SLOTS`` per language and kind at most.
    """
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    known = rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(known) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    names = sorted(r["lang"] for r in known)
    tables = [np.zeros((SLOTS, len(names))), np.zeros((SLOTS, len(names))), np.zeros((KINDS, len(names)))]
    if names:
        share = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], min(1.0, sample / r["count"]))])
        drawn = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000
        counts = rows.where(drawn).mapInArrow(task(_count(names)), "kind int, slot int, lang int, n double")
        for r in counts.groupBy("kind", "slot", "lang").agg(F.sum("n").alias("n")).toLocalIterator():
            tables[r["kind"]][r["slot"], r["lang"]] = r["n"]
    return Model.fit(names, *tables)


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, dtype=np.int32)


def label_text(model: Model, texts: list[str]) -> list[tuple[str, float, list[tuple[int, int, str]], float]]:
    """Language, share of the letters in it, spans of code points, and share of the letters in scripts that
    no language was seen in, for each text."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    foreign: list[float] = []
    scores: list[np.ndarray] = []
    for text in texts:
        steps = [(begin, words_of(points)) for begin, points in _steps(_points(text))]  # one text's features at a time
        found.append((_joined([w.begins + b for b, w in steps]), _joined([w.ends + b for b, w in steps])))
        sizes, strange = _joined([w.ends - w.begins for _, w in steps]), [model.unseen[w.script] for _, w in steps]
        foreign.append(float(sizes[np.concatenate(strange)].sum() / sizes.sum()) if len(sizes) else 0.0)
        own = [model.scores(w) for _, w in steps]
        scores.append(np.concatenate(own) if own else np.zeros((0, len(model.names)), dtype=np.float32))
    labelled = []
    paths = viterbi(scores) if model.names else [np.zeros(0, np.int16)] * len(texts)
    for text, (begins, ends), path, strange in zip(texts, found, paths, foreign):
        if not len(path) or not any(map(str.isalpha, text)):
            labelled.append((UNKNOWN, 0.0, [], 0.0))
            continue
        weight = np.bincount(path, weights=ends - begins, minlength=len(model.names))
        top = int(weight.argmax())
        turns = np.flatnonzero(np.diff(path)) + 1
        firsts, lasts = np.concatenate([[0], turns]), np.concatenate([turns, [len(path)]]) - 1
        spans = [(int(begins[a]), int(ends[b]), model.names[path[a]]) for a, b in zip(firsts, lasts)]
        labelled.append((model.names[top], float(weight[top] / weight.sum()), spans, strange))
    return labelled


#: Bytes of the texts that are labelled together.
TOGETHER = 1 << 20


def _label(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            sizes = pc.binary_length(batch.column("read")).to_pylist()
            begin = 0
            while begin < len(sizes):
                end, size = begin, 0
                while end < len(sizes) and (end == begin or size < TOGETHER):
                    size += sizes[end]
                    end += 1
                found = label_text(model, batch.column("read").slice(begin, end - begin).to_pylist())
                spans = [[{"begin": a, "end": b, "lang": c} for a, b, c in f[2]] for f in found]
                own = batch.slice(begin, end - begin)
                carried = [n for n in own.schema.names if n != "read"]
                made = [pa.array([f[0] for f in found]), pa.array([f[1] for f in found]), pa.array(spans, span), pa.array([f[3] for f in found])]
                yield pa.record_batch([*(own.column(n) for n in carried), *made], names=[*carried, "lang_pred", "score", "spans", "foreign"])
                begin = end

    return run


def identify_languages(docs: DataFrame, model: Model, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``lang_pred, score, spans, foreign`` after ``own_`` columns of those in ``carry``, for every row of ``docs``.

    A word is a run of letters. Its script leaves the languages seen in that script; their scores for
    its letter runs and itself go into a Viterbi path that pays for each change of language. Spans
    are places of code points; the text's language is the one of most letters, the score its share of
    them. ``foreign`` is the share of letters in scripts that the model never saw, whose language is a
    guess. Null texts and texts without a letter are ``und`` with score 0 and no spans; with a model
    that learned no language all are. Ids may be null or repeated; columns that aren't carried are
    ignored, and none clashes; an empty table gives no row. The model is at most ``SLOTS`` numbers
    per language and kind.
    """
    own = docs.select(*[F.col(c).alias(f"own_{c}") for c in carry], F.coalesce("text", F.lit("")).alias("read"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields if f.name != "read")
    spans = "spans array<struct<begin:bigint,end:bigint,lang:string>>"
    return own.mapInArrow(task(_label(model)), ", ".join(x for x in (kinds, "lang_pred string", "score double", spans, "foreign double") if x))
