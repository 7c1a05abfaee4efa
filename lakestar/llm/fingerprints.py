"""Document fingerprints: every shingle hash below a fixed fraction, and likeness of two of them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import Written, parts, task
from lakestar.llm.shingles import U, WORDS, mix, shingles, word_hashes

#: A shingle's hash is retained if it is below 2 ** 64 / FRACTION.
FRACTION = 8
#: Bits of a hash that a fingerprint holds; hexadecimal digits of one.
BITS, DIGITS = 48, 12
#: Characters of the texts that one task reads in order, about.
CHARS = 1 << 25
PARTS = 20_000


def sketch(text: str | None, fraction: int = FRACTION) -> np.ndarray:
    """Rising hashes: all below the threshold, or the smallest one if none is; empty without words."""
    found = np.unique(mix(shingles(word_hashes(text), WORDS) ^ U(0x2545F4914F6CDD1D)))
    below = np.searchsorted(found, U((1 << 64) // fraction))
    return np.unique(found[: max(1, below)] >> U(64 - BITS))


def fingerprint(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes().hex()


def hashes(text: str) -> np.ndarray:
    """The hashes of a fingerprint."""
    raw = np.frombuffer(bytes.fromhex(text), dtype=np.uint8).reshape(-1, BITS // 8)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, 8 - BITS // 8 :] = raw
    return wide.view(">u8").ravel().astype(U)


def merged(a: np.ndarray, b: np.ndarray, fraction: int = FRACTION) -> np.ndarray:
    """The sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    return both[: max(1, np.searchsorted(both, U((1 << BITS) // fraction)))]


def likeness(a: np.ndarray, b: np.ndarray, fraction: int = FRACTION) -> tuple[float, float]:
    """Jaccard index of two sketches, and how much of the first the second holds.

    Counted are hashes below the threshold. Where neither has one, both are a single minimum, and
    equal minima stand for equal sets. Two texts without words are alike, one is unlike any other.
    """
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    limit = U((1 << BITS) // fraction)
    x, y = a[: np.searchsorted(a, limit)], b[: np.searchsorted(b, limit)]
    if not len(x) and not len(y):
        same = float(a[0] == b[0])
        return same, same
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared / (len(x) + len(y) - shared), shared / len(x) if len(x) else float(a[0] in y)


def edited(text: str, following: str) -> str:
    """The last third of the code points, rounded down, replaced by the first as many of another text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_OUT = {
    "n_chars": pa.int64(),
    "edited_sha256": pa.string(),
    "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
    "held_by_edited": pa.float64(),
    "held_by_next": pa.float64(),
}
_KINDS = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


def _judge(fraction: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in their order; a row of the next part (``follows``) ends its part."""
        before: tuple | None = None
        for batch in batches:
            made = []
            for i in range(batch.num_rows):
                doc_id, text, part, follows = (batch[c][i].as_py() for c in ("doc_id", "text", "part", "follows"))
                text = text or ""
                own = sketch(text, fraction)
                if before is not None and before[0] == part:
                    made.append((before[1], *compared(*before[2:], text, own, fraction)))
                before = None if follows else (part, doc_id, text, own)
            if made:
                kinds = {"doc_id": batch.schema.field("doc_id").type, **_OUT}
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*made), kinds.values())], names=list(kinds))

    return run


def compared(text: str, own: np.ndarray, following: str, other: np.ndarray, fraction: int = FRACTION) -> tuple:
    """The columns of a text with this sketch, followed by another with that sketch."""
    changed = edited(text, following)
    after = own if changed == text else sketch(changed, fraction)
    near, held = likeness(own, after, fraction)
    near_next, held_next = likeness(own, other, fraction)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return len(text), digest, fingerprint(own), fingerprint(after), near, near_next, held, held_next


_ORDER = "decimal(38,0)"


def _order() -> Column:
    """One number with the order of rows: falling ids, null last, then a hash of the text."""
    falling = F.coalesce(-F.col("doc_id").cast(_ORDER), F.lit(str(2**64)).cast(_ORDER))
    return (falling * F.lit(2**32).cast(_ORDER) + F.pmod(F.xxhash64("text"), F.lit(2**32))).cast(_ORDER)


def fingerprints(docs: DataFrame, fraction: int = FRACTION, chars: int = CHARS) -> DataFrame:
    """A row's fingerprint, that of its edited text, and how alike they are, for every row of ``docs``.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    held_by_edited, held_by_next``. The edited text has the first third of the next row's text in place of
    its own last third (:func:`edited`); rows follow each other by falling ``doc_id``, null last, the first
    after the last. A fingerprint is the hexadecimal text of the :func:`sketch` of the shingles of five
    words; ``near`` is the Jaccard index, ``held`` the share of the row's shingles that the other has.

    A null text is empty, and its fingerprint as well, as is that of a text without words; rows that
    repeat an id follow each other by a hash of their text, equal rows in any order. A single row
    follows itself. Other columns are ignored; an empty table gives no row.

    Texts are dealt once, to parts of about ``chars`` characters (``PARTS`` parts at most) that are runs of
    that order; the first row of a part goes to the end of the part before it as well. Only the parts'
    borders meet on the driver. A task reads its rows one after the other and holds two texts.
    """
    own = docs.select("doc_id", "text", _order().alias("place"))
    sizes = own.select("place", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"))
    keys = Written(sizes, "places", chars=F.sum("n"))
    n = min(PARTS, parts(docs.sparkSession, keys.figures["chars"] or 0, chars))
    dealt = keys.df.repartitionByRange(n, "place").groupBy(F.spark_partition_id().alias("part"))
    firsts = sorted(r["first"] for r in dealt.agg(F.min("place").alias("first")).collect())
    keys.drop()
    borders = F.split(F.lit(",".join(map(str, firsts))), ",").cast(f"array<{_ORDER}>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, len(firsts).bit_length())))])
    part = F.aggregate(  # the last border that isn't above the row, by bisection
        steps, F.lit(0), lambda at, step: F.when(F.get(borders, at + step) <= F.col("place"), at + step).otherwise(at)
    )
    placed = own.withColumn("part", part)
    twice = F.when(F.get(borders, F.col("part")) == F.col("place"), F.array(F.lit(False), F.lit(True)))
    rows = placed.withColumn("follows", F.explode(F.coalesce(twice, F.array(F.lit(False)))))
    before = F.pmod(F.col("part") - 1, F.lit(max(1, len(firsts))))
    rows = rows.withColumn("part", F.when(F.col("follows"), before).otherwise(F.col("part")))
    ordered = rows.repartitionById(max(1, len(firsts)), "part").sortWithinPartitions("part", "follows", "place", "text")
    kinds = ", ".join(f"{name} {_KINDS[kind]}" for name, kind in _OUT.items())
    return ordered.mapInArrow(task(_judge(fraction)), f"doc_id {dict(docs.dtypes)['doc_id']}, {kinds}")
