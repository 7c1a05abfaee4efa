"""Exact duplicates: short fingerprints go to owners as Golomb codes, only suspects' texts move."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import Written, task, written

#: Bits of a fingerprint beyond log2 of the rows: one unique text in 2^8 is suspected in vain.
SPARE_BITS = 8
#: Fingerprints per owner, about.
OWNED = 1 << 20


def golomb_encode(values: np.ndarray) -> tuple[int, bytes]:
    """Rising numbers as Rice codes of their gaps: all quotients in unary, then all remainders."""
    if not len(values):
        return 0, b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    k = max(0, int(np.log2(max(1.0, float(gaps.mean())))))
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1) - 1
    bits = np.zeros(ends[-1] + 1 + k * len(gaps), dtype=np.uint8)
    bits[ends] = 1
    places = np.arange(k, dtype=np.uint64)
    bits[ends[-1] + 1 :] = ((gaps[:, None] >> places) & np.uint64(1)).ravel()
    return k, np.packbits(bits).tobytes()


def golomb_decode(code: bytes, k: int, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, dtype=np.uint64)
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    ends = np.flatnonzero(bits)[:n]  # the first n ones end the quotients
    quotients = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    rest = bits[ends[-1] + 1 :][: n * k].reshape(n, k).astype(np.uint64)
    remainders = (rest << np.arange(k, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) if k else np.uint64(0)
    return np.cumsum((quotients << np.uint64(k)) + remainders, dtype=np.uint64)


def _short(marks: pd.Series, bits: int) -> np.ndarray:
    return marks.to_numpy(dtype=np.int64).view(np.uint64) >> np.uint64(64 - bits)


def _lists(marks: np.ndarray, bits: int, owner_bits: int):
    """The distinct fingerprints and, for each owner in turn, where its own begin and end."""
    distinct = np.unique(marks)
    owners = (distinct >> np.uint64(bits - owner_bits)).astype(np.int64)
    names, begins = np.unique(owners, return_index=True)
    return distinct, list(zip(names.tolist(), begins.tolist(), [*begins[1:].tolist(), len(distinct)]))


def suspects(marked: DataFrame, rows: int) -> DataFrame:
    """Adds ``suspect`` to rows of ``part, mark``: another row may have the same mark.

    Every part sends each owner of a range of fingerprints one sorted Golomb-coded list without
    repeats; the owner answers with a bitmap over that list. A mark in many rows of a part travels
    once, so a hot text costs an owner one entry per part.
    """
    bits = min(62, max(1, rows - 1).bit_length() + SPARE_BITS)
    owner_bits = min(bits, max(0, (rows // OWNED).bit_length()))

    def send(group: pd.DataFrame) -> pd.DataFrame:
        distinct, lists = _lists(_short(group["mark"], bits), bits, owner_bits)
        made = []
        for owner, begin, end in lists:
            base = np.uint64(owner) << np.uint64(bits - owner_bits)
            made.append((owner, group["part"].iloc[0], end - begin, *golomb_encode(distinct[begin:end] - base)))
        return pd.DataFrame(made, columns=["owner", "part", "n", "k", "code"])

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        lists = [golomb_decode(c, k, n) for c, k, n in zip(group["code"], group["k"], group["n"])]
        values, times = np.unique(np.concatenate(lists), return_counts=True)
        shared = values[times > 1]
        maps = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"part": group["part"], "owner": group["owner"], "bitmap": maps})

    def receive(group: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        marks = _short(group["mark"], bits)
        distinct, lists = _lists(marks, bits, owner_bits)
        got = dict(zip(maps["owner"], maps["bitmap"]))
        shared = np.concatenate(
            [np.unpackbits(np.frombuffer(got[o], dtype=np.uint8), count=e - b) for o, b, e in lists]
        ).astype(bool)
        place = np.searchsorted(distinct, marks)
        again = np.bincount(place, minlength=len(distinct)) > 1
        return group.assign(suspect=(shared | again)[place])

    sent = marked.select("part", "mark").groupBy("part").applyInPandas(task(send), "owner long, part int, n int, k int, code binary")
    maps = sent.groupBy("owner").applyInPandas(task(answer), "part int, owner long, bitmap binary")
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    return marked.groupBy("part").cogroup(maps.groupBy("part")).applyInPandas(task(receive, 2), f"{out}, suspect boolean")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after each run of ASCII blanks became one blank; null is empty.
    The row with the smallest ``doc_id`` stays; a null id counts as the largest, and of rows that
    repeat id and text one stays. Texts of suspects are compared byte by byte, as the key of an
    aggregation that combines before the shuffle: a text that a third of all rows share moves once
    per task. Texts that no other row may share don't leave their join. Other columns are ignored;
    an empty table gives no row.
    """
    own = docs.select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ").alias("norm"))
    marked = Written(
        own.select(
            "doc_id",
            F.spark_partition_id().alias("part"),
            F.xxhash64("norm").alias("mark"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
        ),
        "marks",
    )
    once = Window.partitionBy("doc_id", "sha").orderBy("mark")
    judged = Written(suspects(marked.df, marked.rows).withColumn("turn", F.row_number().over(once)), "suspects")
    marked.drop()
    ids = judged.df.where("suspect").select(F.col("doc_id").alias("suspect_id")).distinct()
    loaded = own.join(ids.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("suspect_id")), "left_semi")
    same = loaded.groupBy("norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = (
        same.where("group_size > 1")
        .groupBy(F.unhex(F.sha2("norm", 256)).alias("sha"))
        .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
        .withColumn("keep_id", F.when(F.col("texts") == 1, F.col("keep_id")).otherwise(
            F.raise_error(F.lit("two texts have one SHA-256")).cast("long")))
    )
    return (
        judged.df.join(written(classes, "classes"), "sha", "left")
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
        .select(
            "doc_id",
            "keep_id",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
        )
    )
