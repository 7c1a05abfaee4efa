"""Embedding near-dedup: random hyperplanes in several tables, exact cosines, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import Written, dealt, looked_up, parts, runs, task
from lakestar.llm.components import components
from lakestar.llm.shingles import U, mix

SIMILAR = 0.93
#: Probability that a pair of exactly that cosine shares no bucket in any table.
MISSED = 1e-5
#: Vectors of a block; a larger bucket is compared block by block.
BLOCK = 1024


def tables_for(rows: int, least: float, missed: float = MISSED) -> tuple[int, int]:
    """Bits per table and tables, for so many vectors of one label.

    Bits grow with log2 of the rows, so a bucket's vectors that have nothing in common stay few; the
    tables make up for it, so the share of missed pairs is the same at every size.
    """
    bits = max(8, max(1, rows).bit_length() + 2)
    alike = 1 - math.acos(least) / math.pi
    return bits, math.ceil(math.log(missed) / math.log1p(-(alike**bits)))


def _planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def buckets(vectors: np.ndarray, label: int, bits: int, tables: int, seed: int) -> np.ndarray:
    """A number per vector and table: the signs of the table's hyperplanes, hashed with the label."""
    signs = (vectors @ _planes(vectors.shape[1], bits, tables, seed) > 0).reshape(len(vectors), tables, bits)
    keys = (signs.astype(U) << np.arange(bits, dtype=U)).sum(axis=2, dtype=U)
    own = (label * 0x9FB21C651E98DF25 + vectors.shape[1]) % 2**64
    salt = mix(np.arange(tables, dtype=U) + U(own))
    return mix(keys ^ salt).view(np.int64)


def _hash(bits: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[bytes, bytes, np.ndarray] | None] = []
            by_kind: dict[tuple[int, int], list[int]] = {}
            vectors = [None if v is None or None in v else np.array(v, dtype=np.float64) + 0.0 for v in batch["embedding"].to_pylist()]
            for i, (v, label) in enumerate(zip(vectors, batch["label"].to_pylist())):
                found.append(None)
                if label is not None and v is not None and len(v) and np.isfinite(v).all() and v.any():
                    by_kind.setdefault((len(v), label), []).append(i)
            for (_, label), rows in by_kind.items():
                own = np.stack([vectors[i] for i in rows])
                scaled = own / np.abs(own).max(axis=1, keepdims=True)
                scaled /= np.linalg.norm(scaled, axis=1, keepdims=True)
                for i, unit, keys in zip(rows, scaled, buckets(scaled, label, bits, tables, seed)):
                    digest = hashlib.blake2b(label.to_bytes(9, "little", signed=True) + vectors[i].tobytes(), digest_size=16)
                    found[i] = (digest.digest(), unit.tobytes(), keys)
            columns = zip(*(x or (None, None, None) for x in found)) if found else ((), (), ())
            kinds = (pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.record_batch(
                [batch["vec_id"], *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                names=["vec_id", "digest", "unit", "buckets"],
            )

    return run


def _roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links: the first row that each row can reach."""
    at = np.arange(len(linked))
    while True:
        least = np.minimum(at, np.where(linked, at[None, :], len(at)).min(axis=1))
        least = np.minimum(least, least[least])
        if (least == at).all():
            return at
        at = least


def link_block(ids: np.ndarray, copies: np.ndarray, units: np.ndarray, keys: np.ndarray, side: np.ndarray | None, bucket: int, least: float) -> tuple | None:
    """Links inside one block of a bucket, or between two (``side``): id, linked copies, root.

    A pair counts only in the first table in which its vectors share a bucket, so over all buckets
    each pair counts once. The roots connect what the counted links connect.
    """
    order = np.argsort(ids)
    ids, copies, units, keys = ids[order], copies[order], units[order], keys[order]
    linked = units @ units.T >= least
    np.fill_diagonal(linked, False)
    if side is not None:
        side = side[order]
        linked &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(linked))
    for begin in range(0, len(a), 20_000):  # bounded memory for the keys of pairs
        i, j = a[begin : begin + 20_000], b[begin : begin + 20_000]
        first = keys[i, (keys[i] == keys[j]).argmax(axis=1)]
        other = first != bucket
        linked[i[other], j[other]] = linked[j[other], i[other]] = False
    rows = np.flatnonzero(linked.any(axis=1))
    if not len(rows):
        return None
    own = linked[np.ix_(rows, rows)]
    return ids[rows], own @ copies[rows], ids[rows][_roots(own)]


def _link(least: float):
    def done(table: pa.Table) -> tuple | None:
        if table.num_rows < 2:
            return None
        units = np.stack([np.frombuffer(u.as_buffer(), dtype=np.float64) for u in table["unit"]])
        keys = np.stack([k.values.to_numpy(zero_copy_only=False) for k in table["buckets"]])
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        side = None if low == high else table["block"].to_numpy() == low
        return link_block(
            table["x"].to_numpy(), table["copies"].to_numpy(), units, keys, side, table["bucket"][0].as_py(), least
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ("bucket", "low", "high")):
            found = done(table)
            if found:
                columns = [pa.array(c.astype(np.int64)) for c in found]
                yield pa.record_batch(columns, names=["x", "links", "root"])

    return run


def embedding_duplicates(vectors: DataFrame, least: float = SIMILAR, seed: int = 5) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of equal, non-null label are linked when their cosine, in double precision, is ``least``
    or more. A vector that is null, empty, zero or holds a null or non-finite component is linked to
    nothing, nor is one without a label; vectors of different length never are. ``n_links`` counts
    the other rows a row is linked with, equal vectors included; ``component_id`` is the smallest
    ``vec_id`` that links reach, null if no id is there. Rows are what is linked: a row without an id
    links as any other, and rows that repeat an id with different vectors stay apart unless links connect
    them. Other columns are ignored; an empty table gives no row.

    Equal vectors become one node with a count and their smallest id before anything is paired. A row's bucket keys travel
    alone; only vectors in buckets of two and more follow, and a bucket above ``BLOCK`` vectors is
    compared as pairs of blocks in different tasks. Links are never listed: a task returns a count
    and a root per vector.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    most = own.where("label is not null").groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_for(most, least)
    hashed = Written(
        own.mapInArrow(task(_hash(bits, tables, seed)), "vec_id long, digest binary, unit binary, buckets array<bigint>"), "hashed"
    )
    kept = F.min(F.struct("unit", "buckets")).alias("f")
    nodes = Written(
        hashed.df.where("digest is not null")
        .groupBy("digest")
        .agg(kept, F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .select("digest", "copies", "first", F.monotonically_increasing_id().alias("x"), "f.unit", "f.buckets"),
        "nodes",
    )
    keys = nodes.df.select("x", F.explode("buckets").alias("bucket"))
    full = Written(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "full")
    members = Written(keys.join(full.df, "bucket"), "members")
    full.drop()
    spread = dealt(members.df, "bucket", "x", "n", BLOCK)
    rows = spread.join(nodes.df.select("x", "copies", "unit", "buckets"), "x")
    n = parts(spark, members.rows, 100_000)
    grouped = rows.repartition(n, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    linked = Written(
        grouped.select("x", "copies", "unit", "buckets", "bucket", "block", "low", "high").mapInArrow(
            task(_link(least)), "x long, links long, root long"
        ),
        "linked",
    )
    members.drop()
    roots = components(linked.df.select("x", "root")).withColumnRenamed("node", "x")
    counts = linked.df.groupBy("x").agg(F.sum("links").alias("links"))
    placed = Written(
        nodes.df.select("digest", "x", "copies", "first").join(counts, "x", "left").join(roots, "x", "left").withColumn("root", F.coalesce("root", "x")),
        "placed",
    )
    linked.drop()
    firsts = placed.df.groupBy("root").agg(F.min("first").alias("component_id"))
    known = placed.df.join(firsts, "root").select(
        F.col("digest").alias("of"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    return (
        looked_up(hashed.df.select("vec_id", "digest"), known, {"digest": "of"})
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("of").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
