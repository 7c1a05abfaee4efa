"""Surrogate keys that outlive a publication: a stored registry of natural keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.joins import MAX_BROADCAST_BYTES, lookup_join
from lakestar.operators.keys import surrogate_key
from lakestar.session import store
from lakestar.sinks.batches import batches


def read_registry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All keys that were ever given out."""
    whole, _ = batches(spark, path)
    return spark.read.schema(schema).parquet(*whole) if whole else spark.createDataFrame([], schema)


def registered_key(
    df: DataFrame, out: str, path: str, natural: Sequence[str], max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Adds a surrogate key that a natural key keeps over any number of publications.

    A natural key (nulls are equal to nulls) that the registry below ``path`` holds has the key it got
    then; new ones get the next numbers above the highest, without gaps, in the order of
    :func:`lakestar.operators.keys.surrogate_key`'s ``dense``, and are registered before the rows are
    returned. Rows that share a natural key share its key. Natural keys that are gone stay registered,
    so one that comes back has its old key.

    Each call adds one batch, which counts once it is written whole, so a broken run leaves no half of
    one. One writer at a time, as with any table that is published by a job.
    """
    spark, natural = df.sparkSession, list(natural)
    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in natural), f"`{out}` bigint"])
    names = {c: f"_natural_{i}" for i, c in enumerate(natural)}

    def keyed(rows: DataFrame) -> DataFrame:
        known = store(read_registry(spark, path, schema).toDF(*names.values(), "_key"), "registry")
        return lookup_join(rows, known.df, names, null_safe=True, max_broadcast_bytes=max_broadcast_bytes, profile=known)

    given = df.select(*natural).distinct()
    fresh = store(keyed(given).filter(F.col("_key").isNull()).select(*natural), "fresh")
    if fresh.rows:
        _, place = batches(spark, path)
        highest = read_registry(spark, path, schema).agg(F.max(out)).first()[0] or 0
        numbered = surrogate_key(fresh.df, out, "dense", natural).withColumn(out, F.col(out).cast("bigint") + highest)
        numbered.write.mode("overwrite").parquet(place)
    return keyed(df).select(*[c for c in df.columns if c != out], F.col("_key").alias(out))
