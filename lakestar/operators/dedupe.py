"""Distinct rows, one row per key, and distinct members per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.operators.joins import lookup_join
from lakestar.session import store

#: Rows of a table's partition that one task writes. A task that makes rows distinct holds them all, some 600 bytes
#: each for expenses, and hashing gives a few tasks five or six such shares.
ROWS_PER_FILE = 250_000


def dedupe(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    latest: bool = False,
) -> DataFrame:
    """Whole-row distinct, or one row per ``keys`` (nulls are equal).

    The survivor is the first row by ``order_by`` (the last if ``latest``), then by all remaining
    columns, so reruns keep the same one. Both forms aggregate before the shuffle: copies of a hot
    row or key shrink to one per task.
    """
    if keys is None:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    extreme = F.max if latest else F.min
    ranked = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)], F.struct(*rest).alias("row"))
    kept = df.groupBy(*keys).agg(extreme(ranked).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.row.{c}") for c in df.columns])


def dedupe_by(df: DataFrame, by: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Whole-row distinct, laid out for a write partitioned ``by`` some columns: one shuffle for both.

    Rows meet by these columns alone, so copies of a row meet as well and a value's rows lie in one
    task. Only if a value has more than ``rows_per_file`` rows, a bucket of the row's hash is added, and
    such a value gets as many tasks as its rows need. The rows of each value are counted beforehand, a
    pass over ``by`` alone, which also tells how many tasks there have to be.
    """
    spark = df.sparkSession
    names = [f"_by_{i}" for i in range(len(by))]
    counted = store(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), "sizes").df.toDF(*names, "_n")
    total = counted.agg(F.sum("_n")).first()[0] or 0
    hot = store(counted.filter(F.col("_n") > rows_per_file), "hot")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_per_file))
    if not hot.rows:
        return df.repartition(tasks, *by).dropDuplicates()
    placed = lookup_join(df, hot.df, dict(zip(by, names)), null_safe=True, profile=hot)
    buckets = F.coalesce(F.ceil(F.col("_n") / F.lit(rows_per_file)), F.lit(1))
    spread = F.pmod(F.xxhash64(*df.columns), buckets).alias("_spread")
    return placed.select(*df.columns, spread).repartition(tasks, *by, "_spread").dropDuplicates().drop("_spread")


def collect_distinct(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Per key the sorted array of the distinct non-null values of ``column``.

    Values are made distinct over the whole cluster first, so a hot key sends each value to its
    group once and not once per row.
    """
    members = df.select(*keys, column).distinct()
    return members.groupBy(*keys).agg(F.sort_array(F.collect_list(column)).alias(out))
