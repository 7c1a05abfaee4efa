"""Joins of large tables that lie in buckets of their key, so that no side is shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.joins import MAX_BROADCAST_BYTES, ROWS_PER_TASK, hot_keys, lookup_join
from lakestar.session import store


@dataclass(frozen=True)
class Bucketed:
    """Rows in buckets of ``keys`` (the catalog table ``name``), and beside them, in a folder without
    buckets, the rows whose key is frequent or holds a null: one bucket would get all of them."""

    spark: SparkSession
    name: str
    apart: str
    keys: tuple[str, ...]
    buckets: int
    columns: tuple[str, ...]

    @property
    def in_buckets(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.columns)

    @property
    def set_apart(self) -> DataFrame:
        return self.spark.read.schema(self.in_buckets.schema).parquet(self.apart)

    @property
    def df(self) -> DataFrame:
        return self.in_buckets.unionByName(self.set_apart)


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    keys: Sequence[str],
    buckets: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    split: bool = True,
    rows_per_bucket: int = ROWS_PER_TASK,
) -> Bucketed:
    """Writes ``df`` below ``path`` in buckets of ``keys`` as the catalog table ``name``, once for all joins.

    Keys with more than ``rows_per_task`` rows, and rows whose key holds a null, go to a folder of their
    own. Without a number of ``buckets`` there are as many as hold ``rows_per_bucket`` rows each: how small a
    key may be to stay in one says nothing about how many there have to be. A lookup side, which has few rows per key, may be written whole (``split=False``), with the buckets of the other.
    """
    spark, keys = df.sparkSession, list(keys)
    stored = store(df, "unbucketed").df
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // rows_per_bucket))
    empty = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    own, apart = stored, stored.limit(0)
    if split:
        listed = store(hot_keys(stored.filter(~empty), keys, rows_per_task).drop("_salts"), "hot-keys")
        hot = F.broadcast(listed.df) if listed.size_bytes <= MAX_BROADCAST_BYTES else listed.df
        frequent = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_hot_{i}") for i, k in enumerate(keys)])
        own = stored.filter(~empty).join(hot, frequent, "left_anti")
        apart = stored.filter(~empty).join(hot, frequent, "left_semi").unionByName(stored.filter(empty))
    place = path.rstrip("/")
    apart.write.mode("overwrite").parquet(f"{place}/apart")
    own.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{place}/buckets").saveAsTable(name)
    return Bucketed(spark, name, f"{place}/apart", tuple(keys), buckets, tuple(df.columns))


def open_bucketed(spark: SparkSession, name: str, path: str, schema: str, keys: Sequence[str], buckets: int) -> Bucketed:
    """A table that :func:`write_bucketed` left below ``path``, for a session whose catalog doesn't know it."""
    place = path.rstrip("/")
    listed = ", ".join(f"`{k}`" for k in keys)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {int(buckets)} BUCKETS LOCATION '{place}/buckets'")
    return Bucketed(spark, name, f"{place}/apart", tuple(keys), buckets, tuple(spark.table(name).columns))


def bucketed_join(
    left: Bucketed, right: Bucketed, on: Mapping[str, str], how: str = "left", max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``left`` with the columns of ``right`` (column names must differ), ``how`` left or inner; nulls match nothing.

    Buckets of both sides are joined where they lie. The left rows set apart, whose frequent keys are few,
    get the lookup rows of their keys by :func:`lakestar.operators.joins.lookup_join`, which broadcasts
    them if they are measured to be small and salts them otherwise. ``right`` must be written whole.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if (tuple(on), tuple(on.values())) != (left.keys, right.keys) or left.buckets != right.buckets:
        raise ValueError("both sides need buckets of the joined keys, in their order, and as many")
    types, others = dict(left.in_buckets.dtypes), dict(right.in_buckets.dtypes)
    if any(types[a] != others[b] for a, b in on.items()):
        raise ValueError("keys of both sides need one type, as other types lie in other buckets")
    if right.set_apart.limit(1).count():
        raise ValueError("the lookup side must be written whole (split=False)")

    def same(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, [a[c] == b[d] for c, d in on.items()])

    own, lookup = left.in_buckets, right.in_buckets
    apart = left.set_apart
    wanted = apart.select(*[F.col(c).alias(f"_want_{i}") for i, c in enumerate(on)]).dropna().distinct()
    few = reduce(lambda x, y: x & y, [lookup[d] == F.col(f"_want_{i}") for i, d in enumerate(on.values())])
    found = store(lookup.join(wanted, few, "left_semi"), "wanted")
    rest = lookup_join(apart, found.df, dict(on), how, max_broadcast_bytes=max_broadcast_bytes, profile=found)
    return own.join(lookup, same(own, lookup), how).unionByName(rest)
