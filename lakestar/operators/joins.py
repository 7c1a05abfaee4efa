"""Joins against a lookup side: broadcast when measured to be small, salted by key otherwise."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.operators.bloom import bloom_words, might_be_in
from lakestar.session import Stored, row_width, shuffles_released, store

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more rows than this is spread over several tasks.
ROWS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class LookupProfile:
    """What one pass over a lookup side finds."""

    rows: int
    size_bytes: int
    max_copies: int


def profile_lookup(df: DataFrame, keys: list[str]) -> LookupProfile:
    """Measures rows, bytes and the largest number of rows per non-null key, in one job."""
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(row_width(df)).alias("_bytes"))
    with shuffles_released(df.sparkSession):
        found = per_key.agg(
            F.sum("_n").alias("rows"),
            F.sum("_bytes").alias("size_bytes"),
            F.max(F.when(has_key, F.col("_n"))).alias("copies"),
        ).collect()[0]
    return LookupProfile(found["rows"] or 0, found["size_bytes"] or 0, found["copies"] or 0)


def _matches(on: Mapping[str, str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for left, right in on.items():
        a, b = F.col(f"l.{left}"), F.col(f"r.{right}")
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    null_safe: bool = False,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    profile: LookupProfile | Stored | None = None,
    hot_from: DataFrame | None = None,
    prune: bool = False,
) -> DataFrame:
    """``left`` with the columns of ``right`` (column names must differ), ``how`` left or inner.

    ``on`` maps left key -> right key. ``right`` is broadcast only if a measurement of the very rows
    stays within ``max_broadcast_bytes`` (``profile``: one made already). Beyond it both sides are
    shuffled, and frequent left keys are spread over salts, with their lookup rows repeated per salt.
    Rows whose key holds a null match nothing unless ``null_safe``: they are spread without counting.
    ``hot_from`` is a cheaper frame to count the left keys in, such as ``left`` before earlier joins.
    ``prune`` lets a shuffled inner join leave out left rows first whose key a Bloom filter of the right
    keys doesn't hold; for lookups that many left rows miss.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    profile = profile or profile_lookup(right, list(on.values()))
    if profile.size_bytes <= max_broadcast_bytes:
        joined = left.alias("l").join(F.broadcast(right.alias("r")), _matches(on, null_safe), how)
        return joined.select("l.*", "r.*")
    if prune and how == "inner" and not null_safe:
        left = pruned(left, right, on, profile.rows)
        hot_from = left
    return salted_join(left, right, on, how, null_safe, rows_per_task, hot_from)


def pruned(left: DataFrame, right: DataFrame, on: Mapping[str, str], rows: int) -> DataFrame:
    """``left`` without most of the rows whose key ``right``, of so many ``rows``, doesn't hold; all others stay.

    Keys of both sides need equal types, as others hash otherwise; then, and where the filter would
    take too much memory, all rows stay.
    """
    types, others = dict(left.dtypes), dict(right.dtypes)
    made = bloom_words(right, list(on.values()), rows) if all(types[a] == others[b] for a, b in on.items()) else None
    return left if made is None else left.dropna(subset=list(on)).filter(might_be_in(list(on), *made))


def hot_keys(df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The keys with more than ``rows_per_task`` rows, and as many salts as that takes."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    top = counted.filter(F.col("_n") > rows_per_task)
    salts = F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("bigint")
    return top.select(*[F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)], salts.alias("_salts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    null_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """The shuffled form of :func:`lookup_join`, for a right side that is known to be large.

    The list of frequent keys is stored and measured; too large a list is joined by a shuffle. The right side is
    marked for a shuffle, as Spark would guess its size from that of compressed files.
    """
    counted = left if hot_from is None else hot_from
    if not null_safe:
        counted = counted.dropna(subset=list(on))
    listed = store(hot_keys(counted, list(on), rows_per_task), "hot-keys")
    hot = F.broadcast(listed.df) if listed.size_bytes <= MAX_BROADCAST_BYTES else listed.df

    def marked(df: DataFrame, keys: list[str]) -> DataFrame:
        condition = F.lit(True)
        for i, key in enumerate(keys):
            condition = condition & F.col(key).eqNullSafe(F.col(f"_hot_{i}"))
        return df.join(hot, condition, "left").drop(*[f"_hot_{i}" for i in range(len(keys))])

    # The salt depends on the row and the task only: a task that is run again salts alike, and
    # copies of one row from different tasks still part.
    own = F.xxhash64(*left.columns) + F.spark_partition_id()
    spread = F.pmod(own, F.coalesce("_salts", F.lit(1).cast("bigint")))
    if not null_safe:
        matchless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
        spread = F.when(matchless, own).otherwise(spread)
    salted_left = marked(left, list(on)).withColumn("_salt", spread).drop("_salts")
    repeats = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = (
        marked(right, list(on.values())).withColumn("_salt", F.explode(repeats)).drop("_salts")
    )
    condition = _matches(on, null_safe) & (F.col("l._salt") == F.col("r._salt"))
    joined = salted_left.alias("l").join(salted_right.hint("merge").alias("r"), condition, how)
    return joined.select(
        *[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in right.columns]
    )


def join_members(
    details: DataFrame, members: DataFrame, on: Mapping[str, str], **options: object
) -> DataFrame:
    """Inner join of detail rows with their aggregated membership."""
    return lookup_join(details, members, on, how="inner", **options)
