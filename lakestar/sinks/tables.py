"""Writing tables: overwrite, append, or replace only the partitions that are written."""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame

from lakestar.operators.conform import copy_columns
from lakestar.operators.layout import clustered
from lakestar.session import parquet_options, shuffles_released

MODES = ("overwrite", "append", "replace_partitions")


def _qualified(df: DataFrame, path: str) -> str:
    """Scheme, place and path; a path without them is below the default file system."""
    found = urlparse(path)
    default = urlparse(df.sparkSession._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///"))
    plain = unquote(found.path)
    if not plain.startswith("/"):
        plain = f"{os.getcwd()}/{plain}"
    return f"{found.scheme or default.scheme}://{found.netloc or ('' if found.scheme else default.netloc)}{os.path.normpath(plain)}"


def _roots(df: DataFrame) -> Iterator[str]:
    """Root paths of the tables that the plan reads: a path per table, not per file."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            paths = leaf.relation().location().rootPaths()
            for k in range(paths.size()):
                yield paths.apply(k).toString()


def _refuse_own_input(df: DataFrame, path: str) -> None:
    """Spark would delete the files first and then fail to read them."""
    target = _qualified(df, path)
    for root in _roots(df):
        read = _qualified(df, root)
        if f"{read}/".startswith(f"{target}/") or f"{target}/".startswith(f"{read}/"):
            raise ValueError(f"{path} is read by the very rows that would replace it")


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    partition_copies: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
    rebalance: bool = True,
    cluster_by: Sequence[str] = (),
) -> None:
    """Writes ``df`` to ``path``.

    ``replace_partitions`` replaces just the partitions that ``df`` holds, so a rerun of one month is
    idempotent; ``append`` is not. ``partition_copies`` (copy -> column) partitions by copies, so the
    columns themselves stay in the files.

    A partitioned write is rebalanced on its partition columns: small partitions share a task, and a
    partition with a large part of all rows is split over several. With two columns to ``cluster_by`` the
    rows of a partition follow both instead (:func:`lakestar.operators.layout.clustered`), so a filter on
    either leaves out row groups and pages. Parquet files are compressed with zstd, unless ``options`` or the
    session name another codec.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode != "append":
        _refuse_own_input(df, path)
    partition_by = list(partition_by)
    if partition_copies:
        df = copy_columns(df, partition_copies)
        partition_by += list(partition_copies)
    if mode == "replace_partitions" and not partition_by:
        raise ValueError("replace_partitions needs partition columns")
    if cluster_by:
        df = clustered(df, partition_by, cluster_by)
    elif partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    options = parquet_options(df.sparkSession, options) if fmt == "parquet" else options or {}
    writer = df.write.format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "replace_partitions":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with shuffles_released(df.sparkSession):
        writer.mode("append" if mode == "append" else "overwrite").save(path)


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keeps frames cached inside the block and releases them at its end, whatever happens."""
    for df in frames:
        df.persist()
    try:
        yield frames
    finally:
        for df in frames:
            df.unpersist()
