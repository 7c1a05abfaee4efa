"""Projections: one declared spec per entity, and small column helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Spec = Mapping[str, "str | Column"]


def conform(df: DataFrame, spec: Spec) -> DataFrame:
    """Exactly the columns of ``spec``: output name -> column name, dotted path or expression."""
    return df.select(
        *[(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in spec.items()]
    )


def with_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.withColumn(name, expr)


def copy_columns(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """Second names for columns: new name -> existing column."""
    return df.withColumns({new: F.col(old) for new, old in copies.items()})


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without these columns; names that do not exist are ignored."""
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Existing name -> new name; names that do not exist are ignored."""
    return df.withColumnsRenamed(dict(names))


def filter_gt(df: DataFrame, column: str, bound: object) -> DataFrame:
    """Rows whose column is above the bound; null is not."""
    return df.filter(F.col(column) > F.lit(bound))


def filter_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every (possibly nested) column has the given value; null never has."""
    for column, value in values.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df
