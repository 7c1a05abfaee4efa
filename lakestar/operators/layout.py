"""The order of rows inside a table, so that file statistics leave out what a filter doesn't want."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.operators.dedupe import ROWS_PER_FILE

#: Bits of each of the two keys in a code.
BITS = 31


def _number(field: T.StructField) -> Column:
    """A column whose order is that of a double."""
    forms = {T.DateType: F.unix_date, T.TimestampType: F.unix_micros}
    if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        return F.col(field.name).cast("double")
    if type(field.dataType) in forms:
        return forms[type(field.dataType)](F.col(field.name)).cast("double")
    raise ValueError(f"{field.name} is neither a number nor a time")


def _apart(code: Column) -> Column:
    """The bits of a number below 2^31 with a free place before each: halves are moved apart, then their halves."""
    for places in (16, 8, 4, 2, 1):
        mask = sum(((1 << places) - 1) << start for start in range(0, 64, 2 * places))
        code = code.bitwiseOR(F.shiftleft(code, places)).bitwiseAND(F.lit(mask))
    return code


def morton_code(first: Column, second: Column) -> Column:
    """Two numbers from 0 to 2^31 - 1, their bits in turn: rows near in both are near in the code."""
    return F.shiftleft(_apart(first.cast("bigint")), 1).bitwiseOR(_apart(second.cast("bigint")))


def scaled(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Each column from its smallest to its largest value as 0 to 2^31 - 1, in order; nulls and NaN are 0.

    The bounds are two numbers a column, found in one pass over these columns alone.
    """
    numbers = [_number(df.schema[c]) for c in columns]
    finite = [F.when(n.between(-1.7e308, 1.7e308), n) for n in numbers]
    bounds = df.agg(*[f(n).alias(f"{name}{i}") for i, n in enumerate(finite) for name, f in (("low", F.min), ("high", F.max))]).first()
    codes = []
    for i, number in enumerate(numbers):
        low, high = bounds[f"low{i}"], bounds[f"high{i}"]
        if low is None or low == high:
            codes.append(F.lit(0).cast("bigint"))
            continue
        # Halves, as the distance of two doubles may be more than a double holds.
        share = (number / 2 - low / 2) / (high / 2 - low / 2)
        place = F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * ((1 << BITS) - 1))
        codes.append(F.when(number.isNull() | F.isnan(number), F.lit(0)).otherwise(place).cast("bigint"))
    return codes


def clustered(df: DataFrame, by: Sequence[str], keys: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` laid out for a write partitioned ``by`` some columns, inside which rows follow the Morton code
    of two ``keys``, numbers or times.

    One shuffle by ranges: a task takes neighbouring small values of ``by``, and a value with many rows is
    split by the code, equal codes by the row's hash, so no task has to hold what many rows share. Spark
    looks at the rows for their bounds, their number and the ranges before it moves them: give a stored frame.
    """
    if len(keys) != 2:
        raise ValueError("rows are clustered by two keys")
    code = morton_code(*scaled(df, keys))
    tasks = max(1, -(-df.count() // rows_per_file))
    tasks = max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.withColumn("_code", code).repartitionByRange(tasks, *by, "_code", F.xxhash64(*df.columns))
    return ranged.sortWithinPartitions(*by, "_code").drop("_code")
