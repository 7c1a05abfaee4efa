"""Runs queries in Spark and their SQL in DuckDB and compares rows: python -m checks.compare [sf] [names]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _normal(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    text = df.astype(object).where(df.notna(), None).map(lambda v: None if v is None else _text(v))
    return sorted(map(tuple, text.itertuples(index=False)), key=repr)


def _text(value: object) -> str:
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    if hasattr(value, "date") and hasattr(value, "hour"):
        return str(value.date()) if not (value.hour or value.minute or value.second) else str(value)
    return str(value)


def difference(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} / {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    a, b = _normal(spark_rows), _normal(sql_rows)
    return next((f"{x} / {y}" for x, y in zip(a, b) if x != y), None)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    sf_dir = str(Path("/root/testdata") / f"sf{sf}")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = oracle(sf_dir)
    for name in names:
        try:
            _check(spark, db, sf_dir, name)
        except Exception as error:  # the others are still worth a run
            print(f"{name:28} FAILED {str(error)[:1500]}", flush=True)


def _check(spark: SparkSession, db: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> None:
    begun = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.toPandas()
    spent = time.time() - begun
    if name not in ORACLES:
        print(f"{name:28} no SQL {len(rows):8} rows {spent:6.1f} s", flush=True)
        return
    answer = db.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    wrong = difference(rows, answer.df())
    shown = {f.name: (f.dataType.simpleString(), types.get(f.name)) for f in df.schema.fields}
    print(f"{name:28} {'ok' if wrong is None else 'DIFFERS'} {len(rows):8} rows {spent:6.1f} s {wrong or ''}", flush=True)
    print("    ", {k: v for k, v in shown.items() if not _alike(*v)} or "", flush=True)


# Type names of the two engines that mean the same.
SAME_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "date": "DATE",
}


def _alike(spark_type: str, sql_type: str | None) -> bool:
    return SAME_TYPES.get(spark_type, spark_type.upper()) == (sql_type or "").replace(" ", "")


if __name__ == "__main__":
    main()
