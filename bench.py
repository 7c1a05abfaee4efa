"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The driver's tables are brought into bronze shapes once and stored, so that a figure is the operator's
own time. Beside it stands DuckDB's for the same result in SQL from the driver's tables, shapes included.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import proxies  # noqa: E402
from checks.compare import oracle  # noqa: E402
from checks.oracles import ORACLES  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from lakestar.session import materialize  # noqa: E402

HEADLINE = (
    "silver_expense",
    "silver_deputy",
    "collect_membership",
    "content_key_token",
    "sk_dense_properties",
    "fk_composite_nullsafe",
    "fk_composite_salted",
    "fact_keys",
    "fact_expense",
    "envelope_items",
    "follow_chain",
    "fan_out_items",
    "partitioned_round_trip",
    "replace_partitions",
    "star_publish",
)
RUNS = 2
SHAPES = ("legislatures", "parties", "deputies", "memberships", "expenses", "conversation_pages")


def stored(shape: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A shape that is written when it is first asked for, and read from then on."""
    kept: dict[tuple, DataFrame] = {}

    def read(spark: SparkSession, sf_dir: str, *more: object, **named: object) -> DataFrame:
        key = (sf_dir, more, tuple(named.items()))
        if key not in kept:
            kept[key] = materialize(shape(spark, sf_dir, *more, **named), "bench")
        return kept[key]

    return read


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for shape in SHAPES:
        setattr(proxies, shape, stored(getattr(proxies, shape)))
    best: dict[str, float] = {}
    other: dict[str, float] = {}
    db = oracle(sf_dir)
    for name in names:
        QUERIES[name](spark, sf_dir).limit(1).count()  # stores the shapes
        if name in ORACLES:
            begun = time.perf_counter()
            db.execute(ORACLES[name]).fetchall()
            other[name] = round(time.perf_counter() - begun, 3)
        for _ in range(RUNS):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent = round(time.perf_counter() - begun, 3)
            best[name] = min(best.get(name, spent), spent)
    scale = Path(sf_dir).name.removeprefix("sf")
    total = round(sum(best.values()), 3)
    print(json.dumps({"metric": "headline queries, best of 2", "value": total, "unit": "sec", "queries": best, "sf": scale, "duckdb": other}))
    spark.stop()


if __name__ == "__main__":
    main()
