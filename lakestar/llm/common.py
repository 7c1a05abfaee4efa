"""Tables in the shared folder that cut a lineage, and what several operators need."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestar.operators.joins import lookup_join
from lakestar.session import scratch_path, ship, store

# Fixed value: a run of characters between the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of a file, where a table's rows are bounded beforehand.
ROWS_PER_FILE = 250_000


class Written:
    """A frame stored in the shared folder, with figures taken while it was written.

    ``most`` bounds the rows, if that is known, and with them the files.
    """

    def __init__(self, df: DataFrame, label: str, most: int | None = None, **figures: Column):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in figures.items()))
        if most is not None:
            observed = observed.coalesce(1 + most // ROWS_PER_FILE)
        observed.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        self.figures = seen.get

    @property
    def rows(self) -> int:
        return self.figures["rows"]

    def drop(self) -> None:
        """For tables that no returned frame reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    return Written(df, label).df


def parts(spark: SparkSession, rows: int = 0, per_part: int = 1_000_000) -> int:
    """Hash buckets for a step over so many rows: the session's count at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def task(fn: Callable, groups: int = 1) -> Callable:
    """``fn`` for workers that may run without this repository; ``groups`` are its arguments.

    The package is shipped to them as an archive (:func:`lakestar.session.ship`); ``fn`` is unpacked
    there, when its modules can be found.
    """
    ship(SparkSession.getActiveSession())
    packed = cloudpickle.dumps(fn)

    def one(first):
        import pickle

        return pickle.loads(packed)(first)

    def two(first, second):
        import pickle

        return pickle.loads(packed)(first, second)

    return two if groups == 2 else one


def looked_up(left: DataFrame, right: DataFrame, on: dict[str, str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """``left`` with the columns of ``right``, which is stored and measured: broadcast if it is small, or
    shuffled with the hot keys of ``left`` salted. Column names have to differ."""
    kept = store(right, "side")
    return lookup_join(left, kept.df, on, how, null_safe, profile=kept)


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The rows of each run of equal keys, from rows that are sorted by them; one run is held at a time."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[c].to_numpy() for c in keys]
        starts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for begin, end in zip([0, *starts], [*starts, batch.num_rows]):
            this = tuple(c[begin] for c in columns)
            if this != key and held:
                yield pa.Table.from_batches(held)
                held = []
            key = this
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def dealt(members: DataFrame, key: str, node: str, size: str, block: int) -> DataFrame:
    """Rows for every pair of blocks of a group, as ``low`` and ``high`` beside the row's own ``block``.

    A group of ``size`` rows above ``block`` is split by a hash; each row goes to as many pairs as
    there are blocks, so that any two rows of the group meet in a task.
    """
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = members.withColumn("block", F.pmod(F.xxhash64(node, key), blocks).cast("int"))
    each = own.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return each.withColumns({"low": F.least("block", "with"), "high": F.greatest("block", "with")}).drop("with", size)
