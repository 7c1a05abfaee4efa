import pytest
from pyspark.sql import functions as F

from lakestar.operators import registered_key
from lakestar.operators.registry import read_registry
from lakestar.sinks.batches import batches
from support import rows

KIND = "name string, code int"


def keyed(spark, data, lake, **options):
    df = spark.createDataFrame(data, KIND).repartition(3)
    return {(r.name, r.code): r.sk for r in registered_key(df, "sk", lake, ["name", "code"], **options).collect()}


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_keys_survive(spark, lake, limit):
    first = keyed(spark, [("b", 1), ("d", 1), (None, 1), ("b", None)], lake, max_broadcast_bytes=limit)
    assert sorted(first.values()) == [1, 2, 3, 4]
    again = keyed(spark, [("d", 1), ("a", 1), (None, None), (None, 1)], lake, max_broadcast_bytes=limit)
    assert {k: again[k] for k in (("d", 1), (None, 1))} == {k: first[k] for k in (("d", 1), (None, 1))}
    assert sorted(again[k] for k in (("a", 1), (None, None))) == [5, 6]
    assert keyed(spark, [("b", 1), ("b", None)], lake) == {k: first[k] for k in (("b", 1), ("b", None))}  # gone and back
    assert len(batches(spark, lake)[0]) == 2  # nothing new, nothing written


def test_rows_of_one_natural_key_share_it(spark, lake):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], KIND)
    assert rows(registered_key(df.withColumn("sk", F.lit("old")), "sk", lake, ["name"]).select("name", "sk")) == [("a", 1), ("a", 1), ("b", 2)]


def test_a_broken_batch_does_not_count(spark, lake):
    first = keyed(spark, [("a", 1)], lake)
    broken = spark.createDataFrame([("b", 1, 77)], f"{KIND}, sk bigint")
    broken.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{lake}/batch-000001")
    second = keyed(spark, [("a", 1), ("b", 1)], lake)
    assert second == {**first, ("b", 1): 2}
    assert rows(read_registry(spark, lake, f"{KIND}, sk bigint")) == [("a", 1, 1), ("b", 1, 2)]


def test_no_rows(spark, lake):
    assert keyed(spark, [], lake) == {} and batches(spark, lake)[0] == []


def test_published_star_keeps_its_keys(spark, lake):
    from lakestar.plans import gold

    kind = "id smallint, dataInicio date, dataFim date"
    before = spark.sql("select cast(id as smallint) as id, date'2000-01-01' as dataInicio, date'2003-12-31' as dataFim from range(50, 55)")
    first = rows(gold.dim_legislature(before, lake))
    more = before.unionByName(spark.createDataFrame([(1, None, None)], kind))
    second = rows(gold.dim_legislature(more, lake))
    assert set(first) < set(second) and sorted(r[3] for r in second) == [1, 2, 3, 4, 5, 6]
    assert rows(gold.dim_legislature(more)) != second  # numbered anew, the early one comes first
