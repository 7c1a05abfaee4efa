import random

import pyarrow.parquet as pq
import pytest

from checks import queries
from lakestar.operators import bucketed_join, morton_code, open_bucketed, write_bucketed
from lakestar.operators.layout import scaled
from lakestar.sinks import write_table
from pyspark.sql import functions as F
from support import SF, plan, rows

COPIES = {"y1": "y"}


def test_codes_interleave_bits(spark):
    rng = random.Random(5)
    edges = [0, 1, 2, 2**30, 2**31 - 1]
    pairs = [(a, b) for a in edges for b in edges] + [(rng.randrange(2**31), rng.randrange(2**31)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", morton_code(F.col("a"), F.col("b")).alias("code"))
    for a, b, code in df.collect():
        assert code == int("".join(x + y for x, y in zip(f"{a:031b}", f"{b:031b}")), 2)


def test_scaling_keeps_the_order(spark):
    values = [None, float("nan"), float("-inf"), -1.5e308, -3.0, 0.0, 2.0, 1.5e308, float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = [r[0] for r in df.select(scaled(df, ["v"])[0], "i").orderBy("i").collect()]
    assert found[:4] == [0, 0, 0, 0] and found[3:] == sorted(found[3:]) and found[-1] == found[-2] == 2**31 - 1
    assert [r[0] for r in df.limit(0).select(scaled(df.limit(0), ["v"])[0]).collect()] == []
    same = spark.sql("select date'2020-01-01' as d")
    assert same.select(scaled(same, ["d"])[0]).first()[0] == 0
    with pytest.raises(ValueError, match="neither"):
        scaled(spark.sql("select 'x' as t"), ["t"])


def groups_in_reach(spark, path, column, value):
    """Row groups whose statistics may hold the value, and all."""
    reached = total = 0
    for file in spark.read.parquet(path).inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file://")).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            seen = meta.row_group(g).column(at).statistics
            total += 1
            reached += seen.min <= value <= seen.max
    return reached, total


def test_a_filter_on_either_key_reads_fewer_row_groups(spark, lake):
    data = spark.range(400_000).selectExpr("xxhash64(id) % 1000 as k", "xxhash64(id, 1) % 100000 as v", "cast(2000 + id % 2 as int) as y", "id")
    data.write.parquet(f"{lake}/in")
    data = spark.read.parquet(f"{lake}/in")
    small = {"parquet.block.size": str(64 * 1024), "parquet.page.size": "8192"}
    write_table(data, f"{lake}/plain", partition_copies=COPIES, options=small)
    write_table(data, f"{lake}/near", partition_copies=COPIES, options=small, cluster_by=["k", "v"])
    for column, value in (("k", 123), ("v", 4567)):
        plain, all_plain = groups_in_reach(spark, f"{lake}/plain", column, value)
        near, all_near = groups_in_reach(spark, f"{lake}/near", column, value)
        assert plain == all_plain > 8 and near < all_near / 2
    near = spark.read.parquet(f"{lake}/near").select(*data.columns)
    assert near.count() == data.count() and near.exceptAll(data).isEmpty()
    with pytest.raises(ValueError, match="two keys"):
        write_table(data, f"{lake}/x", cluster_by=["k"])


def test_a_value_with_most_rows_is_split(spark, lake):
    """All rows in one month and under one pair of keys."""
    spark.range(40_000).selectExpr("id", "1L as k", "cast(null as double) as v", "2000 as y").write.parquet(f"{lake}/in")
    write_table(spark.read.parquet(f"{lake}/in"), f"{lake}/t", partition_copies=COPIES, cluster_by=["k", "v"])
    stored = spark.read.parquet(f"{lake}/t")
    sizes = [r["count"] for r in stored.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 12_000


def test_clustered_rows_are_made_distinct_month_by_month(spark, monkeypatch, with_conf):
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    kept, whole = [], queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, label: kept.append(whole(df, label)) or kept[-1])
    written = queries.clustered_round_trip(spark, SF)
    named = kept[0].select("ano", "mes", F.input_file_name().alias("file")).distinct()
    lies = named.groupBy("ano", "mes").agg(F.count("file").alias("files"))
    assert {r["files"] for r in lies.collect()} == {1}
    assert written.count() == kept[0].count() == kept[0].distinct().count()


def sides(spark, lake, name, rows_per_task=50):
    rng = random.Random(3)
    left = [(i, "hot", 1) for i in range(300)] + [(300 + i, None, 1) for i in range(100)] + [(400 + i, f"k{rng.randrange(60)}", rng.randrange(2)) for i in range(400)]
    right = [("hot", 1, 7), (None, 1, 8), *[(f"k{i}", 0, 100 + i) for i in range(40)], *[("k1", 0, 999)]]
    a = spark.createDataFrame(left, "id int, a string, b int")
    b = spark.createDataFrame(right, "x string, y int, sk int")
    one = write_bucketed(a, f"{name}_left", f"{lake}/left", ["a", "b"], rows_per_task=rows_per_task)
    two = write_bucketed(b, f"{name}_right", f"{lake}/right", ["x", "y"], one.buckets, split=False)
    return left, right, one, two


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("limit", [10**9, -1])
def test_bucketed_join_against_brute_force(spark, lake, how, limit):
    left, right, one, two = sides(spark, lake, f"brute_{how}_{limit + 1}")
    expected = []
    for row in left:
        found = [r for r in right if r[:2] == row[1:] and None not in r[:2]]
        expected += [(*row, *r) for r in found] or ([(*row, None, None, None)] if how == "left" else [])
    assert rows(one.df) == sorted(left, key=repr)
    assert {r.a for r in one.set_apart.collect()} == {"hot", None} and one.in_buckets.filter("a = 'hot'").count() == 0
    joined = bucketed_join(one, two, {"a": "x", "b": "y"}, how, limit)
    assert rows(joined) == sorted(expected, key=repr)


def test_buckets_are_joined_without_a_shuffle(spark, lake, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    _, _, one, two = sides(spark, lake, "plan")
    joined = bucketed_join(one, two, {"a": "x", "b": "y"})
    text = plan(joined)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text
    kept, schema = rows(joined), one.in_buckets.schema.simpleString()
    spark.sql("drop table plan_left")
    ddl = ", ".join(f"`{c}` {t}" for c, t in spark.createDataFrame([], "id int, a string, b int").dtypes)
    again = open_bucketed(spark, "plan_left", f"{lake}/left", ddl, ["a", "b"], one.buckets)
    assert again.in_buckets.schema.simpleString() == schema
    assert rows(bucketed_join(again, two, {"a": "x", "b": "y"})) == kept
    assert "Exchange hashpartitioning" not in plan(bucketed_join(again, two, {"a": "x", "b": "y"}))


def test_a_low_bound_for_frequent_keys_makes_no_more_buckets(spark, lake):
    df = spark.range(4000).selectExpr("id % 1000 as k", "id as v")
    assert write_bucketed(df, "low_bound", f"{lake}/low", ["k"], rows_per_task=10).buckets == 8
    more = write_bucketed(df, "more_buckets", f"{lake}/more", ["k"], rows_per_task=10, rows_per_bucket=100)
    assert more.buckets == 40 and rows(more.df) == rows(df) and more.set_apart.isEmpty()


def test_sides_that_do_not_fit_are_refused(spark, lake):
    _, _, one, two = sides(spark, lake, "fit")
    other = write_bucketed(two.df, "fit_other", f"{lake}/other", ["x", "y"], one.buckets + 1, split=False)
    apart = write_bucketed(two.df, "fit_apart", f"{lake}/apart", ["x", "y"], one.buckets)
    for wrong, on in ((other, {"a": "x", "b": "y"}), (two, {"b": "y", "a": "x"}), (apart, {"a": "x", "b": "y"})):
        with pytest.raises(ValueError):
            bucketed_join(one, wrong, on)
    with pytest.raises(ValueError, match="how"):
        bucketed_join(one, two, {"a": "x", "b": "y"}, "outer")
