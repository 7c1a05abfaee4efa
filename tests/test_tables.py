from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from support import plan, rows
from lakestar.session import materialize, shared_dir, store
from lakestar.sinks import persisted, tables, write_table
from lakestar.sources import read_entity

COPIES = {"y1": "y"}


def _data(spark):
    return spark.range(100).selectExpr("id", "cast(2000 + id % 4 as int) as y")


def test_overwrite_and_read_pruned(spark, lake):
    write_table(_data(spark), f"{lake}/t", options={"compression": "gzip"})
    write_table(_data(spark).limit(10), f"{lake}/t")
    assert read_entity(spark, lake, "t", ["id"]).columns == ["id"]
    assert read_entity(spark, lake, "t").count() == 10


def test_copies_stay_in_the_files_and_months_are_pruned(spark, lake):
    write_table(_data(spark), lake, partition_copies=COPIES)
    stored = spark.read.parquet(lake)
    assert rows(stored.select("id", "y")) == rows(_data(spark))
    one = stored.filter("y1 = 2001")
    assert one.count() == 25
    assert "PartitionFilters: [isnotnull(y1" in plan(one)


def test_append_repeats_and_replace_does_not(spark, lake):
    for _ in range(2):
        write_table(_data(spark), f"{lake}/a", "append", partition_copies=COPIES)
        write_table(_data(spark), f"{lake}/r", "replace_partitions", partition_copies=COPIES)
    assert spark.read.parquet(f"{lake}/a").count() == 200
    assert rows(spark.read.parquet(f"{lake}/r").select("id", "y")) == rows(_data(spark))
    write_table(_data(spark).filter("y = 2001").limit(1), f"{lake}/r", "replace_partitions", partition_copies=COPIES)
    assert spark.read.parquet(f"{lake}/r").count() == 76


def test_input_is_not_overwritten(spark, lake):
    write_table(_data(spark), f"{lake}/t", partition_copies=COPIES)
    write_table(_data(spark), f"{lake}/t2")
    stored = spark.read.parquet(f"{lake}/t")
    for mode in ("overwrite", "replace_partitions"):
        with pytest.raises(ValueError, match="read by"):
            write_table(stored.filter("id > 5").drop("y1"), f"{lake}/t", mode, partition_copies=COPIES)
    write_table(spark.read.parquet(f"{lake}/t2"), f"{lake}/t3")
    assert stored.count() == 100


def test_wrong_modes(spark, lake):
    with pytest.raises(ValueError):
        write_table(_data(spark), lake, "other")
    with pytest.raises(ValueError):
        write_table(_data(spark), lake, "replace_partitions")


def test_a_hot_partition_is_split_and_small_ones_share(spark, lake, with_conf):
    with_conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    hot = spark.range(200_000, numPartitions=8).selectExpr("id", "uuid() as text", "if(id % 3 = 0, 2000, 2001 + id % 5) as y")
    write_table(hot, lake, partition_copies=COPIES)
    stored = spark.read.parquet(lake)
    files = stored.select("y", F.input_file_name().alias("f")).distinct().groupBy("y").count()
    count = {r.y: r["count"] for r in files.collect()}
    assert stored.count() == 200_000
    assert count[2000] > 1


def test_format_pass_through(spark, lake):
    write_table(_data(spark), lake, fmt="orc")
    assert read_entity(spark, lake.rsplit("/", 1)[0], lake.rsplit("/", 1)[1], fmt="orc").count() == 100


def test_store_observes_rows_and_bytes(spark):
    stored = store(_data(spark), "x")
    assert stored.rows == 100 and stored.size_bytes == 100 * (32 + 16 + 16)
    empty = store(_data(spark).filter("id < 0"), "x")
    assert (empty.rows, empty.size_bytes) == (0, 0)
    assert materialize(_data(spark), "x").inputFiles()[0].startswith("file:")
    assert shared_dir(spark) in stored.df.inputFiles()[0].replace("file://", "")


def test_shared_dir_is_the_clusters():
    def session(named, master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: named), sparkContext=context)

    assert shared_dir(session("/shared/by/cluster/", "yarn")) == "/shared/by/cluster"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"))


def test_persisted_releases(spark):
    df = spark.range(3).toDF("persisted_id")
    with pytest.raises(RuntimeError):
        with persisted(df) as (kept,):
            assert kept.is_cached
            raise RuntimeError
    assert not df.is_cached


def test_own_input_is_told_by_whole_paths(spark, lake):
    write_table(_data(spark), f"{lake}/t/part")
    read = spark.read.parquet(f"{lake}/t/part")
    for own in (f"{lake}/t/part", f"file:{lake}/t/part/", f"{lake}/t", f"{lake}/t/other/../part", f"{lake}/t/part/y=1"):
        with pytest.raises(ValueError, match="is read by"):
            write_table(read.filter("id > 5").join(_data(spark), "id"), own)
    write_table(read, f"{lake}/t/party")


def test_two_buckets_are_not_one(spark):
    one = tables._qualified(spark.range(1), "s3a://one/lake/x")
    assert one != tables._qualified(spark.range(1), "s3a://two/lake/x")
    assert one == tables._qualified(spark.range(1), "s3a://one/lake/y/../x/")
    assert tables._qualified(spark.range(1), "/lake/x") == "file:///lake/x"
