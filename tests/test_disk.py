"""What steps leave on disk: no shuffle files of finished steps, and small tables."""

import os
import time

import pytest
from pyspark.sql import functions as F

from support import SF, plan, rows
from checks import openers, queries
from lakestar.operators import Lookup, lookup_join
from lakestar.operators.joins import profile_lookup
from lakestar.operators.keys import assert_unique_key
from lakestar.plans import gold
from lakestar.plans.ingest import requested_pages
from lakestar.session import CODEC, materialize, shared_dir, store
from lakestar.sinks import write_table
from lakestar.sources import plain_client


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}


def _left(spark, step):
    """Shuffle files that are there after a step and were not before; they are removed beside the next steps."""
    before = _shuffle_files(spark)
    step()
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            return set()
        time.sleep(0.1)
    return _shuffle_files(spark) - before


def test_finished_steps_leave_no_shuffle_files(spark, lake, with_conf):
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    grouped = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    assert not _left(spark, lambda: store(grouped, "test"))
    assert not _left(spark, lambda: materialize(grouped, "test"))
    assert not _left(spark, lambda: write_table(grouped, lake, partition_copies={"k1": "k"}))
    assert not _left(spark, lambda: assert_unique_key(grouped, ["k"]))
    assert not _left(spark, lambda: profile_lookup(grouped, ["k"]))
    assert _left(spark, grouped.collect)  # that of the caller is the caller's
    assert rows(grouped) == [(k, 100) for k in range(10)]


def _codecs(path):
    return {name.split(".")[-2] for _, _, names in os.walk(path.removeprefix("file:")) for name in names if name.endswith(".parquet")}


def test_tables_have_a_codec_unless_one_is_named(spark, lake, with_conf):
    df = spark.range(10)
    stored = store(df, "test").path
    write_table(df, f"{lake}/own")
    write_table(df, f"{lake}/named", options={"compression": "snappy"})
    assert _codecs(stored) == _codecs(f"{lake}/own") == {CODEC} and _codecs(f"{lake}/named") == {"snappy"}
    with_conf(spark__sql__parquet__compression__codec="gzip")
    write_table(df, f"{lake}/session")
    assert _codecs(f"{lake}/session") == {"gz"}


def test_a_lookup_beyond_the_bound_is_shuffled_however_small_its_files_are(spark):
    """Spark would broadcast what compressed files make it take for small."""
    side = materialize(spark.range(1000).selectExpr("id as k", "id * 2 as v"), "side")
    left = spark.range(5000).selectExpr("id % 1200 as key")
    joined = lookup_join(left, side, {"key": "k"}, max_broadcast_bytes=-1)
    text = plan(joined)
    assert "SortMergeJoin" in text and text.count("BroadcastHashJoin") == 2  # those with the frequent keys
    assert rows(joined) == rows(left.join(side, F.col("key") == F.col("k"), "left"))


def _fact_parts(spark):
    expenses = spark.range(200).select(
        (F.col("id") % 7).alias("id_deputado"), F.lit("57").alias("id_legislatura"), F.lit(2024).alias("ano"), (F.col("id") % 3).cast("int").alias("mes"),
        F.current_timestamp().alias("data_documento"), F.lit("type").alias("tipoDespesa"), F.col("id").cast("decimal(18,2)").alias("valorDocumento"),
        F.concat(F.lit("doc/"), "id").alias("urlDocumento"), F.lit("name").alias("nomeFornecedor"), F.lit("tax").alias("cnpjCpfFornecedor"),
        F.col("id").cast("decimal(18,2)").alias("valorLiquido"), F.lit(0).cast("decimal(18,2)").alias("valorGlosa"),
    )
    deputies = materialize(spark.range(7).selectExpr("id", "id + 1 as sk_deputado"), "dim")
    legislatures = materialize(spark.range(1).selectExpr("57L as id", "1L as sk_legislatura"), "dim")
    return materialize(expenses, "silver"), deputies, legislatures


def test_the_facts_own_key_is_made_after_rows_were_laid_by_month(spark):
    expenses, deputies, legislatures = _fact_parts(spark)
    links = gold.fact_links(deputies, legislatures)
    laid = gold.fact_expense(expenses, links, lay_by=["ano", "mes"])
    above = plan(laid).split("REBALANCE")[0]
    assert "REBALANCE" in plan(laid) and "sha2" in above and "sha2" not in plan(laid).removeprefix(above)
    assert rows(laid) == rows(gold.fact_expense(expenses, links))


def test_links_that_move_the_fact_come_before_those_that_widen_it(spark, monkeypatch):
    expenses, deputies, legislatures = _fact_parts(spark)
    types = materialize(gold.dim_expense_type(expenses, "uuid"), "dim")
    plain = [Lookup(types, {"tipoDespesa": "tipoDespesa"}, "sk_tipo_despesa"), Lookup(legislatures, {"id_legislatura": "id"}, "sk_legislatura")]
    resolved, resolve = [], Lookup.resolve
    monkeypatch.setattr(Lookup, "resolve", lambda link, *frames: resolved.append(link.sk) or resolve(link, *frames))
    found = []
    for bound in (-1, 1 << 20):
        links = [*plain, Lookup(deputies, {"id_deputado": "id"}, "sk_deputado", max_broadcast_bytes=bound)]
        columns = {c: c for c in ("sk_despesa", "sk_tipo_despesa", "sk_deputado", "sk_legislatura", "valorDocumento")}
        found.append(rows(gold.fact_expense(expenses, links, columns)))
    assert resolved == ["sk_deputado", "sk_tipo_despesa", "sk_legislatura", "sk_tipo_despesa", "sk_legislatura", "sk_deputado"]
    assert found[0] == found[1] and len(found[0]) == 200


def test_keys_move_as_bytes(spark):
    """Of a hash and of uuids; the fact shows the hash's digits again."""
    expenses, deputies, legislatures = _fact_parts(spark)
    people = materialize(deputies.select("id", F.expr("uuid()").alias("sk_deputado")), "dim")
    types, providers = (materialize(dim(expenses), "dim") for dim in (gold.dim_expense_type, gold.dim_provider))
    fact = materialize(gold.fact_expense(expenses, gold.fact_links(people, legislatures)), "fact")
    moved = queries._key_bytes(fact, "sk_despesa", "sk_deputado", "sk_fornecedor")
    assert {c: t for c, t in moved.dtypes if c.startswith("sk_")} == {
        "sk_despesa": "binary", "sk_deputado": "binary", "sk_legislatura": "bigint", "sk_tipo_despesa": "bigint", "sk_fornecedor": "bigint"
    }
    assert moved.select(F.length("sk_despesa"), F.length("sk_deputado")).distinct().collect() == [(32, 16)]
    shown = queries._natural_fact(fact, people, legislatures, types, providers)
    own = fact.join(people, "sk_deputado").select("sk_despesa", "id")
    assert rows(shown.select("sk_despesa", "deputy")) == rows(own) and own.count() == 200


def test_the_looked_up_fact_is_stored_before_it_is_followed_back(spark):
    read = queries.QUERIES["fact_expense_looked_up"](spark, SF).inputFiles()
    assert any("/lakestar-fact-" in f for f in read) and not any("/lakestar-silver-" in f for f in read)


def _tables(spark, label):
    return {name for name in os.listdir(shared_dir(spark).removeprefix("file:")) if name.startswith(f"lakestar-{label}-")}


def test_landed_pages_go_once_they_are_indexed(spark):
    before = _tables(spark, "pages"), _tables(spark, "index")
    found = queries.QUERIES["bronze_expenses"](spark, SF)
    assert _tables(spark, "pages") == before[0] and len(_tables(spark, "index") - before[1]) == 1
    assert found.count() > 0


@pytest.mark.parametrize("name", ["layers_in_order", "layers_requested"])
def test_pages_go_once_they_are_in_bronze(spark, name):
    labels = ("pages", "index", "shelved", "shelf", "landing", "judged")
    before = [_tables(spark, label) for label in labels]
    found = queries.QUERIES[name](spark, SF)
    assert [_tables(spark, label) for label in labels] == before
    assert found.count() == 6000


def test_a_landing_folder_stays(spark, lake):
    source = requested_pages(plain_client(openers.open_numbered_page), landing=lake, params={"itens": 3})
    walk = source(spark.createDataFrame([("api/deputados/1/despesas?n=7",)], "uri string"))
    assert walk.pages.count() == 3
    source.drop()
    assert spark.read.parquet(f"{lake}/*").count() == 3
