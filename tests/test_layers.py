"""The jobs from landed pages to the star schema."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import openers, proxies
from support import SF, plan, rows
from lakestar.plans import gold, silver
from lakestar.plans.ingest import ingest_details, landed_pages, list_starts, requested_pages
from lakestar.plans.pipeline import STEPS, Config, build_gold, build_silver, ingest_expenses, run_all
from lakestar.session import materialize, scratch_path
from lakestar.sources import fan_out, schemas

TABLES = ("legislature", "party", "deputy", "expense_type", "provider", "fact")


@pytest.fixture(scope="module")
def config(spark):
    lost = F.regexp_extract("uri", r"^api/deputados/(\d+)/despesas", 1).try_cast("int") % 37 == 0
    pages = materialize(proxies.api_pages(spark, SF).filter(~F.coalesce(lost, F.lit(False))), "pages")
    return Config(
        scratch_path(spark, "lake"),
        "api",
        landed_pages(pages),
        only_of_legislature=None,
        region=None,
        expense_mode="replace_partitions",
    )


@pytest.fixture(scope="module")
def star(spark, config):
    return run_all(spark, config)


def test_six_steps():
    assert len(STEPS) == 6


def test_keys_point_at_stored_rows(spark, star):
    fact = star.read(spark, "fact")
    for name, sk in (
        ("deputy", "sk_deputado"),
        ("legislature", "sk_legislatura"),
        ("expense_type", "sk_tipo_despesa"),
        ("provider", "sk_fornecedor"),
    ):
        dim = star.read(spark, name)
        assert dim.count() == dim.select(sk).distinct().count()
        orphans = fact.filter(fact[sk].isNotNull()).join(dim, sk, "left_anti")
        assert orphans.count() == 0, name
    deputies = star.read(spark, "deputy")
    assert deputies.filter("sk_partido is not null").join(star.read(spark, "party"), "sk_partido", "left_anti").count() == 0


def test_fact_has_every_expense_once(spark, config, star):
    expenses = spark.read.parquet(f"{config.layer('silver_layer')}/expenses_data")
    fact = star.read(spark, "fact")
    assert fact.count() == expenses.count() == fact.select("sk_despesa").distinct().count()


def test_missing_first_pages_are_in_quarantine(spark, config, star):
    lost = spark.read.parquet(f"{config.layer('quarantine')}/expenses_data")
    spenders = {r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_custkey").distinct().collect()}
    listed = {r[0] for r in spark.read.parquet(f"{config.layer('bronze_layer')}/deputies_data").select("id").collect()}
    assert listed == spenders
    assert {r.reason for r in lost.collect()} == {"missing"}
    assert {int(r.uri.split("/")[2]) for r in lost.collect()} == {i for i in spenders if i % 37 == 0}


def test_rerun_changes_nothing(spark, config, star):
    before = {name: rows(star.read(spark, name)) for name in TABLES}
    ingest_expenses(spark, config)
    build_silver(spark, config)
    again = build_gold(spark, config)
    assert {name: rows(again.read(spark, name)) for name in TABLES} == before


def test_filters_of_the_expense_job(spark, config, star):
    from dataclasses import replace

    narrow = replace(config, root=scratch_path(spark, "narrow"), only_of_legislature=57, region="BUILDING")
    deputies = spark.read.parquet(f"{config.layer('bronze_layer')}/deputies_data")
    deputies.write.parquet(f"{narrow.layer('bronze_layer')}/deputies_data")
    ingest_expenses(spark, narrow)
    found = spark.read.parquet(f"{narrow.layer('bronze_layer')}/expenses_data").select("id_deputado").distinct()
    wanted = deputies.filter("ultimoStatus.idLegislatura = 57 and ultimoStatus.siglaUf = 'BUILDING'")
    assert 0 < found.count() <= wanted.count()
    assert found.join(wanted, found.id_deputado == wanted.id, "left_anti").count() == 0


def test_fact_is_built_without_a_shuffle(spark, config, star):
    expenses = spark.read.parquet(f"{config.layer('silver_layer')}/expenses_data")
    links = gold.fact_links(star.read(spark, "deputy"), star.read(spark, "legislature"))
    text = plan(gold.fact_expense(expenses, links))
    assert "Exchange hashpartitioning" not in text and "SinglePartition" not in text
    assert text.count("BroadcastHashJoin") == 2
    assert "Python" not in text


def test_scans_read_only_what_they_need(spark, config, star):
    expenses = spark.read.parquet(f"{config.layer('silver_layer')}/expenses_data")
    assert "ReadSchema: struct<tipoDespesa:string>" in plan(gold.dim_expense_type(expenses))
    deputies = spark.read.parquet(f"{config.layer('bronze_layer')}/deputies_data")
    from lakestar.operators import filter_equal

    wanted = filter_equal(deputies, {"ultimoStatus.idLegislatura": 57, "ultimoStatus.siglaUf": "PR"}).select("id")
    text = plan(wanted)
    assert "ReadSchema: struct<id:bigint,ultimoStatus:struct<siglaUf:string,idLegislatura:int>>" in text
    assert "PushedFilters: [IsNotNull(ultimoStatus.idL" in text and "EqualTo(ultimoStatus.idL" in text


def test_silver_deputy_does_not_depend_on_partitioning(spark):
    people = proxies.deputies(spark, SF)
    assert rows(silver.silver_deputy(people.repartition(3))) == rows(silver.silver_deputy(people.repartition(7)))


def test_both_page_sources_and_any_chunks_give_the_same_parties(spark):
    shelf = scratch_path(spark, "shelf")
    found = []
    for per_request in (2, 100):
        pages = materialize(proxies.party_pages(spark, SF, 10, per_request), "pages")
        client = openers.shelve(pages, f"{shelf}/{per_request}")
        sources = (landed_pages(pages), requested_pages(client, parallelism=4))
        starts = list_starts(proxies.legislatures(spark, SF), "api/partidos", "id", 54, "idLegislatura", {"itens": 10}, per_request)
        for source in sources:
            path = scratch_path(spark, "parties")
            ingest_details(starts, source, schemas.PARTY_REFERENCE, schemas.PARTY, path)
            found.append(rows(spark.read.parquet(path).select("id", "sigla", "nome", "uri")))
    assert found[0] and all(f == found[0] for f in found)


def test_details_are_read_once(spark):
    """Also beside members too many to broadcast, whose join counts the ids of the details before it."""
    pages = landed_pages(materialize(proxies.deputy_pages(spark, SF), "pages"))
    starts = list_starts(proxies.legislatures(spark, SF), "api/deputados", "id", 54, "idLegislatura", {"itens": 100})
    membership, found = (["id", "uri"], "idLegislatura", "legislaturas"), []
    for options in ({}, {"max_broadcast_bytes": -1}):
        read = spark.sparkContext.accumulator(0)

        def seen(uri, read=read):
            read.add("?" not in uri)
            return True

        def source(starts):
            walk = pages(starts)
            return replace(walk, pages=walk.pages.filter(F.udf(seen, "boolean").asNondeterministic()("uri")))

        path = scratch_path(spark, "details")
        ingest_details(starts, source, schemas.DEPUTY_REFERENCE, schemas.DEPUTY, path, membership, **options)
        found.append(rows(spark.read.parquet(path)))
        assert read.value == len(found[0]) > 0
    assert found[0] == found[1]


def test_a_named_expense_run_is_added_once(spark, config, star):
    from dataclasses import replace

    named = replace(config, root=scratch_path(spark, "named"), expense_mode="append", expense_run="quarter-1")
    spark.read.parquet(f"{config.layer('bronze_layer')}/deputies_data").write.parquet(f"{named.layer('bronze_layer')}/deputies_data")
    for _ in range(2):
        ingest_expenses(spark, named)
    found, once = (spark.read.parquet(f"{c.layer('bronze_layer')}/expenses_data") for c in (named, config))
    assert rows(found.drop("run_id").select(*once.columns)) == rows(once)
    with pytest.raises(ValueError, match="named run"):
        ingest_expenses(spark, replace(named, expense_mode="overwrite"))


def test_a_shelf_reads_few_rows_for_a_page_by_a_path_with_a_scheme(spark, monkeypatch):
    monkeypatch.setattr(openers, "GROUP_BYTES", 32 * 1024)
    pages = spark.range(20_000).selectExpr("concat('api/', id) as uri", "cast(200 + id % 3 as int) as status", "repeat(uuid(), 3) as body")
    place = "file://" + scratch_path(spark, "shelf").removeprefix("file:")
    pages = materialize(pages, "pages")
    client = openers.shelve(pages, place)
    asked = pages.filter("uri like '%77'").collect()
    with client() as open_page:
        assert [open_page(r.uri, None) for r in asked] == [(r.status, r.body) for r in asked]
        assert open_page("api/none", None) == (404, None) and open_page("", None) == (404, None)
        kept = dict(zip(open_page.__code__.co_freevars, (c.cell_contents for c in open_page.__closure__)))["kept"]
        assert len(kept) <= openers.KEPT_GROUPS and max(len(g) for g in kept.values()) < 1000


def test_neighbouring_addresses_lie_and_are_asked_for_together(spark):
    """Files of a shelf hold ranges of addresses, and a task asks in their order."""
    pages = spark.range(3000).selectExpr("concat('api/', id) as uri", "200 as status", "'{\"dados\": []}' as body")
    place = scratch_path(spark, "shelf")
    client = openers.shelve(pages, place)
    files = spark.read.parquet(place).groupBy(F.input_file_name().alias("f")).agg(F.min("uri").alias("low"), F.max("uri").alias("high"))
    ends = sorted((r.low, r.high) for r in files.collect())
    assert len(ends) > 1 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    asked = fan_out(pages.select("uri"), client, parallelism=4).select(F.spark_partition_id().alias("p"), "start_uri", "status").collect()
    assert len(asked) == 3000 and {r.status for r in asked} == {200}
    for task in {r.p for r in asked}:
        own = [r.start_uri for r in asked if r.p == task]
        assert own == sorted(own)
