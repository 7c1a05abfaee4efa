"""The driver's tables in the shapes of the bronze layer, with nulls, copies and orphans worked in.

Only checks and benchmarks use this module; ``FIXTURES.md`` tells which table stands for which entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.operators import lookup_join
from lakestar.plans.ingest import list_starts
from lakestar.session import materialize, store
from lakestar.sources.pages import DATA_FIELD, LINKS_FIELD, NEXT_RELATION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id_of(date: str) -> Column:
    return F.year(date) - 1940


def legislatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per order year, even years twice."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    number = F.col("y") - 1940
    repeated = years.withColumn("copy", F.explode(F.when(F.col("y") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return repeated.select(
        number.cast("smallint").alias("id"),
        F.concat(F.lit("api/legislaturas/"), number).alias("uri"),
        F.concat("y", F.lit("-01-01")).alias("dataInicio"),
        F.concat("y", F.lit("-12-31")).alias("dataFim"),
    )


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per nation."""
    nations = table(spark, sf_dir, "nation")
    joined = nations.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    status = F.struct(
        F.col("r_name").alias("situacao"),
        F.col("n_nationkey").cast("string").alias("totalPosse"),
        (F.col("n_nationkey") + 10).cast("string").alias("totalMembros"),
        F.struct(F.lower("n_name").alias("nome")).alias("lider"),
    )
    return joined.select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("sigla"),
        F.concat(F.lit("Party "), "n_name").alias("nome"),
        F.concat(F.lit("api/partidos/"), "n_nationkey").alias("uri"),
        status.alias("status"),
        F.concat(F.lit("logo/"), "n_nationkey").alias("urlLogo"),
    )


def deputies(spark: SparkSession, sf_dir: str, versions: bool = True) -> DataFrame:
    """One per customer; with ``versions`` every third also has an older status.

    Some have no party, some one that is no nation's: an orphan link.
    """
    people = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    last = F.array(F.lit("2024-02-01"))
    dates = F.when(key % 3 == 0, F.array(F.lit("2023-02-01"), F.lit("2024-02-01"))).otherwise(last) if versions else last
    people = people.withColumn("seen", F.explode(dates))
    older = F.col("seen") == "2023-02-01"
    born = (
        F.when(key % 13 == 0, "not a date")
        .when(key % 29 == 0, "")
        .otherwise(F.concat((1940 + key % 50).cast("string"), F.lit("-0"), (1 + key % 9).cast("string"), F.lit("-15")))
    )
    status = F.struct(
        F.lower("c_name").alias("nomeEleitoral"),
        F.when(key % 19 == 0, "NOWHERE").when(key % 17 != 0, F.col("n_name")).alias("siglaPartido"),
        F.col("c_mktsegment").alias("siglaUf"),
        F.when(older, 54).otherwise(55 + key % 8).cast("int").alias("idLegislatura"),
        F.concat(F.lit("foto/"), key).alias("urlFoto"),
        F.when(older, "was").otherwise("is").alias("situacao"),
        F.lit("Titular").alias("condicaoEleitoral"),
        F.col("seen").alias("data"),
    )
    return people.select(
        key.alias("id"),
        F.concat(F.lit("api/deputados/"), key).alias("uri"),
        F.col("c_name").alias("nomeCivil"),
        status.alias("ultimoStatus"),
        born.alias("dataNascimento"),
        F.lit(None).cast("string").alias("dataFalecimento"),
        F.col("n_name").alias("ufNascimento"),
        F.lower("n_name").alias("municipioNascimento"),
        F.col("c_mktsegment").alias("escolaridade"),
    )


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reference per order: deputy and legislature, which is missing now and then."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("api/deputados/"), "o_custkey").alias("uri"),
        F.when(F.col("o_orderkey") % 19 != 0, _id_of("o_orderdate")).alias("idLegislatura"),
    )


def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One per line item, every tenth order twice; orphan, unreadable and missing keys and times.

    A provider has two tax ids or none.
    """
    items = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    order, line, supplier = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")
    twice = F.when(order % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    items = items.withColumn("copy", F.explode(twice))
    legislature = (
        F.when(order % 97 == 0, "99").when(order % 101 == 0, "x").otherwise(_id_of("o_orderdate").cast("string"))
    )
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    withheld = F.when(line == 1, F.lit(10)).otherwise(F.lit(0)).cast("decimal(18,2)")
    time = F.concat(F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("T00:00:00"))
    return items.select(
        F.col("o_custkey").alias("id_deputado"),
        legislature.alias("id_legislatura"),
        F.year("l_shipdate").alias("ano"),
        F.month("l_shipdate").alias("mes"),
        F.col("o_orderpriority").alias("tipoDespesa"),
        F.when(order % 11 != 0, time).alias("dataDocumento"),
        F.concat_ws("-", order, line).alias("numDocumento"),
        amount.alias("valorDocumento"),
        F.when(order % 23 != 0, F.concat_ws("/", F.lit("doc"), order, line)).alias("urlDocumento"),
        F.col("s_name").alias("nomeFornecedor"),
        F.when(supplier % 7 != 0, F.concat(F.lit("TAX"), supplier, F.lit("-"), order % 2)).alias("cnpjCpfFornecedor"),
        (amount - withheld).cast("decimal(18,2)").alias("valorLiquido"),
        withheld.alias("valorGlosa"),
    )


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages ``uri, status, body``: a conversation is a chain, a turn is a page with one item.

    The item is a bare object for even conversations and an array for odd ones. Turn 1 is not found
    where 7 divides the conversation, and fails where 11 does.
    """
    turns = table(spark, sf_dir, "conversations")
    following = turns.select(
        F.col("conv_id").alias("next_conv"), (F.col("turn") - 1).alias("next_turn"), F.lit(True).alias("goes_on")
    )
    joined = turns.join(
        following, (F.col("conv_id") == F.col("next_conv")) & (F.col("turn") == F.col("next_turn")), "left"
    )
    item = F.struct("conv_id", "turn", "role", "text", F.length("text").alias("unused"))
    link = F.struct(
        F.lit(NEXT_RELATION).alias("rel"), F.concat_ws("/", F.col("conv_id"), F.col("turn") + 1).alias("href")
    )
    own = F.struct(F.lit("self").alias("rel"), F.concat_ws("/", "conv_id", "turn").alias("href"))
    links = F.when(F.col("goes_on"), F.array(own, link)).otherwise(F.array(own))
    lone = F.to_json(F.struct(item.alias(DATA_FIELD), links.alias(LINKS_FIELD)))
    many = F.to_json(F.struct(F.array(item).alias(DATA_FIELD), links.alias(LINKS_FIELD)))
    first_turn = F.col("turn") == 1
    status = F.when(first_turn & (F.col("conv_id") % 7 == 0), 404).when(
        first_turn & (F.col("conv_id") % 11 == 0), 503
    )
    return joined.select(
        F.concat_ws("/", "conv_id", "turn").alias("uri"),
        F.coalesce(status, F.lit(200)).alias("status"),
        F.when(F.col("conv_id") % 2 == 0, lone).otherwise(many).alias("body"),
    )


def odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per turn whose data is, by turns: an item, text, a number, an item and a number, an item
    and null, an item with text behind the body, or links that are none."""
    turns = table(spark, sf_dir, "conversations")
    item = F.to_json(F.struct("conv_id", "turn", "role", "text"))
    kinds = (
        F.concat(F.lit('{"dados": ['), item, F.lit("]}")),
        F.lit('{"dados": "xy"}'),
        F.lit('{"dados": 5}'),
        F.concat(F.lit('{"dados": [7, '), item, F.lit("]}")),
        F.concat(F.lit('{"dados": ['), item, F.lit(", null]}")),
        F.concat(F.lit('{"dados": '), item, F.lit("} trailing")),
        F.concat(F.lit('{"dados": ['), item, F.lit('], "links": ["x"]}')),
    )
    kind = (F.col("conv_id") + F.col("turn")) % len(kinds)
    body = F.element_at(F.array(*kinds), (kind + 1).cast("int"))
    return turns.select(F.concat_ws("/", "conv_id", "turn").alias("uri"), F.lit(200).alias("status"), body.alias("body"))


def conversation_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "conversations").filter("turn = 0")
    return first.select("conv_id", F.concat_ws("/", "conv_id", "turn").alias("uri")).distinct()


def _listed(items: DataFrame, page_size: int) -> DataFrame:
    """Landed list pages from ``first_uri, item``: about ``page_size`` items each, linked by ``next``."""
    counted = items.groupBy("first_uri").agg(F.ceil(F.count(F.lit(1)) / page_size).cast("int").alias("n_pages"))
    measured = store(counted, "sizes")
    sizes = measured.df
    slot = F.pmod(F.xxhash64(F.to_json("item")), "n_pages").cast("int").alias("page")
    # All references of a list share one address: a lookup that is broadcast, or salted.
    lookup = sizes.withColumnRenamed("first_uri", "_uri")
    sized = lookup_join(items, lookup, {"first_uri": "_uri"}, "inner", profile=measured)
    grouped = (
        sized.select("first_uri", slot, "item")
        .groupBy("first_uri", "page")
        .agg(F.collect_list("item").alias(DATA_FIELD))
    )
    slots = sizes.select("first_uri", "n_pages", F.explode(F.sequence(F.lit(0), F.col("n_pages") - 1)).alias("page"))
    pages = slots.join(grouped, ["first_uri", "page"], "left")

    def address(page: Column) -> Column:
        return F.when(page == 0, F.col("first_uri")).otherwise(F.concat("first_uri", F.lit("&pagina="), page + 1))

    link = F.struct(F.lit(NEXT_RELATION).alias("rel"), address(F.col("page") + 1).alias("href"))
    links = F.when(F.col("page") + 1 < F.col("n_pages"), F.array(link)).otherwise(F.filter(F.array(link), lambda _: F.lit(False)))
    body = F.to_json(F.struct(DATA_FIELD, links.alias(LINKS_FIELD)))
    return pages.select(address(F.col("page")).alias("uri"), F.lit(200).alias("status"), body.alias("body"))


def _details(items: DataFrame) -> DataFrame:
    """Landed detail pages: the lone item of each address."""
    item = F.struct(*items.columns)
    body = F.to_json(F.struct(item.alias(DATA_FIELD)))
    return items.select("uri", F.lit(200).alias("status"), body.alias("body"))


def _listed_by_ids(
    spark: SparkSession, sf_dir: str, endpoint: str, references: DataFrame, page_size: int, per_request: int = 100
) -> DataFrame:
    """List pages below the addresses that name the legislatures, a handful; each lists everything."""
    first = list_starts(
        legislatures(spark, sf_dir), f"api/{endpoint}", "id", 54, "idLegislatura", {"itens": page_size}, per_request
    )
    addresses = F.array(*[F.lit(r["uri"]) for r in first.collect()])
    items = references.select(F.explode(addresses).alias("first_uri"), F.struct(*references.columns).alias("item"))
    return _listed(items, page_size)


def legislature_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    bare = legislatures(spark, sf_dir).distinct()
    first = F.lit(f"api/legislaturas?itens={page_size}").alias("first_uri")
    return _listed(bare.select(first, F.struct(*bare.columns).alias("item")), page_size)


def party_pages(spark: SparkSession, sf_dir: str, page_size: int = 100, per_request: int = 100) -> DataFrame:
    party = parties(spark, sf_dir)
    listed = _listed_by_ids(spark, sf_dir, "partidos", party.select("id", "uri", "sigla"), page_size, per_request)
    return listed.unionByName(_details(party))


def deputy_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    members = materialize(memberships(spark, sf_dir).distinct(), "memberships")  # read twice
    listed = _listed_by_ids(spark, sf_dir, "deputados", members, page_size)
    return listed.unionByName(_details(deputies(spark, sf_dir, versions=False)))


def expense_pages(spark: SparkSession, sf_dir: str, page_size: int = 100, legislature: int = 57) -> DataFrame:
    """Expenses below their deputy's address, without the two keys the job adds."""
    spent = expenses(spark, sf_dir)
    own = [c for c in spent.columns if c not in ("id_deputado", "id_legislatura")]
    uri = F.concat(
        F.lit("api/deputados/"), "id_deputado", F.lit(f"/despesas?idLegislatura={legislature}&itens={page_size}")
    )
    return _listed(spent.select(uri.alias("first_uri"), F.struct(*own).alias("item")), page_size)


def api_pages(spark: SparkSession, sf_dir: str, page_size: int = 100) -> DataFrame:
    """Landed pages of all four entities, as the pipeline asks for them below the address ``api``."""
    kinds = (legislature_pages, party_pages, deputy_pages, expense_pages)
    return reduce(DataFrame.unionByName, [kind(spark, sf_dir, page_size) for kind in kinds])
