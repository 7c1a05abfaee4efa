"""One query per operator and job, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import openers, proxies
from lakestar.functions import parse_date, parse_timestamp
from lakestar.operators import (
    Lookup,
    bucketed_join,
    collect_distinct,
    content_key,
    copy_columns,
    dedupe,
    dimension_from_fact,
    drop_columns,
    filter_equal,
    filter_gt,
    join_members,
    registered_key,
    rename,
    resolve_fk,
    surrogate_key,
    with_column,
    write_bucketed,
)
from lakestar.plans import gold, silver
from lakestar.plans.incremental import rebuild_changed
from lakestar.plans.ingest import (
    PageSource,
    ingest_children,
    ingest_details,
    ingest_list,
    landed_pages,
    list_starts,
    requested_pages,
)
from lakestar.plans.pipeline import Config, run_all
from lakestar.session import drop_table, materialize, scratch_path, store
from lakestar.sinks import append_once, persisted, write_table
from lakestar.sources import (
    Retry,
    add_constants,
    fan_out,
    follow_pages,
    join_ids,
    judge_pages,
    land_pages,
    odd_items,
    plain_client,
    read_entity,
    request_uri,
    schemas,
    typed_records,
    unwrap_envelope,
)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Workers may run without this repository on their path: the library ships itself, this module's openers go by value.
cloudpickle.register_pickle_by_value(openers)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _shown(df: DataFrame) -> DataFrame:
    """Timestamps as seconds and money as double: both engines show those alike in any session."""
    forms = {T.TimestampType: F.unix_seconds, T.DecimalType: lambda c: F.col(c).cast("double")}
    return df.select(
        *[
            forms[type(f.dataType)](f.name).alias(f.name) if type(f.dataType) in forms else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# ---- silver ---------------------------------------------------------------------------------


@query
def silver_legislature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_legislature(proxies.legislatures(spark, sf_dir))


@query
def silver_party(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_party(proxies.parties(spark, sf_dir))


@query
def silver_deputy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_deputy(proxies.deputies(spark, sf_dir))


@query
def silver_expense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(silver.silver_expense(proxies.expenses(spark, sf_dir)))


# ---- functions and projections --------------------------------------------------------------


@query
def parse_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides whole times: short ones, whose hour must not be lost, and bare dates."""
    people = proxies.deputies(spark, sf_dir, versions=False)
    endings = ("T05:00:00", "T05:00:00Z", "T05:00:00+02:00", "T5", " 5", " 05:00", "")
    ending = F.element_at(F.array(*[F.lit(z) for z in endings]), (F.col("id") % 7 + 1).cast("int"))
    stamp = F.concat("dataNascimento", ending)
    born, at = parse_date("dataNascimento"), parse_timestamp(stamp, "UTC-3")
    return _shown(people.select("id", born.alias("born"), at.alias("stamp")))


@query
def timestamp_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = {"utc": "UTC", "west": "UTC-3", "east": "+05:30"}
    read = {name: parse_timestamp("dataDocumento", zone).alias(name) for name, zone in zones.items()}
    spent = proxies.expenses(spark, sf_dir)
    return _shown(spent.select("numDocumento", *read.values()))


@query
def timestamp_clock_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half past two at night, a time that clocks show twice or never when they change, by each policy."""
    night = F.concat(F.substring("dataDocumento", 1, 11), F.lit("02:30:00"))
    read = {p: parse_timestamp(night, "Europe/Berlin", twice=p, never=p).alias(f"at_{p}") for p in ("earlier", "later", "null")}
    spent = proxies.expenses(spark, sf_dir)
    return _shown(spent.select("numDocumento", *read.values(), parse_timestamp(night, "Europe/Berlin").alias("at_default")))


@query
def filter_key_gt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_gt(proxies.legislatures(spark, sf_dir), "id", 57).select("id")


@query
def filter_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"ultimoStatus.idLegislatura": 57, "ultimoStatus.siglaUf": "BUILDING"}
    return filter_equal(proxies.deputies(spark, sf_dir), wanted).select("id")


@query
def rename_drop_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = with_column(proxies.memberships(spark, sf_dir), "following", F.col("id") + 1)
    copied = copy_columns(members, {"legislature_copy": "idLegislatura"})
    return rename(drop_columns(copied, ["uri", "no_such_column"]), {"id": "id_deputado", "absent": "x"})


# ---- aggregation and joins ------------------------------------------------------------------


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collect_distinct(proxies.memberships(spark, sf_dir), ["id", "uri"], "idLegislatura", "legislaturas")


def _as_text(column: str) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",").alias(column)


@query
def collect_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _members(spark, sf_dir).select("id", "uri", _as_text("legislaturas"))


@query
def membership_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = rename(dedupe(_members(spark, sf_dir), ["id"]).drop("uri"), {"id": "id_deputado"})
    members = materialize(members, "members")
    joined = join_members(proxies.deputies(spark, sf_dir, versions=False), members, {"id": "id_deputado"})
    return joined.select("id", "nomeCivil", _as_text("legislaturas"))


def _stored(df: DataFrame) -> DataFrame:
    """Dimensions are stored before something refers to them."""
    return materialize(df, "dim")


def _legislature_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(gold.dim_legislature(silver.silver_legislature(proxies.legislatures(spark, sf_dir))))


def _party_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(gold.dim_party(silver.silver_party(proxies.parties(spark, sf_dir))))


def _deputy_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(gold.dim_deputy(silver.silver_deputy(proxies.deputies(spark, sf_dir))))


def _back(df: DataFrame, dim: DataFrame, sk: str, names: dict[str, str], base: DataFrame | None = None) -> DataFrame:
    """Natural columns of the dimension row that a foreign key points at, in place of the key; ``base`` is
    the frame before earlier calls, in which keys are counted without joining again."""
    return Lookup(dim, {sk: sk}, "_row", out="_row").resolve(df, base).select(
        *[c for c in df.columns if c != sk], *[F.col(f"_row.{old}").alias(new) for new, old in names.items()]
    )


def _pointed(dim: DataFrame) -> DataFrame:
    return dim.withColumn("_row", F.struct(*dim.columns))


@query
def fk_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    legislatures = _legislature_dim(spark, sf_dir)
    people = proxies.deputies(spark, sf_dir).select("id", F.col("ultimoStatus.idLegislatura").alias("last"))
    linked = resolve_fk(people, legislatures, {"last": "id"}, "sk_legislatura")
    return _back(linked, _pointed(legislatures), "sk_legislatura", {"begins": "dataInicio"})


def _expense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return proxies.expenses(spark, sf_dir).select(
        "numDocumento", "id_legislatura", "nomeFornecedor", "cnpjCpfFornecedor"
    )


@query
def fk_inner_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    legislatures = _legislature_dim(spark, sf_dir)
    rows = _expense_rows(spark, sf_dir)
    linked = resolve_fk(rows, legislatures, {"id_legislatura": "id"}, "sk_legislatura", how="inner", cast="lenient")
    return _back(linked, _pointed(legislatures), "sk_legislatura", {"found": "id"}).select("numDocumento", "found")


@query
def fk_inner_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shuffled inner join to a third of the providers, the others' rows left out before the shuffle."""
    rows = _expense_rows(spark, sf_dir)
    third = F.substring("nomeFornecedor", -1, 1).isin("0", "3", "6", "9")
    providers = _stored(gold.dim_provider(rows.filter(third), "dense"))
    on = {c: c for c in ("nomeFornecedor", "cnpjCpfFornecedor")}
    linked = resolve_fk(rows, providers, on, "sk_fornecedor", how="inner", max_broadcast_bytes=-1, prune=True)
    names = {"found_name": "nomeFornecedor", "found_tax_id": "cnpjCpfFornecedor"}
    return _back(linked, _pointed(providers), "sk_fornecedor", names).select("numDocumento", *names)


@query
def fk_cast_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    legislatures = _legislature_dim(spark, sf_dir)
    rows = _expense_rows(spark, sf_dir)
    linked = resolve_fk(rows, legislatures, {"id_legislatura": "id"}, "sk_legislatura", cast="lenient")
    return _back(linked, _pointed(legislatures), "sk_legislatura", {"found": "id"}).select(
        "numDocumento", "id_legislatura", "found"
    )


def _provider_fk(spark: SparkSession, sf_dir: str, null_safe: bool, **options: int) -> DataFrame:
    rows = _expense_rows(spark, sf_dir)
    providers = _stored(gold.dim_provider(rows, "dense"))
    on = {"nomeFornecedor": "nomeFornecedor", "cnpjCpfFornecedor": "cnpjCpfFornecedor"}
    linked = resolve_fk(rows, providers, on, "sk_fornecedor", null_safe=null_safe, **options)
    names = {"found_name": "nomeFornecedor", "found_tax_id": "cnpjCpfFornecedor"}
    return _back(linked, _pointed(providers), "sk_fornecedor", names).select("numDocumento", *names)


@query
def fk_composite_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _provider_fk(spark, sf_dir, False)


@query
def fk_composite_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _provider_fk(spark, sf_dir, True)


@query
def fk_composite_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fk_composite_nullsafe``, by the join for large dimensions, with hot keys salted."""
    return _provider_fk(spark, sf_dir, True, max_broadcast_bytes=-1, rows_per_task=500)


@query
def fk_composite_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fk_composite_plain``, both sides in buckets of the key, frequent keys and nulls set apart."""
    rows = _expense_rows(spark, sf_dir)
    names = {"found_name": "nomeFornecedor", "found_tax_id": "cnpjCpfFornecedor"}
    providers = _stored(gold.dim_provider(rows, "dense")).select(*[F.col(old).alias(new) for new, old in names.items()], "sk_fornecedor")
    place = scratch_path(spark, "buckets")
    own = write_bucketed(rows, f"b_{uuid4().hex}", f"{place}/left", list(names.values()), rows_per_task=500)
    lookup = write_bucketed(providers, f"b_{uuid4().hex}", f"{place}/right", list(names), own.buckets, split=False)
    joined = bucketed_join(own, lookup, {old: new for new, old in names.items()})
    return joined.select("numDocumento", *names)


# ---- keys -----------------------------------------------------------------------------------


@query
def content_key_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["id_deputado", "id_legislatura", "numDocumento", "valorDocumento"]
    return _shown(content_key(proxies.expenses(spark, sf_dir), columns, "id_despesa").select(*columns, "id_despesa"))


@query
def content_key_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["numDocumento", "urlDocumento", "cnpjCpfFornecedor", "valorDocumento"]
    return _shown(content_key(proxies.expenses(spark, sf_dir), columns, "key", "token").select(*columns, "key"))


def _properties(df: DataFrame, sk: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(sk).alias("keys"),
        F.min(sk).alias("lowest"),
        F.max(sk).alias("highest"),
    )


@query
def sk_dense_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = proxies.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return _properties(surrogate_key(orders, "sk", "dense", ["o_orderkey"]), "sk")


@query
def sk_hash_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = silver.silver_expense(proxies.expenses(spark, sf_dir))
    return _properties(surrogate_key(spent, "sk", "hash"), "sk").select("n", "keys")


@query
def sk_hash64_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = proxies.table(spark, sf_dir, "orders").select("o_orderkey")
    return _properties(surrogate_key(orders, "sk", "hash64"), "sk").select("n", "keys")


@query
def sk_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publications: a third of the deputies is new in the second, a fifth is gone; keys stay."""
    people = silver.silver_deputy(proxies.deputies(spark, sf_dir)).select("id", "nome_civil")
    path = scratch_path(spark, "registry")
    first = materialize(registered_key(people.filter("id % 3 <> 0"), "sk_first", path, ["id"]), "dim")
    second = registered_key(people.filter("id % 5 <> 0"), "sk_first", path, ["id"]).withColumnRenamed("sk_first", "sk_second")
    return first.join(second, ["id", "nome_civil"], "full")


@query
def sk_monotonic_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = proxies.table(spark, sf_dir, "orders").select("o_orderkey")
    return _properties(surrogate_key(orders, "sk", "monotonic"), "sk").select("n", "keys", "lowest")


@query
def sk_uuid_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = proxies.table(spark, sf_dir, "orders").select("o_orderkey")
    return _properties(surrogate_key(orders, "sk", "uuid"), "sk").select("n", "keys")


# ---- gold -----------------------------------------------------------------------------------


@query
def dim_expense_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = silver.silver_expense(proxies.expenses(spark, sf_dir))
    return gold.dim_expense_type(spent, "dense").select("tipoDespesa")


@query
def dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    spent = silver.silver_expense(proxies.expenses(spark, sf_dir))
    return gold.dim_provider(spent, "dense").select("nomeFornecedor", "cnpjCpfFornecedor")


@query
def dim_provider_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The legacy form: one row per name, the first by tax id."""
    rows = proxies.expenses(spark, sf_dir).select("nomeFornecedor", "cnpjCpfFornecedor")
    dim = dimension_from_fact(rows, ["nomeFornecedor", "cnpjCpfFornecedor"], "sk", "dense", ["nomeFornecedor"])
    return dim.select("nomeFornecedor", "cnpjCpfFornecedor")


def _as_line(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("line")


@query
def dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three dimensions with tables of their own, and whether their keys are 1..n."""
    dims = {
        "sk_legislatura": gold.dim_legislature(silver.silver_legislature(proxies.legislatures(spark, sf_dir))),
        "sk_partido": gold.dim_party(silver.silver_party(proxies.parties(spark, sf_dir))),
        "sk_deputado": gold.dim_deputy(silver.silver_deputy(proxies.deputies(spark, sf_dir))),
    }
    found = []
    for sk, dim in dims.items():
        dim = materialize(dim, "dim")
        sizes = _properties(dim, sk).select(((F.col("n") == F.col("keys")) & (F.col("lowest") == 1) & (F.col("highest") == F.col("n"))).cast("int").alias("dense"))
        line = _as_line([c for c in dim.columns if c != sk])
        found.append(dim.select(F.lit(sk).alias("key"), line).withColumn("dense", F.lit(sizes.first()["dense"])))
    return reduce(DataFrame.unionByName, found)


@query
def deputy_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    legislatures, parties = _legislature_dim(spark, sf_dir), _party_dim(spark, sf_dir)
    people = silver.silver_deputy(proxies.deputies(spark, sf_dir))
    linked = gold.linked_deputies(gold.dim_deputy(people), legislatures, parties, keep_natural=False)
    linked = linked.select("id", "sk_legislatura", "sk_partido")
    linked = _back(linked, _pointed(legislatures), "sk_legislatura", {"legislature": "id"})
    return _back(linked, _pointed(parties), "sk_partido", {"party": "sigla"})


def _key_bytes(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that are text, a hash's or a uuid's hex digits, as their bytes: no shuffle can compress the digits."""
    texts = [c for c in keys if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.unhex(F.replace(c, F.lit("-"), F.lit(""))) for c in texts}) if texts else df


def _natural_fact(
    fact: DataFrame, deputies: DataFrame, legislatures: DataFrame, types: DataFrame, providers: DataFrame
) -> DataFrame:
    """The fact with every key followed back to the dimension row it points at, of which only the columns
    asked for move. The widest names come last, and keys move as bytes, money as whole cents."""
    names = {"provider": "nomeFornecedor", "tax_id": "cnpjCpfFornecedor"}
    ways = [
        (legislatures, "sk_legislatura", {"legislature": "id"}),
        (types, "sk_tipo_despesa", {"expense_type": "tipoDespesa"}),
        (deputies, "sk_deputado", {"deputy": "id"}),
        (providers, "sk_fornecedor", names),
    ]
    columns = fact.columns
    plain = fact = _key_bytes(fact, "sk_despesa", *[sk for _, sk, _ in ways])
    for dim, sk, shown in ways:
        fact = _back(fact, _pointed(_key_bytes(dim.select(sk, *shown.values()), sk)), sk, shown, plain)
    own = F.lower(F.hex("sk_despesa")).alias("sk_despesa")
    order = ["deputy", "legislature", "expense_type", *names]
    return _shown(fact.select(*[own if c == "sk_despesa" else c for c in columns if c in fact.columns], *order))


def _fact_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    expenses = materialize(silver.silver_expense(proxies.expenses(spark, sf_dir)), "silver")
    return expenses, _deputy_dim(spark, sf_dir), _legislature_dim(spark, sf_dir)


@query
def fact_expense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of derived dimensions computed in place; followed back to natural keys."""
    expenses, deputies, legislatures = _fact_parts(spark, sf_dir)
    types = _stored(gold.dim_expense_type(expenses))
    providers = _stored(gold.dim_provider(expenses))
    fact = gold.fact_expense(expenses, gold.fact_links(deputies, legislatures, cast="lenient"))
    return _natural_fact(fact, deputies, legislatures, types, providers)


@query
def fact_expense_looked_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense keys for all dimensions, and providers without a tax id found as well. The fact is stored before it is
    followed back, so that shuffles of the way there are gone by then."""
    expenses, deputies, legislatures = _fact_parts(spark, sf_dir)
    types = _stored(gold.dim_expense_type(expenses, "dense"))
    providers = _stored(gold.dim_provider(expenses, "dense"))
    links = gold.fact_links(deputies, legislatures, types, providers, null_safe_provider=True, cast="lenient")
    fact = materialize(gold.fact_expense(expenses, links), "fact")
    return _natural_fact(fact, deputies, legislatures, types, providers)


@query
def fact_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random keys (stored before use), providers by name alone, unknown legislatures dropped."""
    expenses = materialize(silver.silver_expense(proxies.expenses(spark, sf_dir)), "silver")
    people = silver.silver_deputy(proxies.deputies(spark, sf_dir))
    terms = silver.silver_legislature(proxies.legislatures(spark, sf_dir))
    deputies = _stored(surrogate_key(people.select("id"), "sk_deputado", "uuid"))
    legislatures = _stored(surrogate_key(terms.select("id"), "sk_legislatura", "uuid"))
    types = _stored(gold.dim_expense_type(expenses, "uuid"))
    by_name = dimension_from_fact(expenses, gold.PROVIDER_KEY, "sk_fornecedor", "uuid", ["nomeFornecedor"])
    providers = _stored(by_name)
    links = [
        Lookup(types, {"tipoDespesa": "tipoDespesa"}, "sk_tipo_despesa"),
        Lookup(providers, {"nomeFornecedor": "nomeFornecedor"}, "sk_fornecedor"),
        Lookup(deputies, {"id_deputado": "id"}, "sk_deputado"),
        Lookup(legislatures, {"id_legislatura": "id"}, "sk_legislatura", how="inner", cast="lenient"),
    ]
    return _natural_fact(gold.fact_expense(expenses, links), deputies, legislatures, types, providers)


@query
def fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as it is stored: measures, and which keys are there."""
    expenses, deputies, legislatures = _fact_parts(spark, sf_dir)
    fact = gold.fact_expense(expenses, gold.fact_links(deputies, legislatures, cast="lenient"))
    keys = ("sk_deputado", "sk_legislatura", "sk_tipo_despesa", "sk_fornecedor")
    return _shown(fact).withColumns({k: F.col(k).isNotNull().cast("int") for k in keys})


# ---- sinks ----------------------------------------------------------------------------------

MONTHS = {"ano1": "ano", "mes1": "mes"}


def _by_month(df: DataFrame) -> DataFrame:
    return df.groupBy("ano1", "mes1").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valorDocumento").cast("double").alias("total")
    )


@query
def overwrite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write is what is read; a kept frame is computed once and released."""
    root = scratch_path(spark, "overwrite")
    with persisted(silver.silver_deputy(proxies.deputies(spark, sf_dir))) as (people,):
        write_table(people.select("id"), f"{root}/deputies_data")
        write_table(people, f"{root}/deputies_data")
    return read_entity(spark, root, "deputies_data", ["id", "nome_civil", "data_nascimento"])


@query
def partitioned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "round-trip")
    spent = silver.silver_expense(proxies.expenses(spark, sf_dir), by=list(MONTHS.values()))
    write_table(spent, path, partition_copies=MONTHS, options={"compression": "snappy"}, rebalance=False)
    return _shown(spark.read.parquet(path))


@query
def clustered_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months whose rows follow deputy and amount together."""
    path = scratch_path(spark, "clustered")
    spent = materialize(silver.silver_expense(proxies.expenses(spark, sf_dir), by=list(MONTHS.values())), "silver")
    write_table(spent, path, partition_copies=MONTHS, cluster_by=["id_deputado", "valorDocumento"])
    return _shown(spark.read.parquet(path))


@query
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending repeats rows; distinct rows are back after the dedupe."""
    path = scratch_path(spark, "append")
    spent = materialize(silver.silver_expense(proxies.expenses(spark, sf_dir), by=list(MONTHS.values())), "silver")
    for _ in range(2):  # the distinct has brought months together
        write_table(spent, path, "append", partition_copies=MONTHS, rebalance=False)
    stored = spark.read.parquet(path)
    both = _by_month(stored).join(
        _by_month(dedupe(stored)).withColumnsRenamed({"n": "n_distinct", "total": "total_distinct"}),
        ["ano1", "mes1"],
    )
    return both.withColumns({c: F.col(c).cast("int") for c in MONTHS})


@query
def append_once_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that comes again after it stopped half-way, and once more; a second run appends one month."""
    path, ledger = scratch_path(spark, "append"), scratch_path(spark, "ledger")
    spent = materialize(silver.silver_expense(proxies.expenses(spark, sf_dir)), "silver")
    starts = [("first", spent.filter("ano < 1995")), ("first", spent), ("first", spent), ("second", spent.filter("ano = 1997 and mes = 3"))]
    for number, (run, rows) in enumerate(starts):
        added = append_once(rows, path, run, ledger, MONTHS)
        last = added.withColumnRenamed("rows", "added_last") if number == len(starts) - 1 else None
    months = _by_month(spark.read.parquet(path)).withColumns({c: F.col(c).cast("int") for c in MONTHS})
    return months.join(last, list(MONTHS), "left")


@query
def replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write of one month, with other amounts, leaves the rest alone."""
    path = scratch_path(spark, "replace")
    spent = silver.silver_expense(proxies.expenses(spark, sf_dir))
    write_table(spent, path, "replace_partitions", partition_copies=MONTHS)
    doubled = (F.col("valorDocumento") * 2).cast("decimal(18,2)")
    month = filter_equal(spent, {"ano": 1997, "mes": 3}).withColumn("valorDocumento", doubled)
    write_table(month, path, "replace_partitions", partition_copies=MONTHS)
    return _by_month(spark.read.parquet(path)).withColumns({c: F.col(c).cast("int") for c in MONTHS})


@query
def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first run lacks receipts of one month and has a month that is gone later; the second repairs both."""
    source, root = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    spent = materialize(proxies.expenses(spark, sf_dir), "expenses")
    late, gone = "ano = 1997 and mes = 3", "ano = 1995 and mes = 2"

    def run(rows: DataFrame) -> DataFrame:
        write_table(rows, source, partition_by=list(MONTHS.values()))
        bronze = spark.read.parquet(source)
        return rebuild_changed(
            bronze, lambda r: silver.silver_expense(r, by=list(MONTHS.values())), f"{root}/silver", f"{root}/ledger", MONTHS, columns=silver.EXPENSE_SOURCES
        ).df

    run(spent.filter(f"not ({late} and valorGlosa > 0)"))
    changed = run(spent.filter(f"not ({gone})")).select(F.col("ano").alias("ano1"), F.col("mes").alias("mes1"), "change")
    months = _by_month(spark.read.parquet(f"{root}/silver")).withColumns({c: F.col(c).cast("int") for c in MONTHS})
    return months.join(changed.withColumns({c: F.col(c).cast("int") for c in MONTHS}), ["ano1", "mes1"], "full")


# ---- sources --------------------------------------------------------------------------------


@query
def request_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ids are missing: no address. Names hold a character that an address has to encode."""
    key = F.when(F.col("c_custkey") % 10 != 0, F.col("c_custkey"))
    params = {"idLegislatura": 57, "nome": F.concat("c_mktsegment", F.lit(" & "), "c_name"), "itens": 100}
    address = request_uri("api/", "deputados", key, "despesas", params=params)
    return proxies.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), address.alias("uri"))


@query
def joined_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in chunks of at most 100, taken apart again."""
    chunks = join_ids(proxies.memberships(spark, sf_dir), "id", per_request=100)
    split = chunks.select(F.transform(F.split("ids", ","), lambda i: i.cast("bigint")).alias("ids"))
    return split.select(F.explode("ids").alias("id"), (F.size("ids") <= 100).cast("int").alias("fits"))


@query
def list_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = proxies.legislatures(spark, sf_dir)
    return list_starts(parents, "api/deputados", "id", 56, "idLegislatura", {"itens": 100})


TURN = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, absent STRING"


@query
def typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = proxies.table(spark, sf_dir, "events").select("event_id", "props")
    return typed_records(events, "props", "k INT, absent STRING")


@query
def envelope_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = proxies.conversation_pages(spark, sf_dir)
    return unwrap_envelope(pages, "body", TURN, carry=["uri"])


@query
def envelope_odd_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and rejects of every page: both together are what was put in."""
    pages = materialize(proxies.odd_pages(spark, sf_dir), "pages")
    walk = judge_pages(pages)
    items = unwrap_envelope(walk.pages, "body", TURN, carry=["uri"]).groupBy("uri").agg(F.count("turn").alias("items"))
    odd = odd_items(walk.pages, "body", carry=["uri"]).groupBy("uri").agg(F.count(F.lit(1)).alias("odd"))
    reasons = walk.rejected.select("uri", "reason")
    joined = pages.select("uri").join(items, "uri", "left").join(odd, "uri", "left").join(reasons, "uri", "left")
    return joined.select("uri", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("odd", F.lit(0)).alias("odd"), F.coalesce("reason", F.lit("ok")).alias("reason"))


def _walk(spark: SparkSession, sf_dir: str, **options: object):
    """A conversation's pages are a list: what its addresses share stands before the turn."""
    pages = materialize(proxies.conversation_pages(spark, sf_dir), "pages")
    return follow_pages(proxies.conversation_starts(spark, sf_dir), pages, list_of=lambda uri: F.substring_index(uri, "/", 1), **options)


@query
def follow_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    walked = _walk(spark, sf_dir).pages.withColumnRenamed("conv_id", "start_conv")
    return unwrap_envelope(walked, "body", TURN, carry=["start_conv", "page_no"]).drop("absent")


@query
def follow_at_most_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walk(spark, sf_dir, max_pages=3).pages.select("conv_id", "page_no", "uri")


@query
def quarantine_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _walk(spark, sf_dir).rejected.select("conv_id", "page_no", "uri", "status", "reason")


def _fan_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An address per customer that says how many orders there are to page through."""
    counts = proxies.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    uri = F.concat(F.lit("api/deputados/"), "o_custkey", F.lit("/despesas?n="), "n")
    return counts.select(uri.alias("uri"), F.col("o_custkey").alias("id_deputado"))


RECORD = "doc STRING, position INT, id_legislatura STRING"
QUIET = Retry(sleep=openers.no_pause)


@query
def fan_out_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fan_out(
        _fan_starts(spark, sf_dir), plain_client(openers.open_numbered_page), params={"itens": 3}, parallelism=8, retry=QUIET
    )
    return pages.select("start_uri", "page_no", "status")


@query
def fan_out_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carried key and constants: a constant wins over a field of the item."""
    source = requested_pages(plain_client(openers.open_numbered_page), params={"itens": 3}, parallelism=8, retry=QUIET)
    walk = source(_fan_starts(spark, sf_dir))
    items = unwrap_envelope(walk.pages, "body", RECORD, carry=["id_deputado"])
    return add_constants(items, {"id_legislatura": "57"})


@query
def fan_out_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fan_out_pages``, the pages of a list side by side; a first run is stopped after a wave."""
    path, starts = scratch_path(spark, "ledger"), _fan_starts(spark, sf_dir)
    options = {"params": {"itens": 3}, "parallelism": 8, "retry": QUIET, "numbered": "pagina", "per_wave": 4}
    land_pages(starts, plain_client(openers.open_page_with_last), path, waves=1, **options)
    pages = land_pages(starts, plain_client(openers.open_page_with_last), path, **options)
    return pages.select("start_uri", "page_no", "status")


@query
def fan_out_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fan_out(
        _fan_starts(spark, sf_dir),
        plain_client(openers.open_numbered_page),
        params={"itens": 3},
        carry=["id_deputado"],
        parallelism=8,
        retry=QUIET,
    )
    return judge_pages(materialize(raw, "landing")).rejected.select("id_deputado", "page_no", "status", "reason")


@query
def fan_out_unreadable_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of odd shape end the chain, and their page is rejected instead of stopping the job."""
    raw = fan_out(
        _fan_starts(spark, sf_dir), plain_client(openers.open_page_with_odd_links), params={"itens": 3}, carry=["id_deputado"], parallelism=8, retry=QUIET
    )
    walk = judge_pages(materialize(raw, "landing"))
    good = walk.pages.select("id_deputado", "page_no", F.lit("ok").alias("reason"))
    return good.unionByName(walk.rejected.select("id_deputado", "page_no", "reason"))


# ---- jobs -----------------------------------------------------------------------------------


def _indexed(pages: DataFrame) -> PageSource:
    """Pages that landed, of which the index keeps all that is read: the landed table goes."""
    landed = store(pages, "pages", ["uri"])
    source = landed_pages(landed.df)
    landed.drop()
    return source


@query
def bronze_legislatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = landed_pages(materialize(proxies.legislature_pages(spark, sf_dir, 3), "pages"))
    root = scratch_path(spark, "bronze")
    starts = spark.range(1).select(F.lit("api/legislaturas?itens=3").alias("uri"))
    ingest_list(starts, source, schemas.LEGISLATURE, f"{root}/legislature_data")
    return read_entity(spark, root, "legislature_data")


@query
def bronze_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = landed_pages(materialize(proxies.party_pages(spark, sf_dir, 10), "pages"))
    root = scratch_path(spark, "bronze")
    starts = list_starts(proxies.legislatures(spark, sf_dir), "api/partidos", "id", 54, "idLegislatura", {"itens": 10})
    ingest_details(starts, source, schemas.PARTY_REFERENCE, schemas.PARTY, f"{root}/parties_data")
    return _party_rows(read_entity(spark, root, "parties_data"))


def _party_rows(stored: DataFrame) -> DataFrame:
    return stored.select("id", "sigla", "nome", "uri", "status.situacao", "status.totalMembros", "status.lider.nome").toDF(
        "id", "sigla", "nome", "uri", "situacao", "totalMembros", "lider"
    )


@query
def bronze_parties_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ids an address: several lists name every party, which is still one row."""
    source = landed_pages(materialize(proxies.party_pages(spark, sf_dir, 10, per_request=2), "pages"))
    root = scratch_path(spark, "bronze")
    starts = list_starts(proxies.legislatures(spark, sf_dir), "api/partidos", "id", 54, "idLegislatura", {"itens": 10}, per_request=2)
    ingest_details(starts, source, schemas.PARTY_REFERENCE, schemas.PARTY, f"{root}/parties_data")
    return _party_rows(read_entity(spark, root, "parties_data"))


@query
def bronze_deputies(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = landed_pages(materialize(proxies.deputy_pages(spark, sf_dir), "pages"))
    root = scratch_path(spark, "bronze")
    starts = list_starts(proxies.legislatures(spark, sf_dir), "api/deputados", "id", 54, "idLegislatura", {"itens": 100})
    membership = (["id", "uri"], "idLegislatura", "legislaturas")
    ingest_details(starts, source, schemas.DEPUTY_REFERENCE, schemas.DEPUTY, f"{root}/deputies_data", membership)
    stored = read_entity(spark, root, "deputies_data")
    return stored.select(
        "id", "id_deputado", "nomeCivil", F.col("ultimoStatus.siglaPartido").alias("party"), "dataNascimento", _as_text("legislaturas")
    )


@query
def bronze_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _indexed(proxies.expense_pages(spark, sf_dir, 20))
    path = scratch_path(spark, "bronze")
    address = request_uri("api/deputados", F.col("id"), "despesas", params={"idLegislatura": 57, "itens": 20})
    people = proxies.deputies(spark, sf_dir, versions=False)
    unknown = people.filter("id % 37 = 0").withColumn("id", -F.col("id"))  # parents without a page
    ingest_children(
        people.unionByName(unknown),
        address,
        {"id_deputado": "id"},
        {"id_legislatura": "57"},
        source,
        schemas.EXPENSE,
        ["id_deputado", "id_legislatura", "numDocumento", "valorDocumento"],
        "id_despesa",
        path,
        ["ano", "mes"],
        {"ano1": "ano", "mes1": "mes"},
    )
    shown = ("id_deputado", "id_legislatura", "numDocumento", "valorDocumento", "dataDocumento", "id_despesa", "ano", "mes")
    stored = spark.read.parquet(path)
    return _shown(stored).select(*shown, F.col("ano1").cast("int").alias("ano1"), F.col("mes1").cast("int").alias("mes1"))


@query
def star_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each published table."""
    root = scratch_path(spark, "star")
    write_table(silver.silver_legislature(proxies.legislatures(spark, sf_dir)), f"{root}/silver/legislature_data")
    write_table(silver.silver_party(proxies.parties(spark, sf_dir)), f"{root}/silver/parties_data")
    write_table(silver.silver_deputy(proxies.deputies(spark, sf_dir)), f"{root}/silver/deputies_data")
    spent = silver.silver_expense(proxies.expenses(spark, sf_dir), by=list(MONTHS.values()))
    write_table(spent, f"{root}/silver/expenses_data", partition_copies=MONTHS, rebalance=False)
    star = gold.publish_star(spark, f"{root}/silver", f"{root}/gold", cast="lenient")
    shown = {
        "legislature": list(gold.LEGISLATURE_COLUMNS),
        "party": list(gold.PARTY_COLUMNS),
        "deputy": ["id", "nome_civil", "situacao_atual", "data_nascimento", "escolaridade"],
        "expense_type": list(gold.EXPENSE_TYPE_KEY),
        "provider": list(gold.PROVIDER_KEY),
        "fact": ["ano", "mes"],
    }
    lines = [star.read(spark, name).select(F.lit(name).alias("name"), _as_line(columns)) for name, columns in shown.items()]
    return reduce(DataFrame.unionByName, lines).groupBy("name", "line").agg(F.count(F.lit(1)).alias("n"))


def _layers(spark: SparkSession, source: object, after_bronze: Callable[[], None]) -> DataFrame:
    config = Config(scratch_path(spark, "lake"), "api", source, only_of_legislature=None, region=None)
    star = run_all(spark, config, after_bronze)
    names = ("fact", "deputy", "legislature", "expense_type", "provider")
    fact, *dims = [star.read(spark, name) for name in names]
    return _natural_fact(fact.drop("ano_despesa", "mes_despesa"), *dims)


@query
def layers_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All jobs from landed pages to the stored fact, followed back to natural keys."""
    source = _indexed(proxies.api_pages(spark, sf_dir))
    return _layers(spark, source, source.drop)


@query
def layers_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with every page requested from the tasks, by a client that each of them opens."""
    client = openers.shelve(proxies.api_pages(spark, sf_dir), scratch_path(spark, "shelf"))
    source = requested_pages(client, parallelism=8, retry=QUIET)

    def after_bronze() -> None:
        source.drop()
        drop_table(spark, client.path)

    return _layers(spark, source, after_bronze)
