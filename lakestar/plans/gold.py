"""Gold: dimensions, the deputy's links, the expense fact, and their publication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakestar.operators.conform import Spec, conform
from lakestar.operators.dedupe import dedupe
from lakestar.operators.keys import assert_unique_key, surrogate_key
from lakestar.operators.registry import registered_key
from lakestar.operators.star import (
    Computed,
    ForeignKey,
    Lookup,
    dimension,
    dimension_from_fact,
    link_dimension,
    resolve_all,
)
from lakestar.sinks.tables import write_table
from lakestar.sources.tables import read_entity

# Columns of the dimensions, fact columns and their sources, table places.
LEGISLATURE_COLUMNS = ("id", "dataInicio", "dataFim")
PARTY_COLUMNS = ("sigla", "nome", "situacao", "total_membros", "total_posse", "urlLogo")
EXPENSE_COLUMNS = (
    "id_deputado",
    "id_legislatura",
    "ano",
    "mes",
    "data_documento",
    "tipoDespesa",
    "valorDocumento",
    "urlDocumento",
    "nomeFornecedor",
    "cnpjCpfFornecedor",
    "valorLiquido",
    "valorGlosa",
)
FACT_COLUMNS: Spec = {
    "sk_despesa": "sk_despesa",
    "sk_deputado": "sk_deputado",
    "sk_legislatura": "sk_legislatura",
    "sk_tipo_despesa": "sk_tipo_despesa",
    "sk_fornecedor": "sk_fornecedor",
    "ano": "ano",
    "mes": "mes",
    "data_despesa": "data_documento",
    "valor_documento": "valorDocumento",
    "valor_liquido": "valorLiquido",
    "valor_glosa": "valorGlosa",
}
PLACES = {
    "legislature": "legislature_data",
    "party": "parties_data",
    "deputy": "deputies_data",
    "expense_type": "expenses_data/expense_type",
    "provider": "expenses_data/providers",
    "fact": "expenses_data/expenses",
}

EXPENSE_TYPE_KEY = ("tipoDespesa",)
PROVIDER_KEY = ("nomeFornecedor", "cnpjCpfFornecedor")


def _keyed(silver: DataFrame, columns: Sequence[str], natural: Sequence[str], sk: str, registry: str | None) -> DataFrame:
    """Keys 1..n of these rows, or, with a folder for a ``registry``, the keys that they have had before."""
    if registry is None:
        return dimension(silver, columns, natural, sk)
    return registered_key(silver.select(*columns), sk, f"{registry.rstrip('/')}/{sk}", natural)


def dim_legislature(silver: DataFrame, registry: str | None = None) -> DataFrame:
    return _keyed(silver, LEGISLATURE_COLUMNS, LEGISLATURE_COLUMNS, "sk_legislatura", registry)


def dim_party(silver: DataFrame, registry: str | None = None) -> DataFrame:
    return _keyed(silver, PARTY_COLUMNS, PARTY_COLUMNS, "sk_partido", registry)


def dim_deputy(silver: DataFrame, registry: str | None = None) -> DataFrame:
    return _keyed(silver, silver.columns, ["id"], "sk_deputado", registry)


def dim_expense_type(expenses: DataFrame, method: str = "hash64", seed: int = 0) -> DataFrame:
    return dimension_from_fact(expenses, EXPENSE_TYPE_KEY, "sk_tipo_despesa", method, seed=seed)


def dim_provider(expenses: DataFrame, method: str = "hash64", seed: int = 0) -> DataFrame:
    return dimension_from_fact(expenses, PROVIDER_KEY, "sk_fornecedor", method, seed=seed)


def linked_deputies(
    deputies: DataFrame,
    legislatures: DataFrame,
    parties: DataFrame,
    keep_natural: bool = True,
    shared_codes: str = "refuse",
) -> DataFrame:
    """Deputies with the keys of their last legislature and party (null where there is none).

    ``shared_codes`` says what happens if two parties have one code: ``refuse`` stops, ``first`` links
    to the first of them by its other columns.
    """
    if shared_codes not in ("refuse", "first"):
        raise ValueError(f"shared_codes must be 'refuse' or 'first', not {shared_codes!r}")
    if shared_codes == "first":
        parties = dedupe(parties, ["sigla"], [c for c in PARTY_COLUMNS if c != "sigla"])
    links = [
        Lookup(legislatures, {"id_ultima_legislatura": "id"}, "sk_legislatura"),
        Lookup(parties, {"ultima_filiacao": "sigla"}, "sk_partido"),
    ]
    used = () if keep_natural else ("id_ultima_legislatura", "ultima_filiacao")
    return link_dimension(deputies, links, used)


def fact_links(
    deputies: DataFrame,
    legislatures: DataFrame,
    expense_types: DataFrame | None = None,
    providers: DataFrame | None = None,
    null_safe_provider: bool = False,
    cast: str = "strict",
    method: str = "hash64",
    seed: int = 0,
) -> list[ForeignKey]:
    """The foreign keys of the expense fact.

    Without ``expense_types`` and ``providers``, whose rows come from the very expenses, their hash
    keys are computed in place and the fact does not move. Given as dimensions (of any key method)
    they are looked up.
    """
    type_link = (
        Computed(EXPENSE_TYPE_KEY, "sk_tipo_despesa", method, seed)
        if expense_types is None
        else Lookup(expense_types, {c: c for c in EXPENSE_TYPE_KEY}, "sk_tipo_despesa")
    )
    provider_link = (
        Computed(PROVIDER_KEY, "sk_fornecedor", method, seed, null_safe_provider)
        if providers is None
        else Lookup(providers, {c: c for c in PROVIDER_KEY}, "sk_fornecedor", null_safe=null_safe_provider)
    )
    return [
        type_link,
        provider_link,
        Lookup(deputies, {"id_deputado": "id"}, "sk_deputado"),
        Lookup(legislatures, {"id_legislatura": "id"}, "sk_legislatura", cast=cast),
    ]


def fact_expense(
    expenses: DataFrame, links: Sequence[ForeignKey], columns: Spec = FACT_COLUMNS, lay_by: Sequence[str] = ()
) -> DataFrame:
    """The expense fact: as many rows as distinct expenses. Keys, which no shuffle can compress, come late: links
    that move the fact are resolved before the others, and its own key is added after all of them, and after the
    rows were brought together ``lay_by`` the partitions of a write."""
    linked = resolve_all(expenses.select(*EXPENSE_COLUMNS), sorted(links, key=lambda link: not link.moves_fact))
    laid = linked.hint("rebalance", *lay_by) if lay_by else linked
    return conform(surrogate_key(laid, "sk_despesa", "hash", EXPENSE_COLUMNS), columns)


@dataclass(frozen=True)
class Published:
    """Paths of the star schema's tables by name."""

    paths: Mapping[str, str]
    fmt: str

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.format(self.fmt).load(self.paths[name])


def publish_star(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    fmt: str = "parquet",
    cast: str = "strict",
    options: Mapping[str, str] | None = None,
    silver_fmt: str = "parquet",
    method: str = "hash64",
    seed: int = 0,
    null_safe_provider: bool = False,
    shared_codes: str = "refuse",
    key_registry: str | None = None,
) -> Published:
    """Writes five dimensions and the fact.

    ``method`` and ``seed`` make the keys of expense types and providers, in the dimension and in the
    fact alike: should two natural keys share a 64-bit hash, which stops the job, another seed or the
    method ``hash`` gets out of it.

    ``key_registry`` is a folder in which legislatures, parties and deputies keep their keys from one
    publication to the next; without it they are numbered anew.

    Every dimension is written and read back before something refers to it, so foreign keys point at
    the very rows that are stored, and lookups are planned from real file sizes.
    """
    paths = {name: f"{gold_root.rstrip('/')}/{place}" for name, place in PLACES.items()}
    published = Published(paths, fmt)

    def store(name: str, df: DataFrame, **layout: object) -> DataFrame:
        write_table(df, paths[name], fmt=fmt, options=options, **layout)
        return published.read(spark, name)

    expenses = read_entity(spark, silver_root, "expenses_data", EXPENSE_COLUMNS, silver_fmt)
    legislatures = store("legislature", dim_legislature(read_entity(spark, silver_root, "legislature_data", fmt=silver_fmt), key_registry))
    parties = store("party", dim_party(read_entity(spark, silver_root, "parties_data", fmt=silver_fmt), key_registry))
    plain_deputies = dim_deputy(read_entity(spark, silver_root, "deputies_data", fmt=silver_fmt), key_registry)
    deputies = store("deputy", linked_deputies(plain_deputies, legislatures, parties, shared_codes=shared_codes))
    for name, df, sk in (
        ("expense_type", dim_expense_type(expenses, method, seed), "sk_tipo_despesa"),
        ("provider", dim_provider(expenses, method, seed), "sk_fornecedor"),
    ):
        assert_unique_key(store(name, df), [sk])
    # As long as no link moves the fact it is read, keyed and written in one pass without a shuffle: the
    # silver step of this library lays its files out by month, so months stay in few files. Silver that
    # lies otherwise gives the same rows in more files. A link that shuffles brings months together again.
    links = fact_links(
        deputies, legislatures, null_safe_provider=null_safe_provider, cast=cast, method=method, seed=seed
    )
    months = {"ano_despesa": "ano", "mes_despesa": "mes"}
    moved = any(link.moves_fact for link in links)
    store("fact", fact_expense(expenses, links, lay_by=list(months.values()) if moved else ()), partition_copies=months, rebalance=False)
    return published
