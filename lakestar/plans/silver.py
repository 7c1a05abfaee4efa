"""Silver: one declared projection per entity, then distinct rows or one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.functions.parsing import parse_date, parse_timestamp
from lakestar.operators.conform import Spec, conform
from lakestar.operators.dedupe import dedupe, dedupe_by

# The output columns of each entity and the fields they come from.


def legislature_spec(strict: bool = False) -> Spec:
    return {
        "id": "id",
        "dataInicio": parse_date("dataInicio", strict),
        "dataFim": parse_date("dataFim", strict),
    }


def party_spec() -> Spec:
    return {
        "id": "id",
        "sigla": "sigla",
        "nome": "nome",
        "urlLogo": "urlLogo",
        "situacao": "status.situacao",
        "total_membros": "status.totalMembros",
        "total_posse": "status.totalPosse",
    }


def deputy_spec(strict: bool = False) -> Spec:
    return {
        "id": "id",
        "nome_civil": F.upper("nomeCivil"),
        "nome_eleitoral": F.upper("ultimoStatus.nomeEleitoral"),
        "id_ultima_legislatura": "ultimoStatus.idLegislatura",
        "ultima_filiacao": "ultimoStatus.siglaPartido",
        "foto": "ultimoStatus.urlFoto",
        "situacao_atual": "ultimoStatus.situacao",
        "condicao_eleitoral_atual": "ultimoStatus.condicaoEleitoral",
        "data_nascimento": parse_date("dataNascimento", strict),
        "data_falecimento": parse_date("dataFalecimento", strict),
        "ufNascimento": "ufNascimento",
        "municipioNascimento": "municipioNascimento",
        "escolaridade": "escolaridade",
    }


def expense_spec(zone: str = "UTC-3", strict: bool = False) -> Spec:
    return {
        "id_deputado": "id_deputado",
        "id_legislatura": "id_legislatura",
        "ano": "ano",
        "mes": "mes",
        "data_documento": parse_timestamp("dataDocumento", zone, strict),
        "tipoDespesa": "tipoDespesa",
        "valorDocumento": "valorDocumento",
        "urlDocumento": "urlDocumento",
        "nomeFornecedor": "nomeFornecedor",
        "cnpjCpfFornecedor": "cnpjCpfFornecedor",
        "valorLiquido": "valorLiquido",
        "valorGlosa": "valorGlosa",
    }


#: Bronze columns that silver's expenses come from.
EXPENSE_SOURCES = (
    "id_deputado",
    "id_legislatura",
    "ano",
    "mes",
    "dataDocumento",
    "tipoDespesa",
    "valorDocumento",
    "urlDocumento",
    "nomeFornecedor",
    "cnpjCpfFornecedor",
    "valorLiquido",
    "valorGlosa",
)


def conform_entity(
    df: DataFrame,
    spec: Spec,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str | Column] = (),
    latest: bool = False,
) -> DataFrame:
    """The columns of ``spec``, as distinct rows or one row per ``keys``.

    ``order_by`` ranks the rows of a key by source columns, nested ones included; ``latest`` keeps
    the last of them.
    """
    if keys is None:
        return dedupe(conform(df, spec))
    order = {f"_order_{i}": column for i, column in enumerate(order_by)}
    kept = dedupe(conform(df, {**spec, **order}), keys, list(order), latest)
    return kept.select(*spec)


def silver_legislature(bronze: DataFrame, strict: bool = False) -> DataFrame:
    return conform_entity(bronze, legislature_spec(strict))


def silver_party(bronze: DataFrame) -> DataFrame:
    return conform_entity(bronze, party_spec())


def silver_deputy(bronze: DataFrame, strict: bool = False) -> DataFrame:
    """One row per deputy: that of the latest status."""
    return conform_entity(bronze, deputy_spec(strict), ["id"], ["ultimoStatus.data"], latest=True)


def silver_expense(
    bronze: DataFrame, zone: str = "UTC-3", strict: bool = False, by: Sequence[str] | None = None
) -> DataFrame:
    """Distinct expenses. Equal receipts of one deputy collapse, as the document number is not kept.

    ``by`` lays the rows out for a write partitioned by these columns, without a shuffle more.
    """
    if by is None:
        return conform_entity(bronze, expense_spec(zone, strict))
    return dedupe_by(conform(bronze, expense_spec(zone, strict)), by)
