"""The same results in plain SQL over the driver's tables."""

from __future__ import annotations

_LEGISLATURE = """
years as (select distinct cast(year(o_orderdate) as int) as y from orders),
legislature_raw as (
    select cast(y - 1940 as smallint) as id, concat('api/legislaturas/', y - 1940) as uri,
           concat(y, '-01-01') as begins, concat(y, '-12-31') as ends from years
    union all
    select cast(y - 1940 as smallint), concat('api/legislaturas/', y - 1940),
           concat(y, '-01-01'), concat(y, '-12-31') from years where y % 2 = 0),
legislature as (
    select distinct id, uri, cast(begins as date) as begins, cast(ends as date) as ends from legislature_raw)
"""

_PARTY = """
party as (
    select cast(n_nationkey as bigint) as id, n_name as sigla, concat('Party ', n_name) as nome,
           concat('api/partidos/', n_nationkey) as uri, r_name as situacao,
           cast(n_nationkey + 10 as varchar) as members, cast(n_nationkey as varchar) as seated,
           concat('logo/', n_nationkey) as logo, lower(n_name) as lider
    from nation join region on n_regionkey = r_regionkey)
"""

_DEPUTY = """
deputy_latest as (
    select c_custkey as id, c_name, n_name, c_mktsegment,
           case when c_custkey % 19 = 0 then 'NOWHERE' when c_custkey % 17 <> 0 then n_name end as party,
           cast(55 + c_custkey % 8 as int) as last_legislature,
           case when c_custkey % 13 = 0 then 'not a date' when c_custkey % 29 = 0 then ''
                else concat(1940 + c_custkey % 50, '-0', 1 + c_custkey % 9, '-15') end as born,
           '2024-02-01' as seen, 'is' as situacao
    from customer join nation on c_nationkey = n_nationkey),
deputy_raw as (
    select * from deputy_latest
    union all
    select id, c_name, n_name, c_mktsegment, party, 54, born, '2023-02-01', 'was'
    from deputy_latest where id % 3 = 0)
"""

_MEMBERSHIP = """
membership as (
    select o_custkey as id, concat('api/deputados/', o_custkey) as uri,
           case when o_orderkey % 19 <> 0 then cast(year(o_orderdate) - 1940 as int) end as legislature
    from orders),
member_list as (
    select id, uri, array_to_string(
        list_sort(list(distinct legislature) filter (where legislature is not null)), ',') as legislaturas
    from membership group by id, uri)
"""

_EXPENSE = """
expense_once as (
    select l_orderkey, o_custkey as id_deputado,
           case when l_orderkey % 97 = 0 then '99' when l_orderkey % 101 = 0 then 'x'
                else cast(year(o_orderdate) - 1940 as varchar) end as id_legislatura,
           cast(year(l_shipdate) as int) as ano, cast(month(l_shipdate) as int) as mes,
           o_orderpriority as tipoDespesa,
           case when l_orderkey % 11 <> 0 then date_trunc('day', l_shipdate) end as moment,
           concat(l_orderkey, '-', l_linenumber) as numDocumento,
           cast(l_extendedprice as decimal(18,2)) as valorDocumento,
           case when l_orderkey % 23 <> 0 then concat('doc/', l_orderkey, '/', l_linenumber) end as urlDocumento,
           s_name as nomeFornecedor,
           case when l_suppkey % 7 <> 0 then concat('TAX', l_suppkey, '-', l_orderkey % 2) end as cnpjCpfFornecedor,
           cast(case when l_linenumber = 1 then 10 else 0 end as decimal(18,2)) as valorGlosa
    from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey),
expense_raw as (
    select *, cast(valorDocumento - valorGlosa as decimal(18,2)) as valorLiquido from (
        select * from expense_once
        union all
        select * from expense_once where l_orderkey % 10 = 0)),
expense as (
    select distinct id_deputado, id_legislatura, ano, mes,
           cast(epoch(moment) as bigint) + 10800 as data_documento,
           tipoDespesa, valorDocumento, urlDocumento, nomeFornecedor, cnpjCpfFornecedor, valorLiquido, valorGlosa
    from expense_raw)
"""

_TURNS = """
ordered_turns as (
    select *, row_number() over (partition by conv_id order by turn) - 1 as place,
           case when conv_id % 7 = 0 then 'end' when conv_id % 11 = 0 then 'status' else 'ok' end as second
    from conversations),
reached as (
    select *, turn as page_no, concat(conv_id, '/', turn) as uri
    from ordered_turns where place = turn and (turn <= 1 or second = 'ok')),
usable as (select * from reached where turn <> 1 or second = 'ok')
"""

_FAN = """
fan_starts as (select o_custkey as id_deputado, count(*) as n from orders group by o_custkey),
fan_pages as (
    select id_deputado, n, page_no from fan_starts, unnest(generate_series(0, (n + 2) // 3 - 1)) as t(page_no)),
fan_visited as (
    select *, case when page_no = 1 and id_deputado % 7 = 0 then 404
                   when page_no = 1 and id_deputado % 11 = 0 then 503 else 200 end as status
    from fan_pages where page_no <= 1 or (id_deputado % 7 <> 0 and id_deputado % 11 <> 0))
"""


def _token(column: str) -> str:
    escaped = f"replace(replace(cast({column} as varchar), '\\', '\\\\'), '|', '\\|')"
    return f"coalesce('v' || {escaped}, 'n')"


def _token_hash(*columns: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(_token(c) for c in columns)}))"


# The instant as microseconds, as the key has it.
_FACT_KEY = _token_hash(
    "id_deputado",
    "id_legislatura",
    "ano",
    "mes",
    "data_documento * 1000000",
    "tipoDespesa",
    "valorDocumento",
    "urlDocumento",
    "nomeFornecedor",
    "cnpjCpfFornecedor",
    "valorLiquido",
    "valorGlosa",
)

_MEASURES = """
    {key} as sk_despesa, ano, mes, data_documento as data_despesa,
    cast(valorDocumento as double) as valor_documento, cast(valorLiquido as double) as valor_liquido,
    cast(valorGlosa as double) as valor_glosa
"""

# Money is compared as double.
_MONEY = """cast(valorDocumento as double) as valorDocumento, cast(valorLiquido as double) as valorLiquido,
    cast(valorGlosa as double) as valorGlosa"""



def _line(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '-')" for c in columns) + ") as line"


def _with(*parts: str) -> str:
    return "with " + ", ".join(p.strip() for p in parts)


def _fact(provider: str, tax_id: str) -> str:
    return f"""{_with(_LEGISLATURE, _EXPENSE)}
        select {_MEASURES.format(key=_FACT_KEY)}, id_deputado as deputy, l.id as legislature,
               tipoDespesa as expense_type, {provider} as provider, {tax_id} as tax_id
        from expense left join legislature l on try_cast(id_legislatura as smallint) = l.id"""


_BOTH_KNOWN = "case when cnpjCpfFornecedor is not null then nomeFornecedor end"

ORACLES: dict[str, str] = {
    "silver_legislature": f"""{_with(_LEGISLATURE)}
        select id, begins as "dataInicio", ends as "dataFim" from legislature""",
    "silver_party": f"""{_with(_PARTY)}
        select id, sigla, nome, logo as "urlLogo", situacao, members as total_membros, seated as total_posse
        from party""",
    "silver_deputy": f"""{_with(_DEPUTY)}, ranked as (
            select *, row_number() over (partition by id order by seen desc) as place from deputy_raw)
        select id, upper(c_name) as nome_civil, upper(c_name) as nome_eleitoral,
               last_legislature as id_ultima_legislatura, party as ultima_filiacao, concat('foto/', id) as foto,
               situacao as situacao_atual, 'Titular' as condicao_eleitoral_atual,
               try_cast(born as date) as data_nascimento, cast(null as date) as data_falecimento,
               n_name as "ufNascimento", lower(n_name) as "municipioNascimento", c_mktsegment as escolaridade
        from ranked where place = 1""",
    "silver_expense": f"{_with(_EXPENSE)} select * replace ({_MONEY}) from expense",
    "parse_lenient": f"""{_with(_DEPUTY)}
        select id, try_cast(born as date) as born,
               cast(epoch(try_cast(born as date)) as bigint)
                 + case id % 7 when 1 then 18000 when 2 then 10800 when 6 then 10800 else 28800 end as stamp
        from deputy_latest""",
    "timestamp_zone": f"""{_with(_EXPENSE)}
        select numDocumento, cast(epoch(moment) as bigint) as utc, cast(epoch(moment) as bigint) + 10800 as west,
               cast(epoch(moment) as bigint) - 19800 as east
        from expense_raw""",
    "timestamp_clock_changes": f"""{_with(_EXPENSE)}, nights as (
            select numDocumento, cast(moment as date) as day,
                   make_date(ano, 3, 31) - cast(dayofweek(make_date(ano, 3, 31)) as int) as spring,
                   case when ano < 1996 then make_date(ano, 9, 30) - cast(dayofweek(make_date(ano, 9, 30)) as int)
                        else make_date(ano, 10, 31) - cast(dayofweek(make_date(ano, 10, 31)) as int) end as autumn
            from expense_raw),
        changes as (
            select numDocumento, day, cast(epoch(day) as bigint) + 9000 as wall, day = spring or day = autumn as odd,
                   day > spring and day < autumn as summer, day = autumn as back from nights)
        select numDocumento, wall - case when summer or odd then 7200 else 3600 end as at_earlier,
               wall - case when summer then 7200 else 3600 end as at_later,
               case when not odd then wall - case when summer then 7200 else 3600 end end as at_null,
               wall - case when summer or back then 7200 else 3600 end as at_default
        from changes""",
    "filter_key_gt": f"{_with(_LEGISLATURE)} select id from legislature_raw where id > 57",
    "filter_nested": f"""{_with(_DEPUTY)}
        select id from deputy_raw where last_legislature = 57 and c_mktsegment = 'BUILDING'""",
    "rename_drop_copy": f"""{_with(_MEMBERSHIP)}
        select id as id_deputado, legislature as "idLegislatura", id + 1 as following,
               legislature as legislature_copy
        from membership""",
    "collect_membership": f"{_with(_MEMBERSHIP)} select id, uri, coalesce(legislaturas, '') as legislaturas from member_list",
    "membership_join": f"""{_with(_DEPUTY, _MEMBERSHIP)}
        select d.id, c_name as "nomeCivil", coalesce(legislaturas, '') as legislaturas
        from deputy_latest d join member_list m on d.id = m.id""",
    "fk_single": f"""{_with(_LEGISLATURE, _DEPUTY)}
        select d.id, last_legislature as last, cast(begins as date) as begins
        from deputy_raw d left join legislature l on last_legislature = l.id""",
    "fk_inner_legacy": f"""{_with(_LEGISLATURE, _EXPENSE)}
        select numDocumento, l.id as found
        from expense_raw join legislature l on try_cast(id_legislatura as smallint) = l.id""",
    "fk_inner_pruned": f"""{_with(_EXPENSE)}
        select numDocumento, nomeFornecedor as found_name, cnpjCpfFornecedor as found_tax_id
        from expense_raw where right(nomeFornecedor, 1) in ('0', '3', '6', '9') and cnpjCpfFornecedor is not null""",
    "fk_cast_lenient": f"""{_with(_LEGISLATURE, _EXPENSE)}
        select numDocumento, id_legislatura, l.id as found
        from expense_raw left join legislature l on try_cast(id_legislatura as smallint) = l.id""",
    "fk_composite_plain": f"""{_with(_EXPENSE)}, providers as (
            select distinct nomeFornecedor as name, cnpjCpfFornecedor as tax_id from expense_raw)
        select numDocumento, name as found_name, tax_id as found_tax_id
        from expense_raw left join providers on nomeFornecedor = name and cnpjCpfFornecedor = tax_id""",
    "fk_composite_nullsafe": f"""{_with(_EXPENSE)}, providers as (
            select distinct nomeFornecedor as name, cnpjCpfFornecedor as tax_id from expense_raw)
        select numDocumento, name as found_name, tax_id as found_tax_id
        from expense_raw left join providers
          on nomeFornecedor is not distinct from name and cnpjCpfFornecedor is not distinct from tax_id""",
    "content_key_skip": f"""{_with(_EXPENSE)}
        select id_deputado, id_legislatura, numDocumento, cast(valorDocumento as double) as valorDocumento,
               sha256(concat_ws('|', id_deputado, id_legislatura, numDocumento, valorDocumento)) as id_despesa
        from expense_raw""",
    "content_key_token": f"""{_with(_EXPENSE)}
        select numDocumento, urlDocumento, cnpjCpfFornecedor, cast(valorDocumento as double) as valorDocumento,
               {_token_hash("numDocumento", "urlDocumento", "cnpjCpfFornecedor", "valorDocumento")} as key
        from expense_raw""",
    "sk_dense_properties": """
        select count(*) as n, count(*) as keys, cast(1 as bigint) as lowest, count(*) as highest from orders""",
    "sk_registered": f"""{_with(_DEPUTY)}, first as (
            select id, row_number() over (order by id) as sk_first from deputy_latest where id % 3 <> 0),
        new as (
            select id, (select max(sk_first) from first) + row_number() over (order by id) as sk_new
            from deputy_latest where id % 5 <> 0 and id % 3 = 0)
        select id, upper(c_name) as nome_civil, f.sk_first,
               case when id % 5 <> 0 then coalesce(f.sk_first, sk_new) end as sk_second
        from deputy_latest left join first f using (id) left join new using (id) where id % 3 <> 0 or id % 5 <> 0""",
    "sk_hash_properties": f"{_with(_EXPENSE)} select count(*) as n, count(*) as keys from expense",
    "sk_hash64_properties": "select count(*) as n, count(distinct o_orderkey) as keys from orders",
    "sk_monotonic_properties": "select count(*) as n, count(*) as keys, cast(1 as bigint) as lowest from orders",
    "sk_uuid_properties": "select count(*) as n, count(*) as keys from orders",
    "dim_expense_type": "select distinct o_orderpriority as tipoDespesa from lineitem join orders on l_orderkey = o_orderkey",
    "dim_provider": f"{_with(_EXPENSE)} select distinct nomeFornecedor, cnpjCpfFornecedor from expense",
    "dim_provider_by_name": f"""{_with(_EXPENSE)}, ranked as (
            select nomeFornecedor as name, cnpjCpfFornecedor as tax_id, row_number() over (
                partition by nomeFornecedor order by cnpjCpfFornecedor nulls first) as place
            from expense_raw)
        select name as nomeFornecedor, tax_id as cnpjCpfFornecedor from ranked where place = 1""",
    "dimensions": f"""{_with(_LEGISLATURE, _PARTY, _DEPUTY)}
        select 'sk_legislatura' as key, {_line("id", "begins", "ends")}, 1 as dense from legislature
        union all select 'sk_partido', {_line("sigla", "nome", "situacao", "members", "seated", "logo")}, 1 from party
        union all select 'sk_deputado', {_line("id", "upper(c_name)", "upper(c_name)", "last_legislature", "party",
            "concat('foto/', id)", "situacao", "'Titular'", "try_cast(born as date)", "null", "n_name", "lower(n_name)", "c_mktsegment")}, 1
        from deputy_latest""",
    "deputy_links": f"""{_with(_LEGISLATURE, _PARTY, _DEPUTY)}
        select d.id, l.id as legislature, p.sigla as party
        from deputy_latest d left join legislature l on last_legislature = l.id left join party p on party = p.sigla""",
    "fact_expense": _fact(_BOTH_KNOWN, "cnpjCpfFornecedor"),
    "fact_expense_looked_up": _fact("nomeFornecedor", "cnpjCpfFornecedor"),
    "fact_legacy": f"""{_with(_LEGISLATURE, _EXPENSE)}, named as (
            select nomeFornecedor as name, min(cnpjCpfFornecedor) as tax_id, count(*) - count(cnpjCpfFornecedor) as unknown
            from expense group by nomeFornecedor)
        select {_MEASURES.format(key=_FACT_KEY)}, id_deputado as deputy, l.id as legislature,
               tipoDespesa as expense_type, name as provider, case when unknown = 0 then tax_id end as tax_id
        from expense join legislature l on try_cast(id_legislatura as smallint) = l.id
        left join named on nomeFornecedor = name""",
    "fact_keys": f"""{_with(_LEGISLATURE, _EXPENSE)}
        select {_MEASURES.format(key=_FACT_KEY)}, 1 as sk_deputado,
               cast(l.id is not null as int) as sk_legislatura, 1 as sk_tipo_despesa,
               cast(cnpjCpfFornecedor is not null as int) as sk_fornecedor
        from expense left join legislature l on try_cast(id_legislatura as smallint) = l.id""",
    "overwrite_table": f"""{_with(_DEPUTY)}
        select id, upper(c_name) as nome_civil, try_cast(born as date) as data_nascimento from deputy_latest""",
    "partitioned_round_trip": f"{_with(_EXPENSE)} select * replace ({_MONEY}), mes as mes1, ano as ano1 from expense",
    "append_twice": f"""{_with(_EXPENSE)}
        select ano as ano1, mes as mes1, 2 * count(*) as n,
               cast(2 * sum(valorDocumento) as double) as total, count(*) as n_distinct,
               cast(sum(valorDocumento) as double) as total_distinct
        from expense group by all""",
    "append_once_by_run": f"""{_with(_EXPENSE)}, months as (
            select ano as ano1, mes as mes1, count(*) as n, sum(valorDocumento) as total,
                   ano = 1997 and mes = 3 as again from expense group by all)
        select ano1, mes1, n * case when again then 2 else 1 end as n,
               cast(total * case when again then 2 else 1 end as double) as total, case when again then n end as added_last
        from months""",
    "silver_incremental": f"""{_with(_EXPENSE)}
        select ano as ano1, mes as mes1, nullif(count(*) filter (where not (ano = 1995 and mes = 2)), 0) as n,
               cast(sum(valorDocumento) filter (where not (ano = 1995 and mes = 2)) as double) as total,
               case when ano = 1997 and mes = 3 then 'rebuilt' when ano = 1995 and mes = 2 then 'gone' end as change
        from expense group by all""",
    "replace_partitions": f"""{_with(_EXPENSE)}
        select ano as ano1, mes as mes1, count(*) as n, cast(sum(
                 case when ano = 1997 and mes = 3 then 2 else 1 end * valorDocumento) as double) as total
        from expense group by all""",
    "request_uris": """
        select c_custkey as id, case when c_custkey % 10 <> 0 then concat('api/deputados/', c_custkey,
            '/despesas?idLegislatura=57&nome=', replace(c_mktsegment, ' ', '%20'), '%20%26%20', replace(replace(c_name, '#', '%23'), ' ', '%20'), '&itens=100') end as uri
        from customer""",
    "joined_ids": "select distinct o_custkey as id, 1 as fits from orders",
    "list_request": f"""{_with(_LEGISLATURE)}
        select concat('api/deputados?idLegislatura=', string_agg(cast(id as varchar), ',' order by id), '&itens=100') as uri
        from legislature where id > 56""",
    "typed_fields": """
        select event_id, cast(regexp_extract(props, '"k": (-?[0-9]+)', 1) as int) as k, cast(null as varchar) as absent
        from events""",
    "envelope_items": """
        select concat(conv_id, '/', turn) as uri, conv_id, turn, role, text, cast(null as varchar) as absent
        from conversations""",
    "follow_chain": f"""{_with(_TURNS)}
        select conv_id as start_conv, page_no, conv_id, turn, role, text from usable""",
    "follow_at_most_three": f"{_with(_TURNS)} select conv_id, page_no, uri from usable where turn < 3",
    "quarantine_pages": f"""{_with(_TURNS)}
        select conv_id, page_no, uri, 503 as status, 'status' as reason
        from reached where turn = 1 and second = 'status'""",
    "fan_out_pages": f"""{_with(_FAN)}
        select concat('api/deputados/', id_deputado, '/despesas?n=', n) as start_uri, page_no, cast(status as int) as status
        from fan_visited""",
    "fan_out_items": f"""{_with(_FAN)}
        select id_deputado, concat(id_deputado, '-', position) as doc, cast(position as int) as position,
               '57' as id_legislatura
        from fan_visited, unnest(generate_series(3 * page_no, least(3 * page_no + 3, n) - 1)) as t(position)
        where status = 200""",
    "fan_out_rejected": f"""{_with(_FAN)}
        select id_deputado, page_no, cast(status as int) as status, 'status' as reason
        from fan_visited where status = 503""",
    "bronze_legislatures": f"""{_with(_LEGISLATURE)}
        select id, uri, cast(begins as varchar) as "dataInicio", cast(ends as varchar) as "dataFim" from legislature""",
    "bronze_parties": f"""{_with(_PARTY)}
        select id, sigla, nome, uri, situacao, members as "totalMembros", lider from party""",
    "bronze_deputies": f"""{_with(_DEPUTY, _MEMBERSHIP)}
        select d.id, d.id as id_deputado, c_name as "nomeCivil", party, born as "dataNascimento",
               coalesce(legislaturas, '') as legislaturas
        from deputy_latest d join member_list m on d.id = m.id""",
    "bronze_expenses": f"""{_with(_EXPENSE)}
        select id_deputado, '57' as id_legislatura, numDocumento, cast(valorDocumento as double) as valorDocumento,
               strftime(moment, '%Y-%m-%dT%H:%M:%S') as "dataDocumento",
               sha256(concat_ws('|', id_deputado, '57', numDocumento, valorDocumento)) as id_despesa,
               ano, mes, ano as ano1, mes as mes1
        from expense_raw join customer on id_deputado = c_custkey""",
    "star_publish": f"""{_with(_LEGISLATURE, _PARTY, _DEPUTY, _EXPENSE)}, lines as (
            select 'legislature' as name, {_line("id", "begins", "ends")} from legislature
            union all select 'party', {_line("sigla", "nome", "situacao", "members", "seated", "logo")} from party
            union all select 'deputy', {_line("id", "upper(c_name)", "situacao", "try_cast(born as date)", "c_mktsegment")} from deputy_latest
            union all select distinct 'expense_type', {_line("tipoDespesa")} from expense
            union all select distinct 'provider', {_line("nomeFornecedor", "cnpjCpfFornecedor")} from expense
            union all select 'fact', {_line("ano", "mes")} from expense)
        select name, line, count(*) as n from lines group by name, line""",
    "envelope_odd_shapes": """
        select concat(conv_id, '/', turn) as uri,
               cast(case when (conv_id + turn) % 7 in (0, 3, 4, 5) then 1 else 0 end as bigint) as items,
               cast(case when (conv_id + turn) % 7 in (3, 4) then 1 else 0 end as bigint) as odd,
               case when (conv_id + turn) % 7 in (1, 2) then 'shape' when (conv_id + turn) % 7 = 6 then 'link' else 'ok' end as reason
        from conversations""",
    "fan_out_unreadable_link": f"""{_with(_FAN)}
        select id_deputado, page_no, case when id_deputado % 3 = 0 then 'link' when status = 503 then 'status' else 'ok' end as reason
        from fan_visited where status <> 404 and (id_deputado % 3 <> 0 or page_no = 0)""",
}
ORACLES["fan_out_by_number"] = ORACLES["fan_out_pages"]
ORACLES["bronze_parties_chunked"] = ORACLES["bronze_parties"]
ORACLES["fk_composite_salted"] = ORACLES["fk_composite_nullsafe"]
# Expenses are asked for under legislature 57, and only of deputies that are a member of one.
ORACLES["layers_in_order"] = f"""{_with(_EXPENSE)}, spent as (
        select distinct * replace ('57' as id_legislatura) from expense)
    select {_MEASURES.format(key=_FACT_KEY)}, id_deputado as deputy, cast(57 as smallint) as legislature,
           tipoDespesa as expense_type, {_BOTH_KNOWN} as provider, cnpjCpfFornecedor as tax_id
    from spent"""
ORACLES["layers_requested"] = ORACLES["layers_in_order"]
ORACLES["fk_composite_bucketed"] = ORACLES["fk_composite_plain"]
ORACLES["clustered_round_trip"] = ORACLES["partitioned_round_trip"]
