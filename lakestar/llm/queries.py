"""One query per operator over the driver's whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.chat import chat_round_trip
from lakestar.llm.embeddings import embedding_duplicates
from lakestar.llm.exact import exact_duplicates
from lakestar.llm.fingerprints import fingerprints
from lakestar.llm.infill import fill_in_middle, restored
from lakestar.llm.language import fit_languages, held_out, identify_languages
from lakestar.llm.lines import dedup_lines
from lakestar.llm.minhash import near_duplicates
from lakestar.llm.mixing import mix
from lakestar.llm.negatives import hard_negatives
from lakestar.llm.packing import pack
from lakestar.llm.secrets import scan_secrets
from lakestar.llm.wavelet import token_files

VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.where(~held_out()))
    found = identify_languages(docs, model).withColumnRenamed("own_doc_id", "doc_id")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("mark", "alone")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return chat_round_trip(turns.unionByName(own))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines", "lines_removed")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # imports this module

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_language_id,
        op3_embedding_dedup,
        op4_pack,
        op5_token_files,
        op6_minhash_dedup,
        op7_chat_format,
        op8_exact_dedup,
        op9_secret_scan,
        op10_line_dedup,
        op11_hard_negatives,
        op12_fingerprints,
        op13_fill_in_middle,
        pipeline,
    )
}

_BLANKS = r"[\x20\x09-\x0D]+"

_REACH = """
reach(node, root) as (select id, id from nodes union select l.b, r.root from reach r join links l on l.a = r.node),
component as (select node, min(root) as root from reach group by node)"""

ORACLES: dict[str, str] = {
    "op3_embedding_dedup": f"""
with recursive nodes as (select vec_id as id from embeddings),
v as (
    select vec_id, label, embedding::double[] as e from embeddings
    where label is not null and embedding is not null
      and len(list_filter(embedding::double[], lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding::double[], lambda x: x <> 0)) > 0
),
links as (
    select x.vec_id as a, y.vec_id as b from v x join v y on x.label = y.label and x.vec_id <> y.vec_id
    and len(x.e) = len(y.e) and list_cosine_similarity(x.e, y.e) >= 0.93
),{_REACH}
select e.vec_id, (select count(*) from links l where l.a = e.vec_id) as n_links, c.root as component_id,
       e.vec_id = c.root as kept
from embeddings e join component c on c.node = e.vec_id
""",
    "op6_minhash_dedup": r"""
with recursive w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
s as (
    select distinct doc_id, unnest(case when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from w
),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.s = y.s and x.doc_id <> y.doc_id group by all),
nodes as (select doc_id as id from documents),
links as (
    select a, b from common join n p on p.doc_id = a join n q on q.doc_id = b where c >= 0.8 * (p.n + q.n - c)
),"""
    + _REACH
    + """
select node as doc_id, root as class_id, count(*) over (partition by root) as group_size, node = root as kept from component
""",
    "op7_chat_format": r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
r as (
    select *, case role when 'user' then 15 when 'system' then 18 when 'assistant' then 8 else 15 + length(role) end
        + length(regexp_replace(text, '(\\*)(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<TURN )', '\\\1\2', 'g')) as chars
    from c
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars
from r group by conv_id
""",
    "op8_exact_dedup": rf"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '{_BLANKS}', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept,
       sha256(t) as text_sha256
from n window w as (partition by t)
""",
    "op10_line_dedup": rf"""
with cut as (select doc_id, source, text, string_split(coalesce(text, ''), chr(10)) as l from documents),
each as (select doc_id, source, unnest(l) as line, generate_subscripts(l, 1) as place from cut),
bare as (select *, trim(regexp_replace(line, '{_BLANKS}', ' ', 'g')) as b from each),
spread as (
    select b, min((doc_id, place)) as first from bare where b <> '' group by b
    having count(distinct source) + max(case when source is null then 1 else 0 end) >= 5
),
judged as (select e.*, s.b is not null and (e.doc_id, e.place) <> s.first as gone from bare e left join spread s on s.b = e.b),
rest as (
    select doc_id, string_agg(line, chr(10) order by place) filter (not gone) as text, sum(gone::int) as n from judged group by doc_id
)
select c.doc_id, case when c.text is not null then coalesce(r.text, '') end as text,
       cast(case when c.text is null then 0 else len(c.l) end as bigint) as lines, cast(r.n as bigint) as lines_removed
from cut c join rest r on r.doc_id = c.doc_id
""",
    "op11_hard_negatives": """
with v as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)) as e
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
    select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, cast(list_inner_product(a.e, b.e) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0
),
p as (
    select anchor_id, other as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
),
n as (
    select anchor_id, positive_id, other as negative_id, positive_score, score as negative_score,
           row_number() over (partition by anchor_id, positive_id order by score desc, other) as rank
    from p join s using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 3
""",
    "op13_fill_in_middle": r"""
with d as (
    select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u
    from documents
),
h as (
    select *, len(u) as n, cast('0x' || h[1:8] as bigint) % (len(u) + 1) as a, cast('0x' || h[9:16] as bigint) % (len(u) + 1) as b,
           case when t = '' or regexp_matches(t, '<[PSM]>') or cast('0x' || h[17:24] as bigint) % 100 >= 50 then 'plain'
                when cast('0x' || h[25:32] as bigint) % 100 < 80 then 'spm' else 'psm' end as form
    from d
),
p as (
    select doc_id, n, form, t, array_to_string(u[1:least(a, b)], '') as prefix,
           array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as middle, array_to_string(u[greatest(a, b) + 1:], '') as suffix
    from h
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p
""",
}
