"""Documents to packed sequences in five stages; each reads what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.llm.common import WORD, written
from lakestar.llm.language import UNKNOWN, fit_languages, identify_languages
from lakestar.llm.lines import dedup_lines
from lakestar.llm.minhash import near_duplicates
from lakestar.llm.mixing import mixed_rows
from lakestar.llm.packing import pack
from lakestar.llm.queries import VOCABULARY


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text may be in a language that the labelled rows teach.

    Null and letterless texts go, and texts whose every letter is in a script that no labelled row has.
    """
    model = fit_languages(docs)
    found = identify_languages(docs, model, carry=docs.columns).where((F.col("lang_pred") != UNKNOWN) & (F.col("foreign") < 1))
    return found.select(*[F.col(f"own_{c}").alias(c) for c in docs.columns])


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the lines that stand in many sources; a row of which no line is left goes."""
    clash = {c: f"kept_{c}" for c in ("lines", "lines_removed") if c in docs.columns}
    cut = dedup_lines(docs.withColumnsRenamed(clash))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", changed.cast(dict(docs.dtypes)["n_chars"]))
    left = (F.col("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return cut.where(left).select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every class of near duplicates: the one with the smallest id, null last, then by its text.

    Classes go by texts: different texts under one id both stay, copies without an id leave one. Rows
    without words are classes of their own.
    """
    near = near_duplicates(docs).where("kept and not alone")
    kept = near.select(F.col("doc_id").alias("kept_id"), F.col("mark").alias("kept_mark")).distinct()
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.struct(*docs.columns).alias("own"), F.col("doc_id").cast("long").alias("own_id"), F.xxhash64(text).alias("own_mark"), text.rlike(WORD).alias("worded"))
    same = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_mark") == F.col("kept_mark"))
    first = Window.partitionBy("own_id", "own_mark").orderBy(F.xxhash64("own"))
    one = own.where("worded").join(kept, same, "left_semi").withColumn("nth", F.row_number().over(first)).where("nth = 1")
    return one.select("own.*").unionByName(own.where("not worded").select("own.*"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: rows as often as their source's target has it, some in part, some not at all."""
    return mixed_rows(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows, laid out in sequences."""
    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", known_language),
    ("line dedup", without_boilerplate),
    ("MinHash near-dedup", one_of_each_class),
    ("mixing sources to target weights", mixed),
    ("packing", packed),
]

#: Models, signatures and a linear program: SQL has no words for them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
