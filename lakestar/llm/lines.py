"""Line dedup: lines that spread over many sites are boilerplate; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import Written, written

#: Sites from which on a line is boilerplate.
SITES = 5
#: log2 of a sketch's registers, and the share around the threshold that is counted exactly: five
#: standard errors of such a sketch.
REGISTERS = 12
NEAR = 0.1


def _lines(text: str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _bare(line: Column) -> Column:
    return F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))


def _row(source: str) -> list[Column]:
    """Two hashes that tell rows of one id, or of none, apart; copies of a row share them."""
    own = ["text", source, F.col(source).isNull()]
    return [F.xxhash64(*own).alias("row_a"), F.xxhash64(F.lit(1), *own).alias("row_b")]


def spread_lines(seen: DataFrame, sites: int = SITES) -> DataFrame:
    """``a, b`` of lines in ``sites`` sites or more, from rows of ``a, b, site``.

    A site's lines are sketched where they lie and the sketches merged by line; only lines whose
    estimate is near the threshold are counted exactly.
    """
    sketched = written(
        seen.groupBy("a", "b")
        .agg(F.hll_sketch_agg("site", F.lit(REGISTERS)).alias("sketch"))
        .select("a", "b", F.hll_sketch_estimate("sketch").alias("about")),
        "sketched",
    )
    low, high = min(sites - 1, sites * (1 - NEAR)), max(sites + 1, sites * (1 + NEAR))
    near = sketched.where(F.col("about").between(low, high)).select("a", "b")
    apart = seen.select("a", "b", "site").distinct()  # a frequent line is one row per site before it meets
    counted = apart.join(near, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count("site").alias("n"))
    return sketched.where(F.col("about") > high).select("a", "b").union(counted.where(F.col("n") >= sites).select("a", "b"))


def dedup_lines(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """``docs`` with boilerplate lines removed from ``text``, plus ``lines`` and ``lines_removed``.

    A line is compared with runs of ASCII blanks as one blank and none at its ends; blank lines are
    never removed. A line in ``sites`` distinct sources or more stays where it comes first, by
    ``doc_id`` (null last), place and a hash of the row, and goes everywhere else. A null source is a
    site of its own. A null text stays null. Rows without an id, or that repeat one, are judged one by
    one; only rows equal in ``doc_id``, text and source are one, and each copy keeps the same lines.
    Other columns stay as they are. An empty table gives no row.

    Lines of a single site, nearly all, leave after one aggregation on two hashes; sketches, exact
    counts and places are made for the rest. Every aggregation combines before its shuffle.
    """
    own = docs.select("doc_id", "text", F.coalesce(F.xxhash64("source"), F.lit(0)).alias("site"), F.col("source").isNull().alias("none"), *_row("source"))
    own = own.withColumn("site", F.when(F.col("none"), F.lit(-1)).otherwise(F.col("site"))).drop("none")
    row = ["doc_id", "row_a", "row_b"]
    each = own.select(*row, "site", F.posexplode(_lines("text")).alias("place", "line"))
    each = each.withColumn("line", _bare(F.col("line"))).where("line != ''")
    found = Written(
        each.select(*row, "site", "place", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b")), "lines"
    )
    # Stored sides let a join split the rows of a very frequent line over tasks.
    ends = found.df.groupBy("a", "b").agg(F.min("site").alias("x"), F.max("site").alias("y"))
    several = Written(ends.where("x != y").select("a", "b"), "several")
    shared = Written(found.df.join(several.df, ["a", "b"], "left_semi"), "shared")
    found.drop()
    several.drop()
    spread = written(spread_lines(shared.df, sites), "boilerplate")
    at = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "place", "row_a", "row_b")
    hits = Written(shared.df.join(spread, ["a", "b"], "left_semi"), "spread")
    shared.drop()
    first = written(hits.df.groupBy("a", "b").agg(F.min(at).alias("first")), "first")
    gone = (
        hits.df.join(first, ["a", "b"])
        .where(~at.eqNullSafe(F.col("first")))
        .groupBy(*[F.col(c).alias(f"gone_{c}") for c in row])
        .agg(F.collect_set("place").alias("gone"))
    )
    kept = F.filter(_lines("text"), lambda _, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    names = docs.columns
    numbered = docs.withColumnsRenamed({n: f"own_{n}" for n in names if n != "doc_id" and n != "text"})
    numbered = numbered.select("*", *_row("own_source"))
    same = [F.col(c).eqNullSafe(F.col(f"gone_{c}")) for c in row]
    joined = numbered.join(gone.hint("shuffle_hash"), same, "left")
    changed = joined.select(
        *[F.col("doc_id"), F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")],
        *[F.col(f"own_{n}").alias(n) for n in names if n not in ("doc_id", "text", "lines", "lines_removed")],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(_lines("text"))).cast("long").alias("lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("lines_removed"),
    )
    return changed.select(*[n for n in names if n not in ("lines", "lines_removed")], "lines", "lines_removed")
