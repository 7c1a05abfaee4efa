import re
from collections import defaultdict

import pytest
from odd import ROWS, odd_docs
from pyspark.sql import functions as F

from lakestar.llm.lines import dedup_lines, spread_lines
from lakestar.llm.queries import op10_line_dedup


def brute(rows, sites):
    bare = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
    seen, first = defaultdict(set), {}
    for doc_id, text, _, source, _ in rows:
        for i, line in enumerate((text or "").split("\n")):
            if bare(line):
                seen[bare(line)].add(source)
                at = (doc_id is None, doc_id or 0, i)
                first[bare(line)] = min(first.get(bare(line), at), at)
    found = []
    for doc_id, text, _, _, _ in rows:
        kept = [
            line
            for i, line in enumerate((text or "").split("\n"))
            if not bare(line) or len(seen[bare(line)]) < sites or first[bare(line)] == (doc_id is None, doc_id or 0, i)
        ]
        n = len((text or "").split("\n"))
        found.append((doc_id, None if text is None else "\n".join(kept), 0 if text is None else n, n - len(kept)))
    return found


@pytest.mark.parametrize("sites", [2, 3, 5])
def test_whole_rows(spark, sites):
    rows = [
        (i, "\n".join([f"own {i}", "shared  by all", "" if i % 2 else " \t", f"by {i % 4}", "shared by all "]), None, None if i % 5 == 0 else f"s{i % 6}", i)
        for i in range(40)
    ]
    out = dedup_lines(odd_docs(spark, rows).repartition(4), sites).select("doc_id", "text", "lines", "lines_removed")
    assert sorted(map(tuple, out.collect())) == sorted(brute(rows, sites))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = dedup_lines(docs, 2)
    assert out.columns == [*(c for c in docs.columns if c != "lines"), "lines", "lines_removed"]
    key = lambda r: tuple((v is None, v) for v in r)
    ours = [tuple(r) for r in out.select("doc_id", "text", "lines", "lines_removed").collect()]
    assert sorted(ours, key=key) == sorted(brute(ROWS, 2), key=key)
    assert dedup_lines(odd_docs(spark, [])).count() == 0


def test_sketches_and_exact_counts_find_the_same_lines(spark):
    seen = spark.range(400).select((F.col("id") % 40).alias("a"), F.lit(0).alias("b"), (F.col("id") % 40 * 7 + F.col("id") % (1 + F.col("id") % 40)).alias("site"))
    counts = seen.groupBy("a").agg(F.countDistinct("site").alias("n")).collect()
    for sites in (2, 4, 7):
        assert {r.a for r in spread_lines(seen, sites).collect()} == {r.a for r in counts if r.n >= sites}


def test_no_python_in_the_plan(spark):
    plan = op10_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
