from collections import defaultdict

import public_tokenizers
import pytest
from odd import ROWS, odd_docs
from test_lines import brute as brute_lines
from test_minhash import brute as brute_classes
from test_packing import check_pieces

import corpus_pipeline
from checks.compare import difference, oracle
from lakestar.llm.common import written
from lakestar.llm.language import UNKNOWN, fit_languages, identify_languages
from lakestar.llm.mixing import mix
from lakestar.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_against_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), db.execute(ORACLES[name]).df()) is None


def test_the_contract_has_every_query():
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kinds = docs.dtypes
    stage = dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in docs.collect()]

    known = written(stage["language ID"](spark, docs, SF), "t")
    labels = {r.own_doc_id: r.lang_pred for r in identify_languages(docs, fit_languages(docs)).collect()}
    assert known.dtypes == kinds and sorted(map(tuple, known.collect())) == sorted(r for r in rows if labels[r[0]] != UNKNOWN)

    rows = [tuple(r) for r in known.collect()]
    bare = written(stage["line dedup"](spark, known, SF), "t")
    cut = {r[0]: r for r in brute_lines(rows, 5)}
    expected = [
        (d, cut[d][1], lang, source, len(cut[d][1]) if cut[d][3] else n)
        for d, _, lang, source, n in rows
        if not cut[d][3] or cut[d][1].strip()
    ]
    assert bare.dtypes == kinds and sorted(map(tuple, bare.collect())) == sorted(expected)

    rows = [tuple(r) for r in bare.collect()]
    single = written(stage["MinHash near-dedup"](spark, bare, SF), "t")
    kept = {d for d, c in brute_classes(rows) if d == c}
    assert single.dtypes == kinds and sorted(map(tuple, single.collect())) == sorted(r for r in rows if r[0] in kept)

    mixed = written(stage["mixing sources to target weights"](spark, single, SF), "t")
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r.doc_id] += len(r.text.split())
    assert mixed.dtypes == kinds and taken == {r.doc_id: r.taken for r in mix(single).collect() if r.taken}

    check_pieces([tuple(r) for r in mixed.collect()], stage["packing"](spark, mixed, SF).collect())


def test_near_dedup_keeps_clean_texts(spark):
    """Ids that repeat or are missing take no clean text away, and leave no copy."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, b), (2, a), (3, b), (None, c), (None, c), (None, c + " more"), (5, None), (5, "  ")]
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    out = stage(spark, odd_docs(spark, [(i, t, None, None, None) for i, t in rows]), SF).collect()
    assert sorted(r.text for r in out if r.doc_id == 1) == sorted([a, b])
    others = [(r.doc_id, r.text) for r in out if r.doc_id != 1]
    assert len(others) == 3 and {(5, None), (5, "  ")} < set(others) and sum(t in (c, c + " more") for _, t in others) == 1


def test_language_stage_rejects_scripts_it_never_saw(spark):
    english, german = "the quick brown fox jumps over the lazy dog ", "der schnelle braune Fuchs springt über den Hund "
    rows = [(1, english * 4, "en"), (2, german * 4, "de"), (3, "これは日本語の文章です", None), (4, "これは the quick brown fox", None), (5, english, None)]
    stage = dict(corpus_pipeline.STAGES)["language ID"]
    out = stage(spark, odd_docs(spark, [(i, t, lang, "a", 1) for i, t, lang in rows]), SF).collect()
    assert sorted(r.doc_id for r in out) == [1, 2, 4, 5]


def test_the_run_is_its_stages(spark):
    a = corpus_pipeline.run(spark, SF).toPandas()
    b = corpus_pipeline.run(spark, SF).toPandas()
    assert len(a) and difference(a, b) is None
    assert public_tokenizers.path(corpus_pipeline.VOCABULARY)


def test_odd_rows_pass_every_stage(spark):
    for rows in (ROWS, []):
        docs = odd_docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), "t")
            if name != "packing":
                assert docs.dtypes == odd_docs(spark, []).dtypes
        assert (docs.count() > 0) == bool(rows)
