import itertools
import zlib

import numpy as np
import pytest
from odd import ROWS, odd_docs

from lakestar.llm.language import SCRIPTS, UNKNOWN, fit_languages, held_out, identify_languages, label_text, viterbi, words_of
from lakestar.llm.queries import op2_language_id

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    return fit_languages(spark.read.parquet(f"{SF}/documents.parquet").where(~held_out()))


def test_held_out_documents_are_labelled_right(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = op2_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 150 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_predictions_use_nothing_but_the_text(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    bare = identify_languages(docs.selectExpr("-doc_id - 1 as doc_id", "text", "'xx' as lang"), model)
    full = {r.own_doc_id: tuple(r)[1:] for r in identify_languages(docs, model).collect()}
    assert {-r.own_doc_id - 1: tuple(r)[1:] for r in bare.collect()} == full


def test_spans_of_a_mixed_text(spark, model):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 800").collect()
    one = {lang: next(" ".join(r.text.split()[:60]) for r in rows if r.lang == lang) for lang in ("en", "de", "fr")}
    text = f"{one['de']} {one['fr']} 1234 {one['en']}"
    ((lang, score, spans, _),) = label_text(model, [text])
    assert [s[2] for s in spans] == ["de", "fr", "en"] and 0 < score < 1 and lang in one
    assert abs(spans[1][0] - len(one["de"]) - 1) < 30 and abs(spans[2][0] - text.index("1234")) < 30
    assert spans[0][0] == 0 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_viterbi_finds_the_best_path():
    r = np.random.default_rng(0)
    for _ in range(150):
        scores = [r.normal(size=(k, 3)) * 4 for k in r.integers(0, 7, size=5)]
        for own, path in zip(scores, viterbi(scores, 3.0)):
            worth = lambda p: sum(own[i, c] for i, c in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: E731, B023
            assert len(path) == len(own)
            best = max(worth(p) for p in itertools.product(range(3), repeat=len(own))) if len(own) else 0
            assert worth(path) == pytest.approx(best)


def test_scripts_narrow_the_candidates(spark):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate([("привет мир как дела", "ru"), ("hello world how are you", "en"), ("γεια σου κόσμε", "el")] * 5)]
    model = fit_languages(odd_docs(spark, rows))
    texts = ["неведомое", "unheard", "ανήκουστο", "見知らぬ"]
    assert [label_text(model, [t])[0][0] for t in texts[:3]] == ["ru", "en", "el"]
    assert label_text(model, texts[3:])[0][0] in model.names
    assert [s[0] for s in SCRIPTS] == sorted(s[0] for s in SCRIPTS)


def test_words():
    text = "Ab c1dé ÎX"
    found = words_of(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))
    assert [text[a:b] for a, b in zip(found.begins, found.ends)] == ["Ab", "c", "dé", "ÎX"]


def test_odd_rows(spark, model):
    out = identify_languages(odd_docs(spark), model, carry=odd_docs(spark).columns).collect()
    assert len(out) == len(ROWS)
    for r in out:
        letters = any(c.isalpha() for c in r.own_text or "")
        assert (r.lang_pred == UNKNOWN) == (not letters) and (r.score > 0) == letters
        assert all(r.own_text[s.begin : s.end].strip() for s in r.spans)
    assert identify_languages(odd_docs(spark, []), model).count() == 0
    none = fit_languages(odd_docs(spark, []))
    assert {r.lang_pred for r in identify_languages(odd_docs(spark), none).collect()} == {UNKNOWN}
