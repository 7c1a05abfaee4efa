import hashlib

import numpy as np
import pytest
from odd import ROWS, odd_docs
from pyspark.sql import functions as F

from lakestar.llm import minhash
from lakestar.llm.minhash import BANDS, dart_signature, dealt_outside, near_duplicates, similarity
from lakestar.llm.shingles import STEP, shingles, word_hashes


def grams(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Smallest id of what similarities of 0.8 and more connect."""
    sets = [grams(r[1]) for r in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= 0.8 * len(a | b):
                at[root(i)] = root(j)
    classes = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            classes[root(i)] = min(classes.get(root(i), r[0]), r[0])
    return [(r[0], classes.get(root(i))) for i, r in enumerate(rows)]


def variants(n=240, seed=1):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(3000)]
    bases = [list(r.choice(words, int(k))) for k in r.integers(3, 400, 20)]
    rows = []
    for i in range(n):
        text = list(bases[i % 20])
        for _ in range(int(r.integers(0, 1 + len(text) // 40))):
            text[int(r.integers(len(text)))] = str(r.choice(words))
        rows.append((i, " ".join(text), None, None, None))
    return rows


def test_classes_are_those_of_all_pairs(spark):
    rows = variants()
    out = near_duplicates(odd_docs(spark, rows).repartition(6)).collect()
    assert sorted((r.doc_id, r.class_id) for r in out) == sorted(brute(rows))
    sizes = {}
    for r in out:
        sizes[r.class_id] = sizes.get(r.class_id, 0) + 1
    assert all(r.group_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in out)


def test_chains_of_alike_documents_are_one_class(spark):
    """Neighbours are alike, ends aren't, and the first of a band is like few of its members."""
    words = [f"v{i}" for i in range(900)]
    rows = [(200 - i, " ".join(words[3 * i : 3 * i + 120]), None, None, None) for i in range(150)]
    out = near_duplicates(odd_docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in out) == sorted(brute(rows))


def family(n=150):
    """Variants of one text: alike in pairs here and there, in bands of many."""
    r = np.random.default_rng(9)
    base = [f"u{i}" for i in range(220)]
    rows = []
    for i in range(n):
        text = list(base)
        for at in r.choice(220, int(r.integers(1, 6)), replace=False):
            text[at] = f"x{r.integers(1000)}"
        rows.append((i, " ".join(text), None, None, None))
    return rows


@pytest.mark.parametrize("few, block, counted", [(64, 512, False), (2, 512, False), (2, 20, False), (2, 20, True)])
def test_large_bands_of_different_components(spark, monkeypatch, few, block, counted):
    monkeypatch.setattr(minhash, "FEW", few)
    monkeypatch.setattr(minhash, "BLOCK", block)
    out = near_duplicates(odd_docs(spark, family()), counted=counted).collect()
    expected = brute(family())
    assert len({c for _, c in expected}) > 5
    assert sorted((r.doc_id, r.class_id) for r in out) == sorted(expected)


def test_odd_rows(spark):
    out = near_duplicates(odd_docs(spark)).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.class_id) for r in out), key=key) == sorted(brute(ROWS), key=key)
    assert near_duplicates(odd_docs(spark, [])).count() == 0
    assert [r.kept for r in near_duplicates(odd_docs(spark, [(None, "a b", None, None, None)])).collect()] == [True]


def test_ids_that_repeat_or_are_missing(spark):
    """Texts are linked, not ids: two clean texts under one id are two classes, copies without ids are one."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, b), (2, a), (3, b), (None, c), (None, c + " more"), (None, c), (None, "d e f g h i"), (4, ""), (4, "")]
    rows = [(i, t, None, None, None) for i, t in rows]
    out = near_duplicates(odd_docs(spark, rows)).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(((r.doc_id, r.class_id) for r in out), key=key) == sorted(brute(rows), key=key)
    assert sorted(r.group_size for r in out) == [1, 1, 1, 2, 2, 2, 2, 3, 3, 3]
    assert len({(r.doc_id, r.mark) for r in out if r.kept and not r.alone}) == 4 and sum(r.alone for r in out) == 2


def test_one_outlier_in_a_large_band_deals_its_rows_once(spark):
    rows = [(7, i, 0 if i else 1) for i in range(5000)] + [(8, i, i % 2) for i in range(1000)]
    spread = dealt_outside(spark.createDataFrame(rows, "band long, x long, rx long"), 100)
    n = {r.band: r["count"] for r in spread.groupBy("band").count().collect()}
    assert n == {7: 5000 + 50, 8: 1000 * 5 + 500 * 10}
    met = spread.where("asked").alias("a").join(spread.where("not asked").alias("b"), ["band", "low", "high"])
    assert met.select("band", "a.x", F.col("b.x").alias("y")).distinct().groupBy("band").count().orderBy("band").collect() == [(7, 5000), (8, 500_000)]


@pytest.mark.parametrize("n, j", [(6, 0.5), (60, 0.8), (4000, 0.8)])
def test_signatures_agree_as_often_as_sets_overlap(n, j):
    r = np.random.default_rng(n)
    same, agreed = round(2 * j / (1 + j) * n), []
    for _ in range(20):
        x, y = r.integers(0, 2**63, n).astype(np.uint64), r.integers(0, 2**63, n).astype(np.uint64)
        y[:same] = x[:same]
        agreed.append((dart_signature(x) == dart_signature(y)).mean())
    assert abs(np.mean(agreed) - same / (2 * n - same)) < 0.04


def test_weights_count():
    r = np.random.default_rng(7)
    x, p = r.integers(0, 2**63, 200).astype(np.uint64), r.uniform(0.2, 4, 200)
    q = p * r.choice([0.5, 1, 1.5], 200)
    j = np.minimum(p, q).sum() / np.maximum(p, q).sum()
    assert abs((dart_signature(x, p, 3000) == dart_signature(x, q, 3000)).mean() - j) < 0.04


def test_counted_shingles(spark):
    line = "a b c d e f g h "
    rows = [(1, line * 2, None, None, None), (2, line * 60, None, None, None), (3, line * 58, None, None, None)]
    assert sorted(r.class_id for r in near_duplicates(odd_docs(spark, rows)).collect()) == [1, 1, 1]
    assert sorted(r.class_id for r in near_duplicates(odd_docs(spark, rows), counted=True).collect()) == [1, 2, 2]


def test_words_and_shingles():
    text = "uno\tdos  tres\ncuatro cinco seis é ab a b"
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    hashes = word_hashes(text)
    assert len(hashes) == len(words) and len(set(hashes.tolist())) == len(words)
    assert word_hashes(" dos")[0] == hashes[1]
    assert len(shingles(hashes)) == len(words) - 4 and len(shingles(hashes[:3])) == 1 and not len(shingles(hashes[:0]))
    assert shingles(hashes[:1])[0] != shingles(hashes[:2])[0]
    long = "".join(f"{hashlib.md5(str(i).encode()).hexdigest()[: i % 30]} " for i in range(120_000))
    assert len(long) > STEP
    assert (word_hashes(long) == np.array([word_hashes(w)[0] for w in long.split()])).all()
    assert similarity(hashes, hashes) == 1.0 and similarity(hashes, hashes[:0]) == 0.0
    assert BANDS
