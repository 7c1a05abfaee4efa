import hashlib
import re

import numpy as np
import pytest
from odd import ROWS, odd_docs

from lakestar.llm.exact import exact_duplicates, golomb_decode, golomb_encode, suspects


@pytest.mark.parametrize("n, top", [(0, 9), (1, 1), (5, 6), (3000, 1 << 40), (3000, 3001)])
def test_golomb_round_trip(n, top):
    values = np.sort(np.random.default_rng(n).choice(top, n, replace=False).astype(np.uint64)) if top < 1e7 else np.unique(
        np.random.default_rng(n).integers(0, top, n).astype(np.uint64)
    )
    k, code = golomb_encode(values)
    assert (golomb_decode(code, k, len(values)) == values).all()


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    found = []
    for row, text in zip(rows, norm):
        same = [r[0] for r, t in zip(rows, norm) if t == text]
        ids = [i for i in same if i is not None]
        keep = (min(ids) if ids else None) if len(same) > 1 else row[0]
        found.append((row[0], keep, len(same), hashlib.sha256(text.encode()).hexdigest()))
    return found


def key(row):
    return tuple((v is None, v) for v in row)


def test_odd_rows(spark):
    out = exact_duplicates(odd_docs(spark)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=key) == sorted(brute(ROWS), key=key)
    by_text = {}
    for r in out:
        by_text.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(kept) == 1 for kept in by_text.values())


def test_many_parts_and_a_hot_text(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 700}", None, None, None) for i in range(3000)]
    out = exact_duplicates(odd_docs(spark, rows).repartition(9)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == sorted(brute(rows))


def test_marks_in_two_parts_are_suspected(spark):
    rows = [(p, m << 40) for p, m in ((0, 1), (0, 2), (1, 2), (1, 3), (2, 4), (2, 4), (3, -5))]
    marked = spark.createDataFrame(rows, "part int, mark long")
    found = {(r.part, r.mark >> 40): r.suspect for r in suspects(marked, 1 << 30).collect()}
    assert found == {(0, 1): False, (0, 2): True, (1, 2): True, (1, 3): False, (2, 4): True, (3, -5): False}


def test_empty(spark):
    assert exact_duplicates(odd_docs(spark, [])).count() == 0
