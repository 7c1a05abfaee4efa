import math

import numpy as np
import pytest

from lakestar.llm.components import components
from lakestar.llm.embeddings import SIMILAR, embedding_duplicates, link_block, tables_for


def brute(rows, least=SIMILAR):
    def fine(v):
        return v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)

    n = len(rows)
    linked = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            (_, a, x), (_, b, y) = rows[i], rows[j]
            if i != j and a is not None and a == b and fine(x) and fine(y) and len(x) == len(y):
                p, q = np.array(x, dtype=float), np.array(y, dtype=float)
                if p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= least:
                    linked[i].append(j)
    found = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        found.append((rows[i][0], len(linked[i]), min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)))
    return found


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, 0, b"", "c") for i, k, v in rows], "vec_id long, embedding array<double>, label int, x int, unit binary, copies string")


def test_against_all_pairs(spark):
    r = np.random.default_rng(2)
    rows, centres = [], r.normal(size=(12, 16))
    for i in range(400):
        v = centres[i % 12] + r.normal(size=16) * (0.05, 0.2, 0.35)[i % 3]
        rows.append((i * 3, i % 2 if i % 50 else None, [float(x) for x in (v if i % 9 else centres[0] * (1 + i % 2))]))
    out = embedding_duplicates(table(spark, rows).repartition(5)).collect()
    assert sorted((x.vec_id, x.n_links, x.component_id) for x in out) == brute(rows)
    assert all(x.kept == (x.vec_id == x.component_id) for x in out)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [inf, 1.0], [None, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, -0.0], [1.0], [1e-200, 0.0], [1e200, 0.0], [-1.0, 0.0]]
    rows = [(i, 1, v) for i, v in enumerate(vectors)] + [(50, None, [1.0, 0.0])]
    out = embedding_duplicates(table(spark, rows)).collect()
    found = {x.vec_id: (x.n_links, x.component_id) for x in out}
    assert {i: found[i] for i in (6, 7, 8, 10, 11)} == {i: (4, 6) for i in (6, 7, 8, 10, 11)}
    assert all(found[i] == (0, i) for i in found if i not in (6, 7, 8, 10, 11))
    assert embedding_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_rows_without_an_id_and_ids_that_repeat(spark, seed):
    """Rows are linked, whatever their ids: a null id takes no link away, a repeated one connects nothing."""
    r = np.random.default_rng(seed)
    v, w, u = ([float(x) for x in r.normal(size=8)] for _ in range(3))
    near = [x * (1 + 0.02 * (i % 2)) for i, x in enumerate(v)]
    rows = [(5, 1, v), (7, 1, near), (None, 1, v), (None, 1, w), (9, 1, w), (9, 1, u), (9, 1, u), (3, 1, u), (None, 2, u), (None, 2, [-x for x in u]), (9, 2, v)]
    rows += [(int(r.integers(0, 30)) if i % 4 else None, 3, [float(x) for x in (v if i % 3 else w) + r.normal(size=8) * 0.25]) for i in range(80)]
    key = lambda t: tuple((x is None, x) for x in t)
    out = embedding_duplicates(table(spark, rows).repartition(3)).collect()
    assert sorted(((x.vec_id, x.n_links, x.component_id) for x in out), key=key) == sorted(brute(rows), key=key)


def test_blocks_of_a_large_bucket_count_each_pair_once(spark, monkeypatch):
    import lakestar.llm.embeddings as module

    monkeypatch.setattr(module, "BLOCK", 16)
    r = np.random.default_rng(3)
    centre = r.normal(size=8)
    rows = [(i, 7, (centre + r.normal(size=8) * 0.02).tolist()) for i in range(120)]
    out = embedding_duplicates(table(spark, rows)).collect()
    assert sorted((x.vec_id, x.n_links, x.component_id) for x in out) == brute(rows)


def test_a_pair_counts_in_its_first_bucket_only():
    units = np.array([[1.0, 0.0], [1.0, 0.0]])
    keys = np.array([[5, 6, 7], [4, 6, 7]])
    assert link_block(np.array([9, 3]), np.array([1, 2]), units, keys, None, 7, 0.9) is None
    ids, links, roots = link_block(np.array([9, 3]), np.array([1, 2]), units, keys, None, 6, 0.9)
    assert (ids.tolist(), links.tolist(), roots.tolist()) == ([3, 9], [1, 2], [3, 3])


@pytest.mark.parametrize("rows", [10, 10_000, 10**9])
def test_the_share_missed_is_the_same_at_every_size(rows):
    bits, tables = tables_for(rows, SIMILAR)
    assert (1 - (1 - math.acos(SIMILAR) / math.pi) ** bits) ** tables <= 1e-5


def test_components(spark):
    r = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in r.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3), (5, 9), (9, 5)]
    at = list(range(2000))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in pairs:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            at[high] = low
    nodes = {x for a, b in pairs if a is not None and a != b for x in (a, b)}
    out = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(map(tuple, out)) == sorted((i, root(i)) for i in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
