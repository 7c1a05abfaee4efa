from collections import defaultdict

import numpy as np
import pytest
from odd import odd_docs

from lakestar.llm.mixing import BLOCK, apportion, fill_targets, mix, mixed_rows, sainte_lague


def cycle_weights(names):
    return [(5, 2, 1)[i % 3] for i in range(len(names))]


def by_quotients(votes, seats, most):
    won = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if won[i] < most[i] and votes[i] > 0]
        if not open_:
            break
        won[max(open_, key=lambda i: (votes[i] / (2 * won[i] + 1), -i))] += 1
    return won


@pytest.mark.parametrize("seed", range(30))
def test_seats_are_those_of_the_highest_quotients(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 9))
    votes = r.integers(0, 50, n).astype(float)
    most = r.integers(0, 40, n)
    seats = int(r.integers(0, 120))
    won, extra = sainte_lague(votes, seats, most)
    assert (won + extra).tolist() == by_quotients(votes, seats, most)


@pytest.mark.parametrize("seed", range(20))
def test_entries_that_stand_for_several(seed):
    r = np.random.default_rng(seed)
    votes, most, times = r.integers(0, 9, 6).astype(float), r.integers(0, 9, 6), r.integers(1, 5, 6)
    seats = int(r.integers(0, 90))
    won, extra = sainte_lague(votes, seats, most, times)
    each = [won[i] + (k < extra[i]) for i in range(6) for k in range(times[i])]
    assert sorted(each) == sorted(by_quotients(np.repeat(votes, times), seats, np.repeat(most, times)))


@pytest.mark.parametrize("seed", range(20))
def test_apportioned_words_are_near_their_targets(seed):
    r = np.random.default_rng(seed)
    sizes, times = r.integers(0, 300, 12), r.integers(1, 6, 12)
    targets = np.array(fill_targets(sizes.tolist(), r.choice([1.0, 2.0, 5.0], 12).tolist(), 1.5, 2.0, times.tolist()))
    words = round(float((targets * times).sum()))
    dealt = apportion(targets, words, 2 * sizes, times)
    assert [sum(n for n, _ in runs) for runs in dealt] == times.tolist()
    assert sum(n * w for runs in dealt for n, w in runs) == words
    assert all(abs(w - targets[i]) < 2 and w <= 2 * sizes[i] for i, runs in enumerate(dealt) for _, w in runs)


def test_targets_stop_and_the_excess_is_shared():
    assert fill_targets([10, 100, 100], [5, 2, 1], 1.0, 2.0) == pytest.approx([20, 190 * 2 / 3, 190 / 3])
    assert fill_targets([10, 10], [1, 1], 9.0, 2.0) == [20, 20]
    assert fill_targets([], [], 1.5, 2.0) == []
    assert cycle_weights(["a", "b", "c", None]) == [5, 2, 1, 5]


def check_sources(rows, out):
    """Contract bounds: a block and five percent, and no target without words."""
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    expected = dict(zip(names, fill_targets([sizes[s] for s in names], cycle_weights(names), 1.5, 2.0)))
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
    for s in names:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= BLOCK
        assert sizes[s] < 20 or abs(taken[s] - target[s]) <= max(0.05 * target[s], 2)
        assert taken[s] > 0 or target[s] < 1


@pytest.mark.parametrize("words", [1, 5, 17, 40])
def test_small_sources(spark, words):
    rows = [(i, " ".join(["w"] * words), None, f"s{i}", 5) for i in range(300)]
    check_sources(rows, mix(odd_docs(spark, rows)).collect())


def test_sources_of_all_sizes(spark):
    r = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(k)), None, None if i % 50 == 0 else f"s{int(i**0.5)}", 5) for i, k in enumerate(r.integers(0, 60, 900))]
    check_sources(rows, mix(odd_docs(spark, rows)).collect())


def test_many_sources(spark):
    """One more than a hundred thousand, of few sizes: the driver sees the sizes alone."""
    docs = spark.range(100_001).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 40 as int)) as text", "concat('s', id) as source")
    found = mix(docs).selectExpr("count(*)", "sum(taken)", "sum(target)", "max(abs(taken - target))", "sum(int(taken = 0 and target >= 1))").first()
    assert found[0] == 100_001 and abs(found[1] - found[2]) < 1 and found[3] < 2 and found[4] == 0


def test_several_shards(spark, monkeypatch):
    import lakestar.llm.mixing as module

    monkeypatch.setattr(module, "SHARD", 64)
    rows, docs = corpus(spark)
    out = mix(docs).collect()
    check_sources(rows, out)
    assert sorted(out) == sorted(mix(docs.repartition(3)).collect())


def corpus(spark, n=600):
    r = np.random.default_rng(1)
    rows = [(i, " ".join(["w"] * int(k)), None, [None, "a", "b", "ä", "big", "big", "big"][i % 7], 5) for i, k in enumerate(r.integers(0, 90, n))]
    return rows, odd_docs(spark, rows)


def test_words_come_near_the_targets_and_reruns_agree(spark):
    rows, docs = corpus(spark)
    out = mix(docs.repartition(5)).collect()
    assert sorted(out) == sorted(mix(docs.repartition(3)).collect())
    assert sorted(r.doc_id for r in out) == list(range(len(rows)))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None]
    targets = dict(zip(names, fill_targets([sizes[s] for s in names], cycle_weights(names), 1.5, 2.0)))
    taken = defaultdict(int)
    for r in out:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == r.size * r["first"] + sum(p.n for p in r.pieces) and all(0 <= p.begin and p.begin + p.n <= r.size for p in r.pieces)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 2 * BLOCK for s in names)


def test_rows_of_the_mix_hold_the_words_taken(spark):
    rows, docs = corpus(spark, 200)
    words = defaultdict(int)
    for r in mixed_rows(docs).collect():
        assert r["size"] == "clash" and r.n_chars in (5, len(r.text))
        words[r.doc_id] += len(r.text.split())
    assert words == {r.doc_id: r.taken for r in mix(docs).collect() if r.taken}


def test_odd_rows(spark):
    out = mix(odd_docs(spark)).collect()
    assert len(out) == 15
    assert all(r.taken <= 2 * r.size for r in out)
    assert mixed_rows(odd_docs(spark)).columns == odd_docs(spark).columns
    assert mix(odd_docs(spark, [])).count() == 0 and mixed_rows(odd_docs(spark, [])).count() == 0
    assert mix(odd_docs(spark, [(1, None, None, None, None)])).collect()[0].taken == 0
