import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from support import plan, rows
from lakestar.sources import follow_pages, index_pages, join_ids, judge_pages, odd_items, request_uri, typed_records, unwrap_envelope

ITEM = "a INT, b STRING, m DECIMAL(18,2)"


def _pages(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "n int, body string")


def test_envelope_shapes(spark):
    bodies = [
        '{"dados": {"a": 1, "b": "x", "zz": 9}}',
        '{"dados": [{"a": 2, "b": 57}, {"b": "é"}], "links": []}',
        '{"dados": []}',
        '{"links": []}',
        '{"dados": null}',
        "not json",
        "",
        None,
        '{"dados": [{"m": 1234567890123456.78}, {"m": 100}]}',
        '{"dados": {"m": 0.10}}',
    ]
    found = unwrap_envelope(_pages(spark, bodies), "body", ITEM)
    as_text = found.withColumn("m", F.col("m").cast("string"))
    assert rows(as_text) == sorted(
        [
            (0, 1, "x", None),
            (1, 2, "57", None),
            (1, None, "é", None),
            (8, None, None, "1234567890123456.78"),
            (8, None, None, "100.00"),
            (9, None, None, "0.10"),
        ],
        key=repr,
    )


def test_bad_values_become_null_or_stop(spark):
    pages = _pages(spark, ['{"dados": [{"a": "one", "b": "x"}, {"a": 2, "b": "y"}]}', '{"dados": {"a": "one", "b": "z"}}'])
    found = unwrap_envelope(pages, "body", ITEM)
    assert rows(found.select("a", "b")) == [(2, "y"), (None, "x"), (None, "z")]
    for n in (0, 1):
        with pytest.raises((PySparkException, Py4JJavaError)):
            unwrap_envelope(pages.filter(f"n = {n}"), "body", ITEM, mode="failfast").collect()
    good = _pages(spark, ['{"dados": {"a": 1}}', '{"dados": [{"a": 2}]}', '{"dados": []}', "{}"])
    assert rows(unwrap_envelope(good, "body", ITEM, mode="failfast").select("a")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        unwrap_envelope(good, "body", ITEM, mode="other")


def test_typed_records(spark):
    df = _pages(spark, ['{"a": 1, "extra": 2}', '{"b": 3}', '{"a": "bad"}'])
    assert rows(typed_records(df, "body", "a INT, b STRING")) == [(0, 1, None), (1, None, "3"), (2, None, None)]
    assert typed_records(df, "body", "a INT", out="record").columns == ["n", "record"]
    with pytest.raises((PySparkException, Py4JJavaError)):
        typed_records(df, "body", "a INT", mode="failfast").collect()


def _page(uri, target=None, status=200, body=None):
    links = [{"rel": "self", "href": uri}, {"rel": "next", "href": target}, {"rel": "next", "href": "never"}]
    own = json.dumps({"dados": [{"a": 1}], "links": links if target else links[:1]})
    return (uri, status, own if body is None else body)


def _landed(spark, pages):
    return spark.createDataFrame(pages, "uri string, status int, body string").repartition(3)


def _starts(spark, uris):
    return spark.createDataFrame([(u, i) for i, u in enumerate(uris)], "uri string, key int")


def _brute(pages, starts, max_pages=None):
    """The walk by hand: (key, page number, address) of usable pages, (key, address, reason) of rejected."""
    by_uri = {p[0]: p for p in pages}
    usable, rejected = [], []
    for key, uri in enumerate(starts):
        seen, number = set(), 0
        while uri is not None and uri not in seen and (max_pages is None or number < max_pages):
            seen.add(uri)
            page = by_uri.get(uri)
            if page is None or (page[1] >= 400 and page[1] != 404):
                rejected.append((key, uri, "missing" if page is None else "status"))
                break
            if page[1] == 404:
                break
            try:
                links = json.loads(page[2])["links"]
            except ValueError:
                rejected.append((key, uri, "unreadable"))
                break
            usable.append((key, number, uri))
            uri = next((link["href"] for link in links if link["rel"] == "next"), None)
            number += 1
    return usable, rejected


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("max_pages", [None, 6])
def test_walks_against_brute_force(spark, seed, max_pages):
    rng = random.Random(seed)
    names = [f"p{i}" for i in range(40)]
    pages = []
    for i, name in enumerate(names):
        kind = rng.random()
        # Mostly the page after, sometimes any page: chains, merges and cycles.
        target = names[i + 1] if i + 1 < len(names) and rng.random() < 0.85 else rng.choice([*names, "gone", None])
        status = 404 if kind < 0.03 else 503 if kind < 0.06 else 200
        pages.append(_page(name, target, status, "<html>" if 0.06 <= kind < 0.09 else None))
    starts = [rng.choice([*names, "absent"]) for _ in range(12)]
    usable, rejected = _brute(pages, starts, max_pages)
    for options in ({"list_of": lambda uri: F.lit("all")}, {"max_broadcast_bytes": -1}):
        walk = follow_pages(_starts(spark, starts), _landed(spark, pages), max_pages=max_pages, **options)
        assert rows(walk.pages.select("key", "page_no", "uri")) == sorted(usable, key=repr)
        assert rows(walk.rejected.select("key", "uri", "reason")) == sorted(rejected, key=repr)


def _digitless(uri):
    return F.regexp_replace(uri, "[0-9]+$", "")


@pytest.mark.parametrize("options", [{}, {"list_of": _digitless}, {"list_of": _digitless, "list_pages": 10}])
def test_long_chain_in_few_rounds(spark, monkeypatch, options):
    """In one list, in a list that no task may hold, and with a list of its own for each page."""
    import lakestar.sources.walk as module

    stored = []
    original = module.store
    monkeypatch.setattr(module, "store", lambda df, label, *more: stored.append(label) or original(df, label, *more))
    pages = [_page(f"c{i}", f"c{i + 1}" if i < 999 else None) for i in range(1000)]
    walk = follow_pages(_starts(spark, ["c0"]), _landed(spark, pages), **options)
    assert walk.pages.count() == 1000 and walk.rejected.count() == 0
    assert stored.count("strides") <= 12 and stored.count("walks") <= 7
    assert ("strides" in stored) == (options != {"list_of": _digitless})


def test_work_is_that_of_the_pages_in_reach(spark):
    """Nine lists of ten are in nobody's reach: their links don't move."""
    pages = [_page(f"api/{i}?page={n}", f"api/{i}?page={n + 1}" if n < 19 else None) for i in range(100) for n in range(20)]
    walk = follow_pages(_starts(spark, [f"api/{i * 10}?page=0" for i in range(10)]), _landed(spark, pages))
    assert walk.pages.count() == 200 and walk.dealt < 3 * 200


@pytest.mark.parametrize("seed", range(2))
def test_walks_over_lists_against_brute_force(spark, monkeypatch, seed):
    """Chains that go from list to list and back, cycles over lists, a list with many walks, one too large."""
    import lakestar.sources.walk as module

    monkeypatch.setattr(module, "LIST_WALKS", 3)
    rng = random.Random(seed)
    names = [f"{k}?{i}" for k in "abcd" for i in range(15)]
    pages = []
    for i, name in enumerate(names):
        near = names[i + 1] if i + 1 < len(names) and names[i + 1][0] == name[0] else None
        target = near if rng.random() < 0.85 else rng.choice([*names, "a?99", "e?1", None])
        pages.append(_page(name, target, rng.choice([200] * 20 + [404, 503])))
    starts = [rng.choice([*names, "e?7"]) for _ in range(25)]
    usable, rejected = _brute(pages, starts)
    for list_pages in (14, 100):
        walk = follow_pages(_starts(spark, starts), _landed(spark, pages), list_pages=list_pages)
        assert rows(walk.pages.select("key", "page_no", "uri")) == sorted(usable, key=repr)
        assert rows(walk.rejected.select("key", "uri", "reason")) == sorted(rejected, key=repr)


def test_bodies_are_parsed_once(spark, monkeypatch):
    import lakestar.sources.pages as module

    parsed = []
    original = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, label: parsed.append(plan(df)) or original(df, label))
    walk = judge_pages(_landed(spark, [_page("a", "b"), ("b", 200, '{"dados": [1, {"a": 2}]}'), ("c", 200, "no")]))
    assert len(parsed) == 1 and parsed[0].count("parseJson") == 1 and "from_json" not in parsed[0]
    items, odd = unwrap_envelope(walk.pages, "body", ITEM, carry=["uri"]), odd_items(walk.pages, "body", carry=["uri"])
    for df in (items, odd, walk.rejected):
        assert "parseJson" not in plan(df) and "from_json" not in plan(df)
    assert rows(items.select("uri", "a")) == [("a", 1), ("b", 2)]
    assert rows(odd) == [("b", 0, "1")] and rows(walk.rejected.select("uri", "reason")) == [("c", "unreadable")]


def test_cycle_ends(spark):
    pages = [_page("a", "b"), _page("b", "c"), _page("c", "a")]
    walk = follow_pages(_starts(spark, ["a", "b"]), _landed(spark, pages))
    assert rows(walk.pages.select("key", "page_no", "uri")) == [
        (0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "b"), (1, 1, "c"), (1, 2, "a")
    ]


def test_policies(spark):
    pages = _landed(spark, [_page("a", "b"), _page("b", None, 503)])
    starts = _starts(spark, ["a"])
    kept = follow_pages(starts, pages)
    assert rows(kept.rejected.select("uri", "status", "reason")) == [("b", 503, "status")]
    assert follow_pages(starts, pages, on_error="stop").rejected.count() == 0
    with pytest.raises(ValueError, match="503"):
        follow_pages(starts, pages, on_error="fail")
    with pytest.raises(ValueError, match="on_error"):
        follow_pages(starts, pages, on_error="other")
    assert rows(judge_pages(pages).pages.select("uri")) == [("a",)]
    with pytest.raises(ValueError, match="503"):
        judge_pages(pages, "fail")


def test_two_answers_for_one_address_are_refused(spark):
    with pytest.raises(ValueError, match="not a key"):
        index_pages(_landed(spark, [_page("a"), _page("a", "b")]))


def test_index_is_dealt_by_address(spark, with_conf):
    """However pages landed, no file of the index holds most of them, so no task of a walk reads most."""
    with_conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    pages = _landed(spark, [_page(f"api/{i}") for i in range(800)]).coalesce(1)
    files = index_pages(pages).found.df.groupBy(F.input_file_name()).count()
    assert files.agg(F.sum("count"), F.max("count") < 200).first()[:] == (800, True)


def test_request_addresses(spark):
    df = spark.range(2)
    address = request_uri("http://host/api/", "people", F.col("id"), params={"size": 100, "of": F.col("id") + 1})
    assert rows(df.select(address)) == [
        ("http://host/api/people/0?size=100&of=1",), ("http://host/api/people/1?size=100&of=2",)
    ]


def test_ids_are_joined_in_chunks(spark):
    df = spark.createDataFrame([(i,) for i in [3, 20, 1, 3, None]], "id int")
    assert rows(join_ids(df, "id")) == [("1,3,20",)]
    chunks = [r.ids.split(",") for r in join_ids(spark.range(250), "id", per_request=100).collect()]
    assert sorted(map(len, chunks)) == [50, 100, 100]
    assert {int(i) for c in chunks for i in c} == set(range(250))
    assert all(c == sorted(c, key=int) for c in chunks)
