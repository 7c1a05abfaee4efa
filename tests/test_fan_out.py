import json
import os
import sys
import time
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark import cloudpickle

from checks.openers import no_pause, open_numbered_page
from support import rows
from lakestar.plans.ingest import requested_pages
from lakestar.sources import Retry, add_constants, fan_out, judge_pages, plain_client, unwrap_envelope
from lakestar.sources.chains import _following, _request
from lakestar.sources.walk import index_pages


class Flaky:
    """Fails a number of times, then answers."""

    def __init__(self, failures, answer=(200, "{}")):
        self.left, self.answer, self.asked = list(failures), answer, []

    def __call__(self, uri, params):
        self.asked.append((uri, params))
        if not self.left:
            return self.answer
        failure = self.left.pop(0)
        if isinstance(failure, Exception):
            raise failure
        return failure, None


@pytest.mark.parametrize(
    ("failures", "status", "asked", "pauses"),
    [
        ([], 200, 1, []),
        ([503], 200, 2, [0.0]),
        ([429, 500, OSError("reset")], 200, 4, [0.0, 2.0, 4.0]),
        ([503] * 6, 503, 6, [0.0, 2.0, 4.0, 8.0, 16.0]),
        ([OSError("down")] * 9, None, 6, [0.0, 2.0, 4.0, 8.0, 16.0]),
        ([404], 404, 1, []),
        ([400], 400, 1, []),
    ],
)
def test_retry_budget(failures, status, asked, pauses):
    paused, opener = [], Flaky(failures)
    found, body = _request(opener, "u", {"p": 1}, Retry(sleep=paused.append))
    assert (found, len(opener.asked), paused) == (status, asked, pauses)
    if status is None:
        assert body == "down"


def _starts(spark, n=9, key=1):
    return spark.createDataFrame([(f"api/deputados/{key}/despesas?n={n}", key)], "uri string, id int")


def test_params_go_with_the_first_page_only(spark):
    def opener(uri, params):
        nxt = [{"rel": "next", "href": "second"}] if uri != "second" else []
        return 200, json.dumps({"dados": {"asked": sorted((params or {}).items())}, "links": nxt})

    pages = fan_out(spark.createDataFrame([("first",)], "uri string"), plain_client(opener), params={"itens": 3})
    assert rows(pages.select("uri", "body"))[0] == ("first", '{"dados": {"asked": [["itens", 3]]}, "links": [{"rel": "next", "href": "second"}]}')
    assert json.loads(rows(pages.select("uri", "body"))[1][1])["dados"] == {"asked": []}


def test_carry_constants_and_order(spark):
    pages = fan_out(_starts(spark), plain_client(open_numbered_page), params={"itens": 4}, carry=["id"], pages_per_batch=2)
    assert [r.page_no for r in pages.orderBy("page_no").collect()] == [0, 1, 2]
    items = unwrap_envelope(pages, "body", "doc STRING, id_legislatura STRING", carry=["id"])
    items = add_constants(items, {"id_legislatura": "57"})
    assert rows(items) == [(1, f"1-{n}", "57") for n in range(9)]


def test_cycle_and_bound(spark):
    def opener(uri, params):
        return 200, json.dumps({"links": [{"rel": "next", "href": "b" if uri == "a" else "a"}]})

    starts = spark.createDataFrame([("a",)], "uri string")
    assert fan_out(starts, plain_client(opener)).count() == 2
    assert fan_out(starts, plain_client(opener), max_pages=1).count() == 1


def test_odd_answers_end_the_chain(spark):
    answers = {"a": (200, "<html>"), "b": (204, None), "c": (200, "[1]"), "d": (200, '{"links": null}')}
    starts = spark.createDataFrame([(u,) for u in answers], "uri string")
    pages = fan_out(starts, plain_client(lambda uri, params: answers[uri]))
    assert rows(pages.select("uri", "page_no", "status")) == [("a", 0, 200), ("b", 0, 204), ("c", 0, 200), ("d", 0, 200)]


def test_parallelism(spark):
    starts = spark.range(64).selectExpr("concat('api/deputados/', id + 1, '/despesas?n=1') as uri").coalesce(1)
    assert fan_out(starts, plain_client(open_numbered_page), params={"itens": 1}).rdd.getNumPartitions() == 1
    spread = fan_out(starts, plain_client(open_numbered_page), params={"itens": 1}, parallelism=8)
    assert spread.rdd.getNumPartitions() == 8 and spread.count() == 64


def test_pages_land_once(spark, lake):
    source = requested_pages(plain_client(open_numbered_page), lake, params={"itens": 2}, retry=Retry(sleep=no_pause))
    walk = source(_starts(spark, key=11))
    assert rows(walk.rejected.select("id", "page_no", "status", "reason")) == [(11, 1, 503, "status")]
    assert walk.pages.count() == 1


cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Counted:
    """A client that writes down when it is opened and closed."""

    def __init__(self, path):
        self.path = path

    @contextmanager
    def __call__(self):
        name = f"{self.path}/{os.getpid()}-{time.time_ns()}"
        Path(f"{name}.opened").touch()
        fails = [0]

        def open_page(uri, params):
            fails[0] += 1
            return (503, None) if fails[0] % 2 else (200, json.dumps({"dados": {"uri": uri}}))

        try:
            yield open_page
        finally:
            Path(f"{name}.closed").touch()


def test_one_client_per_task_shared_by_retries(spark, tmp_path):
    starts = spark.createDataFrame([(f"u{i}",) for i in range(12)], "uri string")
    pages = fan_out(starts, Counted(tmp_path), parallelism=3, retry=Retry(sleep=no_pause))
    assert pages.count() == 12
    made = sorted(f.name for f in tmp_path.iterdir())
    assert len([m for m in made if m.endswith(".opened")]) == 3
    assert [m for m in made if m.endswith(".opened")] == [m.replace(".closed", ".opened") for m in made if m.endswith(".closed")]


BODIES = [
    ('{"dados": [], "links": [{"rel": "next", "href": "b"}]}', "b"),
    ('  {"links": [{"rel": "next", "href": "b"}]} trailing', "b"),
    ('{"dados": null, "links": [{"rel": "self"}, {"rel": "next", "href": "b"}, {"rel": "next", "href": "c"}]}', "b"),
    ('{"links": [{"rel": "next", "href": 5}]}', "5"),
    ('{"links": [{"rel": "next"}]}', None),
    ('{"links": ["x"]}', None),
    ('{"links": [null, {"rel": "next", "href": "b"}]}', None),
    ('{"links": {"rel": "next", "href": "b"}}', None),
    ('{"links": "next"}', None),
    ('{"dados": 5, "links": [{"rel": "next", "href": "b"}]}', None),
    ('{"dados": "xy", "links": [{"rel": "next", "href": "b"}]}', None),
    ("{'links': [{'rel': 'next', 'href': 'b'}]}", None),
    ('[{"rel": "next", "href": "b"}]', None),
    ("nothing", None),
    ("", None),
    (None, None),
    ('\u00a0{"links": [{"rel": "next", "href": "b"}]}', None),
    ('\ufeff{"links": [{"rel": "next", "href": "b"}]}', None),
    ('{"dados": {"a": 1, "a": 2}, "links": [{"rel": "next", "href": "b"}]}', None),
    ('{"dados": [NaN], "links": [{"rel": "next", "href": "b"}]}', None),
    ('{"dados": [%s], "links": [{"rel": "next", "href": "b"}]}' % ("1" * 1200), None),
]
NO_LINK = [
    '{"links": [{"rel": "next", "href": {"a": 1.0}}]}',
    '{"links": [{"rel": "next", "href": true}]}',
    '{"links": [{"rel": "next", "href": 1.5}]}',
    '{"links": [{"rel": "next", "href": null}, {"rel": "next", "href": "b"}]}',
]


def test_both_readers_of_links_agree(spark):
    pages = spark.createDataFrame([(f"u{i}", 200, body) for i, (body, _) in enumerate(BODIES)], "uri string, status int, body string")
    read = index_pages(pages).found.df.collect()
    assert {r.uri: r.target if r.reason == "ok" else None for r in read} == {f"u{i}": to for i, (_, to) in enumerate(BODIES)}
    assert [_following(200, body) for body, _ in BODIES] == [to for _, to in BODIES]
    reasons = {r.uri: r.reason for r in judge_pages(pages).rejected.collect()}
    assert [reasons.get(f"u{i}", "ok") for i in range(len(BODIES))] == ["ok"] * 5 + ["link"] * 4 + ["shape"] * 2 + ["unreadable"] * 10


def test_links_that_lead_nowhere(spark):
    pages = spark.createDataFrame([(f"u{i}", 200, body) for i, body in enumerate(NO_LINK)], "uri string, status int, body string")
    assert [(r.reason, r.target) for r in index_pages(pages).found.df.collect()] == [("ok", None)] * len(NO_LINK)
    assert [_following(200, body) for body in NO_LINK] == [None] * len(NO_LINK)


def test_repeated_starts_are_walked_once_and_no_address_is_rejected(spark):
    starts = spark.createDataFrame([("api/deputados/1/despesas?n=2", 1), ("api/deputados/1/despesas?n=2", 1), (None, 2)], "uri string, id int")
    walk = requested_pages(plain_client(open_numbered_page), params={"itens": 5})(starts)
    assert walk.pages.count() == 1
    assert rows(walk.rejected.select("id", "reason")) == [(2, "no address")]
