import json
import sys
from collections import Counter
from contextlib import contextmanager
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark import TaskContext, cloudpickle

from checks.openers import no_pause, open_numbered_page, open_page_with_last
from lakestar.plans.ingest import requested_pages
from lakestar.sources import Retry, fan_out, land_pages, landing, plain_client
from support import rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])
QUIET = Retry(sleep=no_pause)
OPTIONS = {"params": {"itens": 2}, "parallelism": 4, "retry": QUIET}


class Written:
    """A client that writes down each request and its task; asked too often, it breaks the run."""

    def __init__(self, path, opener, most=10**9):
        self.path, self.opener, self.most = str(path), opener, most

    @contextmanager
    def __call__(self):
        def open_page(uri, params):
            if len(list(Path(self.path).iterdir())) >= self.most:
                raise RuntimeError("the run breaks")
            Path(f"{self.path}/{uuid4().hex}").write_text(json.dumps([uri, TaskContext.get().partitionId()]))
            return self.opener(uri, params)

        yield open_page

    def asked(self):
        return [json.loads(f.read_text()) for f in Path(self.path).iterdir()]


def starts(spark, keys, n=15):
    return spark.createDataFrame([(f"api/deputados/{k}/despesas?n={n if k != 8 else 1}", k) for k in keys], "uri string, id int")


def shown(df):
    return rows(df.select("start_uri", "id", "page_no", "uri", "status", "body"))


KEYS = (1, 2, 3, 5, 7, 8, 11, 15, 30)


@pytest.mark.parametrize("opener", [open_numbered_page, open_page_with_last])
@pytest.mark.parametrize("more", [{"numbered": "pagina", "per_wave": 3}, {"per_wave": 2, "max_pages": 5}])
def test_as_walked(spark, lake, opener, more):
    """Lists with a ``last`` link, without one, with one that is short, and with links that leave the numbers."""
    begun = starts(spark, KEYS)
    walked = fan_out(begun, plain_client(opener), carry=["id"], max_pages=more.get("max_pages"), **OPTIONS)
    assert shown(land_pages(begun, plain_client(opener), lake, carry=["id"], **OPTIONS, **more)) == shown(walked)


@pytest.mark.parametrize("opener", [open_numbered_page, open_page_with_last])
def test_long_lists_are_spread_by_page(spark, lake, opener):
    begun, more = starts(spark, KEYS), {"numbered": "pagina", "per_wave": 3, "carry": ["id"], **OPTIONS}
    expected = shown(fan_out(begun, plain_client(opener), carry=["id"], **OPTIONS))
    assert shown(land_pages(begun, plain_client(opener), lake, list_pages=4, max_broadcast_bytes=-1, **more)) == expected


def test_a_list_at_its_end_is_not_walked_again(spark, lake, monkeypatch):
    """Lists 8, of one page, and 7, whose second page isn't found, are done after a wave or two."""
    walked, whole = [], landing._walked

    def listed(links, *more):
        walked.append({r[0].split("/")[2] for r in links.select("start_uri").distinct().collect()})
        return whole(links, *more)

    monkeypatch.setattr(landing, "_walked", listed)
    pages = land_pages(starts(spark, [1, 7, 8]), plain_client(open_numbered_page), lake, per_wave=2, carry=["id"], **OPTIONS)
    assert walked[0] == {"1", "7", "8"} and walked[1] == {"1", "7"} and {"1"} in walked[2:] and not {"7", "8"} & set().union(*walked[2:])
    assert shown(pages) == shown(fan_out(starts(spark, [1, 7, 8]), plain_client(open_numbered_page), carry=["id"], **OPTIONS))


def test_pages_of_one_list_come_from_several_tasks(spark, lake, tmp_path):
    client = Written(tmp_path, open_page_with_last)
    pages = land_pages(starts(spark, [1], 80), client, lake, carry=["id"], numbered="pagina", **OPTIONS)
    assert pages.count() == 40 and len(client.asked()) == 40
    assert len({task for _, task in client.asked()}) >= 3


@pytest.mark.parametrize("numbered", [None, "pagina"])
def test_a_run_that_stops_half_way_asks_each_page_once_in_all(spark, lake, tmp_path, numbered):
    client = Written(tmp_path, open_page_with_last)
    begun, more = starts(spark, [1, 2, 4, 8]), {"numbered": numbered, "per_wave": 3, "carry": ["id"], **OPTIONS}
    land_pages(begun, client, lake, waves=2, **more)
    half = len(client.asked())
    pages = land_pages(begun, client, lake, **more)
    asked = Counter(uri for uri, _ in client.asked())
    assert 4 < half < len(client.asked()) and set(asked.values()) == {1}
    assert shown(pages) == shown(fan_out(begun, plain_client(open_page_with_last), carry=["id"], **OPTIONS))
    assert shown(land_pages(begun, client, lake, **more)) == shown(pages) and len(client.asked()) == sum(asked.values())
    wider = land_pages(starts(spark, [1, 16]), client, lake, **more)  # another start, the known one isn't asked
    assert {r.id for r in wider.select("id").collect()} == {1, 16}
    assert all("/16/" in uri for uri in set(u for u, _ in client.asked()) - set(asked))


def test_a_run_that_breaks_loses_the_wave_at_hand(spark, lake, tmp_path):
    begun, more = starts(spark, [1, 2, 4]), {"per_wave": 2, "carry": ["id"], **OPTIONS}
    with pytest.raises(Exception, match="the run breaks"):
        land_pages(begun, Written(tmp_path, open_numbered_page, 8), lake, **more)
    client = Written(tmp_path, open_numbered_page)
    pages = land_pages(begun, client, lake, **more)
    assert shown(pages) == shown(fan_out(begun, plain_client(open_numbered_page), carry=["id"], **OPTIONS))
    asked = Counter(uri for uri, _ in client.asked())
    assert {n for uri, n in asked.items() if "pagina" not in uri} == {1}  # the first wave was whole


def test_cycles_over_waves_end(spark, lake):
    def ring(uri, params):
        return 200, json.dumps({"links": [{"rel": "next", "href": f"p{(int(uri[1:]) + 1) % 7}"}]})

    begun = spark.createDataFrame([("p0", 1), ("p5", 2), (None, 3)], "uri string, id int")
    pages = land_pages(begun, plain_client(ring), lake, carry=["id"], per_wave=3, retry=QUIET)
    assert rows(pages.filter("id < 3").groupBy("id").count()) == [(1, 7), (2, 7)]
    assert rows(pages.filter("id = 3").select("page_no", "uri", "status")) == [(0, None, None)]


def test_a_source_goes_on_under_its_run_id(spark, lake, tmp_path):
    client = Written(tmp_path, open_page_with_last)
    found = []
    for _ in range(2):
        source = requested_pages(client, lake, run="2024-q1", numbered="pagina", **OPTIONS)
        found.append([rows(source(starts(spark, keys)).pages.select("id", "page_no")) for keys in ([1, 2], [4])])
    assert found[0] == found[1] and len(found[0][0]) == 16
    assert set(Counter(uri for uri, _ in client.asked()).values()) == {1}
