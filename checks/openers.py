"""Page openers without a network: answers made from the address, or taken from stored pages."""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from urllib.parse import parse_qsl

from pyspark.sql import DataFrame

from lakestar.session import parquet_options, shuffles_released, store


def _numbered(uri: str, params: Mapping[str, object] | None) -> tuple[int, dict | None]:
    """Status and answer of :func:`open_numbered_page`."""
    path, _, query = uri.partition("?")
    asked = dict(parse_qsl(query)) | {k: str(v) for k, v in (params or {}).items()}
    key, total, size = int(path.split("/")[2]), int(asked["n"]), int(asked["itens"])
    page = int(asked.get("pagina", 1))
    if page == 2 and key % 7 == 0:
        return 404, None
    if page == 2 and key % 11 == 0:
        return 503, None
    numbers = range((page - 1) * size, min(page * size, total))
    items = [{"doc": f"{key}-{n}", "position": n, "id_legislatura": "1"} for n in numbers]
    links = [{"rel": "self", "href": uri}]
    if page * size < total:
        links.append({"rel": "next", "href": f"{path}?n={total}&itens={size}&pagina={page + 1}"})
    return 200, {"dados": items, "links": links}


def open_numbered_page(uri: str, params: Mapping[str, object] | None) -> tuple[int, str | None]:
    """``api/deputados/<id>/despesas?n=<items>`` in pages of ``itens``, linked by ``next``.

    Page 2 is not found where 7 divides the id, and always fails where 11 does.
    """
    status, answer = _numbered(uri, params)
    return status, None if answer is None else json.dumps(answer)


def open_page_with_last(uri: str, params: Mapping[str, object] | None) -> tuple[int, str | None]:
    """As above, with a ``last`` link. It is short of a page where 5 divides the id; and where 3 does, the
    third page leads to addresses of another form."""
    status, answer = _numbered(uri.replace("other=1&", ""), params)
    if answer is None:
        return status, None
    path, _, query = uri.partition("?")
    asked = dict(parse_qsl(query)) | {k: str(v) for k, v in (params or {}).items()}
    key, total, size, page = int(path.split("/")[2]), int(asked["n"]), int(asked["itens"]), int(asked.get("pagina", 1))
    other = "other=1&" if key % 3 == 0 and (page == 3 or "other" in asked) else ""
    for link in answer["links"]:
        if link["rel"] == "next":
            link["href"] = link["href"].replace("?", f"?{other}")
    pages = max(1, -(-total // size) - (key % 5 == 0))
    answer["links"].append({"rel": "last", "href": f"{path}?n={total}&itens={size}&pagina={pages}"})
    return status, json.dumps(answer)


def no_pause(seconds: float) -> None:
    """Retries without waiting."""


def open_page_with_odd_links(uri: str, params: Mapping[str, object] | None) -> tuple[int, str | None]:
    """As above; the links of the first page are odd where 3 divides the id, in one of two ways."""
    status, body = open_numbered_page(uri, params)
    key = int(uri.partition("?")[0].split("/")[2])
    if body is None or key % 3 or "pagina" in uri:
        return status, body
    return status, json.dumps({"dados": json.loads(body)["dados"], "links": {"rel": "next"} if key % 2 else ["next"]})


#: Pages in a file, and bytes read for one of them.
PAGES_PER_SHELF, GROUP_BYTES = 100_000, 1 << 20
#: Row groups that a task remembers.
KEPT_GROUPS = 8


def shelve(pages: DataFrame, path: str) -> Shelf:
    """Stores pages in the order of their addresses, so that pages asked for in that order lie together."""
    stored = store(pages, "shelved")
    shelves = -(-stored.rows // PAGES_PER_SHELF) + 15
    laid = stored.df.repartitionByRange(shelves, "uri").sortWithinPartitions("uri")
    with shuffles_released(pages.sparkSession):
        laid.write.options(**parquet_options(pages.sparkSession)).option("parquet.block.size", GROUP_BYTES).parquet(path)
    stored.drop()
    return Shelf(path)


class Shelf:
    """A client over shelved pages, in any store that Arrow opens by its scheme.

    A task finds the row group that may hold an address by its statistics, and remembers the last few; one that
    asks in the order of addresses reads each group once.
    """

    def __init__(self, path: str):
        self.path = path

    @contextmanager
    def __call__(self) -> Iterator:
        import pyarrow.dataset
        import pyarrow.fs

        place = self.path if "://" in self.path else f"file://{self.path.removeprefix('file:')}"
        files, root = pyarrow.fs.FileSystem.from_uri(place)
        bounded, unbounded = [], []
        for part in pyarrow.dataset.dataset(root, filesystem=files, format="parquet").get_fragments():
            for group in part.split_by_row_group():
                seen = (group.row_groups[0].statistics or {}).get("uri")
                bounded.append((seen["min"], seen["max"], group)) if seen else unbounded.append(group)
        bounded.sort(key=lambda b: b[:2])
        lows = [low for low, _, _ in bounded]
        kept: dict[int, dict] = {}

        def candidates(uri: str) -> Iterator:
            """Ranges meet at most in an address at their ends."""
            at = bisect_right(lows, uri) - 1
            while at >= 0 and bounded[at][1] >= uri:
                yield at, bounded[at][2]
                at -= 1
            yield from enumerate(unbounded, len(bounded))

        def open_page(uri: str, params: Mapping[str, object] | None) -> tuple[int, str | None]:
            for number, group in candidates(uri):
                if number not in kept:
                    while len(kept) >= KEPT_GROUPS:
                        kept.pop(next(iter(kept)))
                    found = group.to_table(columns=["uri", "status", "body"])
                    kept[number] = {u: (found, i) for i, u in enumerate(found["uri"].to_pylist())}
                if uri in kept[number]:
                    found, i = kept[number][uri]
                    return found["status"][i].as_py(), found["body"][i].as_py()
            return 404, None

        yield open_page
        kept.clear()
