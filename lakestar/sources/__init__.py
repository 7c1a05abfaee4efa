from lakestar.sources.chains import Retry, add_constants, fan_out, plain_client
from lakestar.sources.landing import land_pages
from lakestar.sources.pages import (
    PageWalk,
    judge_pages,
    odd_items,
    typed_records,
    unwrap_envelope,
)
from lakestar.sources.requests import join_ids, request_uri
from lakestar.sources.tables import read_entity
from lakestar.sources.walk import follow_pages, index_pages

__all__ = [
    "PageWalk",
    "Retry",
    "add_constants",
    "fan_out",
    "follow_pages",
    "index_pages",
    "join_ids",
    "judge_pages",
    "land_pages",
    "odd_items",
    "plain_client",
    "read_entity",
    "request_uri",
    "typed_records",
    "unwrap_envelope",
]
