"""Pages of a paged API: reading their envelope and judging them.

Landed pages are a table ``uri, status, body``: one answer per address, the body as JSON text
``{"dados": {…} or […], "links": [{"rel": …, "href": …}]}``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.session import materialize

# Field names of the page envelope, the relations of the following and the last page, and statuses.
DATA_FIELD = "dados"
LINKS_FIELD = "links"
NEXT_RELATION = "next"
LAST_RELATION = "last"
STATUS_NOT_FOUND = 404
FIRST_ERROR_STATUS = 400


@dataclass(frozen=True)
class PageWalk:
    """``pages``: readable pages in reach of a start. ``rejected``: pages that ended a chain early.
    ``dealt``: rows of pages that were moved to find them."""

    pages: DataFrame
    rejected: DataFrame
    dealt: int = 0


def typed_records(
    df: DataFrame, json_col: str, schema: str, mode: str = "permissive", out: str | None = None
) -> DataFrame:
    """JSON text to declared fields: missing fields become null, undeclared ones are dropped.

    ``permissive`` turns a value of the wrong type into null, ``failfast`` stops. The fields replace
    the text column, or go into a struct ``out`` beside the others.
    """
    record = F.from_json(json_col, schema, {"mode": mode.upper()}).alias(out or "_record")
    rest = [c for c in df.columns if c != json_col]
    parsed = df.select(*rest, record)
    return parsed if out else parsed.select(*rest, "_record.*")


def _struct_type(schema: str) -> str:
    """Column list ``a INT, b STRUCT<…>`` as a struct type text."""
    return f"STRUCT<{schema.strip()}>"


# What Spark calls the types of a link's texts and whole numbers, and of an object.
_TEXTS = ("STRING", "BIGINT")
_OBJECT = "map<string,variant>"
_ARRAY = "array<variant>"


def parse_body(body: Column | str) -> Column:
    """The body as a VARIANT, null if it is no JSON: the one time that its text is read.

    Text behind the JSON value is ignored; a name that stands twice in an object, a body with such
    deep nesting or long numbers that Spark's reader refuses it, or one above a VARIANT's size is no JSON.
    """
    return F.try_parse_json(body)


def _parsed(pages: DataFrame, body_col: str) -> Column:
    return F.col(body_col) if isinstance(pages.schema[body_col].dataType, T.VariantType) else parse_body(body_col)


def _is(value: Column, kind: str) -> Column:
    return F.try_variant_get(value, "$", kind).isNotNull()


def _is_link_text(value: Column) -> Column:
    return F.schema_of_variant(value).isin(*_TEXTS)


def _elements(page: Column, field: str) -> Column:
    return F.try_variant_get(page, f"$.{field}", _ARRAY)


def link_to(page: Column, relation: str = NEXT_RELATION, links_field: str = LINKS_FIELD) -> Column:
    """Address of a parsed body's first link of that relation, or null: a text or a whole number."""

    def text(link: Column, name: str) -> Column:
        value = F.try_variant_get(link, f"$.{name}", "variant")
        return F.when(_is_link_text(value), F.try_variant_get(link, f"$.{name}", "string"))

    return text(F.get(F.filter(_elements(page, links_field), lambda link: text(link, "rel") == relation), 0), "href")


def read_links(page: Column, links_field: str = LINKS_FIELD, data_field: str = DATA_FIELD) -> Column:
    """What a parsed body says besides its items: whether it is an object, whether data and links have a
    known shape, and the address of the following page, if any.

    Links have to be an array of objects, data an object or an array; both may be missing or null.
    """
    data, links = F.try_variant_get(page, f"$.{data_field}", "variant"), F.try_variant_get(page, f"$.{links_field}", "variant")
    objects = F.forall(_elements(page, links_field), lambda e: _is(e, _OBJECT))
    return F.struct(
        F.coalesce(_is(page, _OBJECT), F.lit(False)).alias("readable"),
        (data.isNull() | F.is_variant_null(data) | _is(data, _ARRAY) | _is(data, _OBJECT)).alias("shaped"),
        (links.isNull() | F.is_variant_null(links) | F.coalesce(objects, F.lit(False))).alias("linked"),
        link_to(page, NEXT_RELATION, links_field).alias("target"),
    )


def unwrap_envelope(
    pages: DataFrame,
    body_col: str,
    item_schema: str,
    data_field: str = DATA_FIELD,
    carry: Sequence[str] | None = None,
    mode: str = "permissive",
) -> DataFrame:
    """One row per item of each page, with the carried columns first (default: all but the body).

    The body is JSON text or, from :func:`judge_pages` and :func:`lakestar.sources.walk.follow_pages`,
    parsed already. The data field may hold an array or a lone object, which counts as one item; an
    empty array or a missing field gives no rows. Elements that are no object are left out, see
    :func:`odd_items`. A value that doesn't fit its field's type becomes null; ``failfast`` stops there.
    Numbers in a text field are written shortest: 1.50 is ``1.5``.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"mode must be 'permissive' or 'failfast', not {mode!r}")
    carry = [c for c in pages.columns if c != body_col] if carry is None else list(carry)
    get = F.try_variant_get if mode == "permissive" else F.variant_get
    read = pages.select(*carry, _parsed(pages, body_col).alias("_page"))
    lone = F.try_variant_get("_page", f"$.{data_field}", "variant")
    objects = F.filter(_elements(F.col("_page"), data_field), lambda e: _is(e, _OBJECT))
    items = F.when(_is(lone, _OBJECT), F.array(lone)).otherwise(objects)
    each = read.select(*carry, F.explode(items).alias("_raw"))
    return each.select(*carry, get("_raw", "$", _struct_type(item_schema)).alias("_item")).select(*carry, "_item.*")


def odd_items(
    pages: DataFrame, body_col: str, data_field: str = DATA_FIELD, carry: Sequence[str] | None = None
) -> DataFrame:
    """The elements that :func:`unwrap_envelope` leaves out: carried columns, ``position`` and ``text``."""
    carry = [c for c in pages.columns if c != body_col] if carry is None else list(carry)
    read = pages.select(*carry, _parsed(pages, body_col).alias("_page"))
    each = read.select(*carry, F.posexplode(_elements(F.col("_page"), data_field)).alias("position", "_raw"))
    odd = each.filter(~_is(F.col("_raw"), _OBJECT))
    return odd.select(*carry, "position", F.coalesce(F.try_variant_get("_raw", "$", "string"), F.lit("null")).alias("text"))


def page_verdict(status: Column, read: Column) -> Column:
    """``ok``, ``end`` (not found: a silent end of the chain), or what is wrong: ``status``,
    ``unreadable`` (no JSON object), ``shape`` (data neither object nor array) or ``link``."""
    return (
        F.when(status == STATUS_NOT_FOUND, "end")
        .when(status.isNull() | (status >= FIRST_ERROR_STATUS), "status")
        .when(~read["readable"], "unreadable")
        .when(~read["shaped"], "shape")
        .when(~read["linked"], "link")
        .otherwise("ok")
    )


#: Verdicts that send a page to quarantine.
REJECTED = ("status", "unreadable", "shape", "link", "missing", "no address")


def _check_policy(on_error: str) -> None:
    if on_error not in ("quarantine", "fail", "stop"):
        raise ValueError(f"on_error must be 'quarantine', 'fail' or 'stop', not {on_error!r}")


def _apply_policy(pages: DataFrame, rejected: DataFrame, on_error: str, dealt: int = 0) -> PageWalk:
    if on_error == "fail":
        first = rejected.take(1)
        if first:
            raise ValueError(f"page failed: {first[0].asDict()}")
    return PageWalk(pages, rejected.limit(0) if on_error == "stop" else rejected, dealt)


def judged(landed: DataFrame) -> DataFrame:
    """Landed pages with the body parsed, a ``reason`` (see :func:`page_verdict`) and the ``target`` of ``next``."""
    parsed = landed.withColumn("body", parse_body("body")).withColumn("_read", read_links(F.col("body")))
    reason = page_verdict(F.col("status"), F.col("_read"))
    if "uri" in landed.columns:
        reason = F.when(F.col("uri").isNull(), "no address").otherwise(reason)
    return parsed.withColumns({"reason": reason, "target": F.when(reason == "ok", F.col("_read.target"))}).drop("_read")


def judge_pages(landed: DataFrame, on_error: str = "quarantine") -> PageWalk:
    """Landed pages with their ``status, body`` into usable ones and rejected ones with a ``reason``.

    ``quarantine`` returns the rejected pages, ``fail`` stops when there is one, and ``stop`` drops
    them without a trace, which silently shortens the entity. Bodies are parsed once, and stored as
    they were read: whatever reads the usable pages after this finds VARIANTs in ``body``.
    """
    _check_policy(on_error)
    read = materialize(judged(landed).drop("target"), "judged")
    rejected = read.filter(F.col("reason").isin(*REJECTED)).drop("body")
    return _apply_policy(read.filter("reason = 'ok'").drop("reason"), rejected, on_error)
