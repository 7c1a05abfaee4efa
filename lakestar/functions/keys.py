"""Key text and key hashes over several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator of key parts; in token mode, the null marker, the value marker and the escape.
SEPARATOR = "|"
NULL_TOKEN = "n"
VALUE_TOKEN = "v"
ESCAPE = "\\"


def _token(col: Column, escape: bool = True) -> Column:
    text = col.cast("string")
    for mark in (ESCAPE, SEPARATOR) if escape else ():
        text = F.replace(text, F.lit(mark), F.lit(ESCAPE + mark))
    return F.coalesce(F.concat(F.lit(VALUE_TOKEN), text), F.lit(NULL_TOKEN))


def content_text(
    columns: Sequence[str | Column], nulls: str = "token", plain: Sequence[bool] | None = None
) -> Column:
    """The columns as one text; ``plain`` marks those that cannot hold a separator, such as numbers.

    ``skip`` leaves nulls out, so rows that differ only in where the null stands share a text.
    ``token`` marks nulls and escapes the separator: different rows always differ.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if nulls == "skip":
        return F.concat_ws(SEPARATOR, *[c.cast("string") for c in cols])
    if nulls == "token":
        return F.concat_ws(SEPARATOR, *[_token(c, not p) for c, p in zip(cols, plain or [False] * len(cols))])
    raise ValueError(f"nulls must be 'skip' or 'token', not {nulls!r}")


def content_hash(
    columns: Sequence[str | Column], nulls: str = "token", plain: Sequence[bool] | None = None
) -> Column:
    """SHA-256, in hex, of :func:`content_text`. Cast floating point to decimal beforehand."""
    return F.sha2(content_text(columns, nulls, plain), 256)
