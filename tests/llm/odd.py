"""Documents with nulls everywhere, empty and long texts, repeats, ties and clashing column names."""

from __future__ import annotations

import random

LONG = " ".join(random.Random(4).choices(["alpha", "beta", "gamma", "delta\n", "épsilon", "日本"], k=60_000))
TEXT = "one two three four five six seven eight nine ten"
ROWS = [
    (1, TEXT, "en", "a", 10),
    (2, TEXT, None, "b", None),
    (3, TEXT.replace(" ", "\t\n"), "en", None, 1),
    (4, None, "en", "a", 0),
    (5, "", "de", "a", 0),
    (6, " \n\t ", "de", "c", 4),
    (None, "no id here at all, none", "en", "c", 4),
    (None, None, None, None, None),
    (7, LONG, "en", "a", len(LONG)),
    (8, "word", "fr", "b", 4),
    (9, "word", "fr", "b", 4),
    (10, TEXT, "en", "a", 10),
    (10, TEXT, "en", "a", 10),
    (11, "12 34 !!", "es", "b", 8),
    (12, "﻿🙂 naïve   text\x00 end", "es", "b", 8),
]
#: Names that operators use inside.
CLASHES = ["size", "mark", "key", "bands", "x", "sha", "suspect", "lines", "place", "gone", "own_text", "read", "p", "norm", "at"]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark, rows=ROWS):
    kind = ", ".join([KIND, *(f"`{c}` string" for c in CLASHES)])
    return spark.createDataFrame([(*r, *("clash" for _ in CLASHES)) for r in rows], kind)
