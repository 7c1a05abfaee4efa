"""Dimensions, foreign keys and the fact table of a star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.functions.parsing import cast_key
from lakestar.operators.conform import Spec, conform
from lakestar.operators.dedupe import dedupe
from lakestar.operators.joins import (
    MAX_BROADCAST_BYTES,
    ROWS_PER_TASK,
    LookupProfile,
    lookup_join,
    profile_lookup,
)
from lakestar.operators.keys import key_expression, surrogate_key


def dimension(
    df: DataFrame, columns: Sequence[str], natural: Sequence[str], sk: str, method: str = "dense"
) -> DataFrame:
    """The columns plus a surrogate key over the natural key. Give ``df`` unique on ``natural``."""
    return surrogate_key(df.select(*columns), sk, method, natural)


def dimension_from_fact(
    df: DataFrame,
    columns: Sequence[str],
    sk: str,
    method: str = "dense",
    keys: Sequence[str] | None = None,
    seed: int = 0,
) -> DataFrame:
    """The distinct values of ``columns`` in the fact source, nulls kept, plus a surrogate key.

    ``keys`` keeps one row per key subset instead (the first by the remaining columns).
    """
    rows = dedupe(df.select(*columns), keys)
    return surrogate_key(rows, sk, method, list(keys or columns), seed=seed)


@dataclass(frozen=True)
class Lookup:
    """A foreign key found in a dimension: ``on`` maps fact column -> dimension column.

    With plain equality a null never matches; ``null_safe`` lets nulls match nulls. ``cast`` says
    what happens to a fact key that does not fit the type of the dimension key: ``strict`` raises,
    ``lenient`` gives a null foreign key. ``unique='assert'`` refuses a dimension with several rows
    per key, which would multiply the left rows; ``'trust'`` lets it.

    The dimension is measured once (rows per key, bytes), so hand in a stored one. ``prune`` is that of
    :func:`lakestar.operators.joins.lookup_join`.
    """

    dim: DataFrame
    on: Mapping[str, str]
    sk: str
    out: str | None = None
    how: str = "left"
    null_safe: bool = False
    cast: str = "strict"
    unique: str = "assert"
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES
    rows_per_task: int = ROWS_PER_TASK
    prune: bool = False

    def __post_init__(self) -> None:
        if self.cast not in ("strict", "lenient"):
            raise ValueError(f"cast must be 'strict' or 'lenient', not {self.cast!r}")
        if self.unique not in ("assert", "trust"):
            raise ValueError(f"unique must be 'assert' or 'trust', not {self.unique!r}")

    @cached_property
    def _side(self) -> DataFrame:
        renamed = {f"_dim_{i}": dim_col for i, dim_col in enumerate(self.on.values())}
        side = conform(self.dim, {**renamed, "_sk": self.sk})
        if not self.null_safe:
            for key in renamed:
                side = side.filter(F.col(key).isNotNull())
        return side

    @cached_property
    def profile(self) -> LookupProfile:
        found = profile_lookup(self._side, [f"_dim_{i}" for i in range(len(self.on))])
        if self.unique == "assert" and found.max_copies > 1:
            raise ValueError(f"dimension has up to {found.max_copies} rows per {list(self.on.values())}")
        return found

    @property
    def moves_fact(self) -> bool:
        """Whether the dimension is too large to broadcast, so that the fact is shuffled to it."""
        return self.profile.size_bytes > self.max_broadcast_bytes

    def _keyed(self, fact: DataFrame) -> DataFrame:
        """The fact with each key in the type of the dimension's, as ``_fact_0``, ``_fact_1`` …"""
        types = {f.name: f.dataType for f in fact.schema.fields}
        dim_types = {f.name: f.dataType for f in self.dim.schema.fields}
        keys = {}
        for i, (fact_col, dim_col) in enumerate(self.on.items()):
            same = types[fact_col] == dim_types[dim_col]
            wanted = dim_types[dim_col].simpleString()
            keys[f"_fact_{i}"] = F.col(fact_col) if same else cast_key(fact_col, wanted, self.cast == "strict")
        return fact.withColumns(keys)

    def resolve(self, fact: DataFrame, base: DataFrame | None = None) -> DataFrame:
        """``fact`` with the key added; ``base`` is the fact before earlier foreign keys, if any."""
        out = self.out or self.sk
        joined = lookup_join(
            self._keyed(fact),
            self._side,
            {f"_fact_{i}": f"_dim_{i}" for i in range(len(self.on))},
            self.how,
            self.null_safe,
            self.max_broadcast_bytes,
            self.rows_per_task,
            self.profile,
            None if base is None else self._keyed(base),
            self.prune,
        )
        return joined.select(*[c for c in fact.columns if c != out], F.col("_sk").alias(out))


@dataclass(frozen=True)
class Computed:
    """A foreign key into a dimension derived from this very fact, keyed by hash.

    Every fact row's natural key is in such a dimension, so the key is computed in place: the fact
    is neither shuffled nor joined, however large the dimension grows. As with a plain ``=``, a null
    in the natural key gives a null foreign key unless ``null_safe``.
    """

    natural: Sequence[str]
    out: str
    method: str = "hash64"
    seed: int = 0
    null_safe: bool = False

    moves_fact = False

    def resolve(self, fact: DataFrame, base: DataFrame | None = None) -> DataFrame:
        key = key_expression(fact, self.natural, self.method, self.seed)
        if not self.null_safe:
            complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.natural])
            key = F.when(complete, key)
        return fact.withColumn(self.out, key)


ForeignKey = Lookup | Computed


def resolve_fk(
    fact: DataFrame, dim: DataFrame, on: Mapping[str, str], sk: str, out: str | None = None, **options: object
) -> DataFrame:
    """Adds the surrogate key of the matching dimension row as ``out`` (default: ``sk``).

    Options are those of :class:`Lookup`.
    """
    return Lookup(dim, on, sk, out, **options).resolve(fact)


def resolve_all(fact: DataFrame, links: Sequence[ForeignKey]) -> DataFrame:
    """Hot keys are counted in the fact as given: left joins to unique keys do not change its rows."""
    return reduce(lambda linked, link: link.resolve(linked, fact), links, fact)


def link_dimension(dim: DataFrame, links: Sequence[ForeignKey], drop: Sequence[str] = ()) -> DataFrame:
    """A dimension with the keys of other dimensions; ``drop`` removes the natural keys it used."""
    return resolve_all(dim, links).drop(*drop)


def build_fact(fact: DataFrame, links: Sequence[ForeignKey], columns: Spec) -> DataFrame:
    """The star join: every foreign key, then exactly ``columns``."""
    return conform(resolve_all(fact, links), columns)
