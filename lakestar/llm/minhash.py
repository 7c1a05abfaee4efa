"""MinHash near-dedup: dart signatures, banded candidates, exact similarity, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import Written, looked_up, parts, runs, task
from lakestar.llm.components import components
from lakestar.llm.shingles import U, mix, shingles, word_hashes

#: A pair of similarity 0.8 shares none of BANDS bands of ROWS coordinates with probability
#: (1 - 0.8 ** ROWS) ** BANDS = 8e-5; at 0.9 with less than 1e-11.
BANDS, ROWS = 40, 7
SIMILAR = 0.8
#: Nodes up to which a band's remaining pairs are listed, and nodes of a block in larger bands.
FEW, BLOCK = 64, 512
#: Signatures of texts seen before that a task remembers.
SEEN = 2_000


def _counts() -> np.ndarray:
    """Distribution function of the number of darts on a unit of area: Poisson with mean 1."""
    terms = [math.exp(-1)]
    while len(terms) < 24:
        terms.append(terms[-1] / len(terms))
    return np.cumsum(terms)


_COUNTS = _counts()


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)) * 2.0**-53


def _throw(elements: np.ndarray, weights: np.ndarray | None, cell: int, low: int, high: int, k: int):
    """Darts of one weight cell with ranks from ``low`` to ``high``: coordinate, rank, name."""
    seeds = mix(np.arange(low, high, dtype=U) * U(1_000_003) + U(cell + 1))
    start = mix(elements[None, :] ^ seeds[:, None]).ravel()
    darts = np.searchsorted(_COUNTS, _unit(start), side="right")
    each = np.repeat(np.arange(len(start)), darts)
    nth = np.arange(len(each)) - (np.cumsum(darts) - darts)[each]
    name = mix(start[each] + (nth.astype(U) + U(1)) * U(0xA0761D6478BD642F))
    place = mix(name ^ U(0xE7037ED1A0B428DB))
    if weights is not None:  # a dart above the element's weight misses
        inside = cell + _unit(mix(name ^ U(0x8EBC6AF09C88C6E3))) < weights[each % len(elements)]
        each, name, place = each[inside], name[inside], place[inside]
    coordinate = ((name >> U(32)) * U(k)) >> U(32)
    return coordinate.astype(np.int64), low + each // len(elements) + _unit(place), name


def dart_signature(elements: np.ndarray, weights: np.ndarray | None = None, k: int = BANDS * ROWS) -> np.ndarray:
    """``k`` numbers for a weighted set of distinct hashes; weight 1 where none is given.

    Darts fall on the plane of weight and rank of every element, one per unit of area on average, by
    hashes of element, unit and number, so equal regions hold equal darts in every set. Darts below
    an element's weight count; each takes part in one coordinate, and a coordinate keeps the dart of
    lowest rank. Two sets agree in a coordinate with the probability of their weighted Jaccard
    similarity. Units of rising rank are opened until every coordinate has a dart: about ``k ln k``
    darts, or one per unit of weight for sets larger than that.
    """
    if weights is None:
        cells = [(0, elements, None)]
    else:
        cells = [(c, elements[weights > c], weights[weights > c]) for c in range(math.ceil(weights.max()))]
    step = math.ceil(k * (math.log(k) + 3) / (len(elements) if weights is None else weights.sum()))
    best, names, low = np.full(k, np.inf), np.zeros(k, dtype=U), 0
    while True:
        thrown = [_throw(e, w, c, low, low + step, k) for c, e, w in cells]
        at, rank, name = thrown[0] if len(thrown) == 1 else (np.concatenate(x) for x in zip(*thrown))
        order = np.argsort(-rank)  # the lowest is written last
        order = order[rank[order] < best[at[order]]]
        best[at[order]] = rank[order]
        names[at[order]] = name[order]
        if np.isfinite(best).all():
            return names
        low += step


def _bands(names: np.ndarray) -> np.ndarray:
    turns = (np.arange(1, ROWS + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)) | U(1)
    return mix((names.reshape(BANDS, ROWS) * turns).sum(axis=1, dtype=U) + np.arange(BANDS, dtype=U)).view(np.int64)


def _elements(words: np.ndarray, counted: bool) -> tuple[np.ndarray, np.ndarray | None]:
    if not counted:
        return np.unique(shingles(words)), None
    names, times = np.unique(shingles(words), return_counts=True)
    return names, times.astype(float)


def _sign(counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, np.ndarray]] = {}
        for batch in batches:
            keys, sizes, bands = [], [], []
            for text in batch.column("text"):
                words = word_hashes(text.as_py())
                key = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
                if key not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    names, weights = _elements(words, counted)
                    size = float(len(names) if weights is None else weights.sum())
                    seen[key] = (size, _bands(dart_signature(names, weights)) if len(names) else None)
                keys.append(key)
                sizes.append(seen[key][0])
                bands.append(seen[key][1])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array(keys, pa.binary()),
                    pa.array(sizes, pa.float64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "mark", "key", "size", "bands"],
            )

    return run


def similarity(a: np.ndarray, b: np.ndarray, counted: bool = False) -> float:
    """(Weighted) Jaccard similarity of the shingles of two word sequences; 0 if one has none."""
    (x, p), (y, q) = _elements(a, counted), _elements(b, counted)
    if not len(x) or not len(y):
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not counted:
        return len(i) / (len(x) + len(y) - len(i))
    common = np.minimum(p[i], q[j]).sum()
    return float(common / (p.sum() + q.sum() - common))


def _judge(counted: bool, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, known = [], ("", np.empty(0, dtype=U))
            for s, t in zip(batch.column("s"), batch.column("t")):
                a, b = s.as_py(), t.as_py()
                if b != known[0]:
                    known = (b, word_hashes(b))
                keep.append(similarity(word_hashes(a), known[1], counted) >= least)
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sets(counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_elements(word_hashes(t.as_py()), counted) for t in batch.column("text")]
            names = pa.array([e.tobytes() for e, _ in found], pa.binary())
            weights = pa.array([None if w is None else w.tobytes() for _, w in found], pa.binary())
            yield pa.record_batch([batch.column("id"), names, weights], names=["x", "names", "weights"])

    return run


def cross_links(
    roots: np.ndarray,
    sets: list[np.ndarray],
    weights: list[np.ndarray] | None,
    asked: np.ndarray,
    least: float,
) -> list[tuple[int, int]]:
    """Places of similar sets with different roots: for each one ``asked`` about, one for each other root.

    The others are an index by element, so each that is asked about costs the sets it shares elements with.
    """
    known = np.flatnonzero(~asked)
    if not len(known) or len(known) == len(sets):
        return []
    owner = np.repeat(known, [len(sets[i]) for i in known])
    elements = np.concatenate([sets[i] for i in known])
    order = np.argsort(elements, kind="stable")
    elements, owner = elements[order], owner[order]
    weight = None if weights is None else np.concatenate([weights[i] for i in known])[order]
    total = np.array([len(s) for s in sets]) if weights is None else np.array([w.sum() for w in weights])
    links = []
    for i in np.flatnonzero(asked):
        low, high = np.searchsorted(elements, sets[i], side="left"), np.searchsorted(elements, sets[i], side="right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = None if weight is None else np.minimum(weight[at], np.repeat(weights[i], n))
        common = np.bincount(owner[at], weights=shared, minlength=len(sets))
        alike = np.flatnonzero((common > 0) & (common >= least * (total + total[i] - common)) & (roots != roots[i]))
        links += [(int(i), int(alike[k])) for k in np.unique(roots[alike], return_index=True)[1]]
    return links


def dealt_outside(many: DataFrame, block: int) -> DataFrame:
    """Rows of ``band, x, rx`` so that each row outside its band's largest component meets every row of the band.

    ``low`` numbers blocks of the rows outside, which are ``asked`` about, ``high`` blocks of all rows. Few
    rows outside cost little more than the band's rows, once.
    """
    counted = many.groupBy("band", "rx").agg(F.count(F.lit(1)).alias("m"))
    bands = counted.groupBy("band").agg(F.max_by("rx", F.struct("m", "rx")).alias("top"), F.sum("m").alias("all"), F.max("m").alias("m"))
    sizes = bands.select(
        F.col("band").alias("of"), "top", F.ceil(F.col("all") / block).cast("int").alias("highs"), F.ceil((F.col("all") - F.col("m")) / block).cast("int").alias("lows")
    )
    sized = looked_up(many, sizes, {"band": "of"}, "inner")

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("x", "band"), F.col(blocks)).cast("int")

    def each(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    held = sized.select("band", "x", "rx", F.lit(False).alias("asked"), own("highs").alias("high"), each("lows").alias("low"))
    asked = sized.where("rx != top").select("band", "x", "rx", F.lit(True).alias("asked"), each("highs").alias("high"), own("lows").alias("low"))
    return held.unionByName(asked)


def _cross(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ("band", "low", "high")):
            x, sets = table["x"].to_numpy(), [np.frombuffer(s.as_buffer(), dtype=U) for s in table["names"]]
            weights = [np.frombuffer(w.as_buffer()) for w in table["weights"] if w.is_valid]
            asked = table["asked"].to_numpy()
            found = cross_links(table["rx"].to_numpy(), sets, weights or None, asked, least)
            if found:
                yield pa.record_batch([pa.array(x[list(c)]) for c in zip(*found)], names=["x", "y"])

    return run


def _verify(pairs: DataFrame, texts: DataFrame, counted: bool, least: float) -> Written:
    both = pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("s")), "x").join(
        texts.select(F.col("id").alias("y"), F.col("text").alias("t")), "y"
    )
    return Written(both.select("x", "y", "s", "t").mapInArrow(task(_judge(counted, least)), "x long, y long"), "similar")


def near_duplicates(docs: DataFrame, least: float = SIMILAR, counted: bool = False) -> DataFrame:
    """``doc_id, class_id, group_size, kept, mark, alone`` for every row of ``docs``.

    Documents are linked when their sets of five-word shingles (``counted``: multisets) have a
    Jaccard similarity of ``least`` or more; words are runs between ASCII blanks, a text of fewer
    than five words is one shingle, one without words is linked to nothing. A class is what links
    connect; its id is the smallest ``doc_id`` in it, null if there is none. Its first row is kept, by
    ``doc_id``, null last, then by ``mark``, a hash of the text; of rows that are equal in both all are. A
    row without words is a class of its own (``alone``), kept.

    Rows of equal word sequences form one node before anything is paired, by an aggregation that
    combines before its shuffle. Texts are what is linked: rows that repeat an id, or have none, are
    classed by their texts like any others. Other columns are ignored; an empty table gives no row.

    Nodes that share a band are candidates. Each is compared first with the smallest of its bands'
    first nodes, then with the first nodes of other components, then the nodes of each band that are
    still in different components with one another: pair by pair in bands of up to ``FEW`` nodes, in
    larger ones by an index over blocks of ``BLOCK``. A large group of alike documents costs a
    comparison or a few for each member, and no candidate pair between components is left out.
    Similarities are computed from whole texts.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.withColumn("mark", F.xxhash64("text"))
    kinds = "doc_id long, mark long, key binary, size double, bands array<bigint>"
    signed = Written(own.mapInArrow(task(_sign(counted)), kinds), "signed")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    nodes = Written(
        signed.df.where("bands is not null")
        .groupBy("key")
        .agg(F.min(F.struct("size", "bands")).alias("n"), F.min(place).alias("p"))
        .select("key", F.monotonically_increasing_id().alias("x"), "n.size", "n.bands", "p.last", F.coalesce("p.doc_id", F.lit(0)).alias("own_id"), F.col("p.mark").alias("own_mark")),
        "nodes",
    )
    banded = Written(nodes.df.select(F.explode("bands").alias("band"), "x", "size"), "bands")
    first = Written(
        banded.df.groupBy("band")
        .agg(F.min(F.struct("x", "size")).alias("f"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("band", F.col("f.x").alias("y"), F.col("f.size").alias("other")),
        "first",
    )
    near = F.least("size", "other") >= least * F.greatest("size", "other")
    members = Written(banded.df.join(first.df, "band"), "members")
    banded.drop()
    first.drop()
    wanted = nodes.df.join(members.df.select("x").distinct(), "x", "left_semi").select(F.col("x").alias("id"), "last", "own_id", "own_mark")
    stands = own.select(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("own_id"), F.col("mark").alias("own_mark"), "text")
    loaded = stands.join(wanted.hint("shuffle_hash"), ["last", "own_id", "own_mark"])
    if signed.df.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count():  # one text of equal rows
        loaded = loaded.groupBy("last", "own_id", "own_mark", "id").agg(F.first("text").alias("text"))
    texts = Written(loaded.select("id", "text"), "texts")

    start = members.df.where((F.col("x") != F.col("y")) & near).groupBy("x").agg(F.min("y").alias("y"))
    tried = Written(start, "start")
    found = [_verify(tried.df, texts.df, counted, least)]

    def placed() -> DataFrame:
        linked = found[0].df
        for more in found[1:]:
            linked = linked.union(more.df)
        return components(linked)

    def at(df: DataFrame, name: str, to: str, roots: DataFrame) -> DataFrame:
        known = roots.select(F.col("node").alias(name), F.col("root").alias(to))
        return df.join(known, name, "left").withColumn(to, F.coalesce(to, name))

    roots = placed()
    others = members.df.where((F.col("x") != F.col("y")) & near).select("x", "y").distinct()
    others = at(at(others, "x", "rx", roots), "y", "ry", roots).where("rx != ry").select("x", "y")
    second = Written(others.join(tried.df, ["x", "y"], "left_anti"), "second")
    if second.rows:
        found.append(_verify(second.df, texts.df, counted, least))
        roots = placed() if found[-1].rows else roots

    rooted = Written(at(members.df.select("band", "x", "size"), "x", "rx", roots), "rooted")
    span = rooted.df.groupBy("band").agg(F.min("rx").alias("p"), F.max("rx").alias("q"), F.count(F.lit(1)).alias("n"))
    mixed = Written(rooted.df.join(span.where("p != q").select("band", "n"), "band"), "mixed")
    few = mixed.df.where(F.col("n") <= FEW).drop("n")
    right = few.select("band", F.col("x").alias("y"), F.col("size").alias("other"), F.col("rx").alias("ry"))
    cross = few.join(right, "band").where((F.col("x") > F.col("y")) & (F.col("rx") != F.col("ry")) & near)
    third = Written(
        cross.select("x", "y").distinct().join(tried.df.union(second.df), ["x", "y"], "left_anti"), "third"
    )
    if third.rows:
        found.append(_verify(third.df, texts.df, counted, least))
    many = mixed.df.where(F.col("n") > FEW)
    wanted = many.select(F.col("x").alias("id")).distinct()
    sets = texts.df.join(wanted, "id", "left_semi").mapInArrow(task(_sets(counted)), "x long, names binary, weights binary")
    stored = Written(sets, "sets")
    spread = dealt_outside(many.select("band", "x", "rx"), BLOCK).join(stored.df, "x")
    grouped = spread.repartition(parts(docs.sparkSession, mixed.rows, 100_000), "band", "low", "high")
    grouped = grouped.sortWithinPartitions("band", "low", "high").select("band", "low", "high", "asked", "x", "rx", "names", "weights")
    found.append(Written(grouped.mapInArrow(task(_cross(least)), "x long, y long"), "across"))
    if any(more.rows for more in found[-2:]):
        roots = placed()
    for table in (members, texts, tried, second, rooted, mixed, third):
        table.drop()
    stored.drop()
    classes = at(nodes.df.select(F.col("key").alias("of"), "x"), "x", "root", roots).select("of", "root")
    rows = Written(looked_up(signed.df.select("doc_id", "mark", "key"), classes, {"key": "of"}).select("doc_id", "mark", "root"), "rows").df
    groups = rows.where("root is not null").groupBy(F.col("root").alias("group")).agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("group_size"), F.min(place).alias("p")
    )
    found_rows = looked_up(rows, groups, {"root": "group"})
    alone = F.col("root").isNull()
    first = F.col("doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("mark") == F.col("p.mark"))
    return found_rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 1).otherwise(F.col("group_size")).cast("long").alias("group_size"),
        (alone | first).alias("kept"),
        "mark",
        alone.alias("alone"),
    )
