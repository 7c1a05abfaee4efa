"""Hard-negative mining: an R-tree packed by sort-tile-recursion, searched best box first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import Written, runs, task

#: Rows of a leaf, and boxes below a box.
LEAF, FAN = 64, 16
#: Rows of a tile: a 256th of all, but within these bounds.
TILE_LEAST, TILE_MOST = 2048, 1 << 18
#: Rows and bytes, whichever are fewer, of the sample that places the cuts between tiles.
SAMPLE, SAMPLE_BYTES = 16_384, 1 << 25
#: Bytes of tiles' boxes that are sent with a task; beyond them no tile is left out beforehand.
BOXES_BYTES = 1 << 26
#: Searches that go through a tile together.
TOGETHER = 256
LONG = (-(2**62), 2**62)


def cut_tiles(points: np.ndarray, tiles: int) -> list:
    """Cuts by sort-tile-recursion: slabs by the first column, each cut by the next one, and so on.

    The first column (the label) is cut into as many slabs as it has values, the others into the
    ``k``-th root of the tiles left, two at least, for ``k`` columns left, in order of falling variance.
    A tile is a number, a slab list is ``[column, cuts, parts]``.
    """
    axes = [0, *(1 + np.argsort(-points[:, 1:].var(axis=0), kind="stable"))] if len(points) else []
    numbers = iter(range(1 << 62))

    def cut(rows: np.ndarray, tiles: int, at: int) -> list | int:
        if tiles <= 1 or at >= len(axes) or len(rows) < 2:
            return next(numbers)
        values = np.sort(points[rows, axes[at]])
        slabs = min(tiles, len(np.unique(values)) if at == 0 else max(2, math.ceil(tiles ** (1 / (len(axes) - at)))))
        cuts = np.unique(values[[len(values) * i // slabs for i in range(1, slabs)]])
        slab = np.searchsorted(cuts, points[rows, axes[at]], side="right")
        parts = [cut(rows[slab == i], -(-tiles // slabs), at + 1) for i in range(len(cuts) + 1)]
        return [int(axes[at]), cuts, parts] if len(parts) > 1 else parts[0]

    return cut(np.arange(len(points)), tiles, 0)


def tile_of(points: np.ndarray, cuts: list | int) -> np.ndarray:
    out = np.zeros(len(points), dtype=np.int64)

    def place(rows: np.ndarray, cuts: list | int) -> None:
        if isinstance(cuts, int):
            out[rows] = cuts
            return
        column, at, parts = cuts
        values = points[rows, column] if column < points.shape[1] else np.zeros(len(rows), dtype=points.dtype)
        slab = np.searchsorted(at, values, side="right")
        for i, part in enumerate(parts):
            place(rows[slab == i], part)

    place(np.arange(len(points)), cuts)
    return out


def _matrix(lists: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Integer vectors as rows, zero beyond their end."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    values, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(sizes), sizes.max(initial=0)), dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def _wide(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


class Tree:
    """Boxes over one tile's rows: leaves of ``LEAF`` rows, ``FAN`` boxes below each box above them."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, nulls: np.ndarray, labels: np.ndarray, points: np.ndarray):
        rank = np.empty(len(rows), dtype=np.int64)
        rank[np.lexsort((rows, ids, nulls))] = np.arange(len(rows))  # ties go by id, then by row
        whole = np.column_stack([labels, points])
        order = np.lexsort((rank, tile_of(whole, cut_tiles(whole, -(-len(rows) // LEAF)))))
        leaf = np.arange(len(rows)) // LEAF
        order = order[np.lexsort((rank[order], leaf))]
        self.rows, self.ids, self.nulls = rows[order], ids[order], nulls[order]
        self.labels, self.points, self.rank = labels[order], points[order], rank[order]
        begins = np.arange(0, len(rows), LEAF)
        boxes = [np.minimum.reduceat(self.points, begins), np.maximum.reduceat(self.points, begins)]
        marks = [np.minimum.reduceat(self.labels, begins), np.maximum.reduceat(self.labels, begins)]
        self.levels = [(*boxes, *marks)]
        self.opened = 0  # leaves whose rows were compared
        while len(self.levels[-1][0]) > 1:
            below = self.levels[-1]
            begins = np.arange(0, len(below[0]), FAN)
            self.levels.append(tuple(f.reduceat(b, begins) for f, b in zip((np.minimum, np.maximum) * 2, below)))

    def search(self, wanted: np.ndarray, labels: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray,
               bound: np.ndarray, most: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each search the ``most`` best rows: search, place here and score.

        A row counts if its label is the search's (``same``) or another, its score is between ``low``
        and ``high``, and it is not the search's ``own`` row. One queue serves all searches: the box
        with the highest possible score of any search comes first, and is opened for those whose window
        its scores can meet and whose ``most``-th score (``bound`` at first) is not strictly above them.
        """
        width = max(wanted.shape[1], self.points.shape[1])
        wanted, points = _wide(wanted, width), _wide(self.points, width)
        exact = float(np.abs(wanted).max(initial=0)) * float(np.abs(points).max(initial=0)) * width < 2**52
        kind = np.float64 if exact else np.int64
        wanted, points = wanted.astype(kind), points.astype(kind)
        up, down = np.maximum(wanted, 0), np.minimum(wanted, 0)
        least = kind(LONG[0])
        best = np.full((len(wanted), most), least, dtype=kind)  # falling scores, and the rows' places
        found = np.full((len(wanted), most), -1, dtype=np.int64)
        kth = np.maximum(bound.astype(kind), low.astype(kind))
        high = high.astype(kind)
        queue: list[tuple] = []

        def push(level: int, begin: int, end: int, who: np.ndarray) -> None:
            lows, highs, first, last = (b[begin:end] for b in self.levels[level])
            lows, highs = _wide(lows, width).astype(kind).T, _wide(highs, width).astype(kind).T
            top = up[who] @ highs + down[who] @ lows  # per coordinate the larger product of the two ends
            bottom = up[who] @ lows + down[who] @ highs
            label = labels[who, None]
            fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            fits &= (bottom <= high[who, None]) & (top >= kth[who, None])
            for i in np.flatnonzero(fits.any(axis=0)):
                rows = fits[:, i]
                heapq.heappush(queue, (-float(top[rows, i].max()), level, begin + int(i), who[rows], top[rows, i]))

        push(len(self.levels) - 1, 0, len(self.levels[-1][0]), np.arange(len(wanted)))
        while queue:
            _, level, box, who, top = heapq.heappop(queue)
            who = who[top >= kth[who]]
            if not len(who):
                continue
            if level:
                push(level - 1, box * FAN, min((box + 1) * FAN, len(self.levels[level - 1][0])), who)
                continue
            at = np.arange(box * LEAF, min((box + 1) * LEAF, len(self.rows)))
            self.opened += 1
            scores = wanted[who] @ points[at].T
            label = labels[who, None]
            fits = (self.labels[at] == label) if same else (self.labels[at] != label)
            fits &= (self.rows[at] != own[who, None]) & (scores <= high[who, None]) & (scores >= kth[who, None])
            any_ = fits.any(axis=1)
            if not any_.any():
                continue
            who, scores = who[any_], np.where(fits, scores, least)[any_]
            first = np.argsort(-scores, axis=1, kind="stable")[:, :most]  # a leaf's rows are in order of their ids
            scores = np.take_along_axis(scores, first, axis=1)
            places = np.where(scores > least, at[first], -1)
            scores, places = np.concatenate([best[who], scores], axis=1), np.concatenate([found[who], places], axis=1)
            order = np.lexsort((np.where(places >= 0, self.rank[places], len(self.rows)), -scores), axis=1)[:, :most]
            best[who], found[who] = np.take_along_axis(scores, order, axis=1), np.take_along_axis(places, order, axis=1)
            kth[who] = np.maximum(kth[who], best[who, -1])
        who, nth = np.nonzero(found >= 0)
        return who, found[who, nth], best[who, nth].astype(np.int64)


_ROW = "shard int, kind int, block long, row long, vec_id long, label long, v array<bigint>, low long, high long, bound long"
_FOUND = "row long, low long, high long, score long, vec_id long, found long"


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].fill_null(0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)


def _search(most: int, same: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, shard = None, None
        for table in runs(batches, ("shard", "kind", "block")):
            if table["kind"][0].as_py() == 0:
                nulls = table["vec_id"].is_null().combine_chunks().to_numpy(zero_copy_only=False)
                tree = Tree(_numbers(table, "row"), _numbers(table, "vec_id"), nulls, _numbers(table, "label"), _matrix(table["v"]))
                shard = table["shard"][0].as_py()
                continue
            if tree is None or shard != table["shard"][0].as_py():
                continue
            for begin in range(0, table.num_rows, TOGETHER):
                some = table.slice(begin, TOGETHER)
                rows, low, high = (_numbers(some, c) for c in ("row", "low", "high"))
                bound = np.where(some["bound"].is_null().combine_chunks().to_numpy(zero_copy_only=False), LONG[0], _numbers(some, "bound"))
                who, at, score = tree.search(_matrix(some["v"]), _numbers(some, "label"), rows, low, high, bound, most, same)
                ids = pa.array(tree.ids[at], mask=tree.nulls[at])
                yield pa.record_batch(
                    [pa.array(rows[who]), pa.array(low[who]), pa.array(high[who]), pa.array(score), ids, pa.array(tree.rows[at])],
                    names=["row", "low", "high", "score", "vec_id", "found"],
                )

    return run


def _elsewhere(boxes: tuple | None, shards: int, same: bool):
    """Each search once per tile that may hold a better row than its own tile did."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            home, label, high = (_numbers(table, c) for c in ("shard", "label", "high"))
            if boxes is None:
                fits = np.ones((len(home), shards), dtype=bool)
            else:
                lows, highs, first, last = boxes
                wanted = _matrix(table["v"])
                width = max(wanted.shape[1], lows.shape[1])
                wanted, lows, highs = (_wide(m, width).astype(np.float64) for m in (wanted, lows, highs))
                up, down = np.maximum(wanted, 0), np.minimum(wanted, 0)
                slack = 1 + 1e-9 * (np.abs(wanted) @ np.maximum(np.abs(lows), np.abs(highs)).T)
                least = np.maximum(_numbers(table, "low"), np.where(table["bound"].is_null().combine_chunks().to_numpy(zero_copy_only=False), LONG[0], _numbers(table, "bound")))
                fits = (up @ highs.T + down @ lows.T + slack >= least[:, None]) & (up @ lows.T + down @ highs.T - slack <= high[:, None])
                label = label[:, None]
                fits &= (first <= label) & (label <= last) if same else (first != label) | (last != label)
            fits[np.arange(len(home)), home] = False
            row, shard = np.nonzero(fits)
            for begin in range(0, len(row), 4096):
                some = batch.take(pa.array(row[begin : begin + 4096]))
                at = some.schema.get_field_index("shard")
                yield some.set_column(at, some.schema.field(at), pa.array(shard[begin : begin + 4096].astype(np.int32)))

    return run


class _Index:
    def __init__(self, rows: DataFrame, tile_rows: int | None):
        """``rows``: ``row, vec_id, label, v``, stored."""
        spark = rows.sparkSession
        n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        self.tile_rows = tile_rows or min(TILE_MOST, max(TILE_LEAST, n // 256))
        size = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * (width + 1))))
        some = rows.orderBy(F.xxhash64("row", "vec_id", "v")).select("label", "v").limit(size).toArrow()
        points = np.column_stack([_numbers(some, "label"), _matrix(some["v"])])
        cuts = cut_tiles(points, -(-n // self.tile_rows))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table = pa.Table.from_batches([batch])
                own = np.column_stack([_numbers(table, "label"), _matrix(table["v"])])
                yield batch.append_column("tile", pa.array(tile_of(own, cuts)))

        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        tiled = Written(rows.mapInArrow(task(place), f"{kind}, tile long"), "tiled").df
        # A tile that the cuts leave too large, for copies of a vector say, is dealt by row.
        sizes = [(r["tile"], -(-r["n"] // self.tile_rows)) for r in tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n")).orderBy("tile").collect()]
        offsets = np.cumsum([0, *(s for _, s in sizes)])
        self.shards = int(offsets[-1])
        plan = spark.createDataFrame([(t, s, int(o)) for (t, s), o in zip(sizes, offsets)], "tile long, dealt int, first int")
        shard = F.col("first") + F.pmod(F.xxhash64("row"), F.col("dealt")).cast("int")
        self.rows = Written(tiled.join(F.broadcast(plan), "tile").select(*rows.columns, shard.alias("shard")), "shards").df
        self.boxes = None
        if self.shards * (width + 1) * 16 <= BOXES_BYTES:
            self.boxes = self._boxes(width)

    def _boxes(self, width: int) -> tuple:
        """A box per tile, folded in the tasks before it is sent on."""

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[int, tuple] = {}
            for batch in batches:
                table = pa.Table.from_batches([batch])
                points = np.column_stack([_numbers(table, "label"), _wide(_matrix(table["v"]), width)])
                shards = _numbers(table, "shard")
                for s in np.unique(shards):
                    own = points[shards == s]
                    low, high = own.min(axis=0), own.max(axis=0)
                    if s in kept:
                        low, high = np.minimum(low, kept[s][0]), np.maximum(high, kept[s][1])
                    kept[s] = low, high
            if kept:
                yield pa.record_batch(
                    [pa.array(list(kept), pa.int64()), *(pa.array([k[i].tolist() for k in kept.values()], pa.list_(pa.int64())) for i in (0, 1))],
                    names=["shard", "low", "high"],
                )

        ends = self.rows.select("shard", "label", "v").mapInArrow(task(fold), "shard long, low array<bigint>, high array<bigint>")
        each = ends.select("shard", F.posexplode(F.arrays_zip("low", "high")).alias("at", "e"))
        whole = each.groupBy("shard", "at").agg(F.min("e.low").alias("low"), F.max("e.high").alias("high")).toArrow()
        boxes = np.zeros((2, self.shards, width + 1), dtype=np.int64)
        for i, name in enumerate(("low", "high")):
            boxes[i][_numbers(whole, "shard"), _numbers(whole, "at")] = _numbers(whole, name)
        return boxes[0][:, 1:], boxes[1][:, 1:], boxes[0][:, 0], boxes[1][:, 0]

    def _in_tiles(self, searches: DataFrame, most: int, same: bool) -> DataFrame:
        none = F.lit(None).cast("long")
        members = self.rows.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("block"), "row", "vec_id", "label", "v",
                                   none.alias("low"), none.alias("high"), none.alias("bound"))
        keys = ("shard", "kind", "block")
        both = members.unionByName(searches).repartitionById(max(self.shards, 1), "shard").sortWithinPartitions(*keys)
        return both.mapInArrow(task(_search(most, same)), _FOUND)

    def best(self, searches: DataFrame, most: int, same: bool) -> DataFrame:
        """``row, low, high, score, vec_id, found, rank``: the ``most`` best rows of every search.

        ``searches``: ``shard`` (the search's own tile), ``block, row, vec_id, label, v, low, high``. The
        own tile is searched first; its ``most``-th score rules out other tiles.
        """
        keys = ["row", "low", "high"]
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "found")
        first = searches.withColumns({"kind": F.lit(1), "bound": F.lit(None).cast("long")})
        near = Written(self._in_tiles(first, most, same), "near").df
        held = near.groupBy(*keys).agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= most).drop("n")
        known = first.drop("bound").join(held, keys, "left").select(*[c.split(" ")[0] for c in _ROW.split(", ")])
        others = known.mapInArrow(task(_elsewhere(self.boxes, self.shards, same)), _ROW)
        all_ = near.unionByName(self._in_tiles(others, most, same))
        return all_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
    tile_rows: int | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``, scores are integer inner products. Rows where ``anchors``
    (a condition on ``vec_id`` and ``label``) holds are anchors; an anchor's positives are the best
    ``positives`` other rows of its label, and each positive's negatives the best ``negatives`` rows of
    other labels whose score is between ``window`` percent of the positive's. Higher scores come first,
    ties go by smaller ``vec_id``, null last.

    Rows with a null label or vector, or with a null or non-finite component take no part, nor do rows
    with a component of ``2 ** 28 / sqrt(length)`` and more after scaling, whose scores might leave
    64 bits. Vectors of different length are compared as if the shorter went on with zeros; an empty
    one scores 0. Rows that repeat an id are rows of their own, other than each other. A negative
    positive score has an empty window. Other columns are ignored; an empty table gives no row.

    The result is exact, whatever the sample that places the cuts: every row lies in a tile, a tile's
    rows in the boxes of one task, and a box is left out only if no row in it can count.
    """
    spread = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * scale) * F.sqrt(F.size("embedding")) < 2.0**28, F.lit(False)))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = Written(
        own.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fits)
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", spread.alias("v")),
        "vectors",
    )
    index = _Index(rows.df, tile_rows)
    asked = index.rows.where(anchors)
    per = max(1, rows.rows // max(1, index.shards) // TOGETHER)
    block = F.col("shard").cast("long") * per + F.pmod(F.xxhash64("row"), F.lit(per))
    asked = asked.withColumn("block", block)
    ends = {"low": F.lit(LONG[0]).cast("long"), "high": F.lit(LONG[1]).cast("long")}
    best = index.best(asked.withColumns(ends), positives, True)
    near = Written(best.select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("found").alias("positive")), "positives").df
    whole = {
        "low": F.expr(f"(positive_score * {window[0]} + 99) div 100"),
        "high": F.expr(f"positive_score * {window[1]} div 100"),
    }
    pairs = near.where("positive_score >= 0").withColumns(whole).where("low <= high")
    searches = asked.join(pairs.select("row", "low", "high").distinct(), "row")
    worst = index.best(searches, negatives, False).select("row", "low", "high", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asked.select("row", F.col("vec_id").alias("anchor_id"))
    return pairs.join(worst, ["row", "low", "high"]).join(names, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
