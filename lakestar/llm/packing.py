"""Packing: cutting-stock column generation over a length histogram, patterns dealt to ranked rows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import Written, parts, task
from lakestar.llm.tokens import encoder

LENGTH = 1024
#: Lengths are planned in steps of GRAIN ids, rounded up: at most GRAIN - 1 ids of padding a piece.
GRAIN = 4
#: Rounds of column generation; stopping early costs padding, never a piece.
ROUNDS = 4000


def best_pattern(worth: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """Counts per size that fill ``room`` with the highest worth: an unbounded knapsack."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    rising = np.argsort(sizes, kind="stable")
    sizes_up, worth_up = sizes[rising], worth[rising]
    fits = np.searchsorted(sizes_up, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        value[c] = value[c - 1]
        if fits[c]:
            gained = value[c - sizes_up[: fits[c]]] + worth_up[: fits[c]]
            i = int(gained.argmax())
            if gained[i] > value[c] + 1e-12:
                value[c], last[c] = gained[i], i
    counts, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
            continue
        counts[rising[last[c]]] += 1
        c -= sizes_up[last[c]]
    return counts


def generate_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often the relaxed program uses each.

    The basis starts with one pattern per size; the knapsack finds the pattern that its prices make
    most worth while, the ratio test the one that leaves, until no pattern pays.
    """
    m = len(sizes)
    columns = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    use = inverse @ demand
    cost = np.ones(m)
    for _ in range(rounds):
        prices = cost @ inverse
        low = int(prices.argmin())
        if prices[low] < -1e-9:  # a surplus of that size is worth having
            entering, price = -np.eye(m)[low], 0.0
        else:
            entering, price = best_pattern(prices, sizes, room).astype(float), 1.0
            if prices @ entering <= 1 + 1e-7:
                break
        move = inverse @ entering
        ratios = np.where(move > 1e-9, use / np.where(move > 1e-9, move, 1), np.inf)
        out = int(ratios.argmin())
        step = ratios[out]
        use = np.maximum(use - step * move, 0)
        use[out] = step
        columns[:, out], cost[out] = entering, price
        inverse[out] /= move[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(move[others], inverse[out])
    real = cost > 0
    return columns[:, real].astype(np.int64), use[real]


def plan_patterns(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """``({size: pieces}, times)`` that hold the histogram's pieces: rounded down, the rest first-fit."""
    if not histogram:
        return []
    sizes = np.array(sorted(histogram, reverse=True))
    demand = np.array([histogram[s] for s in sizes], dtype=float)
    columns, use = generate_patterns(sizes, demand, room)
    left = demand.astype(np.int64)
    plan: list[tuple[dict[int, int], int]] = []
    for column, times in zip(columns.T, np.floor(use + 1e-6).astype(np.int64)):
        used = column > 0
        times = int(min(times, (left[used] // column[used]).min()))
        if times > 0:
            left -= column * times
            plan.append(({int(s): int(n) for s, n in zip(sizes[used], column[used])}, times))
    while left.any():  # the widest first, as often as whole patterns of the rest repeat
        pattern, free = {}, room
        for i, size in enumerate(sizes):
            n = int(min(left[i], free // size))
            if n:
                pattern[int(size)] = n
                free -= n * int(size)
        times = min(int(left[i] // pattern[int(s)]) for i, s in enumerate(sizes) if int(s) in pattern)
        for i, s in enumerate(sizes):
            left[i] -= pattern.get(int(s), 0) * times
        plan.append((pattern, times))
    return plan


def layout(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per size, for runs of ranks: first rank, pieces a sequence, first sequence, first slot."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    base = 0
    for pattern, times in plan:
        slot = 0
        for size, n in pattern.items():
            runs.setdefault(size, []).append((ranks.get(size, 0), n, base, slot))
            ranks[size] = ranks.get(size, 0) + n * times
            slot += n
        base += times
    return {s: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for s, r in runs.items()}


def _tokens(path: str, end: int, length: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, tail = encoder(path).encode_all, end.to_bytes(4, "little")
        for batch in batches:
            sizes, sums, ids = [], [], []
            for encoded in encode_all(text.as_py() for text in batch.column("text")):
                own = encoded + tail
                view = memoryview(own)
                sizes.append(len(own) // 4)
                sums.append([zlib.crc32(view[i : i + 4 * length]) for i in range(0, len(own), 4 * length)])
                ids.append(own if with_ids else None)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(sums, pa.list_(pa.int64())), pa.array(ids, pa.binary())],
                names=["doc_id", "mark", "doc_tokens", "sums", "ids"],
            )

    return run


def _place(runs: dict[int, tuple[np.ndarray, ...]], at: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(size), dtype=np.int64), np.zeros(len(size), dtype=np.int64)
            for s in np.unique(size[size > 0]).tolist():
                own = size == s
                first, n, base, begin = runs[s]
                r = np.searchsorted(first, rank[own], side="right") - 1
                k = rank[own] - first[r]
                sequence[own], slot[own] = base[r] + k // n[r], begin[r] + k % n[r]
            kept = [batch.column(c) for c in at]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(slot)], names=[*at, "sequence", "slot"])

    return run


def pack(docs: DataFrame, path: str, end: int = 0, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, laid out in sequences of at most ``length`` ids.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``; ``with_ids`` adds
    the piece's ``ids`` as little-endian unsigned 32-bit bytes. A document is its ids by the
    tokenizers file at ``path`` and ``end``; null text is empty. It is cut into whole sequences and
    one rest; the rests are packed by a cutting-stock program over their histogram, which has at most
    ``length / GRAIN`` entries however many documents there are. Each piece of a pattern goes to the
    document of its rank within its size; ranks are counted in hash buckets of ids, so one frequent
    length is many tasks' work. Ids may be null or repeated: each row is a document of its own. Other
    columns are ignored; an empty table gives no row.
    """
    spark, room = docs.sparkSession, length // GRAIN
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("mark")
    )
    kinds = "doc_id long, mark long, doc_tokens long, sums array<bigint>, ids binary"
    coded = Written(own.mapInArrow(task(_tokens(path, end, length, with_ids)), kinds), "coded")
    rest = F.col("doc_tokens") % length
    sized = coded.df.withColumns(
        {
            "full": F.expr(f"doc_tokens div {length}"),
            "size": F.ceil(rest / GRAIN).cast("int"),
            "bucket": F.pmod(F.xxhash64("doc_id", "mark"), F.lit(parts(spark, coded.rows, 100_000))).cast("int"),
        }
    )
    tally = Written(sized.groupBy("bucket", "size").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("full")), "tally")
    histogram = {r["size"]: r["n"] for r in tally.df.where("size > 0").groupBy("size").agg(F.sum("n").alias("n")).collect()}
    plan = plan_patterns(histogram, room)
    runs, sequences = layout(plan), sum(times for _, times in plan)

    earlier = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranks = tally.df.select("bucket", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank0"))
    buckets = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    fulls = tally.df.groupBy("bucket").agg(F.sum("full").alias("f")).select(
        "bucket", F.coalesce(F.sum("f").over(buckets), F.lit(0)).alias("full0")
    )
    inside = Window.partitionBy("bucket").orderBy("size", "doc_id", "mark")
    same = Window.partitionBy("bucket", "size").orderBy("doc_id", "mark")
    ranked = (
        sized.withColumn("rank", F.row_number().over(same) - 1)
        .withColumn("full1", F.sum("full").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
        .join(ranks, ["bucket", "size"])
        .join(fulls, "bucket")
        .withColumns({"rank": F.col("rank") + F.col("rank0"), "full0": F.col("full0") + F.col("full1")})
    )
    at = ["doc_id", "doc_tokens", "sums", "ids", "full", "full0", "size"]
    placed = ranked.select(*at, F.col("rank").cast("long").alias("rank")).mapInArrow(
        task(_place(runs, at)),
        "doc_id long, doc_tokens long, sums array<bigint>, ids binary, full long, full0 long, size int, sequence long, slot long",
    )
    placed = Written(placed, "placed").df
    tally.drop()

    def piece(start: Column, n: Column, crc: Column) -> list[Column]:
        cut = [F.col("ids")] if not with_ids else [F.substring("ids", start * 4 + 1, n * 4).alias("ids")]
        return [start.alias("start"), n.alias("length"), crc.alias("ids_crc32"), *cut]

    whole = placed.where("full > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("i"))
    whole = whole.select(
        "doc_id",
        "doc_tokens",
        *piece(F.col("i") * length, F.lit(length).cast("long"), F.element_at("sums", (F.col("i") + 1).cast("int"))),
        (F.col("full0") + F.col("i") + sequences).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    slots = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rests = placed.where("size > 0").select(
        "doc_id",
        "doc_tokens",
        *piece(F.col("full") * length, F.col("doc_tokens") % length, F.element_at("sums", -1)),
        F.col("sequence").alias("sequence_id"),
        "slot",
    )
    rests = rests.withColumn("offset", F.coalesce(F.sum("length").over(slots), F.lit(0)).cast("long")).drop("slot")
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return whole.select(order).union(rests.select(order))


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = 0) -> DataFrame:
    """``sequence_id, ids, length`` from pieces with ids: the ids in order, padded to ``length``
    unless their number is a power of two."""
    joined = pieces.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"), F.sum("length").cast("int").alias("length")
    )
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    padding = F.when(F.bit_count("length") == 1, 0).otherwise(F.greatest(F.lit(0), length - F.col("length")))
    return joined.select(
        "sequence_id", F.concat(ids, F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), padding))).alias("ids"), "length"
    )
