"""Mixing sources to target weights: equal-token blocks dealt by Sainte-Laguë, then chosen by seed."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from itertools import islice, takewhile

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import WORD, Written, looked_up, parts

#: Words of a block.
BLOCK = 16
#: Words of a shard, unless that made more than SHARDS shards besides one per source.
SHARD = 1 << 20
SHARDS = 20_000


def cycle_weights(position: Column) -> Column:
    """5, 2, 1, repeating over the sources' positions, from 0."""
    return F.get(F.array(F.lit(5.0), F.lit(2.0), F.lit(1.0)), (position % 3).cast("int"))


def fill_targets(sizes: Sequence[int], weights: Sequence[float], share: float, repeat: float, times: Sequence[int] | None = None) -> list[float]:
    """Splits ``share`` of all sizes by weight; what exceeds ``repeat`` times a size is split among the rest.

    ``times`` says how often an entry stands for a source. Entries reach their limit in the order of
    size by weight, so one pass in that order finds the rate of those that stay below.
    """
    times = [1] * len(sizes) if times is None else times
    weighed = [i for i in range(len(sizes)) if weights[i] > 0]
    targets = [0.0] * len(sizes)
    left = Fraction(share) * sum(s * t for s, t in zip(sizes, times))
    weight = sum(Fraction(weights[i]) * times[i] for i in weighed)
    order = sorted(weighed, key=lambda i: Fraction(sizes[i]) / Fraction(weights[i]))
    for at, i in enumerate(order):
        most = Fraction(repeat) * sizes[i]
        if left / weight * Fraction(weights[i]) <= most:
            rate = left / weight
            for j in order[at:]:
                targets[j] = float(rate * Fraction(weights[j]))
            break
        targets[i] = float(most)
        left -= most * times[i]
        weight -= Fraction(weights[i]) * times[i]
    return targets


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Seats by the highest quotients ``votes / (2 n + 1)``, none above ``most``; ties to the earlier entry.

    An entry stands for ``times`` equal ones: each has the first number of seats, and as many of them as
    the second says one seat more. The lowest quotient that wins a seat is found by bisection, the few
    seats at that border by rank, so the work doesn't grow with the seats.
    """
    votes, most = np.asarray(votes, dtype=float), np.asarray(most, dtype=np.int64)
    times = np.ones(len(votes), dtype=np.int64) if times is None else np.asarray(times, dtype=np.int64)
    extra = np.zeros(len(votes), dtype=np.int64)
    seats = int(min(seats, (most * times)[votes > 0].sum()))
    if seats <= 0:
        return np.zeros(len(votes), dtype=np.int64), extra

    def above(limit: float) -> np.ndarray:
        return np.minimum(most, np.where(votes >= limit, np.floor((votes / limit + 1) / 2), 0).astype(np.int64))

    low, high = votes[votes > 0].min() / (2.0 * most.max() + 3), votes.max() * 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (above(middle) * times).sum() >= seats else (low, middle)
    won = above(high)
    while True:
        left = seats - int((won * times).sum())
        if left <= 0:
            return won, extra
        quotients = np.where(won < most, votes / (2 * won + 1), -1.0)
        order = np.argsort(-quotients, kind="stable")
        order = order[quotients[order] >= quotients[order[0]] * (1 - 1e-9)]
        before = np.cumsum(times[order]) - times[order]
        whole = order[before + times[order] <= left]
        won[whole] += 1
        if len(whole) < len(order) and before[len(whole)] < left:
            extra[order[len(whole)]] = left - before[len(whole)]
            return won, extra


def apportion(targets: np.ndarray, words: int, most: np.ndarray, times: np.ndarray | None = None) -> list[list[tuple[int, int]]]:
    """Words by blocks and then by words: for each entry, runs of its ``times`` as (how many, words each).

    Blocks go to the highest quotients of the targets. A block that would go beyond an entry's target is
    cut: what it holds of the target, and what else is missing to ``words``, is dealt word by word, by the
    same rule, on what the entries lack. So every entry comes within a word or two of its target.
    """
    targets, most = np.asarray(targets, dtype=float), np.asarray(most, dtype=np.int64)
    times = np.ones(len(targets), dtype=np.int64) if times is None else np.asarray(times, dtype=np.int64)
    blocks, more = sainte_lague(targets, words // BLOCK, most // BLOCK, times)
    fits = np.minimum(targets // BLOCK, most // BLOCK).astype(np.int64)
    # Entries whose equals got one block more and those that didn't part here, in this order.
    runs = [(i, n, min(int(blocks[i]) + plus, int(fits[i]))) for i in range(len(targets)) for n, plus in ((int(more[i]), 1), (int(times[i] - more[i]), 0)) if n]
    at, number, held = (np.array(c, dtype=np.int64) for c in zip(*runs)) if runs else (np.zeros(0, dtype=np.int64),) * 3
    lack = np.maximum(targets[at] - held * BLOCK, 0.0)
    rest, one = sainte_lague(lack, words - int((held * BLOCK * number).sum()), most[at] - held * BLOCK, number)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(targets))]
    for i, n, h, r, o in zip(at.tolist(), number.tolist(), held.tolist(), rest.tolist(), one.tolist()):
        out[i] += [(k, h * BLOCK + r + plus) for k, plus in ((o, 1), (n - o, 0)) if k]
    return out


def _hash(seed: int, *of: str) -> Column:
    return F.xxhash64(F.lit(seed), *of)


def _positions(sources: DataFrame) -> DataFrame:
    """Adds ``position``, from 0, by code point of ``source``, null last: place in its range, and the ranges before."""
    spark = sources.sparkSession
    n = -(-sources.count() // 1_000_000) or 1
    order = F.col("source").asc_nulls_last()
    ranged = sources.repartitionByRange(n, order).sortWithinPartitions(order)
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = Written(ranged.select("*", F.spark_partition_id().alias("range"), nth.alias("nth")), "ranges").df
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per million sources
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return placed.join(F.broadcast(offsets), "range").select(*sources.columns, (F.col("before") + F.col("nth")).alias("position"))


def _ranked(sources: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank``, from 0, by position among the sources of one size and weight: in hash buckets, whose sizes add up."""
    bucket = F.pmod(F.xxhash64("position"), F.lit(parts(sources.sparkSession, rows))).alias("bucket")
    kept = Written(sources.select("*", bucket), "classes").df
    before = Window.partitionBy("n", "weight").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = kept.groupBy("n", "weight", "bucket").agg(F.count(F.lit(1)).alias("m"))
    offsets = sizes.select("n", "weight", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("n", "weight", "bucket").orderBy("position")
    ranked = kept.withColumn("rank", F.row_number().over(inside) - 1).join(offsets, ["n", "weight", "bucket"])
    return ranked.select(*sources.columns, (F.col("rank") + F.col("before")).alias("rank"))


def _planned(sources: DataFrame, share: float, repeat: float) -> DataFrame:
    """``of, at, source_size, target, words, shards`` for each source: what it should give and gives.

    Sources of one size and weight are one entry to the driver: of sources with N words together there
    are at most the square root of 2 N sizes for each weight.
    """
    spark = sources.sparkSession
    classes = sources.groupBy("n", "weight").agg(F.count(F.lit(1)).alias("times")).orderBy("n", "weight").toArrow()
    n, weight, times = (classes[c].to_pylist() for c in ("n", "weight", "times"))
    targets = fill_targets(n, weight, share, repeat, times)
    total = sum(a * b for a, b in zip(n, times))
    words = round(sum(t * k for t, k in zip(targets, times)))
    dealt = apportion(np.array(targets), words, np.array([int(Fraction(repeat) * s) for s in n], dtype=np.int64), np.array(times, dtype=np.int64))
    rows = []
    for size, w, target, runs in zip(n, weight, targets, dealt):
        begin = 0
        for many, own in runs:
            rows.append((size, w, target, begin, begin + many, own))
            begin += many
    plan = spark.createDataFrame(rows, "n long, weight double, target double, low long, high long, words long")
    per_shard = max(SHARD, total // SHARDS)
    held = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    ranked = _ranked(sources, sum(times))
    return ranked.join(F.broadcast(plan), ["n", "weight"]).where(held).select(
        F.col("source").alias("of"),
        F.col("position").alias("at"),
        F.col("n").alias("source_size"),
        "target",
        "words",
        F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(per_shard))).cast("long").alias("shards"),
    )


def mix(
    docs: DataFrame,
    weigh=cycle_weights,
    share: float = 1.5,
    repeat: float = 2.0,
    seed: int = 17,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, first, pieces`` for every row.

    Size is the number of words; ``weigh`` makes a weight of a source's position by code point, null
    last. Targets share the words by weight (:func:`fill_targets`). Sources win blocks of ``BLOCK`` words
    by Sainte-Laguë on their targets, the block at a target's end being cut (:func:`apportion`), so a
    source of any size gives its target to within a few words. A source's words are laid out shard by
    shard in seeded order; its shards win its words by the same rule, ``repeat`` times their own at most. A
    shard takes all its words as often as its quota holds them, and the remainder from a seeded block
    onwards, round its end: ``taken`` counts the words of a row that fall to it. ``first`` is how often the
    whole row is taken; ``pieces`` are the runs of its words, as first word and number, taken once more: two
    at most. Columns named in ``carry`` come along as ``own_`` and their name.

    Null and wordless texts have size 0 and take 0; rows may repeat an id, each counts by itself;
    null ids are as good as others; ties of sizes or sources change nothing. There may be any number of
    sources: the driver sees one entry for those of equal size and weight, and the shards of sources
    that have several, ``2 * SHARDS`` at most. A rerun takes the same words. An empty table gives no row.
    """
    spark = docs.sparkSession
    sized = Written(
        docs.select(
            "doc_id",
            "source",
            F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), "text").alias("mark"),
            *[F.col(c).alias(f"own_{c}") for c in carry],
        ),
        "sizes",
    )
    known = Written(sized.df.groupBy("source").agg(F.sum("size").alias("n")), "known")
    sources = _positions(known.df).withColumn("weight", weigh(F.col("position")).cast("double"))
    plan = _planned(sources, share, repeat)
    place = (
        looked_up(sized.df, plan, {"source": "of"}, "inner", null_safe=True)
        .withColumn("shard", F.pmod(_hash(seed, "doc_id", "mark"), F.col("shards")).cast("int"))
        .drop("of")
    )
    several = place.where("shards > 1").groupBy("at", "shard", "words").agg(F.sum("size").alias("n")).collect()
    quotas = spark.createDataFrame(_quotas([tuple(r) for r in several], repeat), "at long, shard int, quota long, held long")
    order = Window.partitionBy("at", "shard").orderBy(_hash(seed + 1, "doc_id", "mark"), "doc_id", "mark")
    laid = (
        place.join(F.broadcast(quotas), ["at", "shard"], "left")
        .withColumns({"quota": F.coalesce("quota", "words"), "held": F.coalesce("held", "source_size")})
        .withColumn("stop", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("stop") - F.col("size"))
    )
    some = F.col("held") > 0
    first = F.when(some, F.expr("quota div held")).otherwise(0).cast("long")
    blocks = F.greatest(F.ceil(F.col("held") / F.lit(BLOCK)), F.lit(1))
    origin = F.pmod(F.xxhash64(F.lit(seed + 2), "at", "shard"), blocks) * BLOCK
    end = origin + F.when(some, F.col("quota") % F.col("held")).otherwise(0)

    def run(low: Column, high: Column) -> Column:
        begin, stop = F.greatest("start", low), F.least("stop", high)
        return F.struct((begin - F.col("start")).alias("begin"), F.greatest(F.lit(0).cast("long"), stop - begin).alias("n"))

    pieces = F.array(run(origin, F.least(end, F.col("held"))), run(F.lit(0).cast("long"), end - F.col("held")))
    return laid.withColumns({"first": first, "pieces": F.filter(pieces, lambda p: p["n"] > 0)}).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("first") + F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["n"])).alias("taken"),
        "first",
        "pieces",
        *[f"own_{c}" for c in carry],
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of ``docs``' columns: a row per whole copy, and one per run of words taken once
    more, whose ``text`` is these words with a blank between and whose ``n_chars``, if there is such a
    column, is its length. Rows of which nothing is taken go."""
    names = docs.columns
    mixed = mix(docs, carry=names, **options)
    whole = F.array_repeat(F.lit(None).cast("struct<begin:bigint,n:bigint>"), F.col("first").cast("int"))
    rows = mixed.select(F.explode(F.concat(whole, "pieces")).alias("p"), *[f"own_{c}" for c in names])
    words = F.slice(F.regexp_extract_all("own_text", F.lit(WORD), F.lit(0)), (F.col("p.begin") + 1).cast("int"), F.col("p.n").cast("int"))
    rows = rows.withColumn("own_text", F.when(F.col("p").isNull(), F.col("own_text")).otherwise(F.array_join(words, " ")))
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        cut = F.length("own_text").cast(kind)
        rows = rows.withColumn("own_n_chars", F.when(F.col("p").isNull(), F.col("own_n_chars")).otherwise(cut))
    return rows.select(*[F.col(f"own_{c}").alias(c) for c in names])


def _quotas(shards: list[tuple[int, int, int, int]], repeat: float) -> list[tuple[int, int, int, int]]:
    """``at, shard, quota, words`` from ``at, shard, words of the source to take, words``."""
    shards, out, begin = sorted(shards), [], 0
    while begin < len(shards):
        at, _, words, _ = shards[begin]
        own = list(takewhile(lambda s: s[0] == at, islice(shards, begin, None)))
        sizes = [n for _, _, _, n in own]
        most = np.array([int(Fraction(repeat) * n) for n in sizes], dtype=np.int64)
        targets = np.array([words * n / sum(sizes) for n in sizes])
        dealt = [runs[0][1] if runs else 0 for runs in apportion(targets, words, most)]
        out += [(at, s, q, n) for (_, s, _, n), q in zip(own, dealt)]
        begin += len(own)
    return out
