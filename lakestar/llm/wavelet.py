"""Token files: a wavelet matrix per shard, with access, counts and occurrences from the file."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.llm.common import parts, scratch_path, task
from lakestar.llm.tokens import encoder

# Fixed values of the file: head is magic, tokens, documents, planes; every part is its length and zstd bytes.
MAGIC = b"LSWM0001"
HEAD = struct.Struct("<8sQQB")
#: Bits between two counts of ones.
STRIDE = 512
#: Tokens from which on a shard is closed; a document is never split.
SHARD = 1 << 20

_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def _where(numbers: np.ndarray, held: np.ndarray) -> np.ndarray:
    """``numbers[held]``, by Arrow's filter, which takes less than half the time."""
    bits = pa.py_buffer(np.packbits(held, bitorder="little"))
    return pc.filter(pa.array(numbers), pa.Array.from_buffers(pa.bool_(), len(held), [None, bits])).to_numpy()


class WaveletMatrix:
    """A sequence of unsigned numbers as planes of bits, highest bit first.

    Each plane holds one bit of every number, in the order that the plane before leaves: numbers with
    a 0 first, then those with a 1, both in their old order. Counts of ones before every ``STRIDE``
    bits make a rank one lookup and a short sum.
    """

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n = n
        self.planes = planes
        stride = STRIDE // 8
        self.zeros, self.counts = [], []
        for plane in planes:
            ones = np.add.reduceat(_ONES[plane], np.arange(0, max(1, len(plane)), stride), dtype=np.int64) if len(plane) else np.zeros(1, np.int64)
            self.counts.append(np.concatenate([[0], np.cumsum(ones)]))
            self.zeros.append(n - int(self.counts[-1][-1]))

    @classmethod
    def build(cls, numbers: np.ndarray) -> WaveletMatrix:
        now = np.ascontiguousarray(numbers, dtype=np.uint32)
        bits = int(now.max()).bit_length() if len(now) else 0
        if bits <= 16:
            now = now.astype(np.uint16)
        planes = []
        for bit in range(bits - 1, -1, -1):
            ones = (now >> now.dtype.type(bit) & now.dtype.type(1)).astype(bool)
            planes.append(np.packbits(ones))
            if bit:
                now = np.concatenate([_where(now, ~ones), _where(now, ones)])
        return cls(len(numbers), planes)

    def _rank(self, plane: int, i: int) -> int:
        """Ones before place ``i``."""
        block, rest = divmod(i, STRIDE)
        begin = block * STRIDE // 8
        total = int(self.counts[plane][block]) + int(_ONES[self.planes[plane][begin : begin + rest // 8]].sum(dtype=np.int64))
        if rest % 8:
            total += bin(int(self.planes[plane][begin + rest // 8]) >> (8 - rest % 8)).count("1")
        return total

    def _select(self, plane: int, k: int, bit: int) -> int:
        """Place of the ``k``-th (from 0) one or zero."""
        places = np.minimum(np.arange(len(self.counts[plane])) * STRIDE, self.n)
        before = self.counts[plane] if bit else places - self.counts[plane]
        block = int(np.searchsorted(before, k, side="right")) - 1
        begin = block * STRIDE
        own = np.unpackbits(self.planes[plane][begin // 8 : (begin + STRIDE) // 8])[: self.n - begin]
        return begin + int(np.flatnonzero(own == bit)[k - int(before[block])])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for p, plane in enumerate(self.planes):
            bit = int(plane[i >> 3]) >> (7 - (i & 7)) & 1
            value = value << 1 | bit
            ones = self._rank(p, i)
            i = self.zeros[p] + ones if bit else i - ones
        return value

    def _range(self, number: int, begin: int, end: int) -> tuple[int, int]:
        if number >> len(self.planes):
            return 0, 0
        for p in range(len(self.planes)):
            a, b = self._rank(p, begin), self._rank(p, end)
            if number >> (len(self.planes) - 1 - p) & 1:
                begin, end = self.zeros[p] + a, self.zeros[p] + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def count(self, number: int, begin: int = 0, end: int | None = None) -> int:
        """How often ``number`` stands from ``begin`` up to ``end``."""
        low, high = self._range(number, begin, self.n if end is None else end)
        return high - low

    def find(self, number: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``number``."""
        low, high = self._range(number, 0, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        i = low + k
        for p in range(len(self.planes) - 1, -1, -1):
            bit = number >> (len(self.planes) - 1 - p) & 1
            i = self._select(p, i - self.zeros[p] if bit else i, bit)
        return i

    def numbers(self) -> np.ndarray:
        """The whole sequence, plane by plane from the lowest bit."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.n, dtype=kind)
        for p in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[p], count=self.n).astype(bool)
            before = np.empty_like(now)
            before[np.flatnonzero(~ones)] = now[: self.zeros[p]]
            before[np.flatnonzero(ones)] = now[self.zeros[p] :] | kind(1 << (len(self.planes) - 1 - p))
            now = before
        return now.astype(np.uint32)


def to_file(numbers: np.ndarray, doc_ids: list[int | None], sizes: np.ndarray) -> bytes:
    """The bytes of a shard's file: documents in order, then the planes."""
    matrix = WaveletMatrix.build(numbers)
    pack = zstandard.ZstdCompressor(level=1).compress
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8")
    made = [HEAD.pack(MAGIC, matrix.n, len(doc_ids), len(matrix.planes))]
    for part in (known, ids, sizes.astype("<u8"), *matrix.planes):
        packed = pack(part.tobytes())
        made += [struct.pack("<Q", len(packed)), packed]
    return b"".join(made)


def from_file(data: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    magic, n, docs, planes = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at, unpack, found = HEAD.size, zstandard.ZstdDecompressor().decompress, []
    for i in range(3 + planes):
        (size,) = struct.unpack_from("<Q", data, at)
        found.append(unpack(data[at + 8 : at + 8 + size]))
        at += 8 + size
    known = np.frombuffer(found[0], dtype=np.uint8)
    ids = np.frombuffer(found[1], dtype="<i8").tolist()
    matrix = WaveletMatrix(n, [np.frombuffer(f, dtype=np.uint8) for f in found[3:]])
    return matrix, [i if k else None for i, k in zip(ids, known)], np.frombuffer(found[2], dtype="<u8").astype(np.int64)


def _write(path: str, end: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, tail = encoder(path).encode_all, end.to_bytes(4, "little")
        ids: list[int | None] = []
        own: list[bytes] = []
        part, made, held = 0, 0, 0

        def close() -> pa.RecordBatch:
            numbers = np.frombuffer(b"".join(own), dtype="<u4")
            sizes = np.array([len(o) // 4 for o in own], dtype=np.int64)
            columns = [[part], [made], [len(numbers)], [len(ids)], [to_file(numbers, ids, sizes)]]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "shard", "tokens", "docs", "file"])

        for batch in batches:
            encoded = encode_all(text.as_py() for text in batch.column("text"))
            for doc_id, own_ids, where in zip(batch.column("doc_id"), encoded, batch.column("part")):
                part = where.as_py()
                own.append(own_ids + tail)
                ids.append(doc_id.as_py())
                held += len(own[-1]) // 4
                if held >= shard:
                    yield close()
                    ids, own, made, held = [], [], made + 1, 0
        if ids:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, out: str, end: int = 2, shard: int = SHARD) -> None:
    """Writes the ids of every row and ``end`` to token files below ``out``, in ascending ``doc_id``.

    A row of ``out`` (Parquet, so that any store Spark reaches will do and writes are committed whole)
    is one file: ``part, shard, tokens, docs, file``. Shards follow each other by part, then shard.
    Null text is empty; null ids come last; rows that repeat an id are ordered by a hash of the text.
    Other columns are ignored; an empty table writes no file. A range of ids is one task's work, a
    shard all it holds at a time.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("doc_id").isNull().alias("last"),
    ).withColumn("mark", F.xxhash64("text"))
    n = parts(docs.sparkSession)
    ranged = own.repartitionByRange(n, "last", "doc_id", "mark").sortWithinPartitions("last", "doc_id", "mark")
    ranged = ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))
    made = ranged.mapInArrow(task(_write(path, end, shard)), "part int, shard long, tokens long, docs long, file binary")
    made.write.option("compression", "none").parquet(out)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, shard, data in zip(batch.column("part"), batch.column("shard"), batch.column("file")):
            matrix, ids, sizes = from_file(data.as_py())
            stops = np.cumsum(sizes)
            view = memoryview(np.ascontiguousarray(matrix.numbers(), dtype="<u4")).cast("B")
            sums = [zlib.crc32(view[4 * (e - n) : 4 * e]) for e, n in zip(stops.tolist(), sizes.tolist())]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip((ids, stops - sizes, sizes, sums), kinds)]
            where = [pa.array([x.as_py()] * len(ids), k) for x, k in ((part, pa.int32()), (shard, pa.int64()))]
            yield pa.record_batch([*where, *columns], names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files below ``out``.

    Every file is decoded whole. Starts come from the files' token counts: summed by part, then
    within a part, so one task sees a number per part at most.
    """
    files = spark.read.parquet(out)
    counts = files.select("part", "shard", "tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = counts.groupBy("part").agg(F.sum("tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("before", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(by_part, "part")
    bases = bases.select("part", "shard", (F.col("base") + F.col("before")).alias("base"))
    kinds = "part int, shard long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    found = files.select("part", "shard", "file").mapInArrow(task(_read), kinds)
    return found.join(bases, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """:func:`write_tokens` to the shared folder, and what :func:`read_tokens` reads back."""
    out = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, out, end)
    return read_tokens(docs.sparkSession, out)
