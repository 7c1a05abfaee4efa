import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd import ROWS, odd_docs
from tokenizers import Tokenizer

from lakestar.llm.packing import GRAIN, best_pattern, generate_patterns, pack, plan_patterns, sequences
from lakestar.llm.tokens import encoder
from lakestar.llm.wavelet import WaveletMatrix, from_file, read_tokens, to_file, token_files, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text, end):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "a", " a", "a ", "a  b", "\n\n a", "it's  fine, isn't 'll ok", "x \t y", "é  ü ñ", "1 2  3,4", "<|endoftext|> x",
     "　 a b", "a\x1c b", "🙂 a🙂b 中文 字", "word. Word.\nNext, (one) [two]", "²³ ½ a² Ⅷ", "ǆ Ǆ ß. ﬁ! A' b's", "́a b́ c"],
)
def test_stretches_give_the_librarys_ids(text):
    for t in (text, f"{text} tail", f"head {text}"):
        assert np.frombuffer(encoder(PATH).encode(t), "<u4").tolist() == ids_of(t, 0)[:-1]


def test_knapsack_and_patterns():
    r = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.unique(r.integers(1, 12, 4))
        worth = r.uniform(0, 3, len(sizes))
        best = {0: 0.0}
        for c in range(1, 21):
            best[c] = max([best[c - 1], *(best[c - s] + w for s, w in zip(sizes, worth) if s <= c)])
        counts = best_pattern(worth, sizes, 20)
        assert counts @ sizes <= 20 and counts @ worth == pytest.approx(best[20])
    columns, use = generate_patterns(np.array([9, 6, 4]), np.array([10.0, 10.0, 10.0]), 20)
    assert ((columns.T @ [9, 6, 4]) <= 20).all() and (columns @ use >= 10 - 1e-6).all()
    assert 190 / 20 <= use.sum() <= 10 + 1e-6  # the volume, and ten times one of each


def test_plans_hold_every_piece():
    r = np.random.default_rng(2)
    histogram = {int(s): int(n) for s, n in zip(r.permutation(np.arange(1, 257))[:120], r.integers(1, 5000, 120))}
    held, used = defaultdict(int), 0
    for pattern, times in plan_patterns(histogram, 256):
        assert sum(s * n for s, n in pattern.items()) <= 256
        used += times
        for s, n in pattern.items():
            held[s] += n * times
    assert held == histogram
    sizes = np.array(sorted(histogram))
    _, use = generate_patterns(sizes, np.array([histogram[s] for s in sizes], dtype=float), 256)
    assert use.sum() - 1e-6 <= used <= use.sum() + len(sizes)
    assert plan_patterns({}, 256) == []


def corpus(n=300):
    r = np.random.default_rng(3)
    words = ["the", "packing", "of", "pieces", "überlang", "x,", "nine."]
    return [(i, " ".join(r.choice(words, int(k))), None, None, None) for i, k in enumerate(r.integers(0, 1600, n))]


def check_pieces(rows, pieces, length=1024):
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(ids_of(r[1], 0))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, own in texts.items():
        expected = sorted(
            (at, min(length, len(ids) - at), crc(ids[at : at + length]), len(ids)) for ids in own for at in range(0, len(ids), length)
        )
        assert sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc_id]) == expected
    assert sum(map(len, by_doc.values())) == len(pieces)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= length
    return len(by_sequence)


def test_pieces_cover_documents_and_sequences_are_full(spark):
    rows = corpus()
    pieces = pack(odd_docs(spark, rows).repartition(4), PATH).collect()
    used = check_pieces(rows, pieces)
    assert used <= 1.03 * sum(p.length for p in pieces) / 1024 + 3


def test_odd_rows(spark):
    check_pieces(ROWS, pack(odd_docs(spark), PATH).collect())
    assert pack(odd_docs(spark, []), PATH).count() == 0
    assert [(p.length, p.offset) for p in pack(odd_docs(spark, [(1, None, None, None, None)]), PATH).collect()] == [(1, 0)]


def test_sequences_hold_the_ids(spark):
    rows = corpus(40)
    pieces = pack(odd_docs(spark, rows), PATH, with_ids=True)
    made = {s.sequence_id: np.frombuffer(bytes(s.ids), "<u4") for s in sequences(pieces).collect()}
    for p in pieces.collect():
        ids = ids_of(rows[p.doc_id][1], 0)[p.start : p.start + p.length]
        assert made[p.sequence_id][p.offset : p.offset + p.length].tolist() == ids
    assert all(len(s) == 1024 or len(s) & (len(s) - 1) == 0 for s in made.values())
    assert GRAIN < 1024


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (7, 2), (3000, 5), (5000, 50257), (700, 1 << 20)])
def test_wavelet_matrix(n, top):
    numbers = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    docs, sizes = ([1, None] if n > 1 else [3]), np.array([1, n - 1] if n > 1 else [n])
    matrix, ids, read = from_file(to_file(numbers, docs, sizes))
    assert (matrix.numbers() == numbers).all() and ids == docs and read.tolist() == sizes.tolist()
    for i in range(0, n, max(1, n // 50)):
        assert matrix[i] == numbers[i]
        places = np.flatnonzero(numbers == numbers[i])
        assert matrix.count(int(numbers[i])) == len(places)
        assert matrix.count(int(numbers[i]), n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
        assert [matrix.find(int(numbers[i]), k) for k in (0, len(places) - 1)] == [places[0], places[-1]]
    assert matrix.count(1 << 25) == 0
    with pytest.raises(IndexError):
        matrix[n]
    with pytest.raises(IndexError):
        matrix.find(1 << 25, 0)
    assert isinstance(matrix, WaveletMatrix)


def test_files_give_back_all_documents(spark, tmp_path):
    rows = [r for r in corpus(200) if r[0] % 7] + [(None, "last", None, None, None), (500, None, None, None, None)]
    docs = odd_docs(spark, rows[::-1]).repartition(5)
    write_tokens(docs, PATH, f"{tmp_path}/t", 2, shard=5000)
    assert spark.read.parquet(f"{tmp_path}/t").count() > 8
    start, expected = 0, []
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ids = ids_of(r[1], 2)
        expected.append((r[0], start, len(ids), crc(ids)))
        start += len(ids)
    key = lambda r: (r[1],)
    assert sorted((tuple(r) for r in read_tokens(spark, f"{tmp_path}/t").collect()), key=key) == expected


def test_odd_rows_in_files(spark):
    out = token_files(odd_docs(spark), PATH).collect()
    assert sorted(r.n_tokens for r in out) == sorted(len(ids_of(r[1], 2)) for r in ROWS)
    assert sorted(r.ids_crc32 for r in out) == sorted(crc(ids_of(r[1], 2)) for r in ROWS)
    assert token_files(odd_docs(spark, []), PATH).count() == 0
