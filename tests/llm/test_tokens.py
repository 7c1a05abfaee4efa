import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from odd import odd_docs
from tokenizers import Tokenizer

from lakestar.llm import tokens
from lakestar.llm.packing import pack
from lakestar.llm.tokens import Encoder, encoder
from lakestar.llm.wavelet import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"
TEXTS = [
    END, f"a {END} b", f"a{END}b", f"{END}{END}", f" {END} ", f"a  {END}  b c. {END}\n", f"{END[:-1]} {END} x", f"<|{END}|>", "no token here",
]


def plain(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_added_tokens_are_the_librarys(text):
    assert np.frombuffer(encoder(PATH).encode(text), "<u4").tolist() == plain(PATH, text)


@pytest.mark.parametrize("flag", [None, "lstrip", "rstrip", "single_word", "normalized"])
def test_several_added_tokens(tmp_path, flag):
    made = json.load(open(PATH))
    for i, content in enumerate(["<x>", "<x>y", "two words", "<|end"]):
        new = made["added_tokens"][0] | {"id": 60_000 + i, "content": content, "special": i % 2 == 0}
        made["added_tokens"].append(new | ({flag: True} if flag else {}))
    path = str(tmp_path / "t.json")
    json.dump(made, open(path, "w"))
    for text in [*TEXTS, "a <x>y b<x> two words two  words", "two words<x>two wordsy <|endof", "<x><x>y<|end|>"]:
        assert np.frombuffer(encoder(path).encode(text), "<u4").tolist() == plain(path, text)


def test_operators_match_added_tokens(spark):
    docs = odd_docs(spark, [(i, t, None, None, None) for i, t in enumerate(TEXTS)])
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for out, end in ((pack(docs, PATH), 0), (token_files(docs, PATH), 2)):
        assert {r.doc_id: r.ids_crc32 for r in out.collect()} == {i: crc([*plain(PATH, t), end]) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("block", [8, 500, 1 << 22])
def test_blocks_of_texts_give_the_librarys_ids(monkeypatch, block):
    monkeypatch.setattr(tokens, "BLOCK", block)
    r, library = random.Random(block), Tokenizer.from_file(PATH)
    pool = [*" \n\t\r\x0b\x0c\x1c\x85\xa0\u2003\u3000'.,;:!?()-_\"abcszABC0189éèß中文🙂²½Ⅷ\u0301\u200b\x00\x7f", *[" ", "\n", "  ", "'s", "'ll", " the", END] * 3]
    texts = ["".join(r.choices(pool, k=r.randint(0, 25))) for _ in range(3000)]
    found = list(Encoder(PATH).encode_all(texts))
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_forgotten_pieces_are_merged_again(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    own, library = Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ["one two three four five six seven.", "one two", "eight nine ten (eleven)", "one two three é.é é.é seven."] * 3:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert max(len(own.known), len(own.older)) <= 5
