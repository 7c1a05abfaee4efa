"""Compressed layers are read to their end, whatever their size and however many members they have."""

import base64
import gzip
import random
import zlib

import pytest

from lakestar.llm import secrets
from lakestar.llm.secrets import scan

SAY = b"password=hunter22aa"


def deeper(raw):
    """What is found in bytes below the text, and the streams that end early."""
    text = base64.b64encode(raw).decode()
    base, found, unread = scan(text)
    assert {(s, e) for s, _, e in found - set(base)} <= {(0, len(text))}
    return {k for _, k, _ in found - set(base)}, unread


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress])
def test_a_secret_behind_64_mib(pack):
    assert deeper(pack(b"some words, and so on.\n" * 3_000_000 + SAY)) == ({0}, 0)


def test_every_member_is_read():
    parts = [b"one ", b"", b"two ", SAY, b" end"]
    assert deeper(b"".join(map(gzip.compress, parts))) == ({0}, 0)
    assert deeper(gzip.compress(b"one") + b"\0" * 500 + gzip.compress(SAY)) == ({0}, 0)
    assert deeper(b"".join(gzip.compress(SAY[i : i + 1]) for i in range(len(SAY)))) == ({0}, 0)
    assert deeper(gzip.compress(gzip.compress(b"x") + gzip.compress(SAY))) == ({0}, 0)


def test_pieces_give_what_the_whole_gives(monkeypatch):
    r = random.Random(5)
    inner = base64.b64encode(SAY).decode()
    words = ["plain", "password%3Dhunter22aa", "token = ", "abcdefgh1", inner, "é", ",", "\n", "\n", " ", "AKIA" + "Q" * 16, r"password=abcdefgh", "0" * 33]
    for _ in range(60):
        raw = zlib.compress("".join(r.choices(words, k=40)).encode())
        monkeypatch.setattr(secrets, "PIECE", 1 << 22)
        monkeypatch.setattr(secrets, "CHUNK", 1 << 20)
        whole = deeper(raw)
        monkeypatch.setattr(secrets, "PIECE", 1)
        monkeypatch.setattr(secrets, "CHUNK", 7)
        assert deeper(raw) == whole


def test_a_fault_keeps_what_came_before():
    raw = bytearray(gzip.compress(SAY + b" and more"))
    raw[-6] ^= 1
    assert deeper(bytes(raw))[0] == {0}
    r = random.Random(6)
    words = " ".join(r.choices(["plain", "words", "of", "no", "meaning"], k=50_000)).encode()
    cut = gzip.compress(SAY + b"\n" + words)[:-8_000]
    assert deeper(cut) == ({0}, 1)
    packer = zlib.compressobj(wbits=31)
    fault = packer.compress(SAY) + packer.flush(zlib.Z_FULL_FLUSH) + b"\x07"  # no such kind of block
    assert deeper(fault + gzip.compress(b"AKIA" + b"Q" * 16)) == ({0, 1}, 1)


def test_text_that_looks_packed():
    assert deeper(b"x^2 + y^2, " + SAY)[0] == {0}
