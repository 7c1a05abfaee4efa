"""Layers that are wrapped, not quite text, or compressed and then escaped."""

import base64
import gzip
import zlib
from urllib.parse import quote, quote_plus

import pytest

from lakestar.llm.secrets import KINDS, scan

SAY = "password=hunter22aa"


def below(text):
    base, found, _ = scan(text)
    return {(KINDS[k], s, e) for s, k, e in found - set(base)}


@pytest.mark.parametrize("width, end", [(64, "\n"), (76, "\r\n"), (20, "\n")])
def test_wrapped_base64(width, end):
    for at in range(0, 80, 3):
        for raw in (b"." * at + SAY.encode() + b" tail", gzip.compress(bytes(range(200)) + b" " * at + SAY.encode())):
            b = base64.b64encode(raw).decode()
            wrapped = end.join(b[i : i + width] for i in range(0, len(b), width))
            for before, after in (("", ""), ("see: ", end), (f"-----BEGIN CERTIFICATE-----{end}", f"{end}-----END CERTIFICATE-----")):
                text = before + wrapped + after
                found = below(text)
                assert found and all(k == "assign" for k, _, _ in found)
                assert max(e for _, _, e in found) <= len(before + wrapped) + len(end) + 15


def test_layers_that_are_not_quite_text():
    for raw in (f"A=1\0{SAY}\0B=2".encode(), b"\xff\xfe " + SAY.encode(), b"caf\xe9 " + SAY.encode() + b"\x07"):
        b = base64.b64encode(raw).decode()
        assert below(f"[{b}]") == {("assign", 1, 1 + len(b))}
        c = base64.b64encode(zlib.compress(raw)).decode()
        assert below(f"[{c}]") == {("assign", 1, 1 + len(c))}


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress])
def test_compressed_then_escaped(pack):
    packed = pack(f"{SAY} and some 'more' \"words\" {list(range(40))}".encode())
    every = "".join(f"%{b:02X}" for b in packed)
    hexes = "".join(f"\\x{b:02x}" for b in packed)
    for token in (quote(packed, safe=""), quote_plus(packed), every, hexes, repr(packed)[2:-1]):
        for before, after in (("b'", "'"), ('b"', '"')) if token == repr(packed)[2:-1] else (("x ", " y"), ("", "")):
            if token == repr(packed)[2:-1] and before[1] != repr(packed)[1]:
                continue
            assert below(before + token + after) == {("assign", len(before), len(before + token))}


def test_a_broken_check_sum():
    for pack, at in ((gzip.compress, -6), (zlib.compress, -2)):
        raw = bytearray(pack(SAY.encode()))
        raw[at] ^= 1
        assert len(below(base64.b64encode(bytes(raw)).decode())) == 1
