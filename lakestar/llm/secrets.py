"""Secret scans: layers of encoded text are unwrapped until nothing new comes, each one scanned."""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import task

# The kinds of secrets, in their order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST = {"assign": 8, "access": 16, "hex": 32}

#: Packed bytes read at a time, bytes unpacked at a time, and characters from which on a layer is cut
#: into pieces, where nothing that is looked for can reach over the cut.
STEP = 1 << 14
CHUNK = 1 << 20
PIECE = 1 << 22
#: Layers remembered besides those being unwrapped; one that was forgotten is scanned again.
REMEMBERED = 100_000

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
# Lines of base64 letters, of which the last may be short.
_BASE64 = re.compile(
    r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[A-Za-z0-9+/_-]{16,})*(?:\r?\n[A-Za-z0-9+/_-]{1,15}(?=[=\r\n\"'<)\]]|\Z))?={0,2}"
)
_LINE = re.compile(r"[^\r\n]+")
# Compressed bytes as escapes with the letters between them that stand for themselves; in quotes also blanks and the other quote.
_URL_PACKED = re.compile(
    r"(?:%1[fF]%8[bB]|(?:x|%78)%(?:01|5[eE]|9[cC]|[dD][aA]))(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/+!*'()-])*"
)
_ESCAPE = re.compile(r"""\\(?:(?:x|u00)([0-9A-Fa-f]{2})|([abfnrtv0\\'"]))""")
_SAYS = dict(zip("abfnrtv0", "\a\b\f\n\r\t\v\0"))
_X_START = r"(?:\\(?:x|u00)1[fF]\\(?:x|u00)8[bB]|(?:x|\\(?:x|u00)78)(?:\\(?:x|u00)(?:01|5[eE]|9[cC]|[dD][aA])|\^(?=[^\\\s]{0,8}\\x)))"
_X_REST = r"""\\(?:x|u00)[0-9A-Fa-f]{2}|\\[abfnrtv0\\'"]|[!#-&(-\[\]-~]"""
_X_PACKED = re.compile(
    rf"""(?<='){_X_START}(?:{_X_REST}|[\x20"])*|(?<="){_X_START}(?:{_X_REST}|[\x20'])*|{_X_START}(?:{_X_REST})*"""
)
_GZIP, _ZLIB = b"\x1f\x8b\x08", (b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
# The last place of a text that no match, escape or base64 run, in this layer or deeper, reaches over.
_BREAK = regex.compile(r"""(?r)[^\x09\x0a\x0d\x20-\x7e]|[\x20\n.,;:=)\]>"'`!?][^\s%\\]{0,14}\n""")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the three kinds in a text as it stands, by start and kind.

    Matches are leftmost and don't overlap within a kind; those that are too short are dropped.
    """
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Layer:
    """A text and, for each of its characters or all of them, the span of the document it came from."""

    def __init__(self, text: str, begins: np.ndarray | int | None = None, ends: np.ndarray | int | None = None):
        self.text, self.begins, self.ends = text, begins, ends

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.begins is None:
            return start, end
        if isinstance(self.begins, int):
            return self.begins, self.ends
        return int(self.begins[start:end].min()), int(self.ends[start:end].max())

    def _replaced(self, made: list[tuple[int, int, str]]) -> Layer:
        """Stretches of this text replaced; all characters of a replacement map to its stretch."""
        if isinstance(self.begins, int):
            kept, at = [], 0
            for start, end, new in made:
                kept += [self.text[at:start], new]
                at = end
            return Layer("".join([*kept, self.text[at:]]), self.begins, self.ends)
        begins = np.arange(len(self.text)) if self.begins is None else self.begins
        ends = np.arange(1, len(self.text) + 1) if self.ends is None else self.ends
        text, low, high, at = [], [], [], 0
        for start, end, new in made:
            text += [self.text[at:start], new]
            low += [begins[at:start], np.full(len(new), begins[start:end].min())]
            high += [ends[at:start], np.full(len(new), ends[start:end].max())]
            at = end
        text.append(self.text[at:])
        return Layer("".join(text), np.concatenate([*low, begins[at:]]), np.concatenate([*high, ends[at:]]))

    def unwrapped(self, broken: set) -> Iterator[Layer]:
        """The layers right below this one, large ones in pieces; ``broken`` takes streams that end early."""
        text = self.text
        if "%" in text:
            made = []
            for m in _URL.finditer(text):
                raw = bytes.fromhex(m[0].replace("%", ""))
                made += _characters(raw, m.start(), 3)
            if made:
                yield self._replaced(made)
        if "\\u" in text or "\\x" in text:
            made = []
            for m in _UNICODE.finditer(text):
                point = int(m[1] or m[2] or m[3], 16)
                if point < 0x110000:
                    made.append((m.start(), m.end(), chr(point)))
            if made:
                yield self._replaced(_joined(made))
        for m in _URL_PACKED.finditer(text) if "%" in text else ():
            for token in {m[0], m[0].replace("+", " ")}:  # forms write a blank so
                yield from self._read(unquote_to_bytes(token), m.start(), m.end(), broken, False)
        for m in _X_PACKED.finditer(text) if "\\u" in text or "\\x" in text else ():
            raw = _ESCAPE.sub(lambda e: chr(int(e[1], 16)) if e[1] else _SAYS.get(e[2], e[2]), m[0]).encode("latin-1")
            yield from self._read(raw, m.start(), m.end(), broken, False)
        for m in _BASE64.finditer(text):
            for start, end, token in _runs(m):
                yield from self._read(_unbase64(token), start, end, broken)

    def _read(self, raw: bytes, start: int, end: int, broken: set, plain: bool = True) -> Iterator[Layer]:
        if not plain and not _header(_Bytes([raw])):
            return
        low, high = self.span(start, end)
        for piece in _pieces(_unpacked(raw, (low, high), broken, plain)()):
            yield Layer(piece, low, high)


def _runs(m: re.Match) -> Iterator[tuple[int, int, str]]:
    """``start, end, letters``: each long line, all lines, and lines of one width with the shorter one behind them."""
    lines = [(m.start() + n.start(), m.start() + n.end(), n[0]) for n in _LINE.finditer(m[0])]
    yield from (line for line in lines if len(line[2].rstrip("=")) >= 16)
    blocks, at = [lines], 0
    while at < len(lines):
        n = at + 1
        while n < len(lines) and len(lines[n][2]) == len(lines[at][2]):
            n += 1
        blocks.append(lines[at : n + (n < len(lines) and len(lines[n][2]) < len(lines[at][2]))])
        at = n
    for i, block in enumerate(blocks):
        if len(block) > 1 and (i == 0 or len(block) < len(lines)):
            yield block[0][0], block[-1][1], "".join(letters for _, _, letters in block)


class _Bytes:
    """Chunks as one stream that can be looked into ahead; what was just taken can be put back."""

    def __init__(self, chunks: Iterable[bytes]):
        self.chunks, self.held, self.at = iter(chunks), b"", 0

    def peek(self, n: int) -> bytes:
        if self.at + n > len(self.held):
            got, size = [self.held[self.at :]], len(self.held) - self.at
            while size < n and (more := next(self.chunks, None)) is not None:
                got.append(more)
                size += len(more)
            self.held, self.at = b"".join(got), 0
        return self.held[self.at : self.at + n]

    def take(self, n: int) -> bytes:
        out = self.peek(n)
        self.at += len(out)
        return out

    def back(self, n: int) -> None:
        self.at -= n

    def after(self, mark: bytes, start: int) -> int:
        """The place behind the mark, 0 if there is none."""
        n = start + STEP
        while True:
            seen = self.peek(n)
            at = seen.find(mark, start)
            if at >= 0 or len(seen) < n:
                return at + len(mark) if at >= 0 else 0
            n *= 2


def _header(source: _Bytes) -> int:
    """Bytes before the deflated data of a gzip or zlib stream, 0 if none starts here."""
    head = source.peek(10)
    if head[:2] in _ZLIB:
        return 2
    if head[:3] != _GZIP or len(head) < 10:
        return 0
    at = 10
    if head[3] & 4:
        at += 2 + int.from_bytes(source.peek(12)[10:], "little")
    for flag in (8, 16):
        if head[3] & flag:
            at = source.after(b"\0", at)
            if not at:
                return 0
    return at + (head[3] & 2)


def _fed(unpacker, data: bytes) -> Iterator[bytes]:
    """What comes out for ``data``, piece by piece, and up to a fault if there is one."""
    while True:
        before = unpacker.copy()
        try:
            out = unpacker.decompress(data, CHUNK)
        except zlib.error:
            yield _until_fault(before, data)
            raise
        data = unpacker.unconsumed_tail
        if out:
            yield out
        if unpacker.eof or (not data and len(out) < CHUNK):
            return


def _until_fault(unpacker, data: bytes) -> bytes:
    out, at = [], 0
    try:
        while True:
            new = unpacker.decompress(data[at : at + 1], 1)
            if not new and at >= len(data):
                break
            at += not unpacker.unconsumed_tail
            out.append(new)
    except zlib.error:
        pass
    return b"".join(out)


def _inflated(chunks: Iterable[bytes], name: tuple, broken: set, plain: bool = True) -> Iterator[bytes]:
    """The bytes of all members of a stream, check sums aside, and if ``plain`` as they are those of no member.

    Of a member with a fault all that comes before the fault is given; the next member is looked for
    behind it.
    """
    source, member = _Bytes(chunks), 0
    while source.peek(1):
        begin = _header(source)
        if begin:
            start, unpacker, some, fault = source.take(begin), zlib.decompressobj(-15), False, False
            fed, data = [start], b""
            try:
                while not unpacker.eof and (data := source.take(STEP)):
                    if not some:
                        fed.append(data)
                    for out in _fed(unpacker, data):
                        some = some or bool(out)
                        yield out
            except zlib.error:
                fault = True
            member += 1
            if unpacker.eof:
                source.back(len(unpacker.unused_data))
                source.take(4 if begin == 2 else 8)
                continue
            if some or begin > 2:
                broken.add((*name, member))
            if fault:
                source.back(len(data))
            if not some and plain:
                yield start if fault else b"".join(fed)
        seen = source.peek(STEP)
        at = seen.find(_GZIP, 0 if begin else 1)
        if at < 0:
            at = len(seen) if len(seen) < STEP else len(seen) - len(_GZIP) + 1
        passed = source.take(at)
        if passed and plain:
            yield passed


def _unpacked(raw: bytes, name: tuple, broken: set, plain: bool) -> Callable[[], Iterator[bytes]]:
    """Reads what bytes are packed from, to any depth; a stream may hold itself."""
    met: set[bytes] = set()

    def read() -> Iterator[bytes]:
        return iter([raw])

    def deeper(read: Callable[[], Iterator[bytes]], depth: int) -> Callable[[], Iterator[bytes]]:
        return lambda: _inflated(read(), (*name, depth), broken, plain or depth > 1)

    while _header(_Bytes(read())):
        mark = hashlib.blake2b(digest_size=16)
        for chunk in read():
            mark.update(chunk)
        if mark.digest() in met:
            break
        met.add(mark.digest())
        read = deeper(read, len(met))
    return read


def _pieces(chunks: Iterable[bytes]) -> Iterator[str]:
    """Bytes as text; those that aren't UTF-8 stay one by one. Text is held up to a place to cut."""
    decode = codecs.getincrementaldecoder("utf-8")("surrogateescape").decode
    held, size = [], 0
    for chunk in chunks:
        text = decode(chunk)
        held.append(text)
        size += len(text)
        cut = _BREAK.search(text) if size >= PIECE else None
        if cut:
            yield "".join([*held[:-1], text[: cut.end()]])
            held = [text[cut.end() :]]
            size = len(held[0])
    last = "".join([*held, decode(b"", True)])
    if last:
        yield last


def _characters(raw: bytes, start: int, width: int) -> list[tuple[int, int, str]]:
    """UTF-8 characters of escaped bytes with the stretch each one comes from; bad bytes stay one by one."""
    text = raw.decode("utf-8", "surrogateescape")
    made, at = [], start
    for c in text:
        n = len(c.encode("utf-8", "surrogateescape"))
        made.append((at, at + n * width, c if not 0xDC80 <= ord(c) <= 0xDCFF else chr(ord(c) - 0xDC00)))
        at += n * width
    return made


def _joined(made: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Two escapes that are halves of one character become one; a lone half becomes a mark."""
    out: list[tuple[int, int, str]] = []
    for start, end, c in made:
        if out and out[-1][1] == start and 0xD800 <= ord(out[-1][2][-1]) < 0xDC00 <= ord(c) < 0xE000:
            begin, _, high = out.pop()
            out.append((begin, end, chr(0x10000 + ((ord(high) - 0xD800) << 10) + ord(c) - 0xDC00)))
        else:
            out.append((start, end, c))
    return [(s, e, "\ufffd" if 0xD800 <= ord(c) < 0xE000 else c) for s, e, c in out]


def _unbase64(token: str) -> bytes:
    bare = token.rstrip("=").replace("-", "+").replace("_", "/")
    bare = bare[: len(bare) - (len(bare) % 4 == 1)]  # one letter more holds no byte
    return base64.b64decode(bare + "=" * (-len(bare) % 4))


def scan(text: str) -> tuple[list[tuple[int, int, int]], set[tuple[int, int, int]], int]:
    """Base spans, all spans (those of deeper layers mapped to the text), streams that end early.

    Layers are unwrapped depth first and piece by piece; a layer whose text and span were met before
    is not entered again, so encodings that give themselves end.
    """
    base = base_spans(text)
    spans, broken = set(base), set()
    first = _name(Layer(text))
    work, met = [(first, Layer(text).unwrapped(broken))], {first}
    while work:
        layer = next(work[-1][1], None)
        if layer is None:
            work.pop()
            continue
        name = _name(layer)
        if not layer.text or name in met:
            continue
        if len(met) >= REMEMBERED:
            met = {n for n, _ in work}
        met.add(name)
        spans.update((s, k, e) for (s, e), k in ((layer.span(a, b), k) for a, k, b in base_spans(layer.text)))
        work.append((name, layer.unwrapped(broken)))
    return base, spans, len(broken)


def _name(layer: Layer) -> tuple[bytes, int, int]:
    said = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return (said, *layer.span(0, len(layer.text))) if layer.text else (said, 0, 0)


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "unread"]
    for batch in batches:
        made: list[list] = [[] for _ in names[1:]]
        for text in batch.column("text"):
            base, spans, unread = scan(text.as_py())
            counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            row = [*counts, hashlib.sha256(_told(base).encode()).hexdigest(), _told(sorted(spans)), unread]
            for column, value in zip(made, row):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(made, kinds))], names=names)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, unread`` for every row of ``docs``.

    Spans are ``kind:start:end`` in code points of the whole text, end exclusive: those of the text
    itself, and those found in URL escapes, Unicode escapes, base64 and what it compresses, to any
    depth and size, mapped to the text they came from. ``unread`` counts compressed streams that end
    early; what comes before their fault is scanned. Null and empty text give none. Rows are independent,
    so repeated ids and rows change nothing; other columns are ignored; an empty table gives no row.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return own.mapInArrow(
        task(_scan), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, unread long"
    )
