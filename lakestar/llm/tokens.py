"""Token ids of texts, by a tokenizers file whose path is a parameter; runs inside tasks."""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice
from sys import byteorder

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer, models, pre_tokenizers

#: Pieces a worker remembers in each of two generations; a piece beyond them is encoded again.
REMEMBERED = 200_000
#: Characters that are cut into pieces together.
BLOCK = 1 << 22
#: New pieces that are merged in one call of the model.
TOGETHER = 64
#: White space beyond ASCII, as ``str.isspace`` has it.
WIDE_SPACES = [chr(c) for c in range(128, 0x3001) if chr(c).isspace()]

# The pre-token pattern of the byte-level alphabet, and the bytes that stand for themselves in it.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = ((33, 126), (161, 172), (174, 255))

# Kinds of bytes: letters, digits and marks of ASCII are cut apart, an apostrophe may begin a contraction.
OTHER, LETTER, DIGIT, QUOTE, MARK = range(5)
KINDS = np.array(
    [
        LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else QUOTE if b == 39 else MARK if 32 < b < 127 else OTHER
        for b in range(128)
    ]
    + [OTHER] * 128,
    dtype=np.uint8,
)
BLANKS = np.array([b < 128 and chr(b).isspace() for b in range(256)])
#: Whether a pre-token always ends between a byte of the one kind and one of the other.
APART = np.zeros((5, 5), dtype=bool)
for _one in (LETTER, DIGIT):
    APART[_one, [QUOTE, MARK]] = APART[MARK, _one] = APART[_one, LETTER + DIGIT - _one] = True


def _byte_letters() -> dict[int, int]:
    """Code point 0..255 to the letter that stands for that byte in the vocabulary."""
    plain = {b for low, high in PLAIN_BYTES for b in range(low, high + 1)}
    others = iter(range(256, 512))
    letters = {b: b if b in plain else next(others) for b in range(256)}
    if {chr(c) for c in letters.values()} != set(pre_tokenizers.ByteLevel.alphabet()):
        raise ValueError("the library's byte alphabet is another one")
    return letters


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes without wide white space at which a pre-token surely begins, ``starts`` among them."""
    kinds, blank = KINDS[data], BLANKS[data]
    cut = APART[kinds[:-1], kinds[1:]]
    cut = np.concatenate([[True], cut])
    # A blank or a line end that stands alone: the blank goes with what follows, the line end does not.
    inner = np.flatnonzero((data[1:-1] == 32) | (data[1:-1] == 10)) + 1
    inner = inner[~blank[inner - 1] & ~blank[inner + 1]]
    cut[inner] = True
    cut[inner[data[inner] == 10] + 1] = True
    cut[starts] = True
    return np.flatnonzero(cut)


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit numbers.

    Texts are cut by blocks where a pre-token surely begins: around a blank or a line end that stands
    alone, and between letters, digits and marks of ASCII. Each distinct piece of a block is looked up
    once; pieces that aren't remembered are cut by the whole pattern, and the library's model merges
    them, many in one call with a byte between them that is in no merge. Two generations bound the
    memory. Before that, a text is cut at the added tokens, which are matched as the library does by
    default; if they take blanks or whole words with them, texts that hold one go to the library.
    Files that aren't plain byte-level BPE are encoded text by text.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pattern = regex.compile(PRE_TOKENS)
        kind = self.tokenizer.pre_tokenizer
        self.by_piece = (
            isinstance(kind, pre_tokenizers.ByteLevel)
            and kind.use_regex
            and not kind.add_prefix_space
            and self.tokenizer.normalizer is None
            and isinstance(self.model, models.BPE)
        )
        if self.by_piece:
            self.model._resize_cache(0)  # pieces are remembered here
            self.apart = self._apart()
        added = {i: t for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.content}
        self.added = {t.content: i.to_bytes(4, byteorder) for i, t in added.items()}
        self.added_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.added_bare = not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values())

    def _apart(self) -> int | None:
        """The id of byte 255, which no text holds, if no merge has it, so that it keeps pieces apart."""
        model, letter = self.model, chr(self.letters[255])
        alone = not any(letter in token for token in self.tokenizer.get_vocab(with_added_tokens=False) if token != letter)
        whole = model.ignore_merges or model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix
        return model.token_to_id(letter) if alone and not whole else None

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in order. A block of texts, or of a long text, is held at a time."""
        waiting: list[str] = []
        held = 0
        for text in texts:
            if held + len(text) > BLOCK:
                yield from self._texts(waiting)
                waiting, held = [], 0
            waiting.append(text)
            held += len(text)
        yield from self._texts(waiting)

    def _texts(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_piece:
            yield from map(self._whole, texts)
        elif sum(map(len, texts)) > BLOCK:  # one long text, as encode_all leaves it
            for text in texts:
                yield b"".join([ids for part in self._parts(text) for s in _slices(part) for ids in self._stretches([s])])
        elif not any(token in text for text in texts for token in self.added):
            yield from self._stretches(texts)
        else:
            parts = [self._parts(text) for text in texts]
            ids = iter(self._stretches([p for of_text in parts for p in of_text]))
            for of_text in parts:
                yield b"".join([next(ids) for _ in of_text])

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _parts(self, text: str) -> list[str | bytes]:
        """Stretches of text between the added tokens, and ids."""
        if not any(map(text.__contains__, self.added)):
            return [text]
        if not self.added_bare:
            return [self._whole(text)]
        return [self.added[p] if i % 2 else p for i, p in enumerate(self.added_pattern.split(text))]

    def _stretches(self, stretches: list[str | bytes]) -> list[bytes]:
        """The ids of each stretch; those that are ids already stay."""
        made = {i: s for i, s in enumerate(stretches) if isinstance(s, bytes)}
        wide = [i for i, s in enumerate(stretches) if i not in made and any(map(s.__contains__, WIDE_SPACES))]
        made |= {i: b"".join(self._pieces(self.pattern.findall(stretches[i]))) for i in wide}
        encoded = [b"" if i in made else s.encode("utf-8", "replace") for i, s in enumerate(stretches)]
        ends = np.cumsum([len(e) for e in encoded])
        data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        if not len(data):
            return [made.get(i, b"") for i in range(len(stretches))]
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        cuts = _cuts(data, starts[starts < len(data)])
        offsets = pa.py_buffer(np.append(cuts, len(data)).astype(np.int32))
        pieces = pa.Array.from_buffers(pa.string(), len(cuts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        own = self._pieces(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = pieces.indices.to_numpy()
        numbers = np.frombuffer(b"".join(own), dtype="<u4")
        sizes = np.fromiter(map(len, own), dtype=np.int64, count=len(own)) // 4
        first = np.cumsum(sizes) - sizes
        before = np.concatenate([[0], np.cumsum(sizes[which])])
        ids = numbers[np.repeat(first[which] - before[:-1], sizes[which]) + np.arange(before[-1])].tobytes()
        begin, end = (4 * before[np.searchsorted(cuts, places)] for places in (starts, ends))
        return [made.get(i) or ids[b:e] for i, (b, e) in enumerate(zip(begin.tolist(), end.tolist()))]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, which may hold several pre-tokens."""
        found = list(map(self.known.get, pieces))
        older, new, several = self.older.get, {}, {}
        for i in [i for i, ids in enumerate(found) if ids is None]:
            piece = pieces[i]
            found[i] = older(piece)
            if found[i] is not None or piece in new:
                continue
            if not (piece[-1:].isalpha() and (piece.isalpha() or piece[0] == " " and piece[1:].isalpha())):
                tokens = self.pattern.findall(piece)
                if len(tokens) > 1:  # hardly comes again as it is: its pre-tokens do
                    several[i] = tokens
                    continue
            new[piece] = None
        parts = {t: self.known.get(t) or older(t) for tokens in several.values() for t in tokens}
        new.update((t, None) for t, ids in parts.items() if ids is None)
        tokens = list(new)
        new = dict(zip(tokens, self._merged(tokens)))
        parts.update((t, new[t]) for t, ids in parts.items() if ids is None)
        for i, own in several.items():
            found[i] = b"".join([parts[t] for t in own])
        made = [new[p] if ids is None else ids for p, ids in zip(pieces, found)]
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known = self.known, dict(islice(new.items(), REMEMBERED))
        else:
            self.known |= new
        return made

    def _merged(self, tokens: list[str]) -> list[bytes]:
        """The ids of each pre-token, by the model."""
        together = TOGETHER if self.apart is not None else 1
        made: list[bytes] = []
        for i in range(0, len(tokens), together):
            spelled = [t.encode("utf-8", "replace") for t in tokens[i : i + together]]
            letters = b"\xff".join(spelled).decode("latin-1").translate(self.letters)
            ids = array("I", [t.id for t in self.model.tokenize(letters)])
            data, size = ids.tobytes(), ids.itemsize
            if together == 1:
                made.append(data)
                continue
            stops = (size * np.flatnonzero(np.frombuffer(ids, dtype=np.uint32) == self.apart)).tolist()
            made += [data[b:e] for b, e in zip([0, *(s + size for s in stops)], [*stops, len(data)])]
        return made


def _slices(text: str | bytes) -> Iterator[str | bytes]:
    """A long stretch cut before blanks between two characters that are no white space, where no pre-token reaches over."""
    begin = 0
    while len(text) - begin > BLOCK and isinstance(text, str):
        found = _CUT.search(text, begin + BLOCK)
        if not found:
            break
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:] if begin else text


_CUT = regex.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, kept over its tasks."""
    return Encoder(path)
