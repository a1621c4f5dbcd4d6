"""Token ids of whole texts, by a public tokenizer file and the tokenizers library."""

from __future__ import annotations

import codecs
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
END = 0
#: Latin letters below this, after a space or not, are one pre-token, which goes straight to the tokenizer's model.
WORD_END = "\u0250"
_BELOW_END = re.compile(f"[^{WORD_END}-\U0010ffff]*", re.DOTALL)
CLOSING = ".,;:!?*#$%&"
#: Bytes of texts that are split at once.
SPLIT_BYTES = 4 << 20
_LETTER, _CLOSES, _VISIBLE = np.zeros((3, 256), bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CLOSES[list(CLOSING.encode())] = True
_VISIBLE[33:127] = True


def tokenizer_path(name: str) -> str:
    """A path as it is; a bare name is looked up among the public tokenizers of the machine at hand."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> dict[int, int]:
    """The character that byte-level vocabularies show each byte as: itself if visible, else the next one from 256 on."""
    hidden = [b for b in range(256) if b <= 32 or 127 <= b <= 160 or b == 173]
    return {b: 256 + i for i, b in enumerate(hidden)}


class Pieces(dict):
    """Ids of pieces of text, remembered up to a bound; None for a piece whose white space touches that of its neighbours.

    A piece splits once more where a token always ends: between a letter and a
    closing run of punctuation, and around a single line break. When the memory is full
    it becomes the older half, from which pieces still in use are taken over.
    """

    LIMIT, LONGEST = 250_000, 48

    def __init__(self, tokenizer, dtype: np.dtype):
        self.encode, self.kind, self.older = tokenizer.encode, {2: "H", 4: "I"}[dtype.itemsize], {}
        hidden = byte_characters()
        self.tokenize, self.shown = tokenizer.model.tokenize, "".join(chr(hidden.get(b, b)) for b in range(256))
        self.below_end, self.show = _BELOW_END.fullmatch, codecs.charmap_decode

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.older.get(piece)
        if ids is None:
            ids = self._ids(piece)
        if len(piece) <= self.LONGEST:
            if len(self) >= self.LIMIT:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _ids(self, piece: str) -> bytes | None:
        if piece[piece[0] == " " :].isalpha() and (piece.isascii() or self.below_end(piece)):
            shown = self.show(piece.encode(), "strict", self.shown)[0]
            return array(self.kind, [t.id for t in self.tokenize(shown)]).tobytes()
        if piece != "\n" and (piece == " " or piece[piece[0] == " "].isspace() or piece[-1].isspace()):
            return None
        at = piece.find("\n")
        if 0 < at < len(piece) - 1 and not piece[at - 1].isspace() and not piece[at + 1].isspace():
            before, after = self[piece[:at]], self[piece[at + 1 :]]
            return None if before is None or after is None else before + self["\n"] + after
        body = piece.rstrip(CLOSING)
        if body and body != piece and body[-1].isalpha():
            return self[body] + self[piece[len(body) :]]
        return array(self.kind, self.encode(piece, add_special_tokens=False).ids).tobytes()


def _starts(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places in the bytes of some texts, none empty, where a token always begins.

    These are the texts' beginnings, every space, a closing mark after a letter, and both
    sides of a line break between visible characters of one text.
    """
    cut = raw == 0x20
    cut[1:] |= _LETTER[raw[:-1]] & _CLOSES[raw[1:]]
    cut[begins] = True
    edge = np.zeros(len(raw), bool)
    edge[begins] = edge[ends - 1] = True
    breaks = np.flatnonzero((raw == 0x0A) & ~edge)
    breaks = breaks[_VISIBLE[raw[breaks - 1]] & _VISIBLE[raw[breaks + 1]]]
    cut[breaks] = cut[breaks + 1] = True
    return np.flatnonzero(cut)


def strings(texts: pa.StringArray) -> list[str]:
    """The strings of an array without nulls, decoded together and cut where characters begin."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset :][: len(texts) + 1]
    if not len(texts) or bounds[0] == bounds[-1]:
        return [""] * len(texts)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    whole = str(raw, "utf-8")
    bounds = bounds - bounds[0]
    if len(whole) != len(raw):
        bounds = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][bounds]
    at = bounds.tolist()
    return [whole[a:b] for a, b in zip(at, at[1:])]


def _pieces_of(name: str, tokenizer, dtype: np.dtype) -> Pieces:
    """One memory per worker process and tokenizer, so that a task goes on with what earlier ones have learned."""
    known = vars(sys).setdefault("_llm_token_pieces", {})
    if name not in known:
        known[name] = Pieces(tokenizer, dtype)
    return known[name]


class Encoder:
    """Ids of texts as the library gives them with ``add_special_tokens=False``.

    For byte-level BPE, words that a single space joins are encoded apart and
    remembered, since such a space always begins a token and nothing merges across
    it. Texts in which a space may touch other white space, and those that hold the string
    of an added token, are encoded as they are.
    """

    def __init__(self, name: str = TOKENIZER, remembered: int = Pieces.LIMIT):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._splits = "ByteLevel" in str(type(self.tokenizer.pre_tokenizer).__name__) and self.tokenizer.normalizer is None
        self._pieces = _pieces_of(name, self.tokenizer, self.dtype)
        self._pieces.LIMIT = remembered

    def encode(self, text: str | None) -> bytes:
        """Little-endian ids of ``dtype``."""
        if not text:
            return b""
        if self._splits and not any(added in text for added in self._added):
            first, *rest = text.split(" ")
            get = self._pieces.__getitem__
            parts = [get(first) if first else b"", *[get(" " + w) for w in rest]]
            if None not in parts:
                return b"".join(parts)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        return array(self._pieces.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """What ``encode`` gives for every text, some megabytes at a time, in which each different piece is looked up once."""
        texts = pc.fill_null(texts, "").cast(pa.string())
        sums = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        bounds = [0, *(np.flatnonzero(np.diff(sums // SPLIT_BYTES)) + 1).tolist(), len(texts)]
        for lo, hi in zip(bounds, bounds[1:]):
            part = texts.slice(lo, hi - lo)
            yield from self._encoded(part) if self._splits else (self.encode(t.as_py()) for t in part)

    def _encoded(self, texts: pa.Array) -> Iterator[bytes]:
        _, offsets, data = texts.buffers()
        places = np.frombuffer(offsets, np.int32)[texts.offset :][: len(texts) + 1]
        if not len(texts) or places[0] == places[-1]:
            yield from [b""] * len(texts)
            return
        data = data.slice(places[0], places[-1] - places[0])
        begins, ends = places[:-1] - places[0], places[1:] - places[0]
        filled = ends > begins
        starts = _starts(np.frombuffer(data, np.uint8), begins[filled], ends[filled])
        bounds = pa.py_buffer(np.append(starts, ends[-1]).astype(np.int32))
        pieces = pa.StringArray.from_buffers(len(starts), bounds, data).dictionary_encode()
        which = pieces.indices.to_numpy()
        found = list(map(self._pieces.__getitem__, strings(pieces.dictionary)))
        unsure = np.zeros(len(found), bool)
        if None in found:
            unsure[:] = [ids is None for ids in found]
            found = [ids or b"" for ids in found]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        ids, firsts = np.frombuffer(b"".join(found), self.dtype), np.cumsum(sizes) - sizes
        sums = np.r_[0, np.cumsum(sizes[which])]
        whole = ids[np.repeat(firsts[which] - sums[:-1], sizes[which]) + np.arange(sums[-1])].tobytes()
        at = (sums[np.searchsorted(starts, np.append(begins, ends[-1]))] * self.dtype.itemsize).tolist()
        alone = np.zeros(len(texts), bool)
        alone[np.searchsorted(begins, starts[unsure[which]], "right") - 1] = True
        for added in self._added:
            alone |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        for i, plain in enumerate(alone.tolist()):
            yield self._plain(texts[i].as_py()) if plain else whole[at[i] : at[i + 1]]

    def ids(self, text: str | None) -> np.ndarray:
        """Ids with the end id, as 32-bit numbers."""
        return self.with_end(self.encode(text))

    def with_end(self, encoded: bytes) -> np.ndarray:
        """Encoded ids with the end id, as 32-bit numbers."""
        return np.append(np.frombuffer(encoded, self.dtype), np.array([END], self.dtype)).astype("<u4")
