"""Token ids of whole texts by a public tokenizer, with a cache of word ids.

The tokenizers' splitting rules never join text across a space that follows a
non-space, so a text is cut there and each distinct chunk is encoded once.  What
the cutting rules below don't cover (other scripts, control characters, special
tokens in the text, doubled spaces, other kinds of tokenizer) goes to the
library as one whole text, so ids are always those of the whole text.

Many texts are encoded together: their chunks are hashed in whole arrays and looked up in a
table by two hashes of 64 bits, so only chunks that are not in it cost Python work.
"""

from __future__ import annotations

import json
from array import array
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

# fixed values: the splitting patterns that the two kinds of tokenizer file name
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_PLAIN = regex.compile("[\n\x20-\x7e\xa1-\xff]*")
_ENDS = (".", ",")
_WHOLE = "whole"  # marks a chunk after which a text may not be cut; not bytes, so joining fails


class Generations(dict):
    """A cache of at most twice ``limit`` values: the entries of the last generation stay findable."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


PIECE = 1 << 19  # bytes of text that are encoded together
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_FIRST, _ATTACHED = np.uint64(0x165667B19E3779F9), np.uint64(0x85EBCA77C2B2AE62)
_LETTER, _SIGN = (np.array([f(chr(b)) if b < 128 else False for b in range(256)]) for f in (
    str.isalpha, lambda c: c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"))
_powers_held: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of both bases and of their inverses, modulo 2^64."""
    if not _powers_held or len(_powers_held[0]) < n:
        out = []
        for base in _BASES:
            for b in (base, pow(base, -1, 1 << 64)):
                x = np.full(max(n, PIECE + 2), b, np.uint64)
                x[0] = 1
                out.append(np.multiply.accumulate(x))
        _powers_held[:] = out
    return _powers_held


def _pieces_hashes(buf: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Two hashes of each piece of ``buf``."""
    powers, out = _powers(len(buf) + 1), []
    for k in range(2):
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf + np.uint64(1 + k)) * powers[2 * k + 1][: len(buf)], out=total[1:])
        h = (total[stop] - total[start]) * powers[2 * k][stop]
        h += (stop - start + 1).astype(np.uint64) * _FIRST
        h *= np.uint64(0xD6E8FEB86659FD93)
        out.append(h ^ (h >> np.uint64(31)))
    return out


class Table:
    """Ids of chunks by their hashes, in an open table of arrays; cleared when ``limit`` is reached."""

    def __init__(self, dtype: np.dtype, limit: int):
        self.dtype, self.limit = dtype, limit
        self.bits = max(4, (2 * limit - 1).bit_length())
        self.clear()

    def clear(self) -> None:
        slots = 1 << self.bits
        self.one, self.two, self.entry = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
        self.at, self.size, self.n = np.zeros(self.limit, np.int64), np.zeros(self.limit, np.int32), 0
        self.ids, self.used = np.empty(1 << 16, self.dtype), 0

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Entry numbers, -1 where there is none."""
        slot = (one >> np.uint64(64 - self.bits)).astype(np.int64)
        out, open_ = np.full(len(one), -1, np.int64), np.arange(len(one))
        while len(open_):
            s = slot[open_]
            held = self.one[s]
            hit = (held == one[open_]) & (self.two[s] == two[open_])
            out[open_[hit]] = self.entry[s[hit]]
            open_ = open_[~hit & (held != 0)]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, one: int, two: int, ids: bytes | str) -> None:
        slot, last = one >> (64 - self.bits), (1 << self.bits) - 1
        while self.one[slot]:
            slot = (slot + 1) & last
        self.one[slot], self.two[slot], self.entry[slot] = one, two, self.n
        if ids is _WHOLE:
            self.size[self.n] = -1
        else:
            new = np.frombuffer(ids, self.dtype)
            while self.used + len(new) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used : self.used + len(new)] = new
            self.at[self.n], self.size[self.n] = self.used, len(new)
            self.used += len(new)
        self.n += 1


class Encoder:
    """``limit`` bounds the chunks in the table (about 70 bytes each with its empty places)."""

    def __init__(self, path: str, limit: int = 1_500_000):
        self.library = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size(True) <= 1 << 16 else "<u4")
        self.kind = self._kind(self.library)
        self.pattern = regex.compile(WORD_PATTERN if self.kind == "word" else BYTE_PATTERN)
        self.letters = _byte_letters()
        self.bpe = self.library.model
        self.space = "" if self.kind == "word" else self.letters[32]
        self.table = Table(self.dtype, limit)
        self.chunks = Generations(self._chunk, max(1, limit // 10))
        self.others = Generations(self._piece, max(1, limit // 10))

    @staticmethod
    def _kind(library: Tokenizer) -> str:
        """Which cutting rules hold, from the parts' own settings (the vocabulary is not copied to Python)."""
        part = lambda x: json.loads(x.__getstate__()) if x else {}
        pre, norm, model = part(library.pre_tokenizer), part(library.normalizer), library.model
        marks = all(t.content.startswith("<|") and not t.normalized for t in library.get_added_tokens_decoder().values())
        if type(model).__name__ != "BPE" or model.dropout or not marks:
            return ""
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "byte"
        steps = [s.get("type") for s in pre.get("pretokenizers", [])]
        if steps == ["Split", "ByteLevel"] and not pre["pretokenizers"][1].get("use_regex"):
            split = pre["pretokenizers"][0]
            kept = split.get("behavior") == "Removed" and split.get("invert")
            forms = [s.get("type") for s in norm.get("normalizers", [])]
            if kept and split["pattern"].get("Regex") == WORD_PATTERN and forms == ["NFC", "Replace", "Lowercase"]:
                return "word"
        return ""

    def _whole(self, text: str) -> bytes:
        return self._pack(self.library.encode(text, add_special_tokens=False).ids)

    def _pack(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def _letters_only(self, word: str) -> bytes:
        """Ids of a chunk of letters alone, which is one piece."""
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return self._pack([t.id for t in self.bpe.tokenize(self.space + mapped)])

    def _piece(self, piece: str) -> bytes:
        return self._pack([t.id for t in self.bpe.tokenize(piece.encode().decode("latin-1").translate(self.letters))])

    def _split(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            return self._whole(chunk)
        others = self.others
        return b"".join([others[p] for p in self.pattern.findall(chunk.lower() if self.kind == "word" else chunk)])

    def _chunk(self, chunk: str):
        """Ids of a chunk after a space (which the word kind drops)."""
        if chunk.isalpha() and (chunk.isascii() or _PLAIN.fullmatch(chunk)):
            return self._letters_only(chunk.lower() if self.kind == "word" else chunk)
        if chunk[-1:] in _ENDS and chunk[:-1].isalpha():
            return self.chunks[chunk[:-1]] + self.others[chunk[-1]]
        if self.kind == "word":
            return self._split(chunk)
        if not chunk or chunk[-1].isspace():
            return _WHOLE
        return self._split(" " + chunk)

    def _attached(self, chunk: str):
        """Ids of signs, and what follows them, behind a letter."""
        return _WHOLE if self.kind == "byte" and chunk[-1].isspace() else self._split(chunk)

    def _first(self, chunk: str):
        if self.kind == "byte" and chunk and chunk[-1].isspace():
            return _WHOLE
        return self._split(chunk)

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text as packed little-endian numbers of ``dtype``."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each whole text."""
        out = [b""] * len(texts)
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.kind or "<|" in text:
                out[i] = self._whole(text)
                continue
            held.append((i, self._cuttable(text)))
            size += len(held[-1][1])
            if size >= PIECE:
                self._together(held, texts, out)
                held, size = [], 0
        if held:
            self._together(held, texts, out)
        return out

    def _cuttable(self, text: str) -> bytes:
        """The text with spaces wherever it may be cut."""
        if self.kind == "word":
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
            text = text.replace("\n", " ")
        return text.encode()

    def _together(self, held: list[tuple[int, bytes]], texts: list[str | None], out: list[bytes]) -> None:
        buf = b" ".join(t for _, t in held) + b" "
        data = np.frombuffer(buf, np.uint8)
        # cut at spaces, and behind ASCII letters where a sign other than an apostrophe follows
        space = data == 32
        cut = space.copy()
        cut[1:] |= _LETTER[data[:-1]] & _SIGN[data[1:]]
        stop = np.flatnonzero(cut)
        start = np.append(0, stop[:-1] + space[stop[:-1]])
        attached = np.append(False, ~space[stop[:-1]])
        ends = np.cumsum(np.fromiter((len(t) + 1 for _, t in held), np.int64, len(held)))
        doc = np.searchsorted(ends, start, "right")
        one, two = _pieces_hashes(data, start, stop)
        first = np.zeros(len(start), bool)
        if self.kind == "byte":  # the first chunk of a text has no space before it
            first = start == (ends - np.fromiter((len(t) + 1 for _, t in held), np.int64, len(held)))[doc]
            one = np.where(first, one ^ _FIRST, one)
        one = np.where(attached, one ^ _ATTACHED, one)
        one |= np.uint64(1)  # 0 marks an empty place
        found = self.table.find(one, two)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = missing[np.unique(one[missing], return_index=True)[1]]
            if self.table.n + len(new) > self.table.limit:
                self.table.clear()
                new = np.unique(one, return_index=True)[1]
                missing = np.arange(len(one))
            for k in new.tolist():
                if self.table.n == self.table.limit:  # a piece of more chunks than the table holds
                    break
                chunk = buf[start[k] : stop[k]].decode()
                ids = self._first(chunk) if first[k] else self._attached(chunk) if attached[k] else self._chunk(chunk)
                self.table.add(int(one[k]), int(two[k]), ids)
            found[missing] = self.table.find(one[missing], two[missing])
        size = np.where(found < 0, -1, self.table.size[found]).astype(np.int64)
        whole = np.zeros(len(held), bool)
        whole[doc[size < 0]] = True
        size = np.maximum(size, 0)
        total = int(size.sum())
        ids = self.table.ids[np.arange(total) + np.repeat(self.table.at[found] - (np.cumsum(size) - size), size)]
        after = np.cumsum(np.bincount(doc, size, len(held)).astype(np.int64))
        before = 0
        for (i, _), end, alone in zip(held, after.tolist(), whole.tolist()):
            out[i] = self._whole(texts[i]) if alone else ids[before:end].tobytes()
            before = end


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; Spark reuses its workers, and with them the cache."""
    return Encoder(path)
