"""Token ids of whole texts by the tokenizers library.

With a byte-level tokenizer whose pre-tokenizer is the usual byte-level
pattern, a text may be cut where one match of that pattern surely ends and
the next begins, without changing its ids: around white space as the pattern
does, and between letters, digits and marks. Many texts are cut at once, on
their UTF-8 bytes. Each distinct piece of them is looked up once in a table of
the task process, and encoded by the library if it is not there; any other
tokenizer encodes whole texts. The tokenizer file is a parameter; it is read
where it lies, never copied.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
# Distinct pieces in a task process' table before it starts anew. The table before it is kept, and what is met again is
# taken from there: about 70 MB of Python objects together.
CACHE_PIECES = 300_000
# Pieces encoded by one call: longer calls cost more per piece.
JOINED = 128
# Bytes of text cut at once.
SEGMENT = 3 << 20
# Classes of bytes. OTHER: not known to be a letter, digit or mark; cut from white space alone.
SPACE, WHITE, LETTER, DIGIT, MARK, QUOTE, OTHER = range(7)
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[9:14], _CLASS[32], _CLASS[39], _CLASS[128:] = WHITE, SPACE, QUOTE, OTHER
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = DIGIT, LETTER, LETTER
# For two classes in a row: 1 where a match of the pattern ends between them, 2 inside white space. A single space
# belongs to what follows it, a quote to marks beside it and to letters after it.
_BETWEEN = np.zeros((8, 8), np.uint8)
_BETWEEN[LETTER:OTHER + 1, :LETTER] = _BETWEEN[WHITE, LETTER:OTHER + 1] = 1
for _pair in ((LETTER, DIGIT), (DIGIT, LETTER), (LETTER, MARK), (MARK, LETTER), (DIGIT, MARK), (MARK, DIGIT),
              (LETTER, QUOTE), (DIGIT, QUOTE), (QUOTE, DIGIT)):
    _BETWEEN[_pair] = 1
_BETWEEN[:LETTER, :LETTER] = 2
_BETWEEN = _BETWEEN.ravel()
# White space beyond ASCII as the byte-level pattern understands it (fixed values).
_WIDE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# Characters whose class differs between pattern engines: such texts are encoded whole.
_ODD = (0x180E, 0x200B, 0xFEFF)
# Bytes of a character by its first one.
_SIZE = np.ones(256, np.int8)
_SIZE[0xC0:], _SIZE[0xE0:], _SIZE[0xF0:] = 2, 3, 4
# Where long texts are cut: a single space between characters that are surely not white space.
_CUT = re.compile(rb"(?<=[!-~]) (?=[!-~])")
_LOADED: dict[str, "Encoder"] = {}


def _coded(chars) -> np.ndarray:
    """The UTF-8 bytes of each character, at most three, as one number."""
    return np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in chars], np.int32)


_WIDE_CODES, _ODD_CODES = _coded(_WIDE), _coded(_ODD)
_WIDE_FIRST = frozenset(chr(c).encode()[0] for c in _WIDE)


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str) -> "Encoder":
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def _codes(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """As ``_coded``, of the characters of two and more bytes that start at ``at``."""
    first = buf[at].astype(np.int32)
    second, third = (buf.take(at + k, mode="clip").astype(np.int32) for k in (1, 2))
    return first << 16 | second << 8 | np.where(first < 0xE0, 0, third)


def _starts(buf: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pieces start, and the end. ``edges``: starts of the texts in ``buf``, and its end."""
    kind = _CLASS[buf]
    at = np.flatnonzero(buf >= 0xC2)
    if len(at):
        code = _codes(buf, at)
        latin = at[(code >> 16 == 0xC3) & (code != 0xC39700) & (code != 0xC3B700)]      # from À to ÿ
        kind[latin] = kind[latin + 1] = LETTER
        white = at[np.isin(code, _WIDE_CODES)]
        for k in range(3):
            kind[white[_SIZE[buf[white]] > k] + k] = WHITE
    between = _BETWEEN[kind[:-1] * np.uint8(8) + kind[1:]]
    edge = np.zeros(len(buf) + 1, bool)
    edge[edges] = True
    cut = edge.copy()
    cut[1:-1] |= between == 1
    # The last character of longer white space before something else: the pattern leaves it out.
    last = np.flatnonzero(between == 2) + 1
    last = last[(buf[last] & 0xC0 != 0x80) & ~edge[last]]
    after = last + _SIZE[buf[last]]
    last, after = last[~edge[after]], after[~edge[after]]
    cut[last[kind[after] >= LETTER]] = True
    return np.flatnonzero(cut)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        size = self.tok.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        added = [t["content"].encode() for t in spec.get("added_tokens") or ()]
        # Added tokens are found in a text before anything else: texts that hold one are encoded whole.
        self._added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.by_pieces = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                          and not pre.get("add_prefix_space") and not spec.get("normalizer")
                          and all(t["special"] for t in spec.get("added_tokens") or ()))
        self._spaced = np.zeros(size, bool)
        for token, i in self.tok.get_vocab().items():
            self._spaced[i] = token.startswith("Ġ")
        line = self._ids("\n")
        self._line = line[0] if len(line) == 1 else None
        self._cache: dict[bytes, bytes] = {}
        self._before: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _joined(self, pieces: list[bytes], between: bytes) -> list[bytes]:
        """The ids of pieces that the pattern does not join: each starts with its one space, or has no white space and
        a line feed between it and the next."""
        out: list[bytes] = []
        width = self.dtype.itemsize
        for lo in range(0, len(pieces), JOINED):
            part = pieces[lo:lo + JOINED]
            ids = self._ids(between.join(part).decode())
            raw = ids.tobytes()
            if between:         # the line feed is an id of its own
                gaps = np.flatnonzero(ids == self._line)
                starts, stops = np.append(0, gaps + 1), np.append(gaps, len(ids))
            else:               # only the first id of a piece holds its space
                starts = np.flatnonzero(self._spaced[ids])
                stops = np.append(starts[1:], len(ids))
            if len(starts) == len(part):
                out += [raw[i:j] for i, j in zip((starts * width).tolist(), (stops * width).tolist())]
            else:
                out += [self._ids(w.decode()).tobytes() for w in part]
        return out

    def _learn(self, new: list[bytes]) -> None:
        spaced, lined, single = [], [], []
        for w in new:
            if w[0] == 32 and w[1:2] > b" " and w[1] not in _WIDE_FIRST:
                spaced.append(w)
            elif w[0] > 32 and w[0] not in _WIDE_FIRST:
                lined.append(w)
            else:       # white space, or what may be
                text = w.decode()
                if not text[0].isspace():
                    lined.append(w)
                elif text[0] == " " and text[1:] and not text[1].isspace():
                    spaced.append(w)
                else:
                    single.append(w)
        if self._line is None:
            single, lined = single + lined, []
        self._cache.update(zip(spaced, self._joined(spaced, b"")))
        self._cache.update(zip(lined, self._joined(lined, b"\n")))
        for w in single:
            self._cache[w] = self._ids(w.decode()).tobytes()

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pieces."""
        found = list(map(self._cache.get, pieces))
        new = [w for w, ids in zip(pieces, found) if ids is None]
        if not new:
            return found
        if len(self._cache) + len(new) > CACHE_PIECES:
            self._before, self._cache, new = self._cache, {}, pieces
        old = list(map(self._before.get, new))
        self._cache.update((w, ids) for w, ids in zip(new, old) if ids is not None)
        self._learn([w for w, ids in zip(new, old) if ids is None])
        return [self._cache[w] if ids is None else ids for w, ids in zip(pieces, found)]

    def _group(self, buf: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in ``buf`` one after another, and how many of them lie before each edge."""
        if not len(buf):
            return np.zeros(0, self.dtype), np.zeros(len(edges), np.int64)
        starts = _starts(buf, edges)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [
            None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(buf)]).dictionary_encode()
        which = pieces.indices.to_numpy()
        found = self._look_up(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        held = np.fromiter(map(len, found), np.int32, len(found)) // np.int32(self.dtype.itemsize)
        n = held[which]
        end = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(((np.cumsum(held) - held)[which] - end[:-1]).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        return np.frombuffer(b"".join(found), self.dtype)[at], end[np.searchsorted(starts, edges)]

    def _odd(self, data: np.ndarray) -> list[int]:
        """Positions by which texts are known that must be encoded whole."""
        out: list[int] = []
        for lo in range(0, len(data), SEGMENT):
            part = data[lo:lo + SEGMENT + 2]
            at = np.flatnonzero((part == 0xE1) | (part == 0xE2) | (part == 0xEF))
            out += (lo + at[np.isin(_codes(part, at), _ODD_CODES)]).tolist()
            out += (lo + np.flatnonzero((part >= 0x1C) & (part <= 0x1F))).tolist()
        if self._added:
            for m in self._added.finditer(data):
                out += (m.start(), m.end() - 1)
        return out

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of each text, cut into pieces; text k lies between offsets k and k + 1."""
        cuts, rows = [], []
        for k in np.flatnonzero(np.diff(offsets) > SEGMENT).tolist():
            at, text = 0, memoryview(data[offsets[k]:offsets[k + 1]])
            while len(text) - at > SEGMENT and (m := _CUT.search(text, at + SEGMENT)):
                at = m.start()
                cuts.append(offsets[k] + at)
                rows.append(k)
        edges = np.insert(offsets, np.array(rows, np.int64) + 1, cuts)
        own = np.arange(len(offsets)) + np.searchsorted(rows, np.arange(len(offsets)))
        ids, ends, lo, done = [], [np.zeros(1, np.int64)], 0, 0
        while lo < len(edges) - 1:
            hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + SEGMENT, "right")) - 1)
            got, before = self._group(data[edges[lo]:edges[hi]], edges[lo:hi + 1] - edges[lo])
            ids.append(got)
            ends.append(before[1:] + done)
            done += len(got)
            lo = hi
        flat, end = np.concatenate([np.zeros(0, self.dtype), *ids]), np.concatenate(ends)[own].tolist()
        return [flat[a:b] for a, b in zip(end, end[1:])]

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each whole text; null is empty."""
        if not self.by_pieces:
            return [self._ids(t or "") for t in texts.to_pylist()]
        texts = texts.cast(pa.large_string()).fill_null("")
        data, offsets = _buffers(texts)
        whole = np.unique(np.searchsorted(offsets, self._odd(data), "right") - 1).astype(np.int64)
        if not len(whole):
            return self._pieces(data, offsets)
        plain = np.ones(len(texts), bool)
        plain[whole] = False
        rest = iter(self._pieces(*_buffers(texts.filter(pa.array(plain)))))
        return [next(rest) if p else self._ids(texts[i].as_py()) for i, p in enumerate(plain.tolist())]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; null is empty."""
        return self.encode_all(pa.array([text], pa.large_string()))[0]

    def batches(self, batches: Iterator[pa.RecordBatch], column: int
                ) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        """Each batch with the ids of its texts; batches are encoded together up to about SEGMENT bytes."""
        held, size = [], 0

        def flush():
            ids = iter(self.encode_all(pa.concat_arrays([b.column(column).cast(pa.large_string()) for b in held])))
            for b in held:
                yield b, [next(ids) for _ in range(b.num_rows)]

        for b in batches:
            more = b.column(column).nbytes
            if held and size + more > SEGMENT:
                yield from flush()
                held, size = [], 0
            held.append(b)
            size += more
        if held:
            yield from flush()


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of texts without nulls, and where each of them starts, and the end."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]
