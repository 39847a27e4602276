"""Words of whole texts as hash arrays, computed on the bytes of Arrow string columns.

Texts are taken in slices of about ``SLICE`` bytes, so memory does not follow the Arrow batch. A text
longer than a slice is hashed in pieces cut between words and its words are put together again; only
its 8-byte word hashes are held at once. Null is the empty text.

A word's hash is a polynomial over its bytes modulo 2^64 with a finalizer; it does not depend on where
the word stands. Equality of words, word groups and sets is equality of 64-bit hashes throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stratalake.llm import store

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xC2B2AE3D27D4EB4F


def _table(separator) -> tuple[np.ndarray, np.ndarray]:
    """Byte to byte + 1 in lower case, and whether the byte belongs to a word."""
    fold = np.arange(256, dtype=np.uint64)
    fold[65:91] += 32
    return fold + np.uint64(1), np.array([not separator(b) for b in range(256)])


#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lowering A-Z.
ALNUM = _table(lambda b: not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80))
#: ``[^\x20\x09-\x0D]+`` after lowering A-Z.
SPACED = _table(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = store.remembered({})


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """At least the first n powers of an odd base and of its inverse modulo 2^64."""
    if base not in _powers or len(_powers[base][0]) < n:
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            made.append(np.multiply.accumulate(x))
        _powers[base] = (made[0], made[1])
    return _powers[base]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (two multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of rows ``first`` to ``first + rows - 1``: row number within, and hash.

    ``pieces`` holds bytes, word starts, word ends and prefix sums of the slice, or of each piece of a long text.
    """

    first: int
    rows: int
    row: np.ndarray
    hash: np.ndarray
    pieces: list[tuple[np.ndarray, ...]]

    def bounds(self) -> np.ndarray:
        """Word number at which each row begins, and the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))

    def heads(self, length: int) -> np.ndarray:
        """Hash of the first ``length`` bytes of each word, 0 for words that are no longer."""
        out = []
        for _, start, end, prefix in self.pieces:
            long = end - start > length
            at = start[long]
            h = np.zeros(len(start), np.uint64)
            h[long] = mix(((prefix[at + length] - prefix[at]) * powers(len(prefix))[1][at]) ^ np.uint64(length * 0xD6E8FEB86659FD93 % (1 << 64)))
            out.append(h)
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column without nulls (null becomes the empty text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes, or of one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = to


def _hashed(data: np.ndarray, edges: np.ndarray, kind) -> tuple[np.ndarray, ...]:
    """Start, end, hash of the words in ``data`` and the prefix sums; no word crosses an edge."""
    fold, member = kind
    inside = member[data]
    before = np.empty(len(data) + 1, bool)
    before[1:] = inside
    before[0] = False
    begins = inside & ~before[:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends = np.empty(len(data), bool)
    ends[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    ends[-1:] = inside[-1:]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(fold[data] * up[: len(data)], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * down[start]
    return start, end, mix(h ^ ((end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))), prefix


def _long(data: np.ndarray, kind, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """`_hashed` of one long text, piece by piece; no piece ends within a word."""
    member, at = kind[1], 0
    while at < len(data):
        to = at + size
        while to < len(data):  # back to the last separator, or on to a longer piece
            gaps = np.flatnonzero(~member[data[at:to]])
            if len(gaps):
                to = at + int(gaps[-1]) + 1
                break
            to += size
        yield data[at:to], *_hashed(data[at:to], np.empty(0, np.int64), kind)
        at = to


def words(column, kind, size: int = SLICE) -> Iterator[Words]:
    """The words of every row of a string column, slice by slice."""
    data, offsets = raw(column)
    for a, b in slices(offsets, size):
        part = data[offsets[a] : offsets[b]]
        if not len(part):
            yield Words(a, b - a, np.empty(0, np.int64), np.empty(0, np.uint64), [])
        elif len(part) > size:
            pieces = list(_long(part, kind, size))
            h = np.concatenate([p[3] for p in pieces])
            yield Words(a, 1, np.zeros(len(h), np.int64), h, [(d, s, e, x) for d, s, e, _, x in pieces])
        else:
            edges = offsets[a : b + 1] - offsets[a]
            start, end, h, prefix = _hashed(part, edges, kind)
            row = np.searchsorted(edges, start, "right") - 1
            yield Words(a, b - a, row, h, [(part, start, end, prefix)])


def hash_words(texts: list[str], kind) -> list[np.ndarray]:
    """Word hashes of each text."""
    out: list[np.ndarray] = []
    for w in words(pa.array(texts, pa.string()), kind):
        cut = w.bounds()
        out += [w.hash[cut[i] : cut[i + 1]] for i in range(w.rows)]
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and n + 1 bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def listed(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and bounds of an Arrow list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    bounds = np.asarray(column.offsets)
    values = np.asarray(column.values)[bounds[0] : bounds[-1]] if len(column) else np.asarray(column.values)[:0]
    return values, bounds - (bounds[0] if len(bounds) else 0)


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every run, joined."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


def contains(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each x is in the sorted array."""
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.searchsorted(sorted_values, x)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == x
