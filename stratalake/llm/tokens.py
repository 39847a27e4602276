"""Token ids and token counts of whole texts by public tokenizers.

A text is cut before spaces at which no token of the tokenizer can cross (`space_cut`, `piece_cut`) and,
if the pattern of the pre-tokens allows it, where letters, digits and signs meet (`kind_cut`). The segments
between such places are encoded once per worker and remembered, so a slice of text costs one encoding per
new segment. The memory of a worker is bounded: its memo holds `MEMO` segments and is emptied when full. A
long text is worked on in pieces that end at safe places.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import regex

from stratalake.llm import text as tx

MEMO = 1_000_000
SLICE = 1 << 19
#: Pre-tokens remembered with their ids (packed, four bytes each).
WORDS = 200_000
#: Pre-tokens given to the model in one call.
TOGETHER = 32
BATCH_BYTES = 1 << 18

#: Second-last and last bytes of UTF-8 white space, taken loosely: more places count as unsafe than are.
_LAST = np.zeros(256, bool)
_LAST[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True
_SECOND = np.zeros(256, bool)
_SECOND[[0xC2, 0x9A, 0x80, 0x81]] = True
_PLUS_ONE = np.arange(1, 257, dtype=np.uint64)
_NEXT = np.zeros(256, bool)
_NEXT[[*range(0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True

#: The pattern of byte-level tokenizers for whose pre-tokens `kind_cut` holds.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Kinds of bytes: letters, digits, signs, the apostrophe, others. Letters of two bytes beginning with 0xC3 are told by `kinds`.
LETTER, DIGIT, SIGN, APOSTROPHE, OTHER = 1, 2, 4, 8, 16
_KIND = np.full(256, OTHER, np.uint8)
_KIND[0x21:0x7F] = SIGN
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_KIND[0x30:0x3A] = DIGIT
_KIND[0x27] = APOSTROPHE


def kinds(data: np.ndarray) -> np.ndarray:
    """Kind of every byte; both bytes of U+00C0 to U+00FF are letters, but for the signs of multiplication and division."""
    out = _KIND[data]
    at = np.flatnonzero(data[:-1] == 0xC3)
    at = at[(data[at + 1] != 0x97) & (data[at + 1] != 0xB7)]
    out[at] = out[at + 1] = LETTER
    return out


def kind_cut(data: np.ndarray) -> np.ndarray:
    """Places between letters, digits and signs of one byte: a pre-token of `BYTE_LEVEL` always begins there.

    None is behind an apostrophe, which may take the letters that follow.
    """
    kind = kinds(data)
    last, here = kind[:-1], kind[1:]
    out = np.zeros(len(data), bool)
    out[1:] = (last != here) & (last <= SIGN) & (here <= APOSTROPHE) & (last + here != SIGN + APOSTROPHE)
    return out


def space_cut(data: np.ndarray) -> np.ndarray:
    """Places of single spaces between characters that are not white space.

    For tokenizers whose pre-tokens begin with at most one space: a pre-token always begins there.
    """
    out = data == 0x20
    out[:1] = False
    out[-1:] = False
    at = np.flatnonzero(out)
    last, ok = data[at - 1], ~_NEXT[data[at + 1]]
    second = data[np.maximum(at - 2, 0)]
    out[at[~(ok & (last > 0x20) & ~(_LAST[last] & _SECOND[second]))]] = False
    return out


def piece_cut(data: np.ndarray) -> np.ndarray:
    """First spaces of runs of spaces, for sentence pieces that hold the space mark only in front.

    The byte 0x81 may end the space mark itself, so no cut is made behind it.
    """
    out = data == 0x20
    out[:1] = False
    at = np.flatnonzero(out)
    last = data[at - 1]
    out[at[(last == 0x20) | (last == 0x81)]] = False
    return out


def segments(column, cut: Callable[[np.ndarray], np.ndarray], size: int = SLICE, inner: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Unique]]:
    """(first row, rows, row of each segment, its number among the unique ones, those) per slice.

    A text longer than a slice comes in several yields of one row each. ``inner`` may add places to those of ``cut``.
    """
    data, offsets = tx.raw(column)
    for a, b in tx.slices(offsets, size):
        whole = data[offsets[a] : offsets[b]]
        edges = offsets[a : b + 1] - offsets[a]
        at = 0
        while at < len(whole):
            part = whole[at:]
            if len(part) > size and b - a == 1:
                part = _piece(part, cut, size)
            begins = cut(part)
            if inner:
                begins = inner(part, begins)
            if b - a > 1:
                begins[edges[edges < len(part)]] = True
            begins[:1] = True
            start = np.flatnonzero(begins)
            row = np.searchsorted(edges, start, "right") - 1 if b - a > 1 else np.zeros(len(start), np.int64)
            yield a, b - a, row, *_unique(part, start)
            at += len(part)


def _piece(part: np.ndarray, cut: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The beginning of a long text up to a safe place."""
    while size < len(part):
        safe = np.flatnonzero(cut(part[:size]))
        if len(safe):
            return part[: safe[-1]]
        size *= 2
    return part


@dataclass
class Unique:
    """Different segments of a slice: two independent hashes and the bytes."""

    key: np.ndarray
    check: np.ndarray
    blob: bytes
    start: np.ndarray
    end: np.ndarray

    def bytes(self, i: int) -> bytes:
        return self.blob[self.start[i] : self.end[i]]


def _unique(part: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, Unique]:
    end = np.append(start[1:], len(part))
    keys = []
    for up, down in (tx.powers(len(part) + 1), tx.powers(len(part) + 1, tx.SECOND_BASE)):
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_PLUS_ONE[part] * up[: len(part)], out=prefix[1:])
        keys.append(tx.mix(((prefix[end] - prefix[start]) * down[start]) ^ (end - start).astype(np.uint64)))
    key, check = keys
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    if (check[first][inverse] != check).any():
        _, first, inverse = np.unique(np.stack(keys, 1), axis=0, return_index=True, return_inverse=True)
    return inverse, Unique(key[first], check[first], part.tobytes(), start[first], end[first])


class Memo:
    """Number of each segment seen so far, as sorted hash arrays; about 24 bytes a segment."""

    def __init__(self) -> None:
        self.key, self.check, self.number = np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.key)

    def numbers(self, unique: Unique, add: Callable[[list[int]], np.ndarray]) -> np.ndarray:
        """Numbers of the segments; ``add`` encodes those not seen yet and gives theirs."""
        out = np.full(len(unique.key), -1, np.int64)
        at = np.searchsorted(self.key, unique.key)
        if len(self.key):
            near = np.minimum(at, len(self.key) - 1)
            known = (self.key[near] == unique.key) & (self.check[near] == unique.check)
            out[known] = self.number[near[known]]
        new = np.flatnonzero(out < 0)
        if len(new):
            out[new] = add(new.tolist())
            order = new[np.argsort(unique.key[new], kind="stable")]
            for name, values in (("key", unique.key), ("check", unique.check), ("number", out)):
                setattr(self, name, np.insert(getattr(self, name), at[order], values[order]))
        return out


class PieceCounts:
    """Numbers of sentence pieces per text. A segment's first space is the one that the model adds itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        if any("\u2581" in p.lstrip("\u2581") for p in pieces):
            raise ValueError("the model has pieces with the space mark inside: texts can't be cut at spaces")
        self.memo = Memo()

    def count(self, column) -> np.ndarray:
        total = np.zeros(len(column), np.int64)
        begun = -1
        for first, rows, row, inverse, unique in segments(column, piece_cut):
            n = self._counts(unique)[inverse]
            lead = np.ones(len(row), bool)  # the first segment of a text keeps its own spaces
            lead[1:] = row[1:] != row[:-1]
            lead[:1] &= begun != first or rows > 1
            begun = first
            for i in np.flatnonzero(lead):
                if (whole := unique.bytes(inverse[i])).startswith(b" "):
                    n[i] = len(self.model.encode(whole.decode()))
            total[first : first + rows] += np.bincount(row, n, rows).astype(np.int64)
        return total

    def _counts(self, unique: Unique) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo = Memo()
        return self.memo.numbers(unique, lambda new: self._encode([unique.bytes(i) for i in new]))

    def _encode(self, new: list[bytes]) -> np.ndarray:
        counts: list[int] = []
        while len(counts) < len(new):
            batch, size = [], 0
            for u in new[len(counts) :]:
                batch.append((u[1:] if u[:1] == b" " else u).decode())
                size += len(u)
                if size >= BATCH_BYTES:
                    break
            counts += [len(ids) if t else 1 for t, ids in zip(batch, self.model.encode(batch, num_threads=1))]
        return np.array(counts, np.int64)


class ByteBpe:
    """Ids of a byte-level BPE tokenizer file, by its library; ``pattern`` gives its pre-tokens."""

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(b" " in t for t in added):
            raise ValueError("added tokens with spaces: texts can't be cut at spaces")
        self.added, self.special = added, regex.compile(b"|".join(map(regex.escape, added)) or b"(?!)")
        self.by_kind = pattern == BYTE_LEVEL
        self.words: dict[str, bytes] = {}
        self.tokenize, self.find = self.tokenizer.model.tokenize, regex.compile(pattern).findall
        self.letters = _byte_letters()
        self.gap = self._gap()
        self._clear()

    def _gap(self) -> int | None:
        """A byte that no text holds and no merge takes: pre-tokens around it are encoded as if each stood alone."""
        model, vocab = self.tokenizer.model, self.tokenizer.get_vocab(with_added_tokens=False)
        if any(getattr(model, x, True) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        inside = set().union(*(t for t in vocab if len(t) > 1))
        return next((b for b in (0xFF, 0xFE, 0xC0, 0xC1) if self.letters[b] in vocab and self.letters[b] not in inside), None)

    def _clear(self) -> None:
        self.memo = Memo()
        self.flat, self.at = np.empty(1 << 16, np.int32), np.zeros(1, np.int64)

    def encode(self, column) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, flat ids, bounds) of consecutive rows; every row comes once, empty ones without ids."""
        done, held, pending = 0, -1, []

        def flush() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            ids = np.concatenate(pending)
            yield held, ids, np.array([0, len(ids)])

        for first, rows, row, inverse, unique in segments(column, space_cut, inner=self._inner if self.by_kind else None):
            if held >= 0 and first != held:
                yield from flush()
                done, held, pending = held + 1, -1, []
            if len(self.memo) > MEMO:
                self._clear()
            number = self.memo.numbers(unique, lambda new, u=unique: self._add(u, new))[inverse]
            length = self.at[number + 1] - self.at[number]
            flat = self.flat[tx.ranges(self.at[number], length)]
            if first > done:
                yield done, flat[:0], np.zeros(first - done + 1, np.int64)
                done = first
            if rows == 1:
                held = first
                pending.append(flat)
            else:
                yield first, flat, np.concatenate([[0], np.cumsum(np.bincount(row, length, rows).astype(np.int64))])
                done = first + rows
        if held >= 0:
            yield from flush()
            done = held + 1
        if done < len(column):
            yield done, np.empty(0, np.int32), np.zeros(len(column) - done + 1, np.int64)

    def _add(self, unique: Unique, new: list[int]) -> np.ndarray:
        if len(self.words) > WORDS:
            self.words.clear()
        order, found, counts, special = self._found(unique, np.array(new))
        self._learn(found)
        ids = list(map(self.words.__getitem__, found))
        words_end = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        ends = words_end[np.cumsum(counts)]
        for segment in special:
            ids.append(array("i", self.tokenizer.encode(segment, add_special_tokens=False).ids).tobytes())
            ends = np.append(ends, (ends[-1] if len(ends) else 0) + len(ids[-1]) // 4)
        flat = np.frombuffer(b"".join(ids), np.int32)
        begin, number = int(self.at[-1]), len(self.at) - 1
        if begin + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(flat), len(self.flat)), np.int32)])
        self.flat[begin : begin + len(flat)] = flat
        self.at = np.concatenate([self.at, begin + ends])
        out = np.empty(len(new), np.int64)
        out[order] = number + np.arange(len(new))
        return out

    def _inner(self, data: np.ndarray, spaces: np.ndarray) -> np.ndarray:
        """``spaces`` and the places of `kind_cut`, but for those in segments with added tokens."""
        inner = kind_cut(data)
        if starts := self._starts(data.tobytes()):
            segment = np.cumsum(spaces)
            whole = np.zeros(segment[-1] + 1, bool)
            whole[segment[starts]] = True
            inner[whole[segment]] = False
        return spaces | inner

    def _starts(self, text: bytes) -> list[int]:
        """Where added tokens stand, overlapping ones too."""
        if not any(t in text for t in self.added):
            return []
        return [m.start() for m in self.special.finditer(text, overlapped=True)]

    def _found(self, unique: Unique, new: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray, list[str]]:
        """The order in which segments are taken, their pre-tokens, how many each has, and the last ones: texts with added tokens.

        A segment of one kind of characters, which a space may precede, is a pre-token; others are cut by the pattern.
        """
        start, length = unique.start[new], unique.end[new] - unique.start[new]
        data = np.frombuffer(unique.blob, np.uint8)[tx.ranges(start, length)]
        at = np.cumsum(length) - length
        special, one = np.zeros(len(new), bool), np.zeros(len(new), bool)
        for i in set((np.searchsorted(at, self._starts(data.tobytes()), "right") - 1).tolist()):
            special[i] = self.special.search(unique.bytes(new[i])) is not None
        found: list[str] = []
        if self.by_kind:
            kind = kinds(data)
            kind[at[(data[at] == 0x20) & (length > 1)]] = 0
            one = np.isin(np.bitwise_or.reduceat(kind, at), (LETTER, DIGIT, SIGN)) & ~special
            lines = np.full(int((length[one] + 1).sum()), 0x0A, np.uint8)
            lines[tx.ranges(np.cumsum(length[one] + 1) - length[one] - 1, length[one])] = data[tx.ranges(at[one], length[one])]
            found = lines.tobytes().decode().split("\n")[:-1]
        counts, others = [1] * len(found), np.flatnonzero(~one & ~special)
        for i in new[others]:
            words = self.find(unique.bytes(i).decode())
            found += words
            counts.append(len(words))
        order = np.concatenate([np.flatnonzero(one), others, np.flatnonzero(special)])
        return order, found, np.array(counts, np.int64), [unique.bytes(i).decode() for i in new[special]]

    def _learn(self, found: list[str]) -> None:
        """Ids of the pre-tokens that are not remembered yet, by the model, several in a call."""
        new = [w for w in dict.fromkeys(found) if w not in self.words]
        tokenize, letters = self.tokenize, self.letters
        if self.gap is None:
            for word in new:
                self.words[word] = array("i", [t.id for t in tokenize(word.encode().decode("latin-1").translate(letters))]).tobytes()
            return
        gap, ids = bytes([self.gap]), array("i")
        for i in range(0, len(new), TOGETHER):
            together = gap.join([*map(str.encode, new[i : i + TOGETHER]), b""])
            ids.extend([t.id for t in tokenize(together.decode("latin-1").translate(letters))])
        end = 4 * np.flatnonzero(np.frombuffer(ids, np.int32) == self.tokenizer.token_to_id(letters[self.gap]))
        packed = ids.tobytes()
        self.words.update(zip(new, [packed[a:b] for a, b in zip([0, *(end + 4).tolist()], end.tolist())], strict=True))


def _byte_letters() -> dict[int, str]:
    """The usual letters for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
