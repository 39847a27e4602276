"""Sentence pieces of whole texts with their places in the original bytes, and texts from pieces.

A text is first normalised: at every place the longest key of the model's compiled character map that begins
there is replaced; a character that begins no key stays. For every normalised byte the place of what it
came from is recorded. Spaces become space marks, one more in front. The normalised text is cut before the
first spaces of runs, where no piece can cross; different segments are encoded once per worker by the
library, whose own normalisation is switched off. Piece ends within a segment are remembered with its ids, so
every piece of a text is projected to original bytes by two look-ups in the record. A piece that stands
for a byte of a character begins where the character does and, unless it is the last one, ends there too.

Decoding joins the surfaces of pieces, bytes to characters; bytes that are no UTF-8 are left to the library.

Nothing is shuffled. A task holds its Arrow batch, one slice of 2 MB with its pieces and a memo of bounded
size; for models with a character map also the record of one text. Long texts are encoded in pieces that end at
safe places.

Null texts are empty texts: no pieces, only the end id. Nulls elsewhere are carried through, repeated rows
stay, an empty table gives no rows. Columns of the input called like the results are replaced by them; others
are kept only when named in ``keep``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from stratalake.llm import text as tx
from stratalake.llm.store import bounded, remembered, tidy
from stratalake.llm.tokens import Memo, Unique, piece_cut, segments

MARK = "▁"
#: Segments, and their pieces, remembered by a worker.
MEMO, MEMO_PIECES = 500_000, 4_000_000
BATCH_BYTES = 1 << 18
WINDOW = 1 << 20


class CharacterMap:
    """Longest keys of a compiled character map: a trie in one array of units, and the replacements."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.units = np.frombuffer(compiled[4 : 4 + size], np.uint32).astype(np.int64)
        self.values = compiled[4 + size :]
        self.longest_key = 0
        if size:
            self._explore()

    def _step(self, node: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units below ``node`` by ``byte``, and whether they exist."""
        at = node ^ byte
        ok = at < len(self.units)
        unit = self.units[np.where(ok, at, 0)]
        return np.where(ok, at, 0), ok & ((unit & 0x800000FF) == byte)

    def _base(self, at: np.ndarray) -> np.ndarray:
        """Where the children of the units at ``at`` lie."""
        unit = self.units[at]
        return at ^ ((unit >> 10) << ((unit & 0x200) >> 6))

    def _explore(self) -> None:
        """Depth of the trie and bytes that begin a key; no key may hold a space beside other bytes."""
        nodes, bytes_ = self._base(np.zeros(1, np.int64)), np.arange(1, 256)
        while len(nodes):
            self.longest_key += 1
            at, ok = self._step(nodes[:, None], bytes_[None, :])
            if self.longest_key == 1:
                self.first = np.zeros(256, bool)
                self.first[bytes_[ok[0]]] = True
            elif ok[:, 0x20 - 1].any():
                raise ValueError("a key of the character map holds a space: texts can't be cut at spaces")
            nodes = self._base(at[ok])

    def longest(self, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Length (0: none) and value of the longest key at each place of ``begin``."""
        length, value = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        live, node = np.arange(len(begin)), np.full(len(begin), int(self._base(np.zeros(1, np.int64))[0]))
        for depth in range(self.longest_key):
            inside = begin[live] + depth < len(data)
            live, node = live[inside], node[inside]
            at, ok = self._step(node, data[begin[live] + depth].astype(np.int64))
            live, at = live[ok], at[ok]
            node = self._base(at)
            leaf = (self.units[at] >> 8) & 1 == 1
            length[live[leaf]] = depth + 1
            value[live[leaf]] = self.units[node[leaf]] & 0x7FFFFFFF
        return length, value

    def replacement(self, value: int) -> bytes:
        return self.values[value : self.values.index(b"\0", value)]


@dataclass
class Normaliser:
    """Normalised bytes of a text (spaces unescaped, the added one in front), and the source of each, and of the end."""

    map: CharacterMap
    dummy_prefix: bool
    single_spaces: bool

    @property
    def plain(self) -> bool:
        """Whether nothing changes but for one space in front."""
        return not self.map.longest_key and self.dummy_prefix and not self.single_spaces

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        data = np.frombuffer(raw, np.uint8)
        starts = (data & 0xC0) != 0x80
        source = np.maximum.accumulate(np.where(starts, np.arange(len(data)), 0)) if len(data) else np.empty(0, np.int64)
        out, end = data, len(data)
        if self.map.longest_key:
            out, source = self._mapped(data, source, np.flatnonzero(starts & self.map.first[data]))
        lead = 0
        if self.single_spaces:
            space = out == 0x20
            keep = ~space
            keep[1:] |= ~space[:-1]
            last = np.flatnonzero(~space)
            if len(last):
                first_kept, behind = int(np.flatnonzero(~space)[0]), int(last[-1]) + 1
                lead, end = int(source[first_kept]), int(source[behind]) if behind < len(out) else end
                keep[:first_kept] = False
                keep[behind:] = False
                out, source = out[keep], source[keep]
                while len(out) and (tail := 3 * (out[-3:].tobytes() == MARK.encode()) or int(out[-1] == 0x20)):  # a mark of the text's own
                    end, out, source = int(source[-tail]), out[:-tail], source[:-tail]
            else:
                out, source = out[:0], source[:0]
        made, source = out.tobytes(), np.append(source, end)
        if made and self.dummy_prefix:
            made, source = b" " + made, np.insert(source, 0, lead)
        return made, source

    def _mapped(self, data: np.ndarray, source: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.map.longest(data, begin[i : i + WINDOW]) for i in range(0, len(begin), WINDOW)]
        if not found:
            return data, source
        length, value = (np.concatenate(x) for x in zip(*found))
        hit = np.flatnonzero(length)
        free, taken = 0, []
        for i, at, n in zip(hit.tolist(), begin[hit].tolist(), length[hit].tolist()):
            if at >= free:  # places inside a replaced key begin nothing
                taken.append(i)
                free = at + n
        at, n = begin[taken], length[taken]
        new = [self.map.replacement(v) for v in value[taken].tolist()]
        sizes = np.ones(len(data), np.int64)
        sizes[tx.ranges(at, n)] = 0
        sizes[at] = [len(x) for x in new]
        into = np.cumsum(sizes) - sizes
        out = np.repeat(data, sizes)
        out[tx.ranges(into[at], sizes[at])] = np.frombuffer(b"".join(new), np.uint8)
        return out, np.repeat(source, sizes)


@dataclass
class Encoded:
    """Pieces of the rows from ``first`` on; row i has those from bounds[i] to bounds[i + 1]. ``ends`` is false while a long text goes on."""

    first: int
    bounds: np.ndarray
    ids: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    ends: bool


class Pieces:
    """A sentence-piece model with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as spec

        with open(path, "rb") as f:
            model = spec.ModelProto.FromString(f.read())
        normal, kind = model.normalizer_spec, spec.ModelProto.SentencePiece
        types = {p.type for p in model.pieces}
        if kind.BYTE not in types or kind.USER_DEFINED in types or not normal.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with byte pieces and space marks in front, without symbols of their own")
        if any(MARK in p.piece.lstrip(MARK) for p in model.pieces):
            raise ValueError("the model has pieces with the space mark inside: texts can't be cut at spaces")
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.normalise = Normaliser(CharacterMap(normal.precompiled_charsmap), normal.add_dummy_prefix, normal.remove_extra_whitespaces)
        normal.Clear()
        normal.name, normal.add_dummy_prefix, normal.remove_extra_whitespaces = "identity", False, False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.end_id = self.model.eos_id()
        byte = np.array([p.type == kind.BYTE for p in model.pieces])
        #: Bytes of each piece in a normalised text with space marks, and its surface in a decoded one.
        self.size = np.where(byte, 1, [len(p.piece.encode()) for p in model.pieces])
        silent = {self.model.unk_id(): model.trainer_spec.unk_surface.encode()} | {i: b"" for i, p in enumerate(model.pieces) if p.type == kind.CONTROL}
        self.surface = [silent.get(i, bytes([int(p.piece[1:-1], 16)]) if byte[i] else p.piece.replace(MARK, " ").encode()) for i, p in enumerate(model.pieces)]
        self.number = [b"%d" % i for i in range(len(model.pieces))]
        self._clear()

    def _clear(self) -> None:
        self.memo, self.at = Memo(), np.zeros(1, np.int64)
        self.ids, self.ends = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int64)

    def _add(self, unique: Unique, new: list[int]) -> np.ndarray:
        """Encodes segments not seen yet: their ids, and where each piece ends in the segment."""
        number, at = len(self.at) - 1, int(self.at[-1])
        done = 0
        while done < len(new):
            batch, size = [], 0
            for u in new[done:]:
                batch.append(unique.bytes(u))
                size += len(batch[-1])
                if size >= BATCH_BYTES:
                    break
            done += len(batch)
            found = self.model.encode([b.decode() for b in batch], num_threads=1)
            ids = np.array([i for f in found for i in f], np.int32)
            counts = np.array([len(f) for f in found])
            data = np.frombuffer(b"".join(batch), np.uint8)
            marked = np.cumsum(np.where(data == 0x20, 3, 1))  # ends of the bytes when spaces are space marks
            ends = np.searchsorted(marked, np.cumsum(self.size[ids])) + 1
            ends -= np.repeat(np.cumsum([0, *map(len, batch[:-1])]), counts)
            if at + len(ids) > len(self.ids):
                room = max(len(ids), len(self.ids))
                self.ids, self.ends = np.concatenate([self.ids, np.empty(room, np.int32)]), np.concatenate([self.ends, np.empty(room, np.int64)])
            self.ids[at : at + len(ids)], self.ends[at : at + len(ids)] = ids, ends
            self.at = np.concatenate([self.at, at + np.cumsum(counts)])
            at += len(ids)
        return number + np.arange(len(new))

    def encode(self, column: pa.Array) -> Iterator[Encoded]:
        """Pieces of every row that is not empty, in order."""
        column = pc.fill_null(column, "").cast(pa.large_string())
        if self.normalise.plain:
            spaced = pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column, pa.scalar("", pa.large_string())))
            yield from self._encode(spaced, lambda row, places, data=tx.raw(column): _plain_source(*data, row, places))
            return
        data, offsets = tx.raw(column)
        for a, b in tx.slices(offsets):
            made = [self.normalise(data[x:y].tobytes()) for x, y in zip(offsets[a:b], offsets[a + 1 : b + 1])]
            base = np.cumsum([0, *(len(s) for _, s in made)])
            whole = np.concatenate([s for _, s in made])
            texts = pa.array([m for m, _ in made], pa.large_binary()).cast(pa.large_string())
            for part in self._encode(texts, lambda row, places, w=whole, o=base: w[o[row] + places]):
                part.first += a
                yield part

    def _encode(self, texts: pa.Array, source) -> Iterator[Encoded]:
        begun, passed, held = -1, 0, None
        for first, rows, row, inverse, unique in segments(texts, piece_cut):
            if held is not None:
                held.ends = first != held.first or rows > 1
                yield held
            if len(self.memo) > MEMO or self.at[-1] > MEMO_PIECES:
                self._clear()
            number = self.memo.numbers(unique, lambda new, u=unique: self._add(u, new))[inverse]
            size = (unique.end - unique.start)[inverse]
            edge = np.cumsum(size) - size
            first_of_row = np.searchsorted(row, np.arange(rows))
            in_text = edge - np.append(edge, 0)[first_of_row][row] + (passed if rows == 1 and first == begun else 0)
            begun, passed = first, int(in_text[-1] + size[-1])
            count = self.at[number + 1] - self.at[number]
            take = tx.ranges(self.at[number], count)
            begin_of, end = np.repeat(in_text, count), self.ends[take]
            lead = np.cumsum(count) - count
            begin = np.empty(len(take), np.int64)
            begin[1:] = end[:-1]
            begin[lead] = 0
            piece_row = first + np.repeat(row, count)
            bounds = np.concatenate([[0], np.cumsum(np.bincount(row, count, rows).astype(np.int64))])
            held = Encoded(first, bounds, self.ids[take], source(piece_row, begin_of + begin), source(piece_row, begin_of + end), True)
        if held is not None:
            yield held

    def surfaces(self, ids: list[int], first: bool) -> bytes:
        """Joined surfaces of ids; at the beginning of a text without the space that was put in front."""
        parts = list(map(self.surface.__getitem__, ids))
        if first and (self.normalise.dummy_prefix or self.normalise.single_spaces):
            for i, part in enumerate(parts):
                parts[i] = part.removeprefix(b" ")
                if parts[i] or not self.normalise.single_spaces:
                    break
        return b"".join(parts)

    def decode(self, ids: list[int]) -> bytes:
        """The text of ids as the library decodes them, in UTF-8."""
        made = self.surfaces(ids, True)
        try:
            made.decode()
        except UnicodeDecodeError:
            return self.library.decode(ids).encode()
        return made


def _plain_source(data: np.ndarray, offsets: np.ndarray, row: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sources when only a space was put in front: one place less, within a character its beginning."""
    at = np.maximum(places - 1, 0)
    size = offsets[row + 1] - offsets[row]
    for _ in range(3):
        inside = np.flatnonzero(at < size)
        at[inside[(data[offsets[row[inside]] + at[inside]] & 0xC0) == 0x80]] -= 1
    return at


_models: dict[str, Pieces] = remembered({})


def _model(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def _select(docs: DataFrame, keep: tuple[str, ...], made: list[StructField], column: str) -> tuple[DataFrame, list[str], StructType]:
    kept = [c for c in keep if c not in {f.name for f in made}]
    bounded(docs.sparkSession)
    return docs.select(*kept, docs[column].alias("__in")), kept, StructType([*(docs.schema[c] for c in kept), *made])


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), end: bool = True) -> DataFrame:
    """``keep`` columns with ids, begins and ends: the original bytes from begins[i] to ends[i] gave piece i.

    The end id, if wanted, is empty and stands behind the text.
    """
    long = ArrayType(LongType(), False)
    made = [StructField("ids", ArrayType(IntegerType(), False)), StructField("begins", long), StructField("ends", long)]
    rows, kept, schema = _select(docs, keep, made, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            column = batch.column(len(kept))
            sizes = pc.fill_null(pc.cast(pc.binary_length(column), pa.int64()), 0).to_pylist()
            parts: list[list[tuple[np.ndarray, ...]]] = [[] for _ in sizes]
            for e in model.encode(column):
                for i, (a, b) in enumerate(zip(e.bounds[:-1], e.bounds[1:])):
                    parts[e.first + i].append((e.ids[a:b], e.begin[a:b], e.end[a:b]))
            if end:
                for row, size in zip(parts, sizes):
                    row.append((np.array([model.end_id], np.int32), np.array([size]), np.array([size])))
            bounds = np.cumsum([0, *(sum(len(p[0]) for p in row) for row in parts)])
            flat = [(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)), *(p for row in parts for p in row)]
            lists = [tx.lists(np.concatenate(x), bounds) for x in zip(*flat)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *lists], schema.names)

    return rows.mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with the text of the ids; null ids give the empty text."""
    rows, kept, schema = _select(encoded, keep, [StructField("text", StringType())], ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        for batch in batches:
            texts = pa.array([model.decode(row.as_py() or []).decode() for row in batch.column(len(kept))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], schema.names)

    return rows.mapInArrow(tidy(run), schema)


class _Digest:
    """Running digests of one text's ids, spans and decoded text."""

    def __init__(self) -> None:
        self.n, self.ids, self.spans, self.text = 0, hashlib.sha256(), hashlib.sha256(), hashlib.sha256()

    def add(self, model: Pieces, ids: np.ndarray, spans: np.ndarray) -> None:
        listed = ids.tolist()
        self.text.update(model.surfaces(listed, not self.n))
        self.ids.update((b" " if self.n else b"") + b" ".join(map(model.number.__getitem__, listed)))
        self.spans.update(spans.tobytes())
        self.n += len(listed)

    def done(self, end_id: int) -> tuple[int, str, str, str]:
        self.ids.update(b"%s%d" % (b" " if self.n else b"", end_id))
        return self.n + 1, self.ids.hexdigest(), self.text.hexdigest(), self.spans.hexdigest()


def digests(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_tokens (end id included), ids_sha256 of the decimal ids joined by spaces, decoded_sha256 of the decoded text, and spans_sha256 of the (begin, end) of all pieces as little-endian longs. No list of a whole text is held."""
    made = [StructField("n_tokens", LongType()), *(StructField(c, StringType()) for c in ("ids_sha256", "decoded_sha256", "spans_sha256"))]
    rows, kept, schema = _select(docs, keep, made, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(model_path)
        empty = _Digest().done(model.end_id)
        for batch in batches:
            results, running = [empty] * batch.num_rows, _Digest()
            for e in model.encode(batch.column(len(kept))):
                spans = np.stack([e.begin, e.end], 1)
                for i, (a, b) in enumerate(zip(e.bounds[:-1].tolist(), e.bounds[1:].tolist())):
                    if a < b:
                        running.add(model, e.ids[a:b], spans[a:b])
                    if e.ends:
                        if running.n:
                            results[e.first + i] = running.done(model.end_id)
                        running = _Digest()
            columns = [pa.array(c, t) for c, t in zip(zip(*results), (pa.int64(), pa.string(), pa.string(), pa.string()))] if results else [pa.array([], pa.int64()), *[pa.array([], pa.string())] * 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], schema.names)

    return rows.mapInArrow(tidy(run), schema)
