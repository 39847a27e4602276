"""Language of whole texts by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, seeded by its code point. The vector of an n-gram binds
its letters: the elementwise product of their vectors, each rotated by its place. The vector of a text
bundles (sums) those of its n-grams, words being padded by one space; the prototype of a language bundles the
texts learned for it. A text gets the language whose prototype has the largest cosine with its vector.

Training sums one vector per language and task, then by language and dimension, so no language is a hot group;
one vector per language reaches the driver. Prediction is one pass without a shuffle.

Null texts and texts without a letter get ``und`` and score 0, as does every text when nothing was
learned. Rows with a null language are not learned from. Equal cosines go to the smaller language name.
Repeated rows stay; an empty table gives no rows. Columns not named in ``keep`` do not matter, whatever
they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import store, text as tx

DIMENSIONS = 512
GRAM = 3
#: n-grams whose vectors a worker remembers, a byte per dimension; the table is begun anew when full.
REMEMBERED = 20_000
#: Vectors that are bound or summed up at once.
BLOCK = 4096
UNDETERMINED = "und"
_SPACE = 0x20
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.frombuffer("".join("1" if chr(c).isalpha() else "0" for c in range(0x110000)).encode(), np.uint8) == 49
    return _letters


def grams(texts: list[str | None], n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of all n-grams over the letters of lower-cased texts; other characters become one space."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer("".join(f" {t} " for t in lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in lowered])
    points = np.where(_is_letter()[points], points, _SPACE)
    keep = np.ones(len(points), bool)
    keep[1:] = ~((points[1:] == _SPACE) & (points[:-1] == _SPACE) & (row[1:] == row[:-1]))
    points, row = points[keep], row[keep]
    if len(points) < n:
        return row[:0], points[:0]
    code = np.zeros(len(points) - n + 1, np.int64)
    for i in range(n):
        code = (code << 21) | points[i : len(points) - n + 1 + i]
    same = row[: len(code)] == row[n - 1 :]  # n-grams within one text
    return row[: len(code)][same], code[same]


class Vectors:
    """Vectors of n-grams by code, of +1 and -1 in single bytes."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = GRAM):
        self.dimensions, self.n = dimensions, n
        self.table = np.empty((REMEMBERED, dimensions), np.int8)
        self.letters: dict[int, np.ndarray] = {}
        self._clear()

    def _clear(self) -> None:
        self.codes, self.at = np.empty(0, np.int64), np.empty(0, np.int64)

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            if len(self.letters) >= REMEMBERED:
                self.letters.clear()
            self.letters[point] = (np.random.default_rng(point).integers(0, 2, self.dimensions) * 2 - 1).astype(np.int8)
        return self.letters[point]

    def _bind(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), self.dimensions), np.int8)
        for place in range(self.n):
            points, which = np.unique((codes >> (21 * place)) & 0x1FFFFF, return_inverse=True)
            out *= np.stack([np.roll(self._letter(p), place) for p in points.tolist()])[which]
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Row of ``table`` for each of at most `REMEMBERED` sorted different codes."""
        new = codes[~tx.contains(self.codes, codes)]
        if len(self.codes) + len(new) > REMEMBERED:
            self._clear()
            new = codes
        base = len(self.codes)
        for i in range(0, len(new), BLOCK):
            part = new[i : i + BLOCK]
            self.table[base + i : base + i + len(part)] = self._bind(part)
        if len(new):
            where = np.searchsorted(self.codes, new)
            self.codes = np.insert(self.codes, where, new)
            self.at = np.insert(self.at, where, base + np.arange(len(new)))
        return self.at[np.searchsorted(self.codes, codes)]

    def _sum(self, codes: np.ndarray, counts: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Sum of vectors times counts, `BLOCK` vectors at a time; exact below 2^24."""
        out = np.zeros(self.dimensions, np.float32)
        for i in range(0, len(codes), BLOCK):
            rows = self.rows(codes[i : i + BLOCK]) if at is None else at[i : i + BLOCK]
            out += counts[i : i + BLOCK].astype(np.float32) @ self.table[rows].astype(np.float32)
        return out

    def bundle(self, row: np.ndarray, code: np.ndarray, rows: int) -> np.ndarray:
        """Sum of the n-gram vectors of each row."""
        out = np.zeros((rows, self.dimensions), np.float32)
        cut = np.searchsorted(row, np.arange(rows + 1))
        codes, inverse = np.unique(code, return_inverse=True)
        at = self.rows(codes) if len(codes) <= REMEMBERED else None
        for i in range(rows):
            if cut[i] < cut[i + 1]:
                count = np.bincount(inverse[cut[i] : cut[i + 1]], minlength=1)
                used = np.flatnonzero(count)
                out[i] = self._sum(codes[used], count[used], None if at is None else at[used])
        return out


_vectors: dict[tuple[int, int], Vectors] = store.remembered({})


def _shared(dimensions: int, n: int) -> Vectors:
    return _vectors.setdefault((dimensions, n), Vectors(dimensions, n))


def _parts(column, size: int = 1 << 18) -> Iterator[tuple[int, int, list[str | None]]]:
    for a, b in tx.slices(tx.raw(column)[1], size):
        yield a, b, column.slice(a, b - a).to_pylist()


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, n: int = GRAM) -> dict[str, np.ndarray]:
    """Prototype of every value of ``lang`` over all rows of ``docs`` (text, lang) with both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, total = _shared(dimensions, n), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for a, _, texts in _parts(batch.column(0)):
                row, code = grams(texts, n)
                names = sorted({lang for lang in langs[a : a + len(texts)]})
                number = np.array([names.index(x) for x in langs[a : a + len(texts)]])
                of = number[row]
                order = np.argsort(of, kind="stable")
                for name, v in zip(names, vectors.bundle(of[order], code[order], len(names))):
                    total[name] = total.get(name, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "vector": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))})

    chosen = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    parts = chosen.mapInArrow(store.tidy(run), "lang string, vector array<double>")
    summed = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("value"))  # whole numbers: any order gives the same
    prototypes: dict[str, np.ndarray] = {}
    for r in summed.collect():
        prototypes.setdefault(r["lang"], np.zeros(dimensions))[r["pos"]] = r["value"]
    return prototypes


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",), dimensions: int = DIMENSIONS, n: int = GRAM, text: str = "text") -> DataFrame:
    """``keep`` columns with lang_pred and score, the cosine cut to 0 to 1."""
    names = sorted(prototypes)
    unit = np.stack([prototypes[k] / max(np.linalg.norm(prototypes[k]), 1e-12) for k in names]) if names else np.zeros((0, dimensions))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = _shared(dimensions, n)
        for batch in batches:
            found, score = np.full(batch.num_rows, len(names)), np.zeros(batch.num_rows)
            column = batch.column(len(keep))
            for a, b, texts in _parts(column):
                row, code = grams(texts, n)
                v = vectors.bundle(row, code, b - a).astype(np.float64)
                length = np.linalg.norm(v, axis=1)
                lettered = np.zeros(b - a, bool)
                lettered[row[(code & 0x1FFFFF) != _SPACE]] = True
                lettered[row[((code >> 21) & 0x1FFFFF) != _SPACE]] = True
                if names:
                    cosine = (v @ unit.T) / np.maximum(length, 1e-12)[:, None]
                    best = np.argmax(np.round(cosine, 9), axis=1)
                    found[a:b] = np.where(lettered, best, len(names))
                    score[a:b] = np.where(lettered, np.clip(cosine[np.arange(b - a), best], 0, 1), 0)
            label = pa.array([*names, UNDETERMINED]).take(pa.array(found))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], label, pa.array(score)], [*keep, "lang_pred", "score"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(store.tidy(run), schema)


def language(docs: DataFrame, training: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Learn from the rows where ``training`` holds, predict every row."""
    return identify(docs, learn(docs.where(training)), keep)
