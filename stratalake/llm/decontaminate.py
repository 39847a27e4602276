"""Benchmark passages in a corpus by a positional inverted index.

1. Every window of a test item (``WINDOW`` consecutive words, or all words of a shorter item) is to be
   found in the documents. One pass counts how often each test word occurs in the corpus.
2. Every window keeps its rarest words with their offsets. A second pass stores the postings of those
   words: word, document, positions.
3. The posting lists are intersected from the rarest word on: each list is shifted by the word's offset
   in the window, so a window can begin only where all shifted lists agree. What is left is a place of
   the item in the document: a diagonal (document position minus item position).
4. `phrase_matches` checks all words along each diagonal on the documents that have one, and returns the
   runs of equal words that hold a whole window. `proximity_matches` returns documents where the rarest
   words of an item window stand near each other in any order.
5. A window that several items hold is looked for once, in the name of one of them. Windows held by the
   same items form one set; a document that holds a window of a set is given all items of the set.

Words are compared by 64-bit hashes. Test words travel to the tasks by broadcast as long as they were
counted to be at most ``BROADCAST_WORDS``; beyond that they are joined. No list of a word meets in one
task: postings are rows per word and document.

A null text has no words: nothing is hit, and a null item is never found. Items that are empty are never
found; items with equal texts are found together, repeated rows of documents each get their result.
Documents are told apart by id and text, so null or repeated ids do no harm. Empty tables give no rows,
or documents without hits. Other columns do not matter, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratalake.llm import store
from stratalake.llm import text as tx

WINDOW = 10
#: Rarest words of a window whose posting lists are intersected.
LISTS = 3
#: Different test words that are broadcast, 8 bytes each.
BROADCAST_WORDS = 4_000_000
#: Rows of two longs that are broadcast.
BROADCAST_ROWS = 1_000_000


def item_words(items: DataFrame) -> DataFrame:
    """(uid, item_id, words): word hashes of every item with a word; equal word sequences share a uid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in tx.words(batch.column(1), tx.ALNUM):
                ids = batch.column(0).slice(w.first, w.rows)
                yield pa.RecordBatch.from_arrays([ids, tx.lists(tx.signed(w.hash), w.bounds())], ["item_id", "words"])

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).mapInArrow(store.tidy(run), "item_id long, words array<long>")
    return rows.where(F.size("words") > 0).withColumn("uid", F.xxhash64("words"))


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """(uid, at, terms): every place of a window in a text."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return texts.select("uid", "words", F.explode(starts).alias("at")).select("uid", "at", F.slice("words", F.col("at") + 1, window).alias("terms"))


def windows_of(texts: DataFrame, window: int) -> DataFrame:
    """(uid, at, term, offset) of the windows of every different text; equal windows are kept once."""
    once = _cut(texts, window).groupBy("terms").agg(F.min(F.struct("uid", "at")).alias("first"))
    return once.select("first.uid", "first.at", F.posexplode("terms").alias("offset", "term"))


def shared_windows(texts: DataFrame, window: int) -> DataFrame:
    """(window, uid, at, held_by): windows of several texts under the name `windows_of` keeps, and their set of texts."""
    held = _cut(texts, window).groupBy(F.xxhash64("terms").alias("window"), "uid").agg(F.min("at").alias("at"))
    found = held.groupBy("window").agg(
        F.min(F.struct("uid", "at")).alias("first"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("uid")).alias("x"), F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y")
    )
    return found.where("n > 1").select("window", "first.uid", "first.at", F.xxhash64("n", "x", "y", "first.uid").alias("held_by"))


def holders(texts: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """(held_by, holder): the texts of every set of `shared_windows`."""
    one = shared.groupBy("held_by").agg(F.min("window").alias("window"))
    places = _cut(texts, window).select(F.xxhash64("terms").alias("window"), F.col("uid").alias("holder")).distinct()
    return places.join(store.broadcast_below(one, BROADCAST_ROWS), "window").select("held_by", "holder")


def count_terms(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(term, occurrences) of the given sorted hashes in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            for w in tx.words(batch.column(0), tx.ALNUM):
                at = np.minimum(np.searchsorted(terms, w.hash), len(terms) - 1)
                total += np.bincount(np.where(terms[at] == w.hash, at, len(terms)), minlength=len(terms) + 1)
        some = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(tx.signed(terms[some])), pa.array(total[some])], ["term", "n"])

    if not len(terms):
        return docs.sparkSession.createDataFrame([], "term long, occurrences long")
    return docs.select("text").mapInArrow(store.tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("occurrences"))


def build_index(docs: DataFrame, terms: np.ndarray | None) -> DataFrame:
    """(doc_id, text_key, n_words, terms, positions): per document its postings of the sorted terms (None: of all).

    ``positions`` holds one list per term. A document without postings keeps its row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in tx.words(batch.column(2), tx.ALNUM):
                bounds = w.bounds()
                hit = np.arange(len(w.hash)) if terms is None else np.flatnonzero(tx.contains(terms, w.hash))
                row, h = w.row[hit], w.hash[hit]
                order = np.lexsort((hit, h, row))
                hit, row, h = hit[order], row[order], h[order]
                new = np.ones(len(hit), bool)
                new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                head = np.flatnonzero(new)
                position = pa.array((hit - bounds[row]).astype(np.int32))
                inner = pa.ListArray.from_arrays(pa.array(np.append(head, len(hit)).astype(np.int32)), position)
                cut = np.searchsorted(row[head], np.arange(w.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(w.first, w.rows), batch.column(1).slice(w.first, w.rows), pa.array(np.diff(bounds)),
                        tx.lists(tx.signed(h[head]), cut), pa.ListArray.from_arrays(pa.array(cut), inner),
                    ],
                    ["doc_id", "text_key", "n_words", "terms", "positions"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), store.text_key().alias("text_key"), F.col("text"))
    return chosen.mapInArrow(store.tidy(run), "doc_id long, text_key long, n_words long, terms array<long>, positions array<array<int>>")


class Index:
    """Postings of the rarest words of every window over a corpus, and what is asked of them."""

    def __init__(self, docs: DataFrame, items: DataFrame, window: int = WINDOW, lists: int = LISTS):
        self.docs, self.window, self.lists = docs, window, lists
        self.items = store.keep(item_words(items), "items")
        self.texts = self.items.groupBy("uid").agg(F.first("words").alias("words"))
        spelled = store.keep(windows_of(self.texts, window), "windows")
        self.shared = store.keep(shared_windows(self.texts, window), "shared-windows")
        self.holders = store.keep(holders(self.texts, self.shared, window), "holders")
        words = spelled.select("term").distinct()
        known = self._small(words, BROADCAST_WORDS)
        if known is None:
            self.stored = store.keep(build_index(docs, None), "index")
            counted = self.stored.select(F.explode(F.arrays_zip("terms", "positions")).alias("p")).groupBy(F.col("p.terms").alias("term")).agg(F.sum(F.size("p.positions")).alias("occurrences"))
            counted = counted.join(words, "term", "left_semi")
        else:
            counted = count_terms(docs, known)
        self.occurrences = store.keep(counted, "terms")
        rare = Window.partitionBy("uid", "at").orderBy("occurrences", "offset")
        ranked = (
            spelled.join(self.occurrences, "term", "left").withColumn("missing", F.max(F.col("occurrences").isNull()).over(Window.partitionBy("uid", "at")))
            .where(~F.col("missing")).withColumn("rank", F.row_number().over(rare)).where(F.col("rank") <= lists)
        )
        self.anchors = store.keep(ranked.select("uid", "at", "rank", "term", "offset"), "anchors")
        if known is not None:
            chosen = self._small(self.anchors.select("term").distinct(), BROADCAST_WORDS)
            self.stored = store.keep(build_index(docs, chosen), "index")
        posting = F.explode(F.arrays_zip("terms", "positions")).alias("p")
        self.postings = self.stored.where(F.size("terms") > 0).select("doc_id", "text_key", posting).select("doc_id", "text_key", F.col("p.terms").alias("term"), F.col("p.positions").alias("positions"))

    @staticmethod
    def _small(words: DataFrame, rows: int) -> np.ndarray | None:
        """Sorted hashes if there are at most ``rows``."""
        if words.limit(rows + 1).count() > rows:
            return None
        return np.sort(np.array([r["term"] for r in words.toLocalIterator()], np.int64).view(np.uint64))

    def _shifted(self, rank: int) -> DataFrame:
        """(doc_id, text_key, uid, at, begin): where the list of that rank lets a window begin."""
        anchors = self.anchors.where(F.col("rank") == rank).drop("rank")
        met = self.postings.join(store.broadcast_below(anchors, BROADCAST_ROWS), "term")
        return met.select("doc_id", "text_key", "uid", "at", F.explode("positions").alias("position"), "offset").select("doc_id", "text_key", "uid", "at", (F.col("position") - F.col("offset")).alias("begin")).where("begin >= 0")

    def candidates(self) -> DataFrame:
        """(doc_id, text_key, uid, diagonal): the intersection of the shifted lists, rarest first."""
        met = self._shifted(1)
        for rank in range(2, self.lists + 1):
            other = self._shifted(rank).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("uid").alias("u"), F.col("at").alias("a"), F.col("begin").alias("b"))
            # the shorter list goes on when a window has fewer words than lists
            last = self.anchors.groupBy("uid", "at").agg(F.max("rank").alias("last"))
            same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")) & (F.col("uid") == F.col("u")) & (F.col("at") == F.col("a")) & (F.col("begin") == F.col("b"))
            short = met.join(store.broadcast_below(last.where(F.col("last") < rank).select("uid", "at"), BROADCAST_ROWS), ["uid", "at"], "left_semi")
            met = met.join(other, same, "left_semi").unionByName(short.select(*met.columns))
        return met.select("doc_id", "text_key", "uid", (F.col("begin") - F.col("at")).alias("diagonal")).distinct()

    def phrase_matches(self) -> DataFrame:
        """(doc_id, text_key, n_hit, uid): documents that hold a window, words hit, and each text found.

        The places along which the lists agree go with the document; its words are compared with those
        of the item. One document has no more places than word positions times items.
        """
        matched = store.keep(self._matched(), "matched")
        runs = matched.select("doc_id", "text_key", "n_hit", F.explode("runs").alias("r")).select("doc_id", "text_key", "n_hit", "r.*")
        windows = runs.select("doc_id", "text_key", "n_hit", "uid", F.explode(F.sequence("low", "high")).alias("at"))
        sets = windows.join(self._narrow(self.shared.select("uid", "at", "held_by")), ["uid", "at"]).select("doc_id", "text_key", "n_hit", "held_by").distinct()
        others = sets.join(self._narrow(self.holders), "held_by").select("doc_id", "text_key", "n_hit", F.col("holder").alias("uid"))
        return runs.select("doc_id", "text_key", "n_hit", "uid").unionByName(others).distinct()

    @staticmethod
    def _narrow(table: DataFrame) -> DataFrame:
        return store.broadcast_below(table, BROADCAST_ROWS)

    def _matched(self) -> DataFrame:
        """(doc_id, text_key, n_hit, runs): words hit, and the ranges of windows (uid, low, high) of a text that were found."""
        texts = self.texts
        places = store.keep(self.candidates(), "places")
        per_doc = places.join(texts, "uid").groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("uid", "diagonal", "words")).alias("places"))
        keys = F.struct(F.col("doc_id").cast("long").alias("doc_id"), store.text_key().alias("text_key"))
        docs = self.docs.select(keys.alias("k"), "text").select("k.doc_id", "k.text_key", "text")
        found = places.select("doc_id", "text_key").distinct()
        held = docs.join(store.broadcast_below(found.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t")), BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left_semi")
        held = held.groupBy("doc_id", "text_key").agg(F.first("text").alias("text"))
        named = per_doc.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "places")
        joined = held.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))).select("doc_id", "text_key", "text", "places")
        window = self.window
        spans = pa.list_(pa.struct([("uid", pa.int64()), ("low", pa.int32()), ("high", pa.int32())]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = batch.column(3)
                flat, cut = places.flatten(), np.asarray(places.offsets) - (places.offsets[0].as_py() if len(places) else 0)
                uid, diagonal = np.asarray(flat.field(0)), np.asarray(flat.field(1))
                terms, term_cut = tx.listed(flat.field(2))
                ids, n_hit, runs = [], [], []
                for w in tx.words(batch.column(2), tx.ALNUM):
                    bounds = w.bounds()
                    signed = tx.signed(w.hash)
                    for row in range(w.rows):
                        mine = signed[bounds[row] : bounds[row + 1]]
                        covered, found = np.zeros(len(mine) + 1, np.int64), set()
                        for p in range(cut[w.first + row], cut[w.first + row + 1]):
                            item = terms[term_cut[p] : term_cut[p + 1]]
                            for begin, end in _runs(mine, item, int(diagonal[p]), window):
                                covered[begin] += 1
                                covered[end] -= 1
                                found.add((int(uid[p]), begin - int(diagonal[p]), end - int(diagonal[p]) - min(window, len(item))))
                        ids.append(w.first + row)
                        n_hit.append(int((np.cumsum(covered) > 0).sum()))
                        runs.append([{"uid": u, "low": a, "high": b} for u, a, b in sorted(found)])
                at = pa.array(ids, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(n_hit, pa.int64()), pa.array(runs, spans)], ["doc_id", "text_key", "n_hit", "runs"])

        return joined.mapInArrow(store.tidy(run), "doc_id long, text_key long, n_hit long, runs array<struct<uid:long,low:int,high:int>>").where("n_hit > 0")

    def proximity_matches(self, slack: int = 5) -> DataFrame:
        """(doc_id, text_key, uid, at): windows whose rarest words all stand within ``window + slack`` words, in any order.

        A window that several texts hold is returned for each of its places.
        """
        reach = self.window + slack
        near = None
        for rank in range(1, self.lists + 1):
            anchors = self.anchors.where(F.col("rank") == rank).select("uid", "at", "term")
            met = self.postings.join(store.broadcast_below(anchors, BROADCAST_ROWS), "term").select("doc_id", "text_key", "uid", "at", "positions")
            if near is None:
                near = met.select("doc_id", "text_key", "uid", "at", F.explode("positions").alias("low")).withColumn("high", F.col("low"))
                continue
            other = met.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("uid").alias("u"), F.col("at").alias("a"), "positions")
            same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")) & (F.col("uid") == F.col("u")) & (F.col("at") == F.col("a"))
            within = F.expr(f"filter(positions, p -> greatest(high, p) - least(low, p) < {reach})")
            near = near.join(other, same).select("doc_id", "text_key", "uid", "at", "low", "high", F.explode(within).alias("p"))
            near = near.select("doc_id", "text_key", "uid", "at", F.least("low", "p").alias("low"), F.greatest("high", "p").alias("high")).distinct()
        near = near.select("doc_id", "text_key", "uid", "at").distinct()
        places = _cut(self.texts, self.window).select("uid", "at", F.xxhash64("terms").alias("window"))
        first = places.groupBy("window").agg(F.min(F.struct("uid", "at")).alias("first")).select("window", F.col("first.uid").alias("u"), F.col("first.at").alias("a"))
        every = places.join(first, "window").select("u", "a", F.col("uid").alias("holder"), F.col("at").alias("place"))
        met = near.join(every, (F.col("uid") == F.col("u")) & (F.col("at") == F.col("a")))
        return met.select("doc_id", "text_key", F.col("holder").alias("uid"), F.col("place").alias("at"))


def _runs(words: np.ndarray, item: np.ndarray, diagonal: int, window: int) -> list[tuple[int, int]]:
    """Maximal runs of equal words along a diagonal that hold a window, as word ranges of the document."""
    lo, hi = max(0, -diagonal), min(len(item), len(words) - diagonal)
    if hi <= lo:
        return []
    same = np.concatenate([[False], words[lo + diagonal : hi + diagonal] == item[lo:hi], [False]])
    edge = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
    need = min(window, len(item))
    return [(int(a) + lo + diagonal, int(b) + lo + diagonal) for a, b in edge if b - a >= need]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items (sorted as strings), contaminated, text_key."""
    index = Index(docs, items, window)
    found = store.keep(index.phrase_matches(), "phrases")
    ids = index.items.where("item_id IS NOT NULL").select("uid", F.col("item_id").cast("string").alias("item")).distinct()
    exploded = found.join(ids, "uid", "left")
    hits = exploded.groupBy("doc_id", "text_key").agg(F.first("n_hit").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items"))
    hits = hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "n_hit", "items")
    every = index.stored.select("doc_id", "text_key", "n_words")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(hits, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"), (n_hit > 0).alias("contaminated"), "text_key"
    )
