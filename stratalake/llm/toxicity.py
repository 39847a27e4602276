"""Toxicity of whole texts by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, report, other. Small weighted transducers each
treat one thing and pass the symbols on: the target transducer turns an insult after a target in the
same clause into a directed insult, the threat transducer joins a threat and a target, the negation
transducer softens what follows a negation within a few words, the report transducer what follows a
reporting verb. They are composed into one deterministic machine that reads every clause once; its
weight and the weights of the insult words give the clause score. The clauses with a positive score add
up to the score of the text, so a listed word alone in a negated or reported clause counts little.

Insult words and beginnings of insult words are learned from labelled rows: those that occur in texts
labelled toxic far more often than chance (likelihood ratio against the number of candidates) and
hardly elsewhere. Learning reads a bounded sample of labelled rows (``SAMPLE``, smallest hashes of
doc_id); everything else reads every text. Weights come from document counts over different texts.

Null and empty texts get the base score. Labels that are null are not learned from; of several labels
of a document the largest counts. Repeated rows stay; an empty table gives no rows; with no labelled
toxic text only the hand-written words count. Columns not named in ``keep`` do not matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm import store, text as tx

#: Labelled rows that insult words are learned from.
SAMPLE = 20_000
HEADS = (4, 5, 6)
#: Counted features that a task holds before it passes them on.
HELD = 30_000
#: Bytes of texts whose words are hashed at once: the arrays for them are many times as large.
HASHED = 1 << 18
#: Texts that are labelled toxic among those with the word, at least.
PRECISION = 0.95
#: Part of the toxic texts that hold a word or beginning, at least: what a group of near copies repeats is no insult.
SUPPORT = 0.02
#: Log likelihood ratio over the logarithm of the number of candidates, at least.
EVIDENCE = -5.0
BIAS, MOST = -3.0, 5.0
THRESHOLD = 0.3

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, DIRECTED, MENACE = "ITYNROJM"

# Hand-written closed word classes in English, German, French and Spanish.
WORDS = {
    TARGET: "you your yours yourself u ya du dich dir dein deine ihr euch sie er tu toi te ton vous votre tú ti tus usted ustedes vosotros he him she her they them their people",
    NEGATION: "not no never none nor neither without isn wasn aren don doesn didn nicht kein keine nie niemals ne pas jamais aucun sans nunca jamás ni sin",
    REPORT: "said says say told tells wrote writes quoted quote reported claims claimed called sagte sagt schrieb zitierte dit disait écrit cita dijo dice escribió citó",
    THREAT: "kill murder hurt destroy stab shoot strangle töten umbringen schlagen tuer frapper matar golpear",
}
#: Words taken as insults whatever the labels say.
SEEDS = ("idiot", "moron", "scum", "stupid", "worthless", "pathetic", "disgusting")


@dataclass
class Transducer:
    """Deterministic and complete by default: without an arc a symbol is passed on at no weight in the same state."""

    start: tuple
    arcs: dict[tuple, tuple] = field(default_factory=dict)  # (state, symbol): (state, symbol, weight)

    def step(self, state, symbol: str) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def then(self, other: Transducer, symbols: str) -> Transducer:
        """Composition: the output of this one is the input of the other, weights add."""
        made, todo, seen = {}, [(self.start, other.start)], set()
        while todo:
            pair = todo.pop()
            if pair in seen:
                continue
            seen.add(pair)
            for symbol in symbols:
                one, middle, w = self.step(pair[0], symbol)
                two, out, v = other.step(pair[1], middle)
                made[pair, symbol] = ((one, two), out, w + v)
                todo.append((one, two))
        return Transducer((self.start, other.start), made)


def _after(trigger: str, softened: str, weight: float, reach: int) -> Transducer:
    """``weight`` on the softened symbols within ``reach`` words after a trigger; states count down."""
    arcs: dict[tuple, tuple] = {}
    for n in range(reach + 1):
        for symbol in (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, DIRECTED, MENACE):
            left = reach if symbol == trigger else max(n - 1, 0)
            arcs[n, symbol] = (left, symbol, weight if n and symbol in softened else 0.0)
    return Transducer(0, arcs)


def grammar() -> Transducer:
    """Target, threat, insult, negation and report transducers, composed in this order."""
    target = Transducer("free", {("free", TARGET): ("met", TARGET, 0.0), ("met", INSULT): ("met", DIRECTED, 0.5)})
    threat = Transducer("free", {
        ("free", THREAT): ("said", THREAT, 0.0), ("said", TARGET): ("free", MENACE, 3.0),
        ("free", TARGET): ("met", TARGET, 0.0), ("met", THREAT): ("free", MENACE, 2.0),
    })
    insult = Transducer("first", {("first", INSULT): ("more", INSULT, 0.5), ("first", DIRECTED): ("more", DIRECTED, 0.5)})
    negation = _after(NEGATION, INSULT + DIRECTED + MENACE, -2.0, 3)
    report = _after(REPORT, INSULT + DIRECTED + MENACE, -1.0, 8)
    symbols = INSULT + THREAT + TARGET + NEGATION + REPORT + OTHER
    machine = target
    for part in (threat, insult, negation, report):
        machine = machine.then(part, symbols)
    return machine


_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


class Scorer:
    """The grammar with a lexicon: feature (word, or beginning with *) to weight."""

    def __init__(self, lexicon: dict[str, float]):
        self.machine = grammar()
        self.lexicon = lexicon
        self.classes = {w: c for c, listed in WORDS.items() for w in listed.split()}
        self.lengths = sorted({len(k.encode()) - 1 for k in lexicon if k.endswith("*")})
        hashed = tx.hash_words([k.rstrip("*") for k in lexicon], tx.ALNUM)
        threats = tx.hash_words([w for w, c in self.classes.items() if c == THREAT], tx.ALNUM)
        self.words = np.sort(np.array([h[0] for k, h in zip(lexicon, hashed) if not k.endswith("*")] + [h[0] for h in threats], np.uint64))
        self.heads = {n: np.sort(np.array([h[0] for k, h in zip(lexicon, hashed) if k.endswith("*") and len(k.encode()) == n + 1], np.uint64)) for n in self.lengths}

    def candidates(self, w: tx.Words) -> np.ndarray:
        """Rows with a word that can score."""
        hit = tx.contains(self.words, w.hash)
        for n, heads in self.heads.items():
            hit |= tx.contains(heads, w.heads(n))
        return np.unique(w.row[hit])

    def weight(self, word: str) -> float:
        best = self.lexicon.get(word, 0.0)
        raw = word.encode()
        for n in self.lengths:
            if len(raw) > n:
                best = max(best, self.lexicon.get(raw[:n].decode("utf-8", "replace") + "*", 0.0))
        return best

    def clauses(self, text: str) -> Iterator[float]:
        """Scores of the clauses above 0."""
        for clause in _CLAUSE.split(text.translate(_LOWER)):
            words = _WORD.findall(clause)
            weights = [self.weight(w) for w in words]
            symbols = [INSULT if x else self.classes.get(w, OTHER) for w, x in zip(words, weights)]
            if INSULT not in symbols and THREAT not in symbols:
                continue
            state, score = self.machine.start, 0.0
            for symbol, weight in zip(symbols, weights):
                state, _, w = self.machine.step(state, symbol)
                score += w + weight
            if score > 0:
                yield score

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-min(BIAS + sum(self.clauses(text)), 30.0)))


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Words and beginnings with their weights from rows (text, toxic): at most what the sampled rows hold."""

    held = HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def counted() -> pa.RecordBatch:
            keys = sorted(set(found[0]) | set(found[1]))
            return pa.RecordBatch.from_pydict({"feature": pa.array(keys, pa.string()), "pos": pa.array([found[1][k] for k in keys], pa.int64()), "neg": pa.array([found[0][k] for k in keys], pa.int64())})

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1)):
                if len(found[0]) + len(found[1]) >= held:
                    yield counted()
                    found = {0: Counter(), 1: Counter()}
                text, toxic = text.as_py(), toxic.as_py()
                words = set(_WORD.findall(text.translate(_LOWER)))
                features = set(words)
                for raw in (w.encode() for w in words):
                    features.update(raw[:n].decode("utf-8", "replace") + "*" for n in HEADS if len(raw) > n)
                found[toxic].update(features)
                found[toxic][""] += 1
        yield counted()

    distinct = labelled.groupBy("text").agg(F.max("toxic").alias("toxic"))
    counts = distinct.mapInArrow(store.tidy(run), "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = store.keep(counts.where("pos > 0"), "features")
    total = counts.where("feature = ''").first()
    weights = dict.fromkeys(SEEDS, 4.0)
    if total is None or not total["neg"]:
        return weights
    n_features = counts.count()
    rate = total["pos"] / (total["pos"] + total["neg"])
    share = F.expr("pos / (pos + neg)")
    ratio = F.col("pos") * F.log(share / rate) + F.when(F.col("neg") > 0, F.col("neg") * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    chosen = counts.where((F.col("feature") != "") & (share >= PRECISION) & (F.col("pos") >= SUPPORT * total["pos"]) & (ratio >= math.log(n_features) + EVIDENCE))
    odds = math.log((total["pos"] + 1) / (total["neg"] + 1))
    for r in chosen.collect():
        weight = math.log((r["pos"] + 0.5) / (r["neg"] + 0.5)) - odds
        weights[r["feature"]] = min(max(weight, weights.get(r["feature"], 0.0)), MOST)
    return {k: w for k, w in weights.items() if "�" not in k}


def sample_labelled(docs: DataFrame, labels: DataFrame, training: Column, rows: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents where ``training`` holds, by the hash of doc_id."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & training)
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")


_scorers: dict[int, Scorer] = store.remembered({})


def score_texts(docs: DataFrame, lexicon: dict[str, float], keep: tuple[str, ...] = ("doc_id",), text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns with score, predicted and n_clauses (clauses that count)."""
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer").add("n_clauses", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(tuple(sorted(lexicon.items())))
        if key not in _scorers:
            _scorers[key] = Scorer(lexicon)
        scorer = _scorers[key]
        base = 1 / (1 + math.exp(-BIAS))
        for batch in batches:
            score, clauses = np.full(batch.num_rows, base), np.zeros(batch.num_rows, np.int32)
            column = batch.column(len(keep))
            for w in tx.words(column, tx.ALNUM, HASHED):
                for row in scorer.candidates(w) + w.first:
                    found = list(scorer.clauses(column[int(row)].as_py()))
                    score[row] = 1 / (1 + math.exp(-min(BIAS + sum(found), 30.0)))
                    clauses[row] = len(found)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(clauses)], [*keep, "score", "predicted", "n_clauses"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(store.tidy(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, training: Column, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Learn from the labelled rows where ``training`` holds, score every row."""
    return score_texts(docs, learn_lexicon(sample_labelled(docs, labels, training)), keep)
