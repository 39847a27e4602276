"""Word hashes, tokens and token counts against plain Python and the tokenizer libraries."""

import itertools
import random
import re

import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from stratalake.llm import text as tx  # noqa: E402
from stratalake.llm import tokens  # noqa: E402
from stratalake.llm.token_counts import token_counts  # noqa: E402

TRICKY = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "▁", "\xa0", "　", "1", "23", "'s", ".", ",", "<s>", "<|endoftext|>", "漢", "😀", "\r\n", "\x00", "the", " the", "\x85", "\x1c"]


def texts(n=3000):
    rng = random.Random(5)
    made = ["".join(rng.choices(TRICKY, k=rng.randint(0, 25))) for _ in range(n)]
    return [*made, None, "", " ", " a b" * 700_000, "x" * 2_500_000]


@pytest.mark.parametrize("kind, pattern", [(tx.ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (tx.SPACED, rb"[^\x20\x09-\x0D]+")])
def test_words_are_those_of_the_pattern(kind, pattern):
    rows, names = texts(), {}
    for w in tx.words(pa.array(rows), kind):
        cut, heads = w.bounds(), w.heads(3)
        for i in range(w.rows):
            found = re.findall(pattern, (rows[w.first + i] or "").encode().lower())
            hashes = w.hash[cut[i] : cut[i + 1]].tolist()
            assert len(found) == len(hashes)
            for word, h, head in zip(found, hashes, heads[cut[i] : cut[i + 1]].tolist()):
                assert names.setdefault(word, h) == h and names.setdefault(h, word) == word
                if len(word) > 3:
                    assert names.setdefault((word[:3],), head) == head
    assert len(names) > 500


def test_piece_counts_are_those_of_the_library():
    rows = texts()
    counter = tokens.PieceCounts(str(P.path("piece_bpe_32k.model")))
    assert counter.count(pa.array(rows)).tolist() == [len(counter.model.encode(t or "")) for t in rows]


def test_byte_ids_are_those_of_the_library():
    rows = texts()[:-1]
    encoder = tokens.ByteBpe(str(P.path("byte_bpe_50k.json")), P.PATTERN)
    got = [ids[a:b].tolist() for _, ids, cut in encoder.encode(pa.array(rows)) for a, b in zip(cut[:-1], cut[1:])]
    assert got == [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in rows], add_special_tokens=False)]


KINDS = ["a", "s", "t", "re", "ll", "B", "é", "ß", "×", "÷", "Ж", "1", "²", "'", "'s", "'S", "-", "_", "…", "«", "\u0301", " ", "  ", "\n", "\xa0", "<|endoftext|>", "<|", "endoftext", "|>", "\x7f"]


@pytest.mark.parametrize("plain", [False, True])
def test_byte_ids_where_kinds_of_characters_meet(plain):
    rng = random.Random(7)
    rows = ["".join(rng.choices(KINDS, k=rng.randint(0, 30))) for _ in range(6000)]
    rows.append("".join(rng.choices(KINDS, k=400_000)))  # longer than a slice
    encoder = tokens.ByteBpe(str(P.path("byte_bpe_50k.json")), P.PATTERN)
    assert encoder.by_kind and encoder.gap is not None
    if plain:  # as for other patterns and models
        encoder.by_kind, encoder.gap = False, None
    got = [ids[a:b].tolist() for _, ids, cut in encoder.encode(pa.array(rows)) for a, b in zip(cut[:-1], cut[1:])]
    assert got == [e.ids for e in encoder.tokenizer.encode_batch(rows, add_special_tokens=False)]


def test_a_word_is_encoded_once_whatever_sign_follows():
    words = ["".join(p) for p in itertools.product("bdfgk", "aeiou", "lmnrst", "aeo")]
    rows = [" ".join(w + sign for w in words) for sign in ["", *".,;:!?)]-/"]]
    encoder, calls = tokens.ByteBpe(str(P.path("byte_bpe_50k.json")), P.PATTERN), []
    encoder.tokenize = lambda text: calls.append(text) or encoder.tokenizer.model.tokenize(text)
    got = [ids[a:b].tolist() for _, ids, cut in encoder.encode(pa.array(rows)) for a, b in zip(cut[:-1], cut[1:])]
    assert got == [encoder.tokenizer.encode(r, add_special_tokens=False).ids for r in rows]
    assert len(encoder.memo) <= len(words) + 20
    assert len(calls) <= len(words) / 8


def test_counts_of_awkward_rows(spark, docs):
    from pyspark.sql import functions as F

    df = docs((1, None), (2, ""), (None, "one two"), (3, "one two"), (3, "one two")).withColumn("n_tokens", F.lit("clash"))
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(df, str(P.path("piece_bpe_32k.model")), 1).collect())
    assert got == [(0, 7, 2, True), (1, 0, 0, False), (2, 0, 0, False), (3, 7, 2, True), (3, 7, 2, True)]
    assert token_counts(docs((1, "x")).limit(0), str(P.path("piece_bpe_32k.model")), 1).count() == 0
