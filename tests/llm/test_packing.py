"""Packing: exact plans, the round trip of ids, and closeness to the lower bound."""

import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from stratalake.llm import packing  # noqa: E402


@pytest.mark.parametrize("seed", range(4))
def test_plan_covers_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    histogram = np.zeros(65, np.int64)
    histogram[rng.integers(1, 65, 20)] = rng.integers(1, 200, 20)
    histogram[7] = 3000  # one length that most pieces have
    plan = packing.plan_packing(histogram, 64)
    length = np.repeat(np.arange(65), histogram)
    rank = np.concatenate([np.arange(n) for n in histogram])
    sequence, offset = plan.place(length, rank)
    order = np.lexsort((offset, sequence))
    sequence, offset, length = sequence[order], offset[order], length[order]
    first = np.r_[True, sequence[1:] != sequence[:-1]]
    assert (offset[first] == 0).all() and (offset + length).max() <= 64
    assert (offset[1:][~first[1:]] == (offset + length)[:-1][~first[1:]]).all()
    assert len(np.unique(sequence)) == plan.sequences
    volume = -(-(histogram * np.arange(65)).sum() // 64)
    assert plan.sequences <= max(volume, plan.bound) * 1.1 + 3


def test_knapsack_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(30):
        weight, count = rng.random(13), rng.integers(0, 4, 13)
        count[0] = 0
        use = packing._knapsack(weight, count, 12)
        best = np.full(13, 0.0)
        for length in range(1, 13):
            for _ in range(int(count[length])):
                best[length:] = np.maximum(best[length:], best[:-length] + weight[length])
        assert (use <= count).all() and (use * np.arange(13)).sum() <= 12
        assert np.isclose((use * weight).sum(), best[12])


def test_pieces_hold_the_ids_of_their_documents(spark, docs):
    from tokenizers import Tokenizer

    rows = [(1, None), (2, ""), (None, "free"), (3, "same text here"), (3, "same text here"), (4, "long words of a text " * 900)] + [(i, "a b c") for i in range(10, 60)]
    path = str(P.path("byte_bpe_50k.json"))
    got = packing.pack(docs(*rows), path, P.PATTERN, capacity=64, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(path)
    wanted = sorted(((i or -1, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows), key=repr)
    by_doc: dict = {}
    for r in got:
        assert len(r.ids) == r.length <= 64 and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        by_doc.setdefault(r.doc_id or -1, []).append(r)
    flat = []
    for i, pieces in by_doc.items():
        copies = sum(p.piece == 0 for p in pieces)
        starts = sorted({(p.piece, p.start, tuple(p.ids)) for p in pieces})
        ids = [x for _, _, part in starts for x in part]
        assert [s for _, s, _ in starts] == [sum(len(p) for _, _, p in starts[:k]) for k in range(len(starts))]
        assert all(len(p) == 64 for _, _, p in starts[1:])
        flat += [(i, ids)] * copies
    assert sorted(flat, key=repr) == wanted
    places = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for (s, o, n), (t, p, _) in zip(places, places[1:]):
        assert (t == s and p == o + n) or (t != s and p == 0)
    assert packing.pack(docs((1, "x")).limit(0), path, P.PATTERN).count() == 0
