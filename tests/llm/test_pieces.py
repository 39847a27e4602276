"""Pieces, their places and decoded texts against the library, also for models with a character map."""

import hashlib
import random

import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from stratalake.llm import pieces  # noqa: E402

MODEL = str(P.path("piece_bpe_32k.model"))
TRICKY = [
    "a", "b", " ", "  ", "\n", "\t", "é", "ß", "▁", "\xa0", "　", "1", "23", "'s", ".", ",", "<s>", "</s>", "<unk>", "<0x41>", "漢", "😀",
    "\r\n", "\x00", "the", " the", "\x85", "ﬁ", "Å", "Å", "½", "ｈ", "\xad", "𝔘", "ﷺ", "한", " ", "​",
]


def texts(n=2500):
    rng = random.Random(3)
    return ["".join(rng.choices(TRICKY, k=rng.randint(0, 25))) for _ in range(n)] + [None, "", " ", "▁", " ▁", "▁ ", "  "]


def assert_like_library(model, rows):
    got = [([], [], []) for _ in rows]
    for e in model.encode(pa.array(rows)):
        for i, (a, b) in enumerate(zip(e.bounds[:-1], e.bounds[1:])):
            for k, x in enumerate((e.ids, e.begin, e.end)):
                got[e.first + i][k].extend(x[a:b].tolist())
    for text, (ids, begins, ends) in zip(rows, got):
        want = model.library.encode(text or "", return_type="proto")
        assert list(zip(ids, begins, ends)) == [(p.id, p.begin, p.end) for p in want.pieces], text
        assert model.decode(ids).decode() == model.library.decode(ids), text


def test_plain_model():
    assert_like_library(pieces.Pieces(MODEL), texts())


def test_long_texts_in_pieces():
    model = pieces.Pieces(MODEL)
    for text in (" a b" * 700_000, "x" * 2_500_000, "漢" * 900_000):
        (ids, ends), at = ([], []), 0
        for e in model.encode(pa.array(["first", text, "last"])):
            if e.first <= 1 < e.first + len(e.bounds) - 1:
                a, b = e.bounds[1 - e.first], e.bounds[2 - e.first]
                ids += e.ids[a:b].tolist()
                ends += e.end[a:b].tolist()
        assert ids == model.library.encode(text) and ends == sorted(ends) and ends[-1] == len(text.encode())


@pytest.mark.parametrize("rule, single", [("nmt_nfkc", True), ("nmt_nfkc", False), ("nfkc_cf", False), ("nfkc_cf", True)])
def test_models_with_a_character_map(tmp_path, rule, single):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as spec

    model = spec.ModelProto.FromString(open(MODEL, "rb").read())
    rules = spec.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    model.normalizer_spec.CopyFrom(rules.normalizer_spec)
    model.normalizer_spec.remove_extra_whitespaces = single
    path = tmp_path / "mapped.model"
    path.write_bytes(model.SerializeToString())
    rows = [t for t in texts() if not (t and single and rule == "nfkc_cf" and "▁" in t)]  # this map keeps marks of a text's own
    assert_like_library(pieces.Pieces(str(path)), rows)


def test_a_key_with_a_space_is_refused():
    with pytest.raises(ValueError):
        units = [0] * 1024  # root, then 'a', then ' ', each with its children at a base of its own
        units[0] = 256 << 10
        units[256 ^ ord("a")] = ((512 ^ 256 ^ ord("a")) << 10) | ord("a")
        units[512 ^ 0x20] = (1 << 8) | 0x20
        pieces.CharacterMap((4 * len(units)).to_bytes(4, "little") + b"".join(u.to_bytes(4, "little") for u in units) + b"x\0")


def test_digests_encode_and_decode_agree(spark, docs):
    from pyspark.sql import functions as F

    rows = [(1, None), (2, ""), (None, "one two"), (3, "one two"), (3, "one two"), (4, " x\ny "), (5, "漢字 é" * 3), (6, "word " * 600_000)]
    df = docs(*rows).withColumn("n_tokens", F.lit("clash")).withColumn("ids", F.lit(1))
    encoded = pieces.encode(df, MODEL)
    back = {(r.doc_id, r.text) for r in pieces.decode(encoded, MODEL).collect()}
    assert back == {(i, t or "") for i, t in rows}
    library = pieces.Pieces(MODEL).library
    want = []
    for i, t in rows:
        ids = [*library.encode(t or ""), 2]
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    made = pieces.digests(df, MODEL)
    assert sorted((tuple(r)[:4] for r in made.collect()), key=repr) == sorted(want, key=repr)
    spans = {r.doc_id: r.spans_sha256 for r in made.where("doc_id = 5").collect()}
    row = encoded.where("doc_id = 5").first()
    flat = b"".join(x.to_bytes(8, "little") for pair in list(zip(row.begins, row.ends))[:-1] for x in pair)
    assert spans[5] == hashlib.sha256(flat).hexdigest() and row.ends[-1] == len("漢字 é".encode()) * 3
    assert pieces.digests(df.limit(0), MODEL).count() == 0 and pieces.encode(df.limit(0), MODEL).count() == 0
