"""What a worker remembers is small, and goes when another operator's task begins."""

import sys

import pyarrow as pa
import public_tokenizers as P

from stratalake.llm import language, packing, store, tokens
from stratalake.llm import text as tx


def test_a_worker_forgets_what_another_operator_remembered():
    held = lambda: [len(packing._encoders), len(language._vectors), len(tx._powers)]

    def seen(batches):
        yield held()
        language._vectors[1, 1] = object()
        yield held()

    def of(module):
        seen.__module__ = module
        return [*store.tidy(seen)(iter([]))]

    packing._encoders["here"] = tx._powers[3] = object()
    assert of("one") == [[0, 0, 0], [0, 1, 0]]
    assert of("one") == [[0, 1, 0], [0, 1, 0]]  # the same operator again
    assert of("other") == [[0, 0, 0], [0, 1, 0]]
    language._vectors.clear()


def test_ids_of_pre_tokens_are_packed():
    encoder = tokens.ByteBpe(str(P.path("byte_bpe_50k.json")), P.PATTERN)
    texts = ["Unforgettable words, spelled out at length; naïve façades.", "", "more words, more words"]
    ids = [x.tolist() for _, flat, bounds in encoder.encode(pa.array(texts)) for x in map(lambda a, b: flat[a:b], bounds[:-1], bounds[1:])]
    assert ids == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    lists = {w: [t.id for t in encoder.tokenize(w.encode().decode("latin-1").translate(encoder.letters))] for w in encoder.words}
    size = lambda ids: sys.getsizeof(ids) + sum(map(sys.getsizeof, ids))
    assert sum(map(sys.getsizeof, encoder.words.values())) < 0.5 * sum(map(size, lists.values()))
