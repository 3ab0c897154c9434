"""Packing: exact round trip, capacity, gaplessness, and few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF001
from rivulet.llm import packing
from rivulet.llm.queries import op6_best_fit_packing, vocabulary


def reference_ids(texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids + [2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_packed(rows, docs):
    """rows: Row of the packed table; docs: list of (doc_id, ids)."""
    want = Counter()
    for doc_id, ids in docs:
        first = len(ids) % 1024 or 1024
        for k, start in enumerate([0, *range(first, len(ids), 1024)]):
            own = np.array(ids[start:first if not start else start + 1024], "<u4")
            want[doc_id, k, start, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences), -(-sum(len(ids) for _, ids in docs) // 1024)


def test_query_round_trip(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    ids = reference_ids([t for _, t in docs])
    used, least = check_packed(op6_best_fit_packing(spark, SF001).collect(),
                               [(d, i) for (d, _), i in zip(docs, ids)])
    assert used <= least + 2


def test_edge_rows(spark):
    texts = [(1, None), (2, ""), (None, "a"), (1, "a"), (1, "a"), (3, "x" * 5000), (4, "tok " * 3000),
             (5, "<|endoftext|> é 漢字 \U0001f600 \x00 '''ll  \n\n  'S"), (6, "  lead"), (7, "trail  ")]
    df = spark.createDataFrame([(*t, 0, "s") for t in texts],
                               "doc_id long, text string, offset int, sequence_id string")
    out = packing.pack_documents(df, *vocabulary(), with_ids=True).collect()
    ids = reference_ids([t for _, t in texts])
    check_packed(out, [(d, i) for (d, _), i in zip(texts, ids)])
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert packing.pack_documents(df.limit(0), *vocabulary()).count() == 0


def lengths_of(patterns):
    out = Counter()
    for lengths, times in patterns:
        assert times > 0 and sum(lengths) <= 1024
        for n in lengths:
            out[n] += times
    return out


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rnd = random.Random(seed)
    top = rnd.choice([40, 300, 1024])
    histogram = Counter(rnd.randint(1, top) for _ in range(rnd.choice([1, 50, 3000])))
    patterns = packing.plan(histogram)
    assert lengths_of(patterns) == histogram
    used = sum(t for _, t in patterns)
    least = -(-sum(n * c for n, c in histogram.items()) // 1024)
    assert used <= least * 1.02 + 2


def test_plan_prefers_exact_complements():
    assert packing.plan({600: 5, 424: 5}) == [((600, 424), 5)]
    assert packing.plan({512: 4}) == [((512, 512), 2)]
    assert sorted(packing.plan({1000: 1, 10: 1, 14: 1})) == [((1000, 14, 10), 1)]
    assert packing.plan({900: 2, 100: 2, 20: 2, 4: 2}) == [((900, 100, 20, 4), 2)]
    assert packing.plan({1024: 10**12}) == [((1024,), 10**12)]
    assert packing.plan({}) == []
    with pytest.raises(ValueError):
        packing.plan({1025: 1})
