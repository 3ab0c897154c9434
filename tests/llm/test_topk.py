"""Exact top-k against scoring every pair."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.llm import topk


def brute(rows, k, every):
    seen = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= topk.LIMIT for x in v):
            continue
        seen[i, tuple(math.floor(256 * x) for x in v)] = None
    out = []
    for i, q in seen:
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in seen if j != i and len(w) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("blocks", [(8192, 2048), (7, 3)])
def test_random_ties_and_odd_rows(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "VECTORS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rnd = np.random.default_rng(1)
    rows = [(i, (rnd.integers(-3, 4, 6) / 7).tolist()) for i in range(60)]  # many ties
    rows += [(100 + i, rows[4][1]) for i in range(20)]                      # copies
    rows += [(200, [0.0] * 6), (205, None), (210, [1.0, None, 0, 0, 0, 0]), (215, [math.nan] * 6),
             (220, [math.inf, 0, 0, 0, 0, 0]), (None, [1.0] * 6), rows[0], (0, [9.0] * 6), (225, []),
             (230, []), (235, [1.0, 2.0]), (240, [3e4, -3e4, 1.0, 0, 0, 0]), (245, [-3e4, 3e4, 1.0, 0, 0, 0]),
             (250, [1e9, 0, 0, 0, 0, 0])]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, q int, twin string")
    assert got(topk.search(df, F.col("vec_id") % 5 == 0, 5)) == brute(rows, 5, 5)


def test_empty_and_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id long, embedding array<float>")
    assert got(topk.search(df, F.col("vec_id") % 50 == 0, 5)) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert topk.search(df.limit(1), F.col("vec_id") % 50 == 0, 5).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(1, 20), st.integers(1, 8), st.integers(0, 2**32 - 1))
def test_index_is_exact(n, d, k, seed):
    rnd = np.random.default_rng(seed)
    width = int(rnd.choice([1, 4, 300, 2**24 - 1]))
    v = rnd.integers(-width, width + 1, (n, d))
    ids = rnd.permutation(n) * 3
    q = rnd.integers(-width, width + 1, d) * (rnd.random(d) < 0.7)
    own = int(ids[0])
    got_ids, got_scores = topk.ImpactIndex(ids, v).search(q, own, k)
    exact = sorted((-int(s), int(i)) for s, i in zip(v.astype(object) @ q.astype(object), ids) if i != own)[:k]
    assert list(zip((-got_scores).tolist(), got_ids.tolist())) == exact


def test_most_postings_are_skipped():
    """On clustered vectors the search ends before all segments are read."""
    rnd = np.random.default_rng(0)
    centres = rnd.normal(0, 1, (10, 64))
    v = centres[np.arange(4000) % 10] + rnd.normal(0, 0.7, (4000, 64))
    v = np.floor(256 * v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.int64)
    index = topk.ImpactIndex(np.arange(4000), v)
    steps = []
    cuts = index._cuts
    index._cuts = lambda *a: steps.append(1) or cuts(*a)
    for i in range(20):
        index.search(v[i], i, 5)
    assert len(steps) <= 20 * (len(topk.LEVELS) - 1)


@pytest.mark.parametrize("blocks", [(8192, 2048), (7, 3)])
def test_components_of_any_size(spark, monkeypatch, blocks):
    """Unnormalised vectors query and are found; ranks are exact beyond 64
    bits, where the score is null."""
    monkeypatch.setattr(topk, "VECTORS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    assert topk.LIMIT == math.inf
    rnd = np.random.default_rng(2)
    rows = [(i, (rnd.integers(-3, 4, 4) / 7 * 10.0 ** rnd.choice([0, 0, 0, 5, 6, 30, 300])).tolist()) for i in range(60)]
    rows += [(60, [65536.0, 0, 0, 0]), (65, [-65536.0, 0, 0, 1e-3]), (70, [65535.99, 0, 0, 0]), (75, [1.7e308, -1.7e308, 0, 1]),
             (80, [1e5, -0.0, 0.001, 0]), (80, [1e5, 0.0, 0.0011, 0]), (85, [1e9]), (90, [2e9])]

    def whole(x):
        return int(x) * 256 if abs(x) > 1e300 else math.floor(256 * x)
    seen = {(i, tuple(map(whole, v))) for i, v in rows}
    want = []
    for i, q in seen:
        if i % 5 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in seen if j != i and len(w) == len(q))
            want += [(i, r + 1, j, -s if abs(s) < 2**63 else None) for r, (s, j) in enumerate(scores[:5])]
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>")
    out = topk.search(df, F.col("vec_id") % 5 == 0, 5).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert any(w[3] is None for w in want) and any(w[3] and w[3] > 2**50 for w in want)


def test_queries_stream_past_one_index(spark, monkeypatch):
    """Runs of queries over many Arrow batches, at the real block size and at
    small ones: an index is built once a block and run, whatever the batches."""
    rnd = np.random.default_rng(3)
    rows = [(i, (rnd.integers(-200, 200, 8) / 100).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, 4, 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        for blocks in ((8192, 131_072), (100, 131_072), (100, 60)):
            monkeypatch.setattr(topk, "VECTORS", blocks[0])
            monkeypatch.setattr(topk, "QUERIES", blocks[1])
            assert got(topk.search(df, F.col("vec_id") % 3 == 0, 4)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    built = []
    whole = topk.ImpactIndex

    def counting(*args):
        built.append(1)
        return whole(*args)

    monkeypatch.setattr(topk, "ImpactIndex", counting)
    frame = topk.quantised(df).select("*", F.lit(0).cast("long").alias("v"), F.lit(0).alias("u"), F.lit(False).alias("asks")).toPandas()
    asks = frame.assign(asks=True)
    batches = [frame[:400], frame[400:], *(asks[i:i + 50] for i in range(0, 900, 50))]
    assert sum(map(len, topk._search_blocks(4)(iter(batches)))) == 900 * 4 and built == [1]
