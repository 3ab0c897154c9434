import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from rivulet.operators import graph as G
from rivulet.operators import ml as M

TRIANGLE_EDGES = [(1, 2), (1, 3), (1, 4), (1, 5), (2, 3), (2, 5), (3, 4), (3, 7), (3, 8), (5, 6), (7, 8)]


def test_triangles_fixture(spark):
    e = spark.createDataFrame(TRIANGLE_EDGES + [(2, 1), (4, 4)], "src long, dst long")
    got = sorted(tuple(r) for r in G.triangles(e).collect())
    assert got == [(1, 2, 3), (1, 2, 5), (1, 3, 4), (3, 7, 8)]


def test_triangles_random_graph(spark):
    rnd = random.Random(2)
    edges = {(rnd.randint(0, 30), rnd.randint(0, 30)) for _ in range(150)}
    und = {(min(a, b), max(a, b)) for a, b in edges if a != b}
    want = sorted((a, b, c) for a, b, c in itertools.combinations(sorted({v for e in und for v in e}), 3)
                  if (a, b) in und and (a, c) in und and (b, c) in und)
    got = sorted(tuple(r) for r in G.triangles(spark.createDataFrame(list(edges), "src long, dst long")).collect())
    assert got == want


def test_connected_components(spark):
    verts = spark.createDataFrame([(i,) for i in range(1, 17)], "id long")
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 4), (3, 5), (6, 7), (8, 9), (8, 10), (5, 11),
                                   (11, 12), (10, 13), (9, 14), (13, 14), (1, 15), (16, 1)], "src long, dst long")
    labels, steps = G.connected_components(verts, edges)
    comp = {r.vertex: r.component for r in labels.collect()}
    assert {v for v, c in comp.items() if c == 1} == {1, 2, 3, 4, 5, 11, 12, 15, 16}
    assert {v for v, c in comp.items() if c == 6} == {6, 7}
    assert {v for v, c in comp.items() if c == 8} == {8, 9, 10, 13, 14}


def test_transitive_closure_random(spark):
    rnd = random.Random(4)
    edges = {(rnd.randint(0, 25), rnd.randint(0, 25)) for _ in range(40)}
    closure = set(edges)
    while True:
        extra = {(a, d) for a, b in closure for c, d in edges if b == c} - closure
        if not extra:
            break
        closure |= extra
    paths, _ = G.transitive_closure(spark.createDataFrame(list(edges), "src long, dst long"))
    assert {tuple(r) for r in paths.collect()} == closure


def test_pagerank_matches_numpy(spark):
    links = [(1, 2), (1, 15), (2, 3), (2, 4), (2, 5), (2, 6), (2, 7), (3, 13), (4, 2), (5, 11), (5, 12),
             (6, 1), (6, 7), (6, 8), (7, 1), (7, 8), (8, 1), (8, 9), (8, 10), (9, 14), (9, 1), (10, 1),
             (10, 13), (11, 12), (11, 1), (12, 1), (13, 14), (14, 12), (15, 1)]
    n = 15
    ranks = {p: 1 / n for p in range(1, n + 1)}
    outdeg = {}
    for s, _ in links:
        outdeg[s] = outdeg.get(s, 0) + 1
    for _ in range(10):
        new = {}
        for s, d in links:
            if s in ranks:
                new[d] = new.get(d, 0.0) + ranks[s] / outdeg[s]
        new = {p: v * 0.85 + (1 - 0.85) / n for p, v in new.items()}
        moved = any(abs(new[p] - ranks[p]) > 1e-4 for p in new if p in ranks)
        ranks = new
        if not moved:
            break
    pages = spark.createDataFrame([(i,) for i in range(1, n + 1)], "id long")
    got, _ = G.pagerank(pages, spark.createDataFrame(links, "src long, dst long"), n)
    got = {r.id: r.rank for r in got.collect()}
    assert got.keys() == ranks.keys()
    assert all(abs(got[p] - ranks[p]) < 1e-12 for p in got)


def test_kmeans_matches_numpy(spark):
    rnd = np.random.default_rng(0)
    pts = np.vstack([rnd.normal(c, 3, size=(10, 2)) for c in [(-5, -45), (47, -48), (27, 48), (-33, 36)]])
    seeds = [(1, -31.85, -44.77), (2, 35.16, 17.46), (3, -5.16, 21.93), (4, -24.06, 6.81)]
    cents = {i: np.array([x, y]) for i, x, y in seeds}
    for _ in range(10):
        assign = [min(cents, key=lambda c: (np.hypot(*(p - cents[c])), c)) for p in pts]
        cents = {c: pts[[a == c for a in assign]].mean(axis=0) for c in sorted(set(assign))}
    df = spark.createDataFrame([(float(x), float(y)) for x, y in pts], "x double, y double")
    out, final = M.kmeans(df, spark.createDataFrame(seeds, "id int, x double, y double"), 10)
    for cid, x, y in final:
        assert np.allclose([x, y], cents[cid])


def test_linear_regression_matches_numpy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=21)
    y = 1.7 * x + 0.25 + rnd.normal(scale=0.1, size=21)
    t0 = t1 = 0.0
    for _ in range(10):
        err = (t0 + t1 * x) - y
        t0, t1 = np.mean(t0 - 0.01 * err), np.mean(t1 - 0.01 * err * x)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    g0, g1 = M.linear_regression(df, iterations=10).first()
    assert abs(g0 - t0) < 1e-12 and abs(g1 - t1) < 1e-12


def test_latest_model_skips_empty_windows(spark):
    rows = [(1, "2024-01-01 05:00:00", 1), (2, "2024-01-01 07:00:00", 3), (3, "2024-01-02 01:00:00", 10),
            (4, "2024-01-04 09:00:00", 5), (5, "2024-01-05 00:00:00", 1)]
    df = spark.createDataFrame(rows, "id int, t string, v long").withColumn("ts", F.to_timestamp_ntz("t"))
    model = M.window_model(df, "ts", "1 day", F.col("v"))
    out = {r.id: r.model_sum for r in M.apply_latest_model(df, "ts", model).collect()}
    assert out == {1: None, 2: None, 3: 4, 4: 10, 5: 5}
