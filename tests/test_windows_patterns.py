import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import patterns as P
from rivulet.operators import windows as W
from rivulet.operators.iterate import fibonacci_steps
from rivulet.operators.trigger import delta_trigger_top


def test_count_window_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), i, rnd.randint(0, 9)) for i in range(137)]
    df = spark.createDataFrame(rows, "k string, q long, v long")
    got = sorted((r.k, r.q, r.window_sum) for r in W.count_window_sum(df, "k", "q", "v", 10, 5, width=8).collect())
    want = []
    for k in "ab":
        seq = [r for r in rows if r[0] == k]
        for i in range(5, len(seq) + 1, 5):
            want.append((k, seq[i - 1][1], sum(r[2] for r in seq[max(0, i - 10):i])))
    assert got == sorted(want)


def test_session_fixture(spark):
    # (key, ts millis, n) with a 3 ms gap; each session keeps its first ts
    rows = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
    df = spark.createDataFrame(rows, "key string, ms long, n int") \
        .withColumn("ts", F.timestamp_millis("ms"))
    out = W.sessions(df, "key", "ms", "ts", "3 milliseconds",
                     [F.min("ms").alias("first"), F.sum("n").alias("n")], block_seconds=0.002)
    got = sorted((r.key, r.first, r.n) for r in out.collect())
    assert got == sorted([("a", 1, 1), ("c", 6, 1), ("c", 11, 1), ("b", 1, 3), ("a", 10, 1)])


def test_sessions_touching_rows_merge(spark):
    df = spark.createDataFrame([("k", 0), ("k", 3), ("k", 7)], "key string, ms long") \
        .withColumn("ts", F.timestamp_millis("ms"))
    out = W.sessions(df, "key", "ms", "ts", "3 milliseconds", [F.count(F.lit(1)).alias("n")])
    assert sorted(r.n for r in out.collect()) == [1, 2]


def test_strt_a_plus_fixture(spark):
    rows = [("1", 1), ("2", 2), ("1", 3), ("2", 3), ("2", 2), ("1", 1)]
    df = spark.createDataFrame([(0, i, w, v) for i, (w, v) in enumerate(rows)],
                               "g int, seq long, word string, id int")
    out = P.start_then_run(df, "g", "seq", F.col("word") == "1", ["word"], width=2)
    ends = {r.last_a: r.start_word for r in out.collect()}
    # map the matched last rows back to their id: (start_word, A_id)
    ids = {i: v for i, (_, v) in enumerate(rows)}
    assert sorted((w, ids[s]) for s, w in ends.items()) == sorted([("2", 3), ("2", 1)])


def test_strt_a_plus_run_at_key_start(spark):
    df = spark.createDataFrame([(0, 0, "A"), (0, 1, "A"), (0, 2, "B"), (1, 0, "A"), (1, 1, "B")],
                               "g int, seq long, t string")
    out = P.start_then_run(df, "g", "seq", F.col("t") == "A", ["seq"]).collect()
    assert [(r.g, r.start_seq, r.last_a, r.run_length) for r in out] == [(0, 0, 1, 1)]


def test_followed_by_within(spark):
    rows = [(1, 0, "A", 0), (1, 1, "B", 4000), (1, 2, "A", 5000), (1, 3, "B", 11000),
            (2, 0, "A", 0), (2, 1, "C", 1), (2, 2, "B", 2)]
    df = spark.createDataFrame(rows, "u int, seq long, t string, ms long").withColumn("ts", F.timestamp_millis("ms"))
    out = P.followed_by(df, "u", "seq", "ts", F.col("t") == "A", F.col("t") == "B", "5 seconds", ["seq"], width=2)
    assert [(r.u, r.seq, r.next_seq) for r in out.collect()] == [(1, 0, 1)]


def test_fibonacci_fixture(spark):
    pairs = [(1, 40), (29, 38), (11, 15), (17, 39), (24, 41), (7, 33), (20, 2), (11, 5), (3, 16),
             (23, 36), (15, 23), (28, 13), (1, 1), (10, 6), (21, 5), (14, 36), (17, 15), (7, 9)]
    expected = {(1, 40): 3, (24, 41): 2, (3, 16): 5, (1, 1): 10, (17, 15): 4, (29, 38): 2,
                (7, 33): 3, (23, 36): 3, (10, 6): 6, (7, 9): 5, (11, 15): 4, (20, 2): 5,
                (15, 23): 4, (21, 5): 5, (17, 39): 3, (11, 5): 6, (28, 13): 4, (14, 36): 3}
    df = spark.createDataFrame(pairs, "a int, b int")
    got = {(r.a, r.b): r.steps for r in fibonacci_steps(df, "a", "b", 100).collect()}
    assert got == expected


def _brute_delta(rows, threshold, evict_ms):
    out = []
    for k in sorted({r[0] for r in rows}):
        seq = sorted([r for r in rows if r[0] == k], key=lambda r: r[1])
        last = None
        for i, (kk, q, speed, dist, ms) in enumerate(seq):
            if last is None:
                last = dist
                continue
            if dist - last > threshold:
                last = dist
                kept = [r for r in seq[:i + 1] if r[4] > ms - evict_ms]
                top = max(kept, key=lambda r: (r[2], -r[1]))
                out.append((k, q, top[1]))
    return sorted(out)


def test_delta_trigger_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = []
    for k in range(3):
        dist, ms = 0.0, 0
        for q in range(120):
            speed = rnd.randint(40, 100)
            dist += rnd.randint(0, 30)
            ms += rnd.choice([500, 1000, 1500])
            rows.append((k, q, float(speed), dist, ms))
    df = spark.createDataFrame(rows, "car long, q long, speed double, distance double, ms long") \
        .withColumn("ts", F.timestamp_millis("ms"))
    out = delta_trigger_top(df, "car", "ts", "q", "speed", "distance", 50, "10 seconds")
    got = sorted((r.car, r.fire_q, r.q) for r in out.collect())
    assert got == _brute_delta(rows, 50, 10_000)


def test_window_apply_full_contents(spark):
    df = spark.createDataFrame([(1, 0), (1, 1000), (1, 2600), (2, 100)], "k long, ms long") \
        .withColumn("ts", F.timestamp_millis("ms"))

    def span(pdf):
        return pd.DataFrame({"k": [pdf.k.iloc[0]], "n": [len(pdf)], "span": [int(pdf.ms.max() - pdf.ms.min())]})

    out = W.window_apply(df, "ts", "2 seconds", ["k"], span, "k long, n long, span long")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1, 0), (1, 2, 1000), (2, 1, 0)]


@pytest.mark.parametrize("width", [3, 17, 64])
def test_delta_trigger_blocked_hot_key(spark, width):
    rnd = random.Random(width)
    rows, dist = [], {}
    ms = 0
    for q in range(400):
        k = 0 if rnd.random() < 0.5 else rnd.randint(1, 3)       # key 0 is hot
        ms += rnd.choice([200, 700, 1500, 4000])
        dist[k] = dist.get(k, 0.0) + rnd.choice([0, 5, 20, 45, 60])
        rows.append((k, q, float(rnd.randint(40, 100)), dist[k], ms))
    df = spark.createDataFrame(rows, "car long, q long, speed double, distance double, ms long") \
        .withColumn("ts", F.timestamp_millis("ms"))
    out = delta_trigger_top(df, "car", "ts", "q", "speed", "distance", 50, "10 seconds", width=width)
    got = sorted((r.car, r.fire_q, r.q) for r in out.collect())
    assert got == _brute_delta(rows, 50, 10_000)


@pytest.mark.parametrize("size,slide", [(7, 3), (4, 4), (5, 7), (1, 1)])
def test_count_window_other_shapes(spark, size, slide):
    rnd = random.Random(size * 10 + slide)
    rows = [(rnd.choice("abc"), i, rnd.randint(-3, 9)) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, q long, v long")
    out = W.count_window_sum(df, "k", "q", "v", size, slide, width=6)
    got = sorted((r.k, r.q, r.rn, r.window_sum) for r in out.collect())
    want = []
    for k in "abc":
        seq = [r for r in rows if r[0] == k]
        for i in range(slide, len(seq) + 1, slide):
            want.append((k, seq[i - 1][1], i, sum(r[2] for r in seq[max(0, i - size):i])))
    assert got == sorted(want)


def test_delta_trigger_zero_eviction_emits_nothing(spark):
    rows = [(1, q, 50.0, float(q * 60), q * 1000) for q in range(5)]
    df = spark.createDataFrame(rows, "car long, q long, speed double, distance double, ms long") \
        .withColumn("ts", F.timestamp_millis("ms"))
    assert delta_trigger_top(df, "car", "ts", "q", "speed", "distance", 50, "0 seconds").count() == 0
