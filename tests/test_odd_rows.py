"""Null keys, sparse sequences, hot keys, rows out of order, late models:
cases the driver tables do not hold, at several block widths."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rivulet import sinks
from rivulet.functions.text import token_route
from rivulet.operators import graph as G
from rivulet.operators import ml as M
from rivulet.operators import patterns as P
from rivulet.operators import relational as R
from rivulet.operators import windows as W
from rivulet.operators.files import manifest, relative_to
from rivulet.operators.iterate import fibonacci_steps, route
from rivulet.operators.statemachine import state_machine_alerts
from rivulet.operators.trigger import _first_over, delta_trigger_top
from rivulet.sources import streams

WIDTHS = [1, 7, 1 << 16]


def keyed(spark, kind="long", n=160):
    """Half the rows under one key, a sixth under null, a sparse sequence."""
    rnd = random.Random(3)
    rows, q = [], 0
    for _ in range(n):
        q += rnd.choice([1, 2, 1000])
        k = rnd.choice([5, 5, 5, None, 6, 7])
        rows.append((k if k is None or kind == "long" else f"k{k}", q, rnd.randint(0, 9), rnd.choice("abcdefg")))
    return spark.createDataFrame(rows, f"k {kind}, q long, v long, e string") \
        .withColumn("ts", F.timestamp_seconds(F.col("q") * 10))


@pytest.mark.parametrize("width", WIDTHS)
def test_running_sum_and_count_window_keep_null_keys(spark, width):
    df = keyed(spark)
    w = Window.partitionBy("k").orderBy("q")
    want = df.select("k", "q", F.sum("v").over(w).alias("running"))
    got = W.running_sum(df.select("k", "q", "v"), "k", "q", "v", width=width).drop("v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    want = df.select("k", "q", F.row_number().over(w).alias("rn"), F.sum("v").over(w.rowsBetween(-3, 0)).alias("window_sum")) \
        .where("rn % 2 = 0")
    got = W.count_window_sum(df, "k", "q", "v", 4, 2, width=width)
    assert sorted(map(str, got.select("k", "q", "window_sum").collect())) == \
        sorted(map(str, want.select("k", "q", "window_sum").collect()))


def test_count_window_of_fractions(spark):
    df = spark.createDataFrame([(1, i, 0.5) for i in range(1, 31)], "k int, q long, v double")
    got = {r.q: r.window_sum for r in W.count_window_sum(df, "k", "q", "v", 10, 5).collect()}
    assert got == {5: 2.5, 10: 5.0, 15: 5.0, 20: 5.0, 25: 5.0, 30: 5.0}


@pytest.mark.parametrize("seconds", [1, 600, 86_400])
def test_sessions_follow_time_not_sequence(spark, seconds):
    rnd = random.Random(5)
    rows = [(rnd.choice([1, None, 2]), i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 4000)))
            for i in range(120)] + [(1, 500, None), (9, 1, dt.datetime(2024, 1, 1)), (9, 2, dt.datetime(2024, 1, 1, 2)),
                                    (9, 3, dt.datetime(2024, 1, 1, 0, 30))]
    df = spark.createDataFrame(rows, "k int, q long, ts timestamp")
    got = W.sessions(df, "k", "q", "ts", "1 hour", [F.count(F.lit(1)).alias("n")], block_seconds=seconds)
    want = []
    for k in {r[0] for r in rows}:
        times = sorted(r[2] for r in rows if r[0] == k and r[2])
        start = 0
        for i in range(1, len(times) + 1):
            if i == len(times) or times[i] - times[i - 1] > dt.timedelta(hours=1):
                want.append((k, times[start], i - start))
                start = i
    assert sorted(((r.k, r.session_start, r.n) for r in got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("width", WIDTHS)
def test_patterns_keep_null_keys_and_skip(spark, width):
    df = keyed(spark)
    got = {(r.k, r.q, r.next_q) for r in
           P.followed_by(df, "k", "q", "ts", F.col("v") < 6, F.col("v") < 7, "12 hours", ["q"], width).collect()}
    runs = {(r.k, r.start_q, r.last_a, r.run_length) for r in
            P.start_then_run(df, "k", "q", F.col("v") < 5, ["q"], width).collect()}
    want, want_runs = set(), set()
    data = [tuple(r) for r in df.select("k", "q", "v").collect()]
    for k in {r[0] for r in data}:
        seq = sorted(r[1:] for r in data if r[0] == k)
        i = 0
        while i + 1 < len(seq):
            (q, v), (q2, v2) = seq[i], seq[i + 1]
            if v < 6 and v2 < 7 and (q2 - q) * 10 < 12 * 3600:
                want.add((k, q, q2))
                i += 2
            else:
                i += 1
        i = 0
        while i < len(seq):
            if seq[i][1] < 5:
                j = i
                while j + 1 < len(seq) and seq[j + 1][1] < 5:
                    j += 1
                if i:
                    want_runs.add((k, seq[i - 1][0], seq[j][0], j - i + 1))
                elif j:
                    want_runs.add((k, seq[0][0], seq[j][0], j))
                i = j
            i += 1
    assert got == want
    assert runs == want_runs


@pytest.mark.parametrize("seconds", [1, 10_000])
def test_global_pattern_in_time_order(spark, seconds):
    rnd = random.Random(8)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 3000)), rnd.choice("AB")) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, t string")
    got = {(r.id, r.next_id) for r in P.followed_by_in_time(
        df, "ts", "id", F.col("t") == "A", F.col("t") == "B", "10 seconds", ["id"], seconds).collect()}
    seq = sorted(rows, key=lambda r: (r[1], r[0]))
    assert got == {(a[0], b[0]) for a, b in zip(seq, seq[1:])
                   if a[2] == "A" and b[2] == "B" and b[1] - a[1] < dt.timedelta(seconds=10)}


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("kind", ["long", "string"])
def test_state_machine_and_trigger_take_any_key(spark, width, kind):
    df = keyed(spark, kind)
    whole = sorted(map(str, state_machine_alerts(df, "k", "q", "e").collect()))
    assert sorted(map(str, state_machine_alerts(df, "k", "q", "e", width).collect())) == whole
    assert {r.k for r in state_machine_alerts(df, "k", "q", "e", width).collect()} >= {None}
    car = W.running_sum(df.select("k", "q", "v", "ts"), "k", "q", "v", "d")
    got = sorted(map(str, delta_trigger_top(car, "k", "ts", "q", "v", "d", 12.0, "4 hours", width).collect()))
    want = []
    rows = [tuple(r) for r in car.select("k", "q", "v", "d", "ts").collect()]
    for k in {r[0] for r in rows}:
        seq, last = sorted(r[1:] for r in rows if r[0] == k), None
        for i, (q, v, d, t) in enumerate(seq):
            if last is None:
                last = d
            elif d - last > 12.0:
                last = d
                kept = [r for r in seq[:i + 1] if r[3] > t - dt.timedelta(hours=4)]
                top = max(kept, key=lambda r: (r[1], -r[0]))
                want.append((k, q, top[0]))
    fired = delta_trigger_top(car, "k", "ts", "q", "v", "d", 12.0, "4 hours", width)
    assert sorted(((r.k, r.fire_q, r.q) for r in fired.collect()), key=str) == sorted(want, key=str)
    assert len(got) == len(want)


@pytest.mark.parametrize("width", [2, 1 << 16])
def test_trigger_checks_order_across_blocks(spark, width):
    rows = [(1, 0, 1.0, 5.0, 0), (1, 1, 1.0, 6.0, 1), (1, 2, 1.0, 3.0, 2), (1, 3, 1.0, 9.0, 3)]
    df = spark.createDataFrame(rows, "k long, q long, v double, d double, s long").withColumn("ts", F.timestamp_seconds("s"))
    with pytest.raises(Exception, match="non-decreasing"):
        delta_trigger_top(df, "k", "ts", "q", "v", "d", 1.0, "1 hour", width).collect()


def test_trigger_subtracts(spark):
    import numpy as np
    d = np.array([0.1, 0.30000000000000004])
    assert _first_over(d, d[:1], 0.2)[0] == (1 if d[1] - d[0] > 0.2 else 2)
    rnd = np.random.default_rng(0)
    for _ in range(200):
        d = np.cumsum(rnd.integers(0, 4, 30) * 0.1)
        for last in d:
            over = np.flatnonzero(d - last > 0.2)
            assert _first_over(d, np.array([last]), 0.2)[0] == (over[0] if len(over) else len(d))


def test_feedback_loop_has_no_cap(spark):
    def brute(x, y):
        for n in range(1, 400):
            x, y = y, x + y
            if x >= 100 or y >= 100:
                return n
            if x <= 0 and y <= 0:
                return None
    big = (1 << 63) - 1
    pairs = [(-1, 1), (-3, 2), (0, 0), (0, 1), (-5, -1), (-7, 100), (big, big), (-big, 1), (-big, big), (big, -big),
             (-7540113804746346429, 4660046610375530309), (5, None), (100, 100)]
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "a long, b long, row int")
    got = {r.row: r.steps for r in fibonacci_steps(df, "a", "b").collect()}
    assert got == {i: None if p[1] is None else brute(*p) for i, p in enumerate(pairs)}
    assert got[0] == 13 and got[1] == 15


def test_latest_model_after_the_last_window(spark):
    model = spark.createDataFrame([(dt.datetime(2024, 1, 3), 2, 10)], "window_end timestamp, model_n long, model_sum long")
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 23)), (2, dt.datetime(2024, 1, 3)), (3, dt.datetime(2024, 1, 9)),
                                  (4, None)], "id int, ts timestamp")
    out = {r.id: r.model_sum for r in M.apply_latest_model(rows, "ts", model).collect()}
    assert out == {1: None, 2: 10, 3: 10, 4: None}
    none = M.apply_latest_model(rows, "ts", model.limit(0))
    assert {r.model_n for r in none.collect()} == {None}


def test_kmeans_with_many_centroids(spark):
    pts = spark.range(3000).select((F.col("id") % 70).cast("double").alias("x"), (F.col("id") / 70).alias("y"))
    seeds = spark.range(10_000).select(F.col("id"), (F.col("id") % 100).cast("double").alias("x"),
                                       (F.col("id") / 100).cast("double").alias("y"))
    out, cents = M.kmeans(pts, seeds, 1)
    assert out.where("cluster is null").count() == 0 and 1 < len(cents) <= 3000


def test_linear_regression_reads_once(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (2.0, 4.5)], "x double, y double")
    plan = M.linear_regression(df)._jdf.queryExecution().executedPlan().toString()
    assert "x" in plan
    assert M.linear_regression(df.limit(0)).first() == (None, None)
    assert M.linear_regression(df, iterations=0).first() == (0.0, 0.0)


def test_closure_cap_counts_supersteps(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(10)], "src long, dst long")
    for cap in (0, 1, 2, 5, 20):
        paths, _ = G.transitive_closure(edges, cap)
        assert max(r.dst - r.src for r in paths.collect()) == min(cap + 1, 10)


def test_components_of_a_long_chain_take_few_rounds(spark):
    n = 20_000
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "src long, dst long")
    labels, rounds = G.connected_components(spark.range(n + 1).withColumnRenamed("id", "id"), edges)
    assert {(r.component, r["count"]) for r in labels.groupBy("component").count().collect()} == {(0, n), (n, 1)}
    assert rounds <= 20


def test_group_reduce(spark):
    df = spark.range(50_000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("v")) \
        .unionByName(spark.createDataFrame([(None, 4), (None, 9), (8, None)], "k long, v long"))
    got = {r.k: r.v for r in R.group_reduce(df, ["k"], "v", lambda a, b: F.greatest(a, b)).collect()}
    assert got == {0: 49_998, 1: 49_999, 2: 49_997, None: 9, 8: None}
    got = {r.k: r.v for r in R.group_reduce(df, ["k"], "v", lambda a, b: (a + b) % 1009, F.lit(0)).collect()}
    assert got[0] == sum(i for i in range(0, 50_000, 3) if i % 7) % 1009 and got[8] == 0


def test_records_without_a_key_fail_and_null_fields_keep_their_place(spark):
    raw = spark.createDataFrame([('{"word": "a", "frequency": 1, "timestamp": 2}',)], "value string")
    assert [tuple(r) for r in streams.decode_word_events(raw).collect()] == [("a", 1, 2)]
    for bad in ('{"word": "a", "timestamp": 2}', '{"word": null, "frequency": 1, "timestamp": 2}', "no json"):
        with pytest.raises(Exception):
            streams.decode_word_events(spark.createDataFrame([(bad,)], "value string")).collect()
    df = spark.createDataFrame([(None, 5, 7)], "word string, frequency int, timestamp1 long")
    assert streams.encode_word_events(df).first().value == ",5,7"
    assert df.select(sinks.tuple_line(df.columns)).first()[0] == "(null,5,7)"


def test_relative_paths_of_any_store(spark, tmp_path):
    df = spark.createDataFrame([("hdfs://n:1/a/b/x",), ("hdfs://n:1/a/c/x",)], "path string")
    assert [r[0] for r in df.select(relative_to("path", "hdfs://n:1/a/")).collect()] == ["b/x", "c/x"]
    with pytest.raises(Exception, match="not below"):
        df.select(relative_to("path", "hdfs://n:1/b")).collect()
    for d in ("p", "q"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "same").write_text(d)
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        assert sorted(r.relative_path for r in manifest(spark, root).collect()) == ["p/same", "q/same"]


def test_route_splits_completely(spark):
    df = spark.createDataFrame([("abc",), ("abcdef",), ("",), (None,)], "t string")
    kept, rest = route(df, token_route("t") == "kept")
    assert [r.t for r in kept.collect()] == ["abc"] and rest.count() == 3


def test_eight_byte_events_of_any_address(spark):
    import struct
    rnd = random.Random(2)
    rows = [(a, rnd.choice("abcdefg")) for a in [0, 1, -1, 127, 128, 255, 256, 0x80C3A9EB - (1 << 32), 2**31 - 1, -2**31]
            + [rnd.randint(-2**31, 2**31 - 1) for _ in range(200)]]
    df = spark.createDataFrame(rows, "address int, type string")
    raw = streams.encode_state_events(df)
    assert [bytes(r.value) for r in raw.collect()] == [struct.pack("<ii", a, "abcdefg".index(t)) for a, t in rows]
    assert [tuple(r) for r in streams.decode_state_events(raw).collect()] == rows
