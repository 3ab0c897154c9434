"""Null, NaN and unknown events: batch and stream against a plain model."""

import os
import random
import tempfile
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rivulet.operators.statemachine import TRANSITIONS, state_machine_alerts
from rivulet.operators.trigger import delta_trigger_top
from rivulet.operators.windows import count_window_sum, running_sum
from rivulet.streaming import stateful as ST


def stream_of(spark, rows, schema, size=40):
    d = tempfile.mkdtemp(prefix="rivulet-odd-in-")
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], schema).coalesce(1).write.parquet(os.path.join(d, f"b{i:05d}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(d)


def run(df, name):
    q = (df.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="rivulet-odd-ckpt-")).trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(map(tuple, df.sparkSession.table(name).collect()), key=repr)


def alerts(rows):
    state, out = defaultdict(lambda: "Initial"), []
    for k, q, e in rows:
        if e is None:
            continue
        to = TRANSITIONS.get((state[k], e))
        if to is None:
            out.append((k, q, state[k], e))
        else:
            state[k] = "Initial" if to == "Terminal" else to
    return sorted(out, key=repr)


def test_state_machine_skips_nulls_and_reports_unknown_letters(spark):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 3), q, rnd.choice(["a", "a", "b", "c", "d", "e", "g", None, "?", "", "aa"])) for q in range(300)]
    rows += [(9, 400, "a"), (9, 401, None), (9, 402, "b"), (8, 403, None)]
    schema = "k long, q long, e string"
    want = alerts(rows)
    assert not any(r[0] == 9 for r in want) and any(r[3] == "?" for r in want)
    for width in (5, 1000):
        got = state_machine_alerts(spark.createDataFrame(rows, schema), "k", "q", "e", width)
        assert sorted(map(tuple, got.select("k", "q", "state", "event").collect()), key=repr) == want
    assert run(ST.state_machine_alerts(stream_of(spark, rows, schema), "k", "q", "e"), "odd_sm") == want


def top_speeds(rows, threshold, span):
    """(key, firing, winner) of rows (key, q, second, speed, distance)."""
    last, seen, out = {}, defaultdict(list), []
    for k, q, t, v, d in rows:
        if None in (q, t, v, d) or v != v or d != d:
            continue
        seen[k].append((q, t, v))
        if k not in last:
            last[k] = d
        elif d - last[k] > threshold:
            last[k] = d
            inside = [(v2, -q2) for q2, t2, v2 in seen[k] if t2 > t - span]
            out.append((k, q, -max(inside)[1]))
    return sorted(out)


def test_delta_trigger_takes_measurements_only(spark):
    rnd, rows, at = random.Random(3), [], defaultdict(float)
    for q in range(400):
        k = rnd.randint(0, 2)
        at[k] += rnd.choice([0, 1, 3])
        rows.append((k, q, q * 2, rnd.choice([float(rnd.randint(0, 30)), None, float("nan"), 1e6 if q % 97 == 0 else 5.0]),
                     rnd.choice([at[k], at[k], at[k], None, float("nan")])))
    rows += [(1, 500, None, 9e9, at[1] + 100), (2, 501, 1002, float("nan"), at[2] + 100)]
    schema = "k long, q long, s long, v double, d double"
    want = top_speeds(rows, 12.0, 60)
    assert len(want) > 20
    timed = lambda df: df.withColumn("ts", F.timestamp_seconds("s"))
    for width in (20, 1000):
        got = delta_trigger_top(timed(spark.createDataFrame(rows, schema)), "k", "ts", "q", "v", "d", 12.0, "60 seconds", width)
        assert sorted((r.k, r.fire_q, r.q) for r in got.collect()) == want
        assert got.where("v is null or isnan(v) or d is null").isEmpty()
    got = run(ST.delta_trigger_top(timed(stream_of(spark, rows, schema)), "k", "q", "ts", "v", "d", 12.0, "60 seconds"), "odd_dt")
    assert sorted(r[:3] for r in got) == want


@pytest.mark.parametrize("kind", ["int", "long", "double"])
def test_running_totals_and_count_windows_pass_over_nulls(spark, kind):
    rnd = random.Random(4)
    whole = kind != "double"
    rows = [(rnd.randint(0, 2), q, rnd.choice([None, 1, 7] if whole else [None, 0.5, 2.25])) for q in range(150)]
    rows[0] = (rows[0][0], 0, None)
    schema = f"k long, q long, v {kind}"
    df = spark.createDataFrame(rows, schema)
    want = sorted(map(tuple, running_sum(df, "k", "q", "v", "total", width=16).select("k", "q", "total").collect()), key=repr)
    got = run(ST.running_totals(stream_of(spark, rows, schema), "k", "q", "v", "total"), f"odd_rt_{kind}")
    assert [(a, b, float(c)) for a, b, c in got] == [(a, b, float(c)) for a, b, c in want]
    want = sorted(map(tuple, count_window_sum(df, "k", "q", "v", 10, 5, width=16).select(
        "k", "q", "rn", "window_sum").collect()), key=repr)
    got = run(ST.count_window_sums(stream_of(spark, rows, schema), "k", "q", "v", 10, 5), f"odd_cw_{kind}")
    assert [(*r[:3], float(r[3])) for r in got] == [(*r[:3], float(r[3] or 0)) for r in want]
