import random

import numpy as np
import pytest

from rivulet.operators.statemachine import TRANSITIONS, segmented_compose, state_machine_alerts


def _brute(rows):
    state, out = {}, []
    for k, q, e in sorted(rows, key=lambda r: (r[0], r[1])):
        s = state.get(k, "Initial")
        t = TRANSITIONS.get((s, e))
        if t is None:
            out.append((k, q, s, e))
        elif t == "Terminal":
            state.pop(k, None)
        else:
            state[k] = t
    return sorted(out)


def _rows(n=600, seed=5):
    rnd = random.Random(seed)
    # a biased walk so valid transitions are common
    return [(0 if rnd.random() < 0.4 else rnd.randint(1, 5), i, rnd.choice("aabbcdeg" + "f"))
            for i in range(n)]


@pytest.mark.parametrize("width", [3, 41, 100_000])
def test_alerts_match_sequential_model(spark, width):
    rows = _rows()
    df = spark.createDataFrame(rows, "k long, q long, e string")
    got = sorted(tuple(r) for r in state_machine_alerts(df, "k", "q", "e", width=width).collect())
    assert got == _brute(rows)


def test_alerts_across_small_arrow_batches(spark):
    rows = _rows(500, 9)
    df = spark.createDataFrame(rows, "k long, q long, e string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(tuple(r) for r in state_machine_alerts(df, "k", "q", "e", width=50).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _brute(rows)


def test_segmented_compose_matches_loop():
    rnd = np.random.default_rng(1)
    f = rnd.integers(0, 5, size=(50, 5)).astype(np.int8)
    starts = rnd.random(50) < 0.2
    starts[0] = True
    got = segmented_compose(f, starts)
    cur = None
    for i in range(50):
        cur = f[i].copy() if starts[i] else f[i][cur]
        assert (got[i] == cur).all()
