import time

import pytest

from rivulet.operators.enrich import async_enrich, modulo_key


def test_async_enrich_ordered_and_unordered(spark):
    df = spark.range(0, 200, 1, 4).withColumnRenamed("id", "n")

    def slow(n):
        time.sleep(0.001 * (n % 3))
        return modulo_key(n)

    ordered = async_enrich(df, "n", slow, "key", capacity=5, timeout_s=5.0, ordered=True)
    rows = ordered.collect()
    assert [r.n for r in rows] == list(range(200))
    assert all(r.key == f"key-{r.n % 10}" for r in rows)
    unordered = async_enrich(df, "n", slow, "key", capacity=5, timeout_s=5.0, ordered=False)
    got = sorted((r.n, r.key) for r in unordered.collect())
    assert got == [(n, f"key-{n % 10}") for n in range(200)]
    counts = {r.key: r["count"] for r in unordered.groupBy("key").count().collect()}
    assert counts == {f"key-{i}": 20 for i in range(10)}


def test_a_late_call_fails_without_waiting_for_it(spark):
    for ordered in (True, False):
        df = spark.range(0, 4, 1, 1).withColumnRenamed("id", "n")
        late = async_enrich(df, "n", lambda n: time.sleep(20 * (n == 2)), "key", timeout_s=0.2, ordered=ordered)
        began = time.monotonic()
        with pytest.raises(Exception, match="lookup timed out"):
            late.collect()
        assert time.monotonic() - began < 10


def test_a_slow_call_is_not_excused_by_others(spark):
    """The deadline counts from a call's own start."""
    df = spark.range(0, 40, 1, 1).withColumnRenamed("id", "n")
    late = async_enrich(df, "n", lambda n: time.sleep(15 if n == 0 else 0.05), "key", capacity=2, timeout_s=0.5, ordered=False)
    with pytest.raises(Exception, match="lookup timed out"):
        late.collect()
