"""Windows that hold a third of the rows, exclusive patterns, in-flight
counters, failing lookups."""

import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import patterns as P
from rivulet.operators import relational as R
from rivulet.operators import windows as W
from rivulet.operators.enrich import async_enrich


def test_a_hot_window_is_merged_from_parts(spark):
    """No call gets more than an Arrow batch, whatever a window holds."""
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), 5 if rnd.random() < 0.4 else rnd.randint(0, 300), rnd.choice([None, 1.5, 7.0, -2.0])) for _ in range(4000)]
    rows += [(None, 4, 1.0), (None, 4, 2.0)]
    df = spark.createDataFrame(rows, "k string, s long, v double").withColumn("ts", F.timestamp_seconds("s"))

    def part(g):
        assert len(g) <= 500
        return g.iloc[:1][["k", "window_start"]].assign(n=len(g), low=g["v"].min(), high=g["v"].max())

    def merge(g):
        return g.iloc[:1][["k", "window_start"]].assign(n=g["n"].sum(), low=g["low"].min(), high=g["high"].max())

    schema = "k string, window_start timestamp, n long, low double, high double"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = W.window_apply_parts(df, "ts", "10 seconds", ["k"], part, schema, merge, schema)
        got = sorted(map(repr, got.withColumn("low", F.nanvl("low", F.lit(None))).withColumn("high", F.nanvl("high", F.lit(None))).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = W.tumbling(df, "ts", "10 seconds", ["k"], [F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")])
    assert got == sorted(map(repr, want.select("k", "window_start", "n", "low", "high").collect()))


def test_exclusive_pattern(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.randint(0, 3), q, rnd.choice("ABC"), q * 10) for q in range(500)], "k long, q long, e string, s long") \
        .withColumn("ts", F.timestamp_seconds("s"))
    a, b = F.col("e") == "A", F.col("e") == "B"
    for one, two in ((P.followed_by(df, "k", "q", "ts", a, b, "1 minute", ["q"], 16, exclusive=x)
                      for x in (True, False)),
                     (P.followed_by_in_time(df, "ts", "q", a, b, "15 seconds", ["q"], 60, exclusive=x) for x in (True, False))):
        one, two = (sorted(map(tuple, x.select("k", "q", "next_q").collect())) for x in (one, two))
        assert one == two and one
    with pytest.raises(Exception, match="exclusive"):
        P.followed_by(df, "k", "q", "ts", a, a, "1 minute", ["q"], exclusive=True).collect()


def test_blanks_are_counted_in_the_pass_that_writes(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", " "), (None, "x"), ("b", "y"), ("\t", "")], "p string, q string")
    path = f"{tmpdir_fresh}/t"
    df.write.parquet(path)
    watched, seen = R.observed_blanks(spark.read.parquet(path), ["p", "q"])
    kept = R.rows_without_blanks(watched, ["p", "q"])
    assert kept._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    kept.write.parquet(f"{tmpdir_fresh}/out")
    assert seen.get == {"rows": 4, "blanks": [2, 2]}
    assert spark.read.parquet(f"{tmpdir_fresh}/out").count() == 1
    watched, seen = R.observed_blanks(df.limit(0), ["p"])
    watched.collect()
    assert seen.get == {"rows": 0, "blanks": [0]}


@pytest.mark.parametrize("ordered", [True, False])
def test_failing_lookups_in_a_column(spark, ordered):
    def service(n):
        if n % 7 == 3:
            raise ValueError(f"lost {n}")
        return f"v{n}"

    df = spark.createDataFrame([(i, i % 20) for i in range(300)], "i long, n long").repartition(3)
    got = async_enrich(df, "n", service, "v", capacity=4, ordered=ordered, errors="column")
    assert got.columns == ["i", "n", "v", "v_error"]
    assert sorted(map(tuple, got.collect())) == [
        (i, i % 20, None if i % 20 % 7 == 3 else f"v{i % 20}", f"lost {i % 20}" if i % 20 % 7 == 3 else None) for i in range(300)]
    with pytest.raises(Exception, match="lost"):
        async_enrich(df, "n", service, "v", ordered=ordered).collect()
    with pytest.raises(ValueError):
        async_enrich(df, "n", service, "v", errors="ignore")
