"""Replayable sources: every element once over restarts, windows closed by
the end of the input, the element clock."""

import os
import random
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from rivulet.operators import windows as W
from rivulet.sources.replay import counter_stream, replay_stream
from rivulet.streaming import stateful as ST
from rivulet.streaming import windows as SW


def scratch(name):
    return tempfile.mkdtemp(prefix=f"rivulet-{name}-")


def drain(df, out, ckpt, mode="append"):
    """One run over what the source offers."""
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def folder(spark, df, files):
    path = scratch("replay")
    df.repartitionByRange(files, "q").sortWithinPartitions("q").write.mode("overwrite").parquet(path)
    return path


def test_counters_once_over_restarts(spark):
    out, ckpt, progress = scratch("out"), scratch("ckpt"), scratch("progress")
    counts = [0]
    while counts[-1] < 993 and len(counts) < 20:
        stream = counter_stream(spark, 1000, 7, 10, rowsPerBatch=50, rowsPerPartition=20, progress=progress)
        drain(stream, out, ckpt)
        got = spark.read.parquet(out)
        counts.append(got.count())
        assert counts[-1] == got.distinct().count()
        if len(counts) == 3:
            # as if the driver had died before it recorded the batch's end:
            # the next run does it again
            last = max((f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()), key=int)
            os.remove(os.path.join(ckpt, "commits", last))
            os.remove(os.path.join(ckpt, "commits", f".{last}.crc"))
    assert len(counts) > 4
    assert sorted((r.n, r.ms) for r in spark.read.parquet(out).select(
        "n", F.unix_millis("event_time").alias("ms")).collect()) == [(n, (n - 6) * 10) for n in range(7, 1000)]


def test_an_offer_that_was_lost_is_made_up_for(spark):
    """The driver dies after the source has noted an offer that Spark never
    logged: nothing is lost or given twice."""
    out, ckpt, progress = scratch("out"), scratch("ckpt"), scratch("progress")
    stream = lambda: counter_stream(spark, 100, rowsPerBatch=30, progress=progress)
    drain(stream(), out, ckpt)
    with open(os.path.join(progress, "offered"), "w") as f:
        f.write("60")
    for _ in range(3):
        drain(stream(), out, ckpt)
    assert sorted(r.n for r in spark.read.parquet(out).collect()) == list(range(100))


def test_replay_is_in_order_and_whole(spark):
    df = spark.range(1000).select(F.col("id").alias("q"), F.concat(F.lit("v"), "id").alias("v"))
    path = folder(spark, df, 4)
    out = scratch("out")
    drain(replay_stream(spark, path, df.schema, counter="seq", rowsPerPartition=64), out, scratch("ckpt"))
    got = spark.read.parquet(out)
    assert sorted(map(tuple, got.select("q", "v", "seq").collect())) == [(i, f"v{i}", i) for i in range(1000)]


def events(spark, n=400):
    rnd, rows, at = random.Random(6), [], 0
    for q in range(n):
        at += rnd.choice([0, 100, 900, 4000])
        rows.append((rnd.choice("abc"), q, rnd.randint(0, 9), at))
    return spark.createDataFrame(rows, "k string, q long, v long, ms long").withColumn("ts", F.timestamp_millis("ms"))


def test_end_of_input_closes_sessions_and_windows(spark):
    df = events(spark)
    path = folder(spark, df, 3)
    stream = lambda: SW.until_end(replay_stream(spark, path, df.schema, marker="ts"), "ts")
    out = scratch("out")
    drain(SW.session_windows(stream(), "ts", "5 seconds", ["k"], [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")]),
          out, scratch("ckpt"))
    want = W.sessions(df, "k", "q", "ts", "5 seconds", [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")])
    assert sorted((r.k, r.session_start, r.n, r.s) for r in spark.read.parquet(out).collect()) == \
        sorted((r.k, r.session_start, r.n, r.s) for r in want.collect())
    out = scratch("out")
    drain(SW.windowed_counts(stream(), "ts", "10 seconds", ["k"], [F.sum("v").alias("s")]), out, scratch("ckpt"))
    want = W.tumbling(df, "ts", "10 seconds", ["k"], [F.sum("v").alias("s")])
    assert sorted((r.k, r.window_start, r.s) for r in spark.read.parquet(out).collect()) == \
        sorted((r.k, r.window_start, r.s) for r in want.collect())


def test_delta_trigger_until_the_end(spark):
    from rivulet.operators.trigger import delta_trigger_top
    df = events(spark).withColumn("d", F.col("q") * 1.5)
    path = folder(spark, df, 3)
    out = scratch("out")
    stream = SW.until_end(replay_stream(spark, path, df.schema, marker="ts"), "ts")
    drain(ST.delta_trigger_top(stream, "k", "q", "ts", "v", "d", 20.0, "30 seconds"), out, scratch("ckpt"))
    want = delta_trigger_top(df, "k", "ts", "q", "v", "d", 20.0, "30 seconds")
    assert sorted((r.k, r.fire_q, r.q) for r in spark.read.parquet(out).collect()) == \
        sorted((r.k, r.fire_q, r.q) for r in want.collect())


def test_element_clock_over_batches_and_restarts(spark):
    """Windows of 250 ms, which are 25 elements, against counting them."""
    df = events(spark, 330).select("k", "q", "v")
    path = folder(spark, df, 3)
    out, ckpt, progress = scratch("out"), scratch("ckpt"), scratch("progress")
    for _ in range(10):
        stream = SW.element_clock(replay_stream(spark, path, df.withColumn("event_time", F.lit(None).cast("timestamp"))
                                                .drop("event_time").schema, counter="seq", rowsPerBatch=47,
                                                progress=progress), "seq", 10)
        drain(SW.windowed_counts(stream, "event_time", "250 milliseconds", [],
                                 [F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")]), out, ckpt)
    got = {int(r.window_start.timestamp() * 1000 + 0.5): (r.s, r.n) for r in spark.read.parquet(out).collect()}
    model: dict[int, list] = {}
    for i, v in enumerate(pd.Series([r.v for r in df.orderBy("q").collect()])):
        model.setdefault((i + 1) * 10 // 250 * 250, []).append(int(v))
    closed = {w: (sum(x), len(x)) for w, x in model.items() if w + 250 <= 3300}  # the clock stands at 3300
    assert got == closed
