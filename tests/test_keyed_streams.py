"""transformWithState operators against their batch forms."""

import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from rivulet.operators import patterns as P
from rivulet.operators.statemachine import state_machine_alerts
from rivulet.operators.windows import running_sum
from rivulet.sources.replay import replay_stream
from rivulet.streaming import config, keyed
from rivulet.streaming import windows as SW

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture()
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    config.use_rocksdb_state(spark)
    yield spark
    spark.conf.set(PROVIDER, before)


def scratch(name):
    return tempfile.mkdtemp(prefix=f"rivulet-{name}-")


def folder(df, files=4):
    path = scratch("keyed")
    df.repartitionByRange(files, "q").sortWithinPartitions("q").write.mode("overwrite").parquet(path)
    return path


def drain(spark, build, df, size=None, marker=None):
    """The output of ``build(stream)`` over the rows of ``df``, ``size`` at
    most in a micro-batch, stopped and started anew until all are given."""
    path, progress, out, ckpt = folder(df), scratch("progress"), scratch("out"), scratch("ckpt")
    paced = {"rowsPerBatch": size, "progress": progress} if size else {}
    n = df.count() + bool(marker)
    for _ in range(20):
        whole = not size or (os.path.exists(f"{progress}/offered") and int(open(f"{progress}/offered").read()) >= n)
        stream = build(replay_stream(spark, path, df.schema, marker=marker, **paced))
        q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        if not q.awaitTermination(60):
            q.stop()
            raise TimeoutError("a run took more than a minute")
        if whole:
            return spark.read.schema(stream.schema).parquet(out)
    raise TimeoutError("the source is not drained")


def same(got, want, *cols):
    one, two = (sorted(map(tuple, x.select(*cols).collect()), key=repr) for x in (got, want))
    assert one == two and one


def events(spark, n=360):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 4), q, rnd.choice([None, 1, 2, 30]), rnd.choice(["a", "a", "b", "c", "d", "e", "g", None, "?"]))
            for q in range(n)]
    return spark.createDataFrame(rows, "k long, q long, v long, e string")


def test_totals_and_machine_equal_batch(rocks):
    df = events(rocks)
    got = drain(rocks, lambda s: keyed.running_totals(s, "k", "q", "v", "total"), df, 80)
    same(got, running_sum(df, "k", "q", "v", "total", width=16).select("k", "q", "total"), "k", "q", "total")
    got = drain(rocks, lambda s: keyed.state_machine_alerts(s, "k", "q", "e"), df, 80)
    same(got, state_machine_alerts(df, "k", "q", "e"), "k", "q", "state", "event")


def test_idle_keys_lose_their_state(rocks):
    path, ckpt = scratch("idle"), scratch("ckpt")

    def feed(i, rows):
        rocks.createDataFrame(rows, "k long, q long, v long").coalesce(1).write.parquet(f"{path}/b{i}")

    def totals(idle):
        return keyed.running_totals(rocks.readStream.schema("k long, q long, v long").option(
            "recursiveFileLookup", "true").parquet(path), "k", "q", "v", "total", idle)

    feed(0, [(1, 0, 5), (2, 1, 7)])
    out = scratch("out")

    def go():
        # with processing time Spark plans batches without data for ever
        q = (totals(4000).writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .trigger(once=True).start())
        assert q.awaitTermination(60)

    go()
    time.sleep(5)
    feed(1, [(1, 3, 1), (2, 4, 1)])
    go()
    feed(2, [(1, 5, 2)])
    go()
    got = {r.q: r.total for r in rocks.read.parquet(out).collect()}
    assert got[0] == 5 and got[1] == 7 and got[3] == 1 and got[4] == 1 and got[5] in (2, 3)


def test_connected_streams(rocks):
    rnd = random.Random(2)
    data = rocks.createDataFrame([(rnd.randint(0, 99), t) for t in range(1, 200, 2)], "key long, q long")
    model = rocks.createDataFrame([(t, t / 2) for t in range(40, 200, 40)], "q long, m double")
    path = folder(model)
    out = drain(rocks, lambda s: keyed.connected_apply(s, replay_stream(rocks, path, model.schema), "key", "q", "m", 5), data)
    got = sorted((r.key, r.q, r.model) for r in out.where("kind = 'prediction'").collect())
    assert [g[:2] for g in got] == sorted((r.key, r.q) for r in data.collect())
    assert all(m == (q // 40 * 20.0 if q >= 40 else None) for _, q, m in got)
    assert sorted(r.model for r in out.where("kind = 'update'").collect()) == [20.0, 40.0, 60.0, 80.0]


@pytest.mark.parametrize("block, within", [("20 seconds", "4 seconds"), ("3 seconds", "7 seconds")])
def test_global_pattern_out_of_order(rocks, block, within):
    """Files hold the rows out of order; the watermark waits for them and the
    end marker releases the last blocks."""
    rnd, rows, at = random.Random(7), [], 1_000
    for i in range(500):
        at += rnd.choice([0, 0, 100, 900, 2500, 30_000 if i % 60 == 0 else 1000])
        rows.append([i, rnd.choice(["A", "B", "B", "A", "C"]), rnd.random(), at])
    for r in rows:
        r.append(r[3] + rnd.randint(0, 3_000))  # when it arrives
    rows.append([500, "A", 0.5, None, 5])
    rows.sort(key=lambda r: r[4])
    df = (rocks.createDataFrame([(*r[:4], q) for q, r in enumerate(rows)], "id long, e string, x double, ms long, q long")
          .withColumn("ts", F.timestamp_millis("ms")))
    got = drain(rocks, lambda s: keyed.followed_by_in_time(
        SW.until_end(s, "ts", "4 seconds"), "ts", "id", F.col("e") == "A", F.col("e") == "B", within, ["x"], block),
        df, 90, "ts")
    want = P.followed_by_in_time(df, "ts", "id", F.col("e") == "A", F.col("e") == "B", within, ["id", "x"])
    same(got, want, "ts", "id", "x", "next_id", "next_x")
    assert got.count() > 50
