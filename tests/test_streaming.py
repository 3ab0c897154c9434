"""Streaming forms against their batch forms: parquet files feed a file
stream (one file per micro-batch), results go to a memory sink."""

import os
import random
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from rivulet.operators.statemachine import state_machine_alerts as batch_alerts
from rivulet.operators.windows import running_sum
from rivulet.streaming import stateful as ST
from rivulet.streaming import windows as SW


def _stream_from(spark, pdfs, schema):
    d = tempfile.mkdtemp(prefix="rivulet-stream-in-")
    for i, pdf in enumerate(pdfs):
        spark.createDataFrame(pdf, schema).coalesce(1).write.parquet(os.path.join(d, f"b{i:03d}"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(d)


def _run(df, name, mode="append"):
    ckpt = tempfile.mkdtemp(prefix="rivulet-stream-ckpt-")
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)


def _events(n=300, seed=1):
    rnd = random.Random(seed)
    return pd.DataFrame({"k": [rnd.randint(0, 4) for _ in range(n)], "q": list(range(n)),
                         "v": [rnd.randint(0, 50) for _ in range(n)],
                         "e": [rnd.choice("abcdeg") for _ in range(n)]})


def test_running_totals_stream_equals_batch(spark):
    ev = _events()
    schema = "k long, q long, v long, e string"
    stream = _stream_from(spark, [ev.iloc[i:i + 60] for i in range(0, len(ev), 60)], schema)
    got = _run(ST.running_totals(stream, "k", "q", "v", "total"), "rt")
    batch = running_sum(spark.createDataFrame(ev, schema), "k", "q", "v", "total")
    assert sorted(map(tuple, got.select("k", "q", "total").collect())) == \
        sorted(map(tuple, batch.select("k", "q", "total").collect()))


def test_state_machine_stream_equals_batch(spark):
    ev = _events(400, 2)
    schema = "k long, q long, v long, e string"
    stream = _stream_from(spark, [ev.iloc[i:i + 70] for i in range(0, len(ev), 70)], schema)
    got = _run(ST.state_machine_alerts(stream, "k", "q", "e"), "sm")
    batch = batch_alerts(spark.createDataFrame(ev, schema), "k", "q", "e", width=16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_session_and_tumbling_streams(spark):
    rows = [("a", 1), ("b", 1), ("b", 3), ("b", 5), ("c", 6), ("a", 10), ("c", 11),
            ("zz", 10_000)]                      # far-future row flushes open windows
    pdf = pd.DataFrame(rows, columns=["key", "ms"])
    schema = "key string, ms long"
    stream = _stream_from(spark, [pdf.iloc[:4], pdf.iloc[4:7], pdf.iloc[7:]], schema)
    timed = SW.event_time(stream.withColumn("t", F.timestamp_millis("ms")), "t", "0 seconds")
    sess = _run(SW.session_windows(timed, "event_time", "3 milliseconds", ["key"],
                                   [F.min("ms").alias("first"), F.count(F.lit(1)).alias("n")]), "sess")
    got = sorted((r.key, r.first, r.n) for r in sess.collect() if r.key != "zz")
    assert got == sorted([("a", 1, 1), ("c", 6, 1), ("c", 11, 1), ("b", 1, 3), ("a", 10, 1)])

    stream2 = _stream_from(spark, [pdf.iloc[:4], pdf.iloc[4:7], pdf.iloc[7:]], schema)
    timed2 = SW.event_time(stream2.withColumn("t", F.timestamp_millis("ms")), "t", "0 seconds")
    tumb = _run(SW.windowed_counts(timed2, "event_time", "5 milliseconds", [],
                                   [F.count(F.lit(1)).alias("n")]), "tumb")
    counts = sorted(r.n for r in tumb.collect())
    assert counts == [2, 2, 3]                   # [0,5): a1 b1 b3 ; [5,10): b5 c6 ; [10,15): a10 c11


def test_window_join_stream(spark):
    grades = pd.DataFrame({"name": ["tom", "tom", "ann", "bob"], "grade": [1, 2, 3, 4],
                           "ms": [100, 2500, 200, 300]})
    salaries = pd.DataFrame({"name": ["tom", "ann", "ann", "bob"], "salary": [10, 20, 30, 40],
                             "ms": [1500, 1900, 2100, 9000]})
    g = _stream_from(spark, [grades], "name string, grade int, ms long")
    s = _stream_from(spark, [salaries], "name string, salary int, ms long")
    gl = SW.event_time(g.withColumn("t", F.timestamp_millis("ms")), "t", "0 seconds", "gt")
    sl = SW.event_time(s.withColumn("t", F.timestamp_millis("ms")), "t", "0 seconds", "st")
    j = SW.window_join(gl.select("name", "grade", "gt"), sl.select("name", "salary", "st"),
                       ["name"], "gt", "st", "2 seconds")
    got = sorted((r.name, r.grade, r.salary) for r in _run(j.select("name", "grade", "salary"), "wj").collect())
    assert got == [("ann", 3, 20), ("tom", 1, 10)]


def test_side_outputs_foreach_batch(spark):
    pdf = pd.DataFrame({"line": ["hello wonderful world", "a bb extraordinary"]})
    stream = _stream_from(spark, [pdf.iloc[:1], pdf.iloc[1:]], "line string")
    from rivulet.functions.text import nonword_tokens
    toks = stream.select(F.explode(nonword_tokens("line")).alias("t"))
    seen = {"kept": [], "rejected": []}

    def sink(name):
        return lambda df, bid: seen[name].extend(r[0] for r in df.collect())

    ckpt = tempfile.mkdtemp(prefix="rivulet-side-")
    q = SW.split_outputs(toks, {
        "kept": lambda b: b.where(F.length("t").between(1, 5)),
        "rejected": lambda b: b.where(F.length("t") > 5).select(F.concat(F.lit("rejected: "), "t")),
    }, {"kept": sink("kept"), "rejected": sink("rejected")}) \
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(seen["kept"]) == ["a", "bb", "hello", "world"]
    assert sorted(seen["rejected"]) == ["rejected: extraordinary", "rejected: wonderful"]


def test_count_window_pattern_trigger_streams_equal_batch(spark):
    from rivulet.operators import patterns as P
    from rivulet.operators import windows as W
    from rivulet.operators.trigger import delta_trigger_top
    rnd = random.Random(8)
    n = 360
    pdf = pd.DataFrame({"k": [rnd.randint(0, 3) for _ in range(n)], "q": list(range(n)),
                        "v": [rnd.randint(0, 40) for _ in range(n)],
                        "e": [rnd.choice(["A", "B", "C"]) for _ in range(n)],
                        "ms": [i * 700 for i in range(n)]})
    pdf["d"] = pdf.groupby("k")["v"].cumsum()
    schema = "k long, q long, v long, e string, ms long, d long"
    parts = [pdf.iloc[i:i + 50] for i in range(0, n, 50)]
    batch = spark.createDataFrame(pdf, schema).withColumn("ts", F.timestamp_millis("ms"))

    s1 = _stream_from(spark, parts, schema)
    got = _run(ST.count_window_sums(s1, "k", "q", "v", 10, 5), "cw")
    want = W.count_window_sum(batch, "k", "q", "v", 10, 5, width=16)
    assert sorted(map(tuple, got.select("k", "q", "rn", "window_sum").collect())) == \
        sorted(map(tuple, want.select("k", "q", "rn", "window_sum").collect()))

    s2 = _stream_from(spark, parts, schema).withColumn("ts", F.timestamp_millis("ms"))
    got = _run(ST.followed_by(s2, "k", "q", "ts", "A", "B", "e", "2 seconds", ["v"]), "ab")
    want = P.followed_by(batch, "k", "q", "ts", F.col("e") == "A", F.col("e") == "B",
                         "2 seconds", ["q"], width=16)
    assert sorted((r.k, r.q, r.next_q) for r in got.collect()) == \
        sorted((r.k, r.q, r.next_q) for r in want.collect())

    s3 = _stream_from(spark, parts, schema).withColumn("ts", F.timestamp_millis("ms"))
    got = _run(ST.delta_trigger_top(s3, "k", "q", "ts", "v", "d", 50.0, 5_000_000), "dt")
    want = delta_trigger_top(batch, "k", "ts", "q", "v", "d", 50.0, "5 seconds")
    assert sorted((r.k, r.fire_q, r.q) for r in got.collect()) == \
        sorted((r.k, r.fire_q, r.q) for r in want.collect())


def test_connected_model_and_data_streams(spark):
    data = pd.DataFrame({"key": [1, 2, 3, 4, 5, 6], "t": [5, 12, 18, 25, 31, 40]})
    model = pd.DataFrame({"t": [10, 20, 30], "m": [1.0, 2.0, 3.0]})
    ds = _stream_from(spark, [data], "key long, t long")
    ms = _stream_from(spark, [model], "t long, m double")
    out = _run(ST.connected_apply(ds, ms, "key", "t", "m", buckets=4), "conn")
    preds = sorted((r.key, r.model) for r in out.where("kind = 'prediction'").collect())
    assert preds == [(1, None), (2, 1.0), (3, 1.0), (4, 2.0), (5, 3.0), (6, 3.0)]
    assert out.where("kind = 'update'").count() == 3


def test_json_token_counts_stream(spark):
    import json
    from rivulet.plans.relational import json_word_counts
    recs = [json.dumps({"id": i, "text": "Quiet River", "user": {"lang": "en"}}) for i in range(3)]
    recs.append(json.dumps({"id": 9, "text": "Quiet Lake", "user": {"lang": "de"}}))
    pdf = pd.DataFrame({"value": recs})
    stream = _stream_from(spark, [pdf.iloc[i:i + 1] for i in range(4)], "value string")
    counts = _run(json_word_counts(stream), "tw", mode="complete")
    assert sorted(map(tuple, counts.collect())) == [("quiet", 3), ("river", 3)]
    # one running count per token, as the keyed running sum emits them
    stream2 = _stream_from(spark, [pdf.iloc[i:i + 1] for i in range(4)], "value string")
    from rivulet.functions.text import delimiter_tokens
    parsed = stream2.select(F.from_json("value", "id long, text string, user struct<lang string>").alias("j"))
    toks = parsed.where(F.col("j.user.lang") == "en").select(
        F.col("j.id").alias("id"), F.posexplode(delimiter_tokens(F.col("j.text"))).alias("pos", "word"))
    toks = toks.select("word", (F.col("id") * 100 + F.col("pos")).alias("q"), F.lit(1).cast("long").alias("one"))
    running = _run(ST.running_totals(toks, "word", "q", "one", "n"), "tw2")
    assert sorted((r.word, r.n) for r in running.collect()) == \
        [("quiet", 1), ("quiet", 2), ("quiet", 3), ("river", 1), ("river", 2), ("river", 3)]


def test_binary_events_decoded_on_a_stream(spark):
    from rivulet.sources.streams import decode_state_events, encode_state_events
    rows = spark.createDataFrame([(1, "a"), (-7, "g"), (3, "c")], "address int, type string")
    d = tempfile.mkdtemp(prefix="rivulet-stream-bin-")
    encode_state_events(rows).coalesce(1).write.parquet(os.path.join(d, "b000"))
    stream = spark.readStream.schema("value binary").option("recursiveFileLookup", "true").parquet(d)
    got = _run(decode_state_events(stream), "bin")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_start_then_run_stream_equals_batch(spark):
    from rivulet.operators.patterns import start_then_run
    ev = _events(300, 4)
    schema = "k long, q long, v long, e string"
    ev = pd.concat([ev, pd.DataFrame({"k": range(5), "q": range(1000, 1005), "v": 0, "e": "z"})])  # ends open runs
    ev["e"] = ev["e"].where(~ev["e"].isin(list("cde")), "a")
    stream = _stream_from(spark, [ev.iloc[i:i + 45] for i in range(0, len(ev), 45)], schema)
    got = _run(ST.start_then_run(stream, "k", "q", "e", "a", ["q", "v"]), "sr")
    batch = start_then_run(spark.createDataFrame(ev, schema), "k", "q", F.col("e") == "a", ["q", "v"], width=16)
    cols = ["k", "start_q", "start_v", "last_a", "run_length"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    assert got.count() > 20


def test_fractions_and_skipping_matches_on_streams(spark):
    ev = pd.DataFrame({"k": 1, "q": range(1, 31), "v": 0.5, "e": "A"})
    schema = "k long, q long, v double, e string"
    parts = [ev.iloc[i:i + 7] for i in range(0, len(ev), 7)]
    got = _run(ST.count_window_sums(_stream_from(spark, parts, schema), "k", "q", "v", 10, 5), "cf")
    assert {r.q: r.window_sum for r in got.collect()} == {5: 2.5, 10: 5.0, 15: 5.0, 20: 5.0, 25: 5.0, 30: 5.0}
    got = _run(ST.running_totals(_stream_from(spark, parts, schema), "k", "q", "v", "total"), "rf")
    assert {r.q: r.total for r in got.collect()} == {q: q / 2 for q in range(1, 31)}
    ev["ts"] = pd.to_datetime("2024-01-01") + pd.to_timedelta(ev["q"], unit="s")
    schema += ", ts timestamp"
    parts = [ev.iloc[i:i + 7] for i in range(0, len(ev), 7)]
    got = _run(ST.followed_by(_stream_from(spark, parts, schema), "k", "q", "ts", "A", "A", "e", "1 hour", []), "fa")
    assert sorted((r.q, r.next_q) for r in got.collect()) == [(q, q + 1) for q in range(1, 31, 2)]


def test_processing_time_and_settings(spark):
    from rivulet.streaming import config
    ev = _events(40)
    stream = _stream_from(spark, [ev], "k long, q long, v long, e string")
    counts = SW.windowed_counts(SW.arrival_time(stream), "arrival", "1 hour", ["k"], [F.sum("v").alias("s")])
    got = _run(counts, "pt", "update")
    assert sum(r.s for r in got.collect()) == ev["v"].sum()
    assert config.low_latency_trigger("1 second") == {"processingTime": "1 second"}
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    try:
        config.use_rocksdb_state(spark)
        assert spark.conf.get(key) == config.ROCKSDB_PROVIDER
        totals = ST.running_totals(_stream_from(spark, [ev], "k long, q long, v long, e string"), "k", "q", "v", "t")
        assert _run(totals, "rd").count() == len(ev)
    finally:
        spark.conf.set(key, before)
