import os

from pyspark.sql import functions as F

from rivulet.functions.codecs import alert_text, int_to_ipv4
from rivulet.functions.text import delimiter_tokens, token_route, whitespace_tokens
from rivulet.operators.files import copy_files, copy_totals, manifest
from rivulet.sources import files as S
from rivulet.sources import streams as K
from rivulet import sinks


def test_ipv4_and_alert(spark):
    df = spark.createDataFrame([(-1062731519,), (16909060,)], "ip int")
    got = [r[0] for r in df.select(int_to_ipv4("ip")).collect()]
    assert got == ["192.168.1.1", "1.2.3.4"]
    txt = df.limit(1).select(alert_text("ip", F.lit("W"), F.lit("c"))).first()[0]
    assert txt == "ALERT 192.168.1.1 : W -> c"


def test_state_event_roundtrip(spark):
    df = spark.createDataFrame([(-5, "a"), (2147483647, "g"), (0, "d")], "address int, type string")
    back = K.decode_state_events(K.encode_state_events(df))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    assert len(K.encode_state_events(df).first()[0]) == 8


def test_word_event_codecs(spark):
    raw = spark.createDataFrame([('{"word":"bob","frequency":2,"timestamp":7}',)], "value string")
    dec = K.decode_word_events(raw)
    assert tuple(dec.first()) == ("bob", 2, 7)
    assert K.encode_word_events(dec).first()[0] == "bob,2,7"


def test_tokenisers(spark):
    df = spark.createDataFrame([(" a  b \t",)], "t string")
    assert df.select(whitespace_tokens("t")).first()[0] == ["", "a", "", "b"]
    df2 = spark.createDataFrame([("Hello\u000bWorld  FOO\tbar",)], "t string")
    assert df2.select(delimiter_tokens("t")).first()[0] == ["helloworld", "foo", "bar"]
    routes = spark.createDataFrame([("",), ("abcde",), ("abcdef",)], "w string").select(token_route("w")).collect()
    assert [r[0] for r in routes] == [None, "kept", "rejected"]


def test_delimited_and_tuple_sources(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "li.tbl")
    with open(p, "w") as fh:
        fh.write("1|x|3.5|1995-01-02|\n2|y|4.5|1996-01-02|\n")
    df = S.delimited(spark, p, "a long, b string, c double, d string", "|", [0, 2, 3], ["k", "price", "day"])
    assert [tuple(r) for r in df.collect()] == [(1, 3.5, "1995-01-02"), (2, 4.5, "1996-01-02")]
    t = spark.createDataFrame([("(1,50,100.5,1000)",)], "v string")
    parsed = S.tuple_text(t, "v", ["car", "speed", "dist", "ts"], ["int", "int", "double", "long"])
    assert tuple(parsed.first()) == (1, 50, 100.5, 1000)
    e = os.path.join(tmpdir_fresh, "edges.txt")
    with open(e, "w") as fh:
        fh.write("1 2\n2 3\n")
    assert S.edge_list(spark, e).count() == 2
    assert S.integer_range(spark, 1, 10).count() == 10


def test_sinks_and_file_copy(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "w string, n long")
    src = os.path.join(tmpdir_fresh, "src")
    sinks.write_delimited(df, os.path.join(src, "csv"), " ")
    sinks.write_text(df, os.path.join(src, "txt"), single_file=True)
    sinks.discard(df)
    os.makedirs(os.path.join(src, "empty_dir"))
    man = manifest(spark, src)
    files = {r.relative_path: r.length for r in man.collect()}
    assert any(k.startswith("txt/part-") for k in files)
    dst = os.path.join(tmpdir_fresh, "dst")
    copied = copy_files(man, dst)
    tot = copy_totals(copied).first()
    assert tot.files_copied == len(files) and tot.bytes_copied == sum(files.values())
    for rel, n in files.items():
        assert os.path.getsize(os.path.join(dst, rel)) == n
    assert not os.path.exists(os.path.join(dst, "empty_dir"))


def test_in_memory_rows_and_clock(spark):
    from rivulet.streaming.windows import clock_from_sequence
    df = S.from_rows(spark, [(0, "a"), (1, "b"), (2, "c")], "n long, w string")
    out = clock_from_sequence(df, "n", 10).select(F.unix_millis("event_time").alias("ms")).collect()
    assert [r.ms for r in out] == [0, 10, 20]
