from collections import Counter
import re

from pyspark.sql import functions as F

from rivulet.operators import relational as R


def test_shipping_priority_filters_and_sums(spark):
    cust = spark.createDataFrame([(1, "AUTOMOBILE"), (2, "BUILDING")], "c_custkey long, c_mktsegment string")
    orders = spark.sql("""SELECT * FROM VALUES
        (10L, 1L, TIMESTAMP_NTZ'1995-03-01'), (11L, 1L, TIMESTAMP_NTZ'1995-03-12'),
        (12L, 2L, TIMESTAMP_NTZ'1995-01-01') AS t(o_orderkey, o_custkey, o_orderdate)""")
    items = spark.sql("""SELECT * FROM VALUES
        (10L, 100.0D, 0.1D, TIMESTAMP_NTZ'1995-03-13'), (10L, 50.0D, 0.0D, TIMESTAMP_NTZ'1995-04-01'),
        (10L, 70.0D, 0.0D, TIMESTAMP_NTZ'1995-03-12'), (11L, 5.0D, 0.0D, TIMESTAMP_NTZ'1995-05-01'),
        (12L, 9.0D, 0.0D, TIMESTAMP_NTZ'1995-05-01')
        AS t(l_orderkey, l_extendedprice, l_discount, l_shipdate)""")
    rows = R.shipping_priority(items, cust, orders).collect()
    assert [(r.l_orderkey, r.revenue) for r in rows] == [(10, 140.0)]


def test_weblog_anti_join_keeps_left_duplicates(spark):
    docs = spark.createDataFrame([("u1", "x editors y oscillations z"), ("u2", "editors"),
                                  ("u3", " editors  oscillations ")], "url string, contents string")
    ranks = spark.createDataFrame([(50, "u1", 3), (50, "u1", 4), (41, "u3", 1), (10, "u2", 2)],
                                  "rank int, url string, avg_duration int")
    visits = spark.createDataFrame([("u3",)], "url string")
    out = R.weblog_analysis(docs, ranks, visits, [" editors ", " oscillations "], 40,
                            rank_cols=["avg_duration"])
    assert sorted(tuple(r) for r in out.select("rank", "url", "avg_duration").collect()) == \
        [(50, "u1", 3), (50, "u1", 4)]


def test_blank_fields_fixture(spark):
    rows = [("John", "Doe", "Foo Str."), ("Joe", "Johnson", ""), (None, "Kate Morn", "Bar Blvd."),
            ("Tim", "Rinny", ""), ("Alicia", "Jackson", "  ")]
    df = spark.createDataFrame(rows, "f0 string, f1 string, f2 string")
    kept = R.rows_without_blanks(df, ["f0", "f1", "f2"]).collect()
    assert [tuple(r) for r in kept] == [("John", "Doe", "Foo Str.")]
    counts = R.blank_counts(df, ["f0", "f1", "f2"]).first()
    assert tuple(counts) == (1, 0, 3)


def test_blank_includes_control_characters(spark):
    df = spark.createDataFrame([("\t\n\x01",), ("a",)], "f string")
    assert R.blank_counts(df, ["f"]).first()[0] == 1


def test_word_count_matches_python(spark):
    lines = ["To be, or not to be,--that is the question:--", "Whether 'tis nobler_in the mind",
             "", "ÉTÉ été x"]
    df = spark.createDataFrame([(l,) for l in lines], "line string")
    got = {r.word: r.n for r in R.word_count(df).collect()}
    want = Counter(w for l in lines for w in re.split(r"[^a-z0-9_]+", l.lower()) if w)
    assert got == dict(want)


def test_group_sum_having_and_pairs(spark):
    df = spark.createDataFrame([("Ciao", 1), ("Hello", 1), ("Hello", 1)], "word string, frequency long")
    out = R.group_sum_having(df, "word", "frequency", "frequency", F.col("frequency") == 2).collect()
    assert [tuple(r) for r in out] == [("Hello", 2)]
    users = spark.createDataFrame([(1, "Peter"), (2, "John"), (3, "Bill")], "userIdentifier int, name string")
    mails = spark.createDataFrame([(2, "a", "b"), (3, "c", "d"), (1, "e", "f")],
                                  "userId int, subject string, body string")
    pairs = R.record_pairs(users, mails, "userIdentifier", "userId", "user", "email").collect()
    assert len(pairs) == 3 and all(p.user.userIdentifier == p.email.userId for p in pairs)


def test_predicate_share(spark):
    df = spark.range(1, 101)
    r = R.predicate_share(df, F.col("id") <= 25, 4.0).first()
    assert (r.hits, r.total, r.share) == (25, 100, 1.0)
