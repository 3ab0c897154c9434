"""Relational and text queries over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rivulet.functions.codecs import int_to_ipv4
from rivulet.functions.text import delimiter_tokens, whitespace_tokens
from rivulet.operators import relational as R
from rivulet.plans.catalog import query
from rivulet.session import checkpoint_dir
from rivulet.sources.tables import table


@query("tpch_q3", sql="""
SELECT l_orderkey, o_orderdate, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE c_mktsegment = 'AUTOMOBILE' AND o_orderdate < TIMESTAMP '1995-03-12'
  AND l_shipdate > TIMESTAMP '1995-03-12'
GROUP BY l_orderkey, o_orderdate
""")
def tpch_q3(spark, sf):
    return R.shipping_priority(table(spark, sf, "lineitem"), table(spark, sf, "customer"),
                               table(spark, sf, "orders"))


_Q10_SQL = """
WITH rev AS (
  SELECT o_custkey, sum(l_extendedprice * (1 - l_discount)) AS rev
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey
  WHERE year(o_orderdate) > {year} AND l_returnflag = 'R'
  GROUP BY o_custkey)
SELECT c_custkey, c_name, n_name, c_acctbal, round(rev, 4) AS revenue
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN rev ON c_custkey = o_custkey
"""


@query("tpch_q10", sql=_Q10_SQL.format(year=1990))
def tpch_q10(spark, sf):
    return R.returned_item_revenue(table(spark, sf, "customer"), table(spark, sf, "orders"),
                                   table(spark, sf, "lineitem"), table(spark, sf, "nation"))


@query("tpch_q10_late", sql=_Q10_SQL.format(year=1998))
def tpch_q10_late(spark, sf):
    return R.returned_item_revenue(table(spark, sf, "customer"), table(spark, sf, "orders"),
                                   table(spark, sf, "lineitem"), table(spark, sf, "nation"),
                                   after_year=1998)


# Documents play all three web-log tables: the text, the rank (n_chars) and
# the visit log (labels flagged toxic).
@query("weblog", sql="""
SELECT r.n_chars, r.doc_id, r.lang
FROM documents d JOIN documents r ON d.doc_id = r.doc_id
WHERE contains(d.text, ' the ') AND contains(d.text, ' and ') AND r.n_chars > 40
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.toxic = 1 AND l.doc_id = r.doc_id)
""")
def weblog(spark, sf):
    docs = table(spark, sf, "documents")
    visits = table(spark, sf, "labels").where(F.col("toxic") == 1)
    return R.weblog_analysis(docs, docs, visits, keywords=[" the ", " and "], min_rank=40,
                             key="doc_id", text="text", rank="n_chars", rank_cols=["lang"])


def _triples(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return (docs.join(labels, "doc_id", "left")
            .select("doc_id", F.col("lang").alias("f0"), F.col("source").alias("f1"),
                    F.col("quality").cast("string").alias("f2")))


_TRIPLES_SQL = """
WITH t AS (SELECT d.doc_id, d.lang AS f0, d.source AS f1, CAST(l.quality AS VARCHAR) AS f2
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def _blank_sql(c):
    return f"({c} IS NULL OR regexp_matches({c}, '^[\\x00-\\x20]*$'))"


@query("empty_fields", sql=_TRIPLES_SQL + f"""
SELECT doc_id, f0, f1, f2 FROM t
WHERE NOT {_blank_sql('f0')} AND NOT {_blank_sql('f1')} AND NOT {_blank_sql('f2')}
""")
def empty_fields(spark, sf):
    return R.rows_without_blanks(_triples(spark, sf), ["f0", "f1", "f2"])


@query("empty_field_counts", sql=_TRIPLES_SQL + f"""
SELECT CAST(sum(CASE WHEN {_blank_sql('f0')} THEN 1 ELSE 0 END) AS BIGINT) AS blank_f0,
       CAST(sum(CASE WHEN {_blank_sql('f1')} THEN 1 ELSE 0 END) AS BIGINT) AS blank_f1,
       CAST(sum(CASE WHEN {_blank_sql('f2')} THEN 1 ELSE 0 END) AS BIGINT) AS blank_f2
FROM t
""")
def empty_field_counts(spark, sf):
    return R.blank_counts(_triples(spark, sf), ["f0", "f1", "f2"])


@query("empty_fields_in_flight", sql=_TRIPLES_SQL + f"""
SELECT count(*) AS n_rows, count(*) FILTER (NOT {_blank_sql('f0')} AND NOT {_blank_sql('f1')} AND NOT {_blank_sql('f2')}) AS n_kept,
       count(*) FILTER ({_blank_sql('f0')}) AS blank_f0, count(*) FILTER ({_blank_sql('f1')}) AS blank_f1,
       count(*) FILTER ({_blank_sql('f2')}) AS blank_f2
FROM t
""")
def empty_fields_in_flight(spark, sf):
    """Counters that are taken while the kept rows are written."""
    cols = ["f0", "f1", "f2"]
    watched, seen = R.observed_blanks(_triples(spark, sf), cols)
    path = f"{checkpoint_dir(spark).rstrip('/')}/rivulet-kept/{uuid.uuid4().hex}"
    R.rows_without_blanks(watched, cols).write.parquet(path)
    counted = seen.get
    return spark.read.parquet(path).agg(
        F.lit(counted["rows"]).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_kept"),
        *[F.lit(n).cast("long").alias(f"blank_{c}") for c, n in zip(cols, counted["blanks"])])


@query("word_count", sql="""
SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\W+')) AS word FROM documents)
WHERE word <> ''
GROUP BY word
""")
def word_count(spark, sf):
    docs = table(spark, sf, "documents").select("text")
    return R.word_count(docs, text="text")


@query("group_having", sql="""
SELECT o_custkey, count(*) AS frequency FROM orders GROUP BY o_custkey HAVING count(*) = 10
""")
def group_having(spark, sf):
    return R.group_sum_having(table(spark, sf, "orders"), "o_custkey", F.lit(1),
                              "frequency", F.col("frequency") == 10) \
        .select("o_custkey", F.col("frequency").cast("long").alias("frequency"))


_SEGMENT_SQL = """
SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS acctbal
FROM customer GROUP BY c_mktsegment HAVING sum(c_acctbal) > 0
"""


@query("sql_group_by", sql=_SEGMENT_SQL)
def sql_group_by(spark, sf):
    # the same SQL text, with the table bound as a DataFrame argument (no
    # session-wide temp view is registered)
    return spark.sql(_SEGMENT_SQL.replace("FROM customer", "FROM {customer}"),
                     customer=table(spark, sf, "customer"))


@query("object_join", sql="""
SELECT c_custkey, c_name, o_orderkey, o_totalprice
FROM customer JOIN orders ON c_custkey = o_custkey
""")
def object_join(spark, sf):
    users = table(spark, sf, "customer").select("c_custkey", "c_name")
    mails = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    pairs = R.record_pairs(users, mails, "c_custkey", "o_custkey", "user", "mail")
    return pairs.select("user.c_custkey", "user.c_name", "mail.o_orderkey", "mail.o_totalprice")


@query("predicate_share", sql="""
SELECT CAST(sum(CASE WHEN l_discount < 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS hits,
       count(*) AS total,
       1.0 * sum(CASE WHEN l_discount < 0.05 THEN 1 ELSE 0 END) / count(*) AS share
FROM lineitem
""")
def predicate_share(spark, sf):
    return R.predicate_share(table(spark, sf, "lineitem"), F.col("l_discount") < 0.05)


@query("json_lang_tokens", sql="""
SELECT word, count(*) AS n FROM (
  SELECT lower(regexp_replace(tok, '[ \\t\\n\\x0B\\f\\r]', '', 'g')) AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS tok
        FROM documents WHERE lang = 'en' AND text IS NOT NULL))
WHERE word <> ''
GROUP BY word
""")
def json_lang_tokens(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang")
    # Re-aimed live feed: each document becomes one JSON record.
    records = docs.select(F.to_json(F.struct("text", F.struct("lang").alias("user"))).alias("value"))
    return json_word_counts(records)


def json_word_counts(records):
    """Parse JSON records, keep ``user.lang == 'en'`` with a text field,
    tokenise and count per word. Usable on a stream (counts then update)."""
    schema = "text string, user struct<lang string>"
    # Parse once: the parsed struct comes out of a generator, so the
    # optimizer cannot substitute (and so repeat) from_json into each filter
    # and projection that reads a field of it.
    parsed = records.select(F.inline(F.array(F.from_json("value", schema, {"mode": "FAILFAST"}))))
    english = parsed.where((F.col("user.lang") == "en") & F.col("text").isNotNull())
    words = english.select(F.explode(delimiter_tokens(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("ip_format", sql="""
SELECT event_id,
       concat_ws('.', (ip >> 24) & 255, (ip >> 16) & 255, (ip >> 8) & 255, ip & 255) AS ip
FROM (SELECT event_id, CAST(user_id % 127 * 16777259 AS BIGINT) & 4294967295 AS ip FROM events)
""")
def ip_format(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", int_to_ipv4((F.col("user_id") % 127 * 16777259).cast("int")).alias("ip"))


@query("group_reduce_xor", sql="""
SELECT l_orderkey, CAST(bit_xor(CAST(l_partkey AS BIGINT)) AS BIGINT) AS parts FROM lineitem GROUP BY l_orderkey
""")
def group_reduce_xor(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").cast("long").alias("parts"))
    return R.group_reduce(li, ["l_orderkey"], "parts", lambda a, b: a.bitwiseXOR(b))


@query("whitespace_token_count", sql="""
SELECT conv_id, turn, len(regexp_split_to_array(regexp_replace(text, '\\s+$', ''), '\\s'))::INT AS n_tokens
FROM conversations WHERE text IS NOT NULL
""")
def whitespace_token_count(spark, sf):
    conv = table(spark, sf, "conversations").where(F.col("text").isNotNull())
    return conv.select("conv_id", "turn", F.size(whitespace_tokens("text")).alias("n_tokens"))
