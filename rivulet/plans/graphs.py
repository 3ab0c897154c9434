"""Graph queries. Two graphs are derived from ``orders`` over whole tables:

* customer graph - an edge from the customer of each order to the customer
  of the order with the next order key;
* order chains - an edge from each order to the same customer's next order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import graph as G
from rivulet.operators.sequence import neighbour
from rivulet.plans.catalog import query
from rivulet.sources.tables import table

CUST_EDGES_SQL = """SELECT a.o_custkey AS src, b.o_custkey AS dst
  FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1"""
CHAIN_EDGES_SQL = """SELECT src, dst FROM (
    SELECT o_orderkey AS src, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS dst
    FROM orders) WHERE dst IS NOT NULL"""


def customer_edges(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    a = o.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("src"))
    b = o.select((F.col("o_orderkey") - 1).alias("k"), F.col("o_custkey").alias("dst"))
    return a.join(b, "k").select("src", "dst")


def order_chains(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    nb = neighbour(o, "o_custkey", "o_orderkey", ["o_orderkey"], "next", "_n")
    return nb.where(F.col("_n").isNotNull()).select(
        F.col("o_orderkey").alias("src"), F.col("_n.o_orderkey").alias("dst"))


@query("connected_components", sql=f"""
WITH RECURSIVE e0 AS ({CUST_EDGES_SQL}),
e AS (SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0),
cc(vertex, component) AS (
  SELECT c_custkey, c_custkey FROM customer
  UNION
  SELECT e.dst, cc.component FROM cc JOIN e ON cc.vertex = e.src)
SELECT vertex, min(component) AS component FROM cc GROUP BY vertex
""")
def connected_components(spark, sf):
    verts = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    labels, _ = G.connected_components(verts, customer_edges(spark, sf))
    return labels


@query("transitive_closure", sql=f"""
WITH RECURSIVE e AS ({CHAIN_EDGES_SQL}),
tc(src, dst) AS (SELECT src, dst FROM e UNION SELECT tc.src, e.dst FROM tc JOIN e ON tc.dst = e.src)
SELECT src, dst FROM tc
""")
def transitive_closure(spark, sf):
    paths, _ = G.transitive_closure(order_chains(spark, sf))
    return paths


@query("triangles", sql=f"""
WITH e AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b
           FROM ({CUST_EDGES_SQL}) WHERE src <> dst)
SELECT e1.a AS v1, e1.b AS v2, e2.b AS v3
FROM e e1 JOIN e e2 ON e1.a = e2.a AND e1.b < e2.b
JOIN e e3 ON e3.a = e1.b AND e3.b = e2.b
""")
def triangles(spark, sf):
    return G.triangles(customer_edges(spark, sf))


def _pagerank_sql(steps=10, damping=0.85, eps=1e-4):
    parts = [f"""WITH e AS ({CUST_EDGES_SQL}),
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM customer),
deg AS (SELECT src, count(*) AS d FROM e GROUP BY src),
w AS (SELECT e.src, e.dst, CAST(deg.d AS DOUBLE) AS d FROM e JOIN deg USING (src)),
r0 AS (SELECT c_custkey AS id, 1.0::DOUBLE / (SELECT n FROM nn) AS rank FROM customer)"""]
    for k in range(1, steps + 1):
        parts.append(f"""r{k} AS (SELECT w.dst AS id,
    sum(r{k-1}.rank / w.d) * {damping}::DOUBLE + (1.0::DOUBLE - {damping}::DOUBLE) / (SELECT n FROM nn) AS rank
  FROM r{k-1} JOIN w ON r{k-1}.id = w.src GROUP BY w.dst),
m{k} AS (SELECT {k} AS k, count(*) AS moved FROM r{k} JOIN r{k-1} USING (id)
         WHERE abs(r{k}.rank - r{k-1}.rank) > {eps})""")
    moved = " UNION ALL ".join(f"SELECT * FROM m{k}" for k in range(1, steps + 1))
    allr = " UNION ALL ".join(f"SELECT {k} AS k, id, rank FROM r{k}" for k in range(1, steps + 1))
    parts.append(f"""stop AS (SELECT coalesce(min(k), {steps}) AS k FROM ({moved}) WHERE moved = 0),
allr AS ({allr})""")
    return ",\n".join(parts) + "\nSELECT id, round(rank, 10) AS rank FROM allr WHERE k = (SELECT k FROM stop)"


@query("pagerank", sql=_pagerank_sql())
def pagerank(spark, sf):
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    n = cust.count()
    ranks, _ = G.pagerank(cust, customer_edges(spark, sf), n)
    return ranks.select("id", F.round("rank", 10).alias("rank"))
