"""k-means, linear regression and per-window models over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import ml as M
from rivulet.plans.catalog import query
from rivulet.sources.tables import table

KMEANS_STEPS = 5
KMEANS_SEEDS = 4


def _kmeans_sql(steps=KMEANS_STEPS, k=KMEANS_SEEDS):
    parts = [f"""WITH p AS (SELECT p_partkey AS pid, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y FROM part),
c0 AS (SELECT pid AS cid, x, y FROM p ORDER BY pid LIMIT {k})"""]

    def assign(i):
        return f"""a{i} AS (SELECT pid, x, y, cid FROM (
    SELECT p.pid, p.x, p.y, c{i}.cid, row_number() OVER (PARTITION BY p.pid
        ORDER BY sqrt((p.x - c{i}.x) ** 2 + (p.y - c{i}.y) ** 2), c{i}.cid) AS rk
    FROM p, c{i}) WHERE rk = 1)"""
    for i in range(steps):
        parts.append(assign(i))
        parts.append(f"""c{i+1} AS (SELECT cid, sum(x) / count(*) AS x, sum(y) / count(*) AS y
    FROM a{i} GROUP BY cid)""")
    parts.append(assign(steps))
    return ",\n".join(parts) + f"\nSELECT pid AS p_partkey, cid AS cluster FROM a{steps}"


@query("kmeans", sql=_kmeans_sql())
def kmeans(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"),
                                           F.col("p_retailprice").alias("y"))
    # Seeds: the parts with the lowest keys (a top-k by key is the feature).
    seeds = part.orderBy("p_partkey").limit(KMEANS_SEEDS).withColumnRenamed("p_partkey", "id")
    pts, _ = M.kmeans(part, seeds, KMEANS_STEPS)
    return pts.select("p_partkey", F.col("cluster").cast("long").alias("cluster"))


def _linreg_sql(steps=10, alpha=0.01):
    parts = ["""WITH d AS (SELECT l_quantity / 50.0 AS x, l_extendedprice / 100000.0 AS y FROM lineitem),
t0 AS (SELECT 0.0::DOUBLE AS t0, 0.0::DOUBLE AS t1)"""]
    for i in range(1, steps + 1):
        p = f"t{i-1}"
        err = f"(({p}.t0 + {p}.t1 * d.x) - d.y)"
        parts.append(f"""t{i} AS (SELECT avg({p}.t0 - {alpha} * {err}) AS t0,
    avg({p}.t1 - {alpha} * ({err} * d.x)) AS t1 FROM d, {p})""")
    return ",\n".join(parts) + f"\nSELECT round(t0, 10) AS theta0, round(t1, 10) AS theta1 FROM t{steps}"


@query("linear_regression", sql=_linreg_sql())
def linear_regression(spark, sf):
    li = table(spark, sf, "lineitem").select((F.col("l_quantity") / 50.0).alias("x"),
                                             (F.col("l_extendedprice") / 100000.0).alias("y"))
    return M.linear_regression(li, "x", "y", iterations=10, alpha=0.01).select(F.round("t0", 10).alias("theta0"), F.round("t1", 10).alias("theta1"))


_MODEL_SQL = """m AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
                  time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
                  count(*) AS model_n,
                  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS model_sum
           FROM events GROUP BY 1, 2)"""


def _cents():
    return F.round(F.col("value") * 100).cast("long")


@query("windowed_model", sql=f"WITH {_MODEL_SQL}\nSELECT *, model_sum / model_n / 100 AS model_mean FROM m")
def windowed_model(spark, sf):
    m = M.window_model(table(spark, sf, "events"), "ts", "1 day", _cents())
    return m.withColumn("model_mean", F.col("model_sum") / F.col("model_n") / 100)


@query("latest_model_apply", sql=f"""WITH {_MODEL_SQL}
SELECT e.event_id, coalesce(m.model_n, 0) AS model_n, coalesce(m.model_sum, 0) AS model_sum,
       m.model_sum / m.model_n / 100 AS model_mean
FROM events e ASOF LEFT JOIN m ON e.ts >= m.window_end
""")
def latest_model_apply(spark, sf):
    ev = table(spark, sf, "events")
    m = M.window_model(ev, "ts", "1 day", _cents())
    out = M.apply_latest_model(ev.select("event_id", "ts"), "ts", m, "1 day")
    # No closed window yet: an empty model (count 0, sum 0, mean null).
    return out.select("event_id", F.coalesce("model_n", F.lit(0)).alias("model_n"),
                      F.coalesce("model_sum", F.lit(0)).alias("model_sum"),
                      (F.col("model_sum") / F.col("model_n") / 100).alias("model_mean"))


@query("latest_model_gaps", sql="""WITH m AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, count(*) AS model_n,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS model_sum
  FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT e.event_id, coalesce(m.model_n, 0) AS model_n, coalesce(m.model_sum, 0) AS model_sum
FROM events e ASOF LEFT JOIN m ON time_bucket(INTERVAL 10 MINUTE, e.ts) >= m.window_end
""")
def latest_model_gaps(spark, sf):
    """Models of 10-minute windows, many of them empty, applied to all rows."""
    ev = table(spark, sf, "events")
    m = M.window_model(ev.where(F.col("event_type") == "purchase"), "ts", "10 minutes", _cents())
    return M.apply_latest_model(ev.select("event_id", "ts"), "ts", m, "10 minutes").drop("ts").fillna(0)
