"""Iterative learners: k-means with given seeds and batch-gradient linear
regression, plus a per-window model and its as-of application.

The model (k centroids, two thetas) is as large as its parameters, not as
the data, so it travels to the driver between steps and back to the tasks.
There is no join with the model and no cross join.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CELLS = 1 << 20  # point-centroid distances held at once


def nearest(px: np.ndarray, py: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Row of the nearest of ``centroids`` (x, y) for each point; ties go to
    the lower row. Distances are made in slices of bounded size."""
    out = np.empty(len(px), np.int64)
    step = max(1, _CELLS // len(centroids))
    for i in range(0, len(px), step):
        d = np.sqrt((px[i:i + step, None] - centroids[:, 0]) ** 2
                    + (py[i:i + step, None] - centroids[:, 1]) ** 2)
        out[i:i + step] = d.argmin(axis=1)
    return out


def assign_clusters(points: DataFrame, centroids: list[tuple[int, float, float]], x: str = "x",
                    y: str = "y", out: str = "cluster") -> DataFrame:
    """``points`` with the id of the nearest centroid (ids ascending; -1 if
    there are none; null for a point without coordinates)."""
    if not centroids:
        return points.withColumn(out, F.lit(-1).cast("long"))
    ids = np.array([c[0] for c in centroids], np.int64)
    places = np.array([c[1:] for c in centroids], float)

    @F.pandas_udf("long")
    def cluster(px: pd.Series, py: pd.Series) -> pd.Series:
        at = ids[nearest(px.to_numpy(float), py.to_numpy(float), places)]
        return pd.Series(at).astype("Int64").mask((px.isna() | py.isna()).to_numpy())
    return points.withColumn(out, cluster(F.col(x).cast("double"), F.col(y).cast("double")))


def kmeans(points: DataFrame, seeds: DataFrame, iterations: int = 10,
           x: str = "x", y: str = "y", cid: str = "id") -> tuple[DataFrame, list]:
    """Lloyd iterations from given seed centroids ``(id, x, y)``.

    Each step assigns every point to its nearest centroid (a vectorised pass
    with the k centroids in the task) and moves each centroid to the mean of
    its points; a centroid without points disappears. Only the k means
    return to the driver. Returns points with ``cluster`` and the final
    centroids.
    """
    cents = sorted((int(r[0]), float(r[1]), float(r[2])) for r in seeds.select(cid, x, y).collect())
    for _ in range(iterations):
        assigned = assign_clusters(points.select(x, y), cents, x, y, "c").where("c is not null")
        means = assigned.groupBy("c").agg((F.sum(x) / F.count(F.lit(1))).alias("mx"),
                                          (F.sum(y) / F.count(F.lit(1))).alias("my"))
        cents = sorted((int(r[0]), float(r[1]), float(r[2])) for r in means.collect())
    return assign_clusters(points, cents, x, y), cents


def regression_sums(data: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """One row: all that a batch-gradient step needs to know of the data."""
    return data.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(F.col(x) * F.col(x)).alias("sxx"), F.sum(F.col(x) * F.col(y)).alias("sxy"))


def linear_regression(data: DataFrame, x: str = "x", y: str = "y", iterations: int = 10,
                      alpha: float = 0.01, theta: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """Batch gradient descent for ``y = theta0 + theta1 * x``; both thetas
    of a step use the previous step's values. One row ``(t0, t1)``, null
    without data.

    The mean of the per-row updates is a function of five sums, so the data
    is read once and the steps run on that one row, lazily.
    """
    mean = lambda e: e / F.col("n")
    start = F.struct(F.lit(float(theta[0])).alias("t0"), F.lit(float(theta[1])).alias("t1"))

    def step(t: Column, _: Column) -> Column:
        err = t["t0"] * F.col("n") + t["t1"] * F.col("sx") - F.col("sy")
        errx = t["t0"] * F.col("sx") + t["t1"] * F.col("sxx") - F.col("sxy")
        return F.struct((t["t0"] - alpha * mean(err)).alias("t0"), (t["t1"] - alpha * mean(errx)).alias("t1"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step) if iterations else start
    return regression_sums(data, x, y).select(F.when(F.col("n") > 0, done).alias("t")).select("t.t0", "t.t1")


def window_model(df: DataFrame, ts: str, size: str, value: Column) -> DataFrame:
    """Model per tumbling window over all rows: count and integral sum of
    ``value`` (mean = sum / count), with window bounds."""
    g = df.groupBy(F.window(ts, size).alias("w")).agg(F.count(F.lit(1)).alias("model_n"),
                                                      F.sum(value).alias("model_sum"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "model_n", "model_sum")


def _ends(model: DataFrame, size: str) -> DataFrame:
    """Models with the end of the next one (null for the last). Windows are
    numbered by their end; neighbours meet in blocks of 4,096 windows, and
    the blocks' first ends, one row each, link the blocks."""
    seconds = F.expr(f"unix_timestamp(TIMESTAMP'1970-01-01 00:00:00' + INTERVAL {size})"
                     " - unix_timestamp(TIMESTAMP'1970-01-01 00:00:00')")
    block = F.floor(F.unix_timestamp(F.col("window_end").cast("timestamp")) / seconds / 4096)
    m = model.withColumn("_b", block)
    inside = F.lead("window_end").over(Window.partitionBy("_b").orderBy("window_end"))
    firsts = m.groupBy("_b").agg(F.min("window_end").alias("_f"))
    links = firsts.select("_b", F.lead("_f").over(Window.orderBy("_b")).alias("_after"))
    return m.join(links, "_b").withColumn("_next", F.coalesce(inside, F.col("_after"))).drop("_b", "_after")


def apply_latest_model(df: DataFrame, ts: str, model: DataFrame, size: str = "1 day") -> DataFrame:
    """Attach to each row the model of the latest window that closed at or
    before the row's time (null before the first window closes). ``size`` is
    the windows' length; ``model`` has one row per window.

    Each model is copied to the windows it is the latest for, up to the next
    model; rows find theirs with an equi-join on their own window. Rows
    after the last model take that one, a single row joined on a constant.
    """
    step = F.expr(f"INTERVAL {size}")
    spans = _ends(model.select("window_end", "model_n", "model_sum"), size)
    lookup = spans.where(F.col("_next").isNotNull()).select(
        F.explode(F.sequence(F.col("window_end"), F.col("_next") - step, step)).alias("_w"),
        F.struct("model_n", "model_sum").alias("_m"))
    last = model.agg(F.max("window_end").alias("_end"),
                     F.max_by(F.struct("model_n", "model_sum"), "window_end").alias("_last")).withColumn("_one", F.lit(1))
    # window() drops rows without a time; they stay here, without a model
    kind = dict(df.dtypes)[ts]
    some = F.coalesce(F.col(ts), F.lit("1970-01-01 00:00:00").cast(kind))
    rows = (df.withColumn("_t", some).withColumn("_w", F.window("_t", size).start)
            .withColumn("_w", F.when(F.col(ts).isNotNull(), F.col("_w"))).drop("_t")
            .withColumn("_one", F.lit(1)))
    found = rows.join(lookup, "_w", "left").join(F.broadcast(last), "_one", "left")
    chosen = F.when(F.col("_w") >= F.col("_end"), F.col("_last")).otherwise(F.col("_m"))
    return (found.withColumn("_c", chosen).withColumn("model_n", F.col("_c.model_n"))
            .withColumn("model_sum", F.col("_c.model_sum"))
            .drop("_w", "_one", "_m", "_end", "_last", "_c"))
