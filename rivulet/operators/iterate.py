"""Per-row feedback iteration (the streaming "iterate" job) as a closed
fold on the JVM, plus the routing of a stream into several outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fibonacci_steps(df: DataFrame, a: str, b: str, bound: int = 100) -> DataFrame:
    """Add ``steps``. For each ``(a, b)``: repeat ``(x, y) -> (y, x + y)`` starting from
    ``(a, b)`` and count steps until ``x >= bound`` or ``y >= bound``
    (``bound`` > 0). The first step always runs, so a pair already at the
    bound counts 1. A pair that falls to or below zero in both parts only
    falls further and never ends: its count is null, as it is for null parts.

    The loop is a JVM fold. A pair of 64-bit values that differ in sign
    shrinks by the golden ratio a step, so after at most 93 steps both parts
    have one sign, and at most 93 more take them past any bound; the second
    fold of 200 steps therefore settles every row, and the short first one
    spares it for nearly all.
    """
    init = F.struct(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y"),
                    F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(acc: Column, _: Column) -> Column:
        nx, total = acc["y"], F.try_add(acc["x"], acc["y"])
        # beyond 64 bits: past any bound, or below any
        ny = F.coalesce(total, F.when(acc["y"] > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63))))
        return F.when(acc["done"], acc).otherwise(F.struct(
            nx.alias("x"), ny.alias("y"), (acc["n"] + 1).alias("n"),
            ((nx >= bound) | (ny >= bound) | ((nx <= 0) & (ny <= 0))).alias("done")))

    short = F.aggregate(F.sequence(F.lit(1), F.lit(12)), init, step)
    rest = F.aggregate(F.sequence(F.lit(1), F.lit(200)), F.col("_s"), step)
    ends = (F.col("_s.x") >= bound) | (F.col("_s.y") >= bound)
    return (df.withColumn("_s", F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), short))
            .withColumn("_s", F.when(F.col("_s.done"), F.col("_s")).otherwise(rest))
            .withColumn("steps", F.when(ends, F.col("_s.n"))).drop("_s"))


def route(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Split into (rows where ``predicate`` holds, the rest). Both outputs
    are lazy filters over one input plan; on a stream write them from one
    ``foreachBatch`` so the source is read once."""
    return df.where(predicate), df.where(~predicate | predicate.isNull())
