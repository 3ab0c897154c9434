"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import checkpoint_dir

#: Bytes of rows that Spark hands to a Python worker at once: with whole
#: texts a batch counted in rows alone could outgrow the worker's memory.
ARROW_BATCH_BYTES = 16 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables below the cluster's shared
    checkpoint folder (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/rivulet-llm/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so a lost executor costs re-reading a file; and the
    table's true size is then known when joins with it are planned.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes as well as rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def fresh(columns: list[str], base: str) -> str:
    """A column name that ``columns`` does not hold (names compare without
    regard to case, as Spark does)."""
    taken = {c.lower() for c in columns}
    name, i = base, 0
    while name.lower() in taken:
        i += 1
        name = f"{base}{i}"
    return name


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def digest(text: Column) -> Column:
    """128 bits of a text's SHA-256: equal for equal texts only."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Mark a saved table of narrow rows for broadcast if it has at most
    ``rows`` (counted from its file footers); else leave the join to Spark."""
    return F.broadcast(df) if df.count() <= rows else df


def gapless_rank(df: DataFrame, group: str, order: list[str], rank: str,
                 rows_per_part: int = 100_000, least_parts: int = 64) -> DataFrame:
    """Add ``rank``: 0, 1, 2, ... without gaps within each value of ``group``.

    A window over a whole group would put a hot group into one task, so the
    group is cut by a hash of the ``order`` columns into parts; rows are
    numbered inside a part and shifted by the sizes of the parts before it.
    The parts of a group are at most ``max(least_parts, rows / rows_per_part)``;
    the offsets are one row per (group, part). ``order`` should identify a
    row; rows equal in all of it are interchangeable. ``df`` is read twice,
    so pass a saved table. Distinct values of ``group`` must be few (shards,
    lengths): the offsets of one group are summed in one window.
    """
    from pyspark.sql import Window
    most = df.groupBy(group).count().agg(F.max("count")).first()[0] or 0
    parts = max(least_parts, -(-most // rows_per_part))
    cut = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = cut.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_part",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    return (cut.withColumn("_in", F.row_number().over(inside))
            .join(offsets, [group, "_part"])
            .withColumn(rank, (F.col("_offset") + F.col("_in") - 1).cast("long"))
            .drop("_part", "_offset", "_in"))
