"""Per-key sequential scans that do not put a whole key into one task.

A window ``partitionBy(key).orderBy(seq)`` sends every row of a key to one
task; a key holding a third of the table becomes a straggler. The helpers
here cut each key's sequence into blocks of the ordering column
(``seq // width``) and work in two levels:

1. within a ``(key, block)`` group - at most ``width`` rows when ``seq`` is
   unique - with ordinary window functions;
2. across the blocks of one key, on a summary table with one row per
   ``(key, block)``, which is ``width`` times smaller than the input.

The block summary is joined back on ``(key, block)``; the join and the
in-block windows share one hash partitioning, so the big side is shuffled
once. ``seq`` must be a numeric column unique within a key; with a sparse
sequence a block holds fewer rows and the summary shrinks less.

Keys are compared as one struct, which is never null itself, so rows with
null keys form a group like any other and survive the join. Rows without a
``seq`` come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default block width in units of the ordering column. With a dense unique
# sequence this bounds the rows of one (key, block) group.
DEFAULT_WIDTH = 1 << 16

BLK = "_blk"
KEY = "_key"


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def with_block(df: DataFrame, keys: str | Sequence[str], seq: str | Column, width: int) -> DataFrame:
    """Add the key struct and the block number of each row."""
    at = F.col(seq) if isinstance(seq, str) else seq
    block = F.coalesce(F.floor(at / F.lit(width)).cast("long"), F.lit(-(1 << 63)))
    return df.withColumn(KEY, F.struct(*_keys(keys))).withColumn(BLK, block)


def prefix_sums(df: DataFrame, keys: str | Sequence[str], seq: str,
                values: dict[str, Column], width: int = DEFAULT_WIDTH,
                inclusive: bool = True, at: Column | None = None) -> DataFrame:
    """Add one running-sum column per entry of ``values`` (name -> expr).

    The running sum covers the rows of the same key with ``seq`` up to and
    including the current row (``inclusive=False`` excludes it). ``at`` as in
    :func:`neighbour`.
    """
    kb = [KEY, BLK]
    tmp = {name: f"_v_{name}" for name in values}
    b = with_block(df, keys, seq if at is None else at, width)
    for name, expr in values.items():
        b = b.withColumn(tmp[name], expr)
    part = b.groupBy(*kb).agg(*[F.sum(tmp[n]).alias(f"_bs_{n}") for n in values])
    before = Window.partitionBy(KEY).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = part.select(*kb, *[
        F.coalesce(F.sum(f"_bs_{n}").over(before), F.lit(0)).alias(f"_off_{n}")
        for n in values])
    joined = b.join(offsets, kb)
    upto = 0 if inclusive else -1
    inblock = Window.partitionBy(*kb).orderBy(seq).rowsBetween(Window.unboundedPreceding, upto)
    for n in values:
        joined = joined.withColumn(
            n, F.col(f"_off_{n}") + F.coalesce(F.sum(tmp[n]).over(inblock), F.lit(0)))
    return joined.drop(KEY, BLK, *tmp.values(), *[f"_off_{n}" for n in values])


def neighbour(df: DataFrame, keys: str | Sequence[str], seq: str,
              cols: Sequence[str], direction: str = "prev",
              out: str = "_nb", width: int = DEFAULT_WIDTH, at: Column | None = None) -> DataFrame:
    """Add struct column ``out`` holding ``cols`` of the previous
    (``direction='prev'``) or next (``'next'``) row of the same key in
    ``seq`` order; null for the first / last row of a key. ``at`` is the
    number that blocks are cut by if it is not ``seq`` itself; it must not
    fall where ``seq`` rises."""
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    kb = [KEY, BLK]
    b = with_block(df, keys, seq if at is None else at, width)
    payload = F.struct(*[F.col(c) for c in cols])
    if direction == "prev":
        edge = F.max_by(payload, F.col(seq))          # last row of each block
        carry = F.lag("_edge").over(Window.partitionBy(KEY).orderBy(BLK))
        inblock = F.lag(payload).over(Window.partitionBy(*kb).orderBy(seq))
    else:
        edge = F.min_by(payload, F.col(seq))          # first row of each block
        carry = F.lead("_edge").over(Window.partitionBy(KEY).orderBy(BLK))
        inblock = F.lead(payload).over(Window.partitionBy(*kb).orderBy(seq))
    edges = b.groupBy(*kb).agg(edge.alias("_edge"))
    carried = edges.select(*kb, carry.alias("_carry"))
    joined = b.join(carried, kb)
    return (joined.withColumn(out, F.coalesce(inblock, F.col("_carry")))
            .drop(KEY, BLK, "_carry"))
