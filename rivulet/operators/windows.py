"""Event-time and count windows.

Keyed sequential windows (running sums, count windows, sessions) are built
on :mod:`rivulet.operators.sequence`, so a hot key is split into blocks
instead of being sorted inside one task. Time windows use Spark's
``window`` grouping, which pre-aggregates on every task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.sequence import BLK, DEFAULT_WIDTH, KEY, prefix_sums, with_block


def _interval(spec: str) -> Column:
    return F.expr(f"INTERVAL {spec}")


def running_sum(df: DataFrame, keys: str | Sequence[str], seq: str, value: Column | str,
                out: str = "running", width: int = DEFAULT_WIDTH) -> DataFrame:
    """One output row per input row: the key's running sum up to the row."""
    v = F.col(value) if isinstance(value, str) else value
    return prefix_sums(df, keys, seq, {out: v}, width)


def count_window_sum(df: DataFrame, keys: str | Sequence[str], seq: str, value: Column | str,
                     size: int, slide: int, out: str = "window_sum",
                     width: int = DEFAULT_WIDTH) -> DataFrame:
    """Sliding count window per key: at every ``slide``-th row of a key,
    the sum of its last ``size`` rows (fewer at the start). Rows after the
    last complete slide are never emitted.

    Built from two running sums (row number ``n`` and value ``S``): the
    window sum at row ``n`` is ``S(n) - S(n - size)``. Each row sends its
    ``S`` to the group ``(key, n)`` when it fires and to ``(key, n + size)``
    when that row fires; one aggregation over those groups (at most two
    rows each, so no hot group) takes the difference. The running sums are
    computed once, in the type of the value's sum (exact for integers and
    decimals; doubles carry the rounding of their running sums).
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    v = F.col(value) if isinstance(value, str) else value
    acc = prefix_sums(df, ks, seq, {"_rn": F.lit(1).cast("long"), "_s": v}, width)
    fire = (F.col("_rn") % slide == 0)
    feeds = (F.col("_rn") + size) % slide == 0
    kind = dict(acc.dtypes)["_s"]
    sends = F.filter(F.array(
        F.struct(fire.alias("ok"), F.col("_rn").alias("_t"), F.col("_s").alias("now"),
                 F.lit(None).cast(kind).alias("old"), F.col(seq).alias("q")),
        F.struct(feeds.alias("ok"), (F.col("_rn") + size).alias("_t"),
                 F.lit(None).cast(kind).alias("now"), F.col("_s").alias("old"),
                 F.lit(None).cast(dict(acc.dtypes)[seq]).alias("q"))), lambda x: x["ok"])
    msgs = acc.where(fire | feeds).select(*ks, F.inline(sends))
    g = msgs.groupBy(*ks, "_t").agg(F.max("now").alias("now"), F.max("old").alias("old"),
                                     F.max("q").alias(seq))
    return (g.where(F.col("now").isNotNull())
            .select(*ks, F.col(seq), F.col("_t").alias("rn"),
                    (F.col("now") - F.coalesce("old", F.lit(0))).alias(out)))


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str],
             aggs: Sequence[Column]) -> DataFrame:
    """Tumbling event-time window aggregate with flat window columns."""
    g = df.groupBy(F.window(ts, size).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("w", *keys)])


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str],
            aggs: Sequence[Column]) -> DataFrame:
    """Sliding event-time window aggregate (each row lands in size/slide
    windows; partial aggregation runs before the shuffle)."""
    g = df.groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(*aggs)
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("w", *keys)])


def micros(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of a timestamp with or without time zone."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.unix_micros(F.col(ts))


def sessions(df: DataFrame, keys: str | Sequence[str], seq: str, ts: str, gap: str,
             aggs: Sequence[Column], block_seconds: float = 86_400) -> DataFrame:
    """Gap sessions per key in time order (``seq`` breaks ties). A row opens
    a new session when it is the key's first row or its time exceeds the
    previous row's time by more than ``gap``; rows exactly ``gap`` apart stay
    in one session. The session ends ``gap`` after its last row (as Spark's
    ``session_window``). Rows without a time belong to no session.

    A key's time line is cut into blocks of ``block_seconds``:

    * rows: previous time inside the block and whether the row opens a session;
    * block summary: first and last time, sessions opened inside;
    * across the blocks of a key: whether the block's first row opens a
      session, and how many sessions opened before the block;
    * rows: session number = sessions before the block + in-block running
      count of openings; then one grouping, pre-aggregated per task.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    kb = [KEY, BLK]
    g = _interval(gap)
    timed = df.where(F.col(ts).isNotNull())
    b = with_block(timed, ks, micros(timed, ts), int(block_seconds * 1_000_000))
    inblock = Window.partitionBy(*kb).orderBy(ts, seq)
    prev = F.lag(ts).over(inblock)
    rows = b.withColumn("_o", (prev.isNotNull() & (F.col(ts) > prev + g)).cast("long"))
    summary = rows.groupBy(*kb).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"),
                                    F.sum("_o").alias("_inside"))
    per_key = Window.partitionBy(KEY).orderBy(BLK)
    prev_last = F.lag("_last").over(per_key)
    first_opens = (prev_last.isNull() | (F.col("_first") > prev_last + g)).cast("long")
    opened = summary.withColumn("_fo", first_opens).withColumn("_n", F.col("_inside") + F.col("_fo"))
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    carry = opened.select(*kb, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.col("_fo"))
                          .alias("_base"))
    numbered = rows.join(carry, kb).withColumn("_sid", F.col("_base") + F.sum("_o").over(
        inblock.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy(*ks, "_sid")
            .agg(F.min(ts).alias("session_start"), (F.max(ts) + g).alias("session_end"), *aggs)
            .drop("_sid"))


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                right_ts: str, size: str) -> DataFrame:
    """Inner join of rows with equal keys that fall into the same tumbling
    window of ``size``; returns ``window_start`` plus both sides' columns.
    An equi-join on (keys, window start): AQE splits skewed partitions."""
    l = left.withColumn("window_start", F.window(left_ts, size).start)
    r = right.withColumn("window_start", F.window(right_ts, size).start)
    return l.join(r, list(keys) + ["window_start"])


def window_apply(df: DataFrame, ts: str, size: str, keys: Sequence[str], fn, schema: str,
                 slide: str | None = None) -> DataFrame:
    """Run ``fn(pandas.DataFrame) -> pandas.DataFrame`` on the full contents
    of each (keys, window) group (``window_start``/``window_end`` columns
    are added before the call). Use only when no aggregate expresses the
    function: a group is materialised in one Python worker, so its size is
    that of one key's window (see :func:`window_apply_parts`)."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    framed = (df.withColumn("_w", w).withColumn("window_start", F.col("_w.start"))
              .withColumn("window_end", F.col("_w.end")).drop("_w"))
    return framed.groupBy(*keys, "window_start", "window_end").applyInPandas(fn, schema)


def window_apply_parts(df: DataFrame, ts: str, size: str, keys: Sequence[str], part, part_schema: str,
                       merge, schema: str, slide: str | None = None) -> DataFrame:
    """:func:`window_apply` for a function that can be merged, for windows of
    any size: ``part(pandas.DataFrame)`` is run on the rows that a (key,
    window) has in one Arrow batch, before any shuffle, and ``merge`` on the
    results of all its batches. Both see and return ``keys`` and
    ``window_start``; ``part_schema`` is what ``part`` returns."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    framed = df.withColumn("_w", w).withColumn("window_start", F.col("_w.start")).drop("_w")
    by = [*keys, "window_start"]

    def parts(batches):
        for pdf in batches:
            found = [part(g) for _, g in pdf.groupby(by, dropna=False, sort=False)]
            if found:
                yield pd.concat(found)

    return framed.mapInPandas(parts, part_schema).groupBy(*by).applyInPandas(merge, schema)
