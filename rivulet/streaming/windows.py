"""Windowed stream operators: tumbling / sliding / session aggregates and
the windowed stream-stream join. Event time comes from a TIMESTAMP column
with a watermark; rows later than the watermark are dropped, as in the
reference. Results of a window are emitted once, when the watermark
passes its end (append mode)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.sources.replay import END_SQL


def event_time(df: DataFrame, ts: str, delay: str = "0 seconds", out: str = "event_time") -> DataFrame:
    """Add ``out`` as a TIMESTAMP (parquet TIMESTAMP_NTZ is cast; the
    session time zone is UTC) and declare the watermark on it."""
    return df.withColumn(out, F.col(ts).cast("timestamp")).withWatermark(out, delay)


def until_end(df: DataFrame, ts: str, delay: str = "0 seconds") -> DataFrame:
    """Declare the watermark on ``ts`` and take out end markers (rows at
    ``sources.replay.END`` or later). The marker still advances the watermark,
    so at the end of its input a source closes every open window. The filter
    names the watermark column, which keeps Spark from moving it below."""
    return df.withWatermark(ts, delay).where(F.col(ts) < F.expr(END_SQL))


def arrival_time(df: DataFrame, out: str = "arrival") -> DataFrame:
    """Add the time at which a micro-batch takes a row, for windows in
    processing time: ``out`` never runs backwards, so no row is late."""
    return df.withColumn(out, F.current_timestamp()).withWatermark(out, "0 seconds")


def windowed_counts(stream: DataFrame, ts: str, size: str, keys: Sequence[str],
                    aggs: Sequence[Column], slide: str | None = None) -> DataFrame:
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = stream.groupBy(w.alias("_window"), *keys).agg(*aggs)
    return g.select(F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
                    *keys, *[c for c in g.columns if c not in ("_window", *keys)])


def session_windows(stream: DataFrame, ts: str, gap: str, keys: Sequence[str],
                    aggs: Sequence[Column]) -> DataFrame:
    g = stream.groupBy(F.session_window(ts, gap).alias("_session"), *keys).agg(*aggs)
    return g.select(*keys, F.col("_session.start").alias("session_start"),
                    F.col("_session.end").alias("session_end"),
                    *[c for c in g.columns if c not in ("_session", *keys)])


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str,
                right_ts: str, size: str) -> DataFrame:
    """Inner join of two watermarked streams on keys and tumbling window."""
    l = left.withColumn("_w", F.window(left_ts, size))
    r = right.withColumn("_w", F.window(right_ts, size))
    return l.join(r, list(keys) + ["_w"]).withColumn("window_start", F.col("_w.start")).drop("_w")


def split_outputs(stream: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]],
                  sinks: dict[str, Callable[[DataFrame, int], None]]):
    """Side outputs: one ``foreachBatch`` evaluates every named output on
    the same micro-batch (read once, persisted for the batch) and hands it
    to its sink with the batch id (sinks make writes idempotent by id)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, build in outputs.items():
                sinks[name](build(batch), batch_id)
        finally:
            batch.unpersist()
    return stream.writeStream.foreachBatch(each)


def clock_from_sequence(df: DataFrame, seq: str, step_ms: int = 10, out: str = "event_time",
                        delay: str = "0 seconds") -> DataFrame:
    """Synthetic event time ``seq * step_ms`` with a watermark on it - the
    punctuated clock that advances a fixed step per element (``seq`` must
    count elements, e.g. an offset or a per-source sequence number)."""
    ts = F.timestamp_millis(F.col(seq).cast("long") * F.lit(step_ms))
    return df.withColumn(out, ts).withWatermark(out, delay)


def element_clock(df: DataFrame, counter: str, step_ms: int = 10, out: str = "event_time",
                  delay: str = "0 seconds") -> DataFrame:
    """Punctuated event time of a replayed stream: ``step_ms`` for its first
    element and as much more for every further one, with a watermark on it.
    ``counter`` numbers the elements (``sources.replay``): it lives in the
    source's offsets, so the clock goes on after a restart. An end marker has
    no number and advances the watermark past everything."""
    ts = F.coalesce(F.timestamp_millis((F.col(counter) + 1) * F.lit(step_ms)), F.expr(END_SQL))
    return until_end(df.withColumn(out, ts), out, delay)
