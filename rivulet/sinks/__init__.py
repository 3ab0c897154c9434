"""Sinks: delimited / text files, console, discard, Kafka, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Delimited text, one line per row (rows separated by newlines)."""
    df.write.mode(mode).option("sep", sep).csv(path)


def tuple_line(columns: list[str]) -> Column:
    """``(f1,f2,...)`` of a row, a null field as ``null``."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.concat(F.lit("("), F.concat_ws(",", *fields), F.lit(")"))


def write_text(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Each row as text ``(f1,f2,...)``, a null field as ``null``;
    ``single_file`` writes one part (only for small results)."""
    out = df.select(tuple_line(df.columns).alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def discard(df: DataFrame) -> None:
    """Run the plan fully, write nothing."""
    df.write.format("noop").mode("overwrite").save()


def stream_to(df: DataFrame, fmt: str, checkpoint: str, mode: str = "append",
              trigger: dict | None = None, **options):
    """Start a streaming query into ``fmt`` (csv, text, parquet, console,
    memory, noop, kafka) with its checkpoint folder (exactly-once with
    replayable sources and idempotent file sinks)."""
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    for k, v in options.items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
