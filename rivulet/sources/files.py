"""Text, delimited, edge-list and tuple-text sources (batch and stream)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.codecs import parse_tuple_text


# Files a stream takes into one micro-batch: bounds the groups of keyed state.
MAX_FILES = 1000


def _reader(spark: SparkSession, stream: bool, max_files: int):
    return spark.readStream.option("maxFilesPerTrigger", max_files) if stream else spark.read


def text_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files: int = MAX_FILES) -> DataFrame:
    """One row per line, column ``line``."""
    reader = _reader(spark, stream, max_files)
    return reader.text(path).withColumnRenamed("value", "line")


def delimited(spark: SparkSession, path: str, schema: str, sep: str = ",",
              columns: Sequence[int] | None = None, names: Sequence[str] | None = None,
              stream: bool = False, max_files: int = MAX_FILES) -> DataFrame:
    """Delimited file with a full positional ``schema`` (DDL string); keep
    only the 0-based ``columns`` (the reader's column pruning then skips
    the rest while parsing) and optionally rename them. Trailing separators
    are tolerated (PERMISSIVE mode drops the extra empty field)."""
    reader = _reader(spark, stream, max_files).schema(schema) \
        .option("sep", sep).option("mode", "PERMISSIVE")
    df = reader.csv(path)
    if columns is not None:
        df = df.select(*[df.columns[i] for i in columns])
    if names is not None:
        df = df.toDF(*names)
    return df


def edge_list(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """``src dst`` pairs of longs, one per line."""
    return delimited(spark, path, "src long, dst long", sep)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """One long per line, column ``id``."""
    return delimited(spark, path, "id long")


def tuple_text(df: DataFrame, column: str, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Parse ``"(a,b,...)"`` text into typed, named columns."""
    parsed = df.select(parse_tuple_text(column, list(types)).alias("_t"))
    return parsed.select(*[F.col(f"_t._{i + 1}").alias(n) for i, n in enumerate(names)])


def integer_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """``first..last`` inclusive, column ``id``."""
    return spark.range(first, last + 1)


def from_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    """In-memory source (small literal collections only)."""
    return spark.createDataFrame(list(rows), schema)
