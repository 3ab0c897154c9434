"""Stream connectors: Kafka payload codecs and socket text.

The Kafka and socket readers only build options; the decode/encode
expressions work on any ``value`` column, so they are tested on batch rows
and file streams (no broker or port is opened by the tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.codecs import decode_event, encode_event

# JSON record of the word stream.
WORD_EVENT_SCHEMA = "word string, frequency int, timestamp long"


def kafka_stream(spark: SparkSession, servers: str, topic: str,
                 starting: str = "latest", **options) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka package on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def decode_word_events(raw: DataFrame) -> DataFrame:
    """JSON value -> ``word, frequency, timestamp1``. A bad record fails the
    query (FAILFAST), and so does one without a key or with a null in it."""
    j = F.from_json(F.col("value").cast("string"), WORD_EVENT_SCHEMA, {"mode": "FAILFAST"})

    def field(name: str):
        return F.coalesce(F.col(f"j.{name}"), F.raise_error(
            F.concat(F.lit(f"record without {name}: "), F.coalesce(F.col("value").cast("string"), F.lit("null"))))
            .cast({"word": "string", "frequency": "int", "timestamp": "long"}[name]))
    return raw.select("value", j.alias("j")).select(
        field("word").alias("word"), field("frequency").alias("frequency"),
        field("timestamp").alias("timestamp1"))


def encode_word_events(df: DataFrame) -> DataFrame:
    """``word,frequency,timestamp1`` as CSV text in ``value``; a null field
    is empty, so every line has three."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("word", "frequency", "timestamp1")]
    return df.select(F.concat_ws(",", *fields).alias("value"))


def decode_state_events(raw: DataFrame) -> DataFrame:
    """8-byte values -> ``address int, type string``."""
    return raw.select(decode_event(F.col("value")).alias("e")).select("e.*")


def encode_state_events(df: DataFrame, address: str = "address", etype: str = "type") -> DataFrame:
    return df.select(encode_event(address, etype).alias("value"))


def socket_lines(spark: SparkSession, port: int, host: str = "localhost") -> DataFrame:
    """Socket text source; one row per line, column ``line``."""
    return (spark.readStream.format("socket").option("host", host).option("port", port)
            .load().withColumnRenamed("value", "line"))


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, **options):
    """Write a stream's ``value`` (and optional ``key``) column to Kafka;
    the checkpoint keeps the sink's progress."""
    w = (df.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).option("checkpointLocation", checkpoint))
    for k, v in options.items():
        w = w.option(k, v)
    return w
