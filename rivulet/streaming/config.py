"""Streaming runtime settings: state backend, checkpointing, latency."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession, changelog: bool = True) -> None:
    """Keep operator state in RocksDB (off-heap, spills to local disk) with
    incremental changelog checkpoints, for large keyed state. Set before
    the first run of a query; a checkpoint keeps its provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
                   str(changelog).lower())


def low_latency_trigger(interval: str = "0 seconds") -> dict:
    """Trigger arguments for ``writeStream.trigger(**...)``: start the next
    micro-batch as soon as the previous one ends (or every ``interval``)."""
    return {"processingTime": interval}


def run_to_end(writer, timeout_s: int = 3600) -> None:
    """Start a stream writer and wait until its input is used up and the
    windows closed by its end marker are out. ``availableNow`` on a Python
    source needs a setting for that last batch, which a query takes from its
    session some time after it is started; the session's own value is put back
    when the query has ended."""
    conf = writer._spark.conf
    name = "spark.sql.streaming.triggerAvailableNowWrapper.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        query = writer.trigger(availableNow=True).start()
        if not query.awaitTermination(timeout_s):
            query.stop()
            raise TimeoutError(f"the stream has not ended in {timeout_s} s")
    finally:
        conf.set(name, before)
