"""Writers that commit: batches once over failures, copies all or none."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rivulet.operators.files import copy_totals, manifest
from rivulet.sinks import ledger as L
from rivulet.sources.replay import counter_stream, file_system


def scratch(name):
    return tempfile.mkdtemp(prefix=f"rivulet-{name}-")


def run(stream, path, ckpt):
    q = L.write_ledger(stream, path, ckpt).trigger(availableNow=True).start()
    if not q.awaitTermination(60):
        q.stop()
        raise TimeoutError


def numbers(spark, path):
    return sorted(r.n for r in L.committed(spark, path, "n long, event_time timestamp").collect())


def test_a_batch_run_again_changes_nothing(spark):
    path, ckpt, progress = scratch("ledger"), scratch("ckpt"), scratch("progress")
    assert numbers(spark, path) == []
    make = lambda: counter_stream(spark, 300, rowsPerBatch=40, rowsPerPartition=15, progress=progress)
    run(make(), path, ckpt)
    before = numbers(spark, path)
    files = len(glob.glob(f"{path}/data/*"))
    # the run died between the sink's commit and Spark's own
    last = max((f for f in os.listdir(f"{ckpt}/commits") if f.isdigit()), key=int)
    os.remove(f"{ckpt}/commits/{last}")
    os.remove(f"{ckpt}/commits/.{last}.crc")
    run(make(), path, ckpt)
    after = numbers(spark, path)
    assert after[:len(before)] == before == list(range(len(before))) and len(set(after)) == len(after)
    assert len(glob.glob(f"{path}/data/*")) >= files
    for _ in range(8):
        run(make(), path, ckpt)
    assert numbers(spark, path) == list(range(300))


def test_a_writer_that_fails_after_its_commit(spark):
    """The entry is written, then the driver's commit fails: the batch is
    run again and its files are dropped."""
    path, ckpt, flag = scratch("ledger"), scratch("ckpt"), os.path.join(scratch("flag"), "failed")

    class Failing(L._LedgerWriter):
        def commit(self, messages, batchId):
            super().commit(messages, batchId)
            if not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("lost after the commit")

    class FailingSink(L.LedgerSink):
        @classmethod
        def name(cls):
            return "rivulet_ledger_failing"

        def streamWriter(self, schema, overwrite):
            return Failing(self.options["path"])

    spark.dataSource.register(FailingSink)

    def start():
        q = (counter_stream(spark, 100).writeStream.format("rivulet_ledger_failing").option("path", path)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination(60)

    with pytest.raises(Exception, match="lost after the commit"):
        start()
    start()
    assert numbers(spark, path) == list(range(100))


def test_copy_is_all_or_none(spark):
    src, dst = scratch("from"), scratch("to")
    sizes = {}
    for i, name in enumerate(["a.bin", "x/b.bin", "x/y/c.bin", "x/y/empty"]):
        os.makedirs(os.path.dirname(os.path.join(src, name)), exist_ok=True)
        sizes[name] = i * 70_000 if "empty" not in name else 0
        with open(os.path.join(src, name), "wb") as f:
            f.write(os.urandom(sizes[name]))
    for content in (False, True):
        copied = L.copy_committed(manifest(spark, src, content=content), dst)
        assert {r.relative_path: r.bytes for r in copied.collect()} == sizes
        assert copy_totals(copied).first() == (4, sum(sizes.values()))
        for name in sizes:
            assert open(os.path.join(src, name), "rb").read() == open(os.path.join(dst, name), "rb").read()
        assert not glob.glob(f"{dst}/_staging*")
    bad = manifest(spark, src).unionByName(spark.createDataFrame(
        [(f"file:{src}/missing", "z/missing", 1)], "path string, relative_path string, length long"))
    other = scratch("to")
    with pytest.raises(Exception):
        L.copy_committed(bad.withColumn("relative_path", F.concat(F.lit("n/"), "relative_path")), other)
    assert [f for f in glob.glob(f"{other}/**", recursive=True) if os.path.isfile(f)] == []


def test_paths_and_uris():
    for path in ("/tmp/x", "file:/tmp/x", "file:///tmp/x"):
        store, at = file_system(path)
        assert at == "/tmp/x" and store.type_name == "local"
