"""Writers that commit: an exactly-once stream sink and a file copy.

``rivulet_ledger`` writes the rows of a micro-batch as parquet files under
``<path>/data`` with names nobody else has. They count once the batch's entry
in the ledger, ``<path>/epochs/<batch id>``, names them; the entry appears as a
whole, after all tasks have ended. A batch that Spark runs again after a
failure finds its entry and drops its new files, so whatever step a run dies
at, ``committed`` gives every batch once. One query writes to one folder.

``rivulet_copy`` takes rows of ``path`` and ``relative_path`` (and optionally
``content``, for sources that only Spark can read). Tasks copy files to staging
names; when all have ended the driver renames them to their places below the
target, and last the lists of what was copied, which are the copy's counters,
appear under ``<target>/_copied/<job>``. A failed task or job leaves nothing
under a final name. The driver holds the list of one task at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

from rivulet.sources.replay import file_system, get_whole, put_whole, register


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class _LedgerWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq
        store, at = file_system(f"{self.path}/data")
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(at, recursive=True)
                out = pq.ParquetWriter(f"{at}/{name}", batch.schema, filesystem=store)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is None:  # a task without rows
            return Written("", 0)
        out.close()
        return Written(name, rows)

    def _entry(self, batch_id: int) -> str:
        return f"{self.path}/epochs/{batch_id}"

    def commit(self, messages, batchId: int) -> None:
        if get_whole(self._entry(batchId)) is not None:  # a batch that is run again
            self.abort(messages, batchId)
            return
        put_whole(self._entry(batchId), json.dumps([m.name for m in messages if m and m.name]).encode())

    def abort(self, messages, batchId: int) -> None:
        # Spark also aborts a batch whose commit failed after the entry was made
        kept = set(json.loads(get_whole(self._entry(batchId)) or b"[]"))
        store, at = file_system(f"{self.path}/data")
        for m in messages:
            if m and m.name and m.name not in kept:
                store.delete_file(f"{at}/{m.name}")


class LedgerSink(DataSource):
    """Option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "rivulet_ledger"

    def streamWriter(self, schema, overwrite: bool):
        return _LedgerWriter(self.options["path"])


def write_ledger(df: DataFrame, path: str, checkpoint: str):
    """A stream writer (to be started) that commits each batch once."""
    register(df.sparkSession, LedgerSink)
    return (df.writeStream.format("rivulet_ledger").option("path", path).option("checkpointLocation", checkpoint))


def committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed batches."""
    from pyarrow import fs
    path = path.rstrip("/")
    store, at = file_system(f"{path}/epochs")
    entries = [f.path for f in store.get_file_info(fs.FileSelector(at, allow_not_found=True))
               if f.base_name.isdigit()]
    names = []
    for e in entries:
        with store.open_input_stream(e) as f:
            names += json.loads(f.read())
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{n}" for n in sorted(names)])


class _CopyWriter(DataSourceArrowWriter):
    def __init__(self, target: str, job: str) -> None:
        self.target, self.job = target.rstrip("/"), job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq
        store, root = file_system(self.target)
        staging = f"{root}/_staging-{self.job}"
        store.create_dir(staging, recursive=True)
        staged, places, sizes = [], [], []
        for batch in iterator:
            columns = batch.to_pydict()
            contents = columns.get("content") or [None] * batch.num_rows
            for path, place, content in zip(columns["path"], columns["relative_path"], contents):
                name, size = uuid.uuid4().hex, 0
                with store.open_output_stream(f"{staging}/{name}") as out:
                    if content is not None:
                        size = out.write(content)
                    else:
                        source, at = file_system(path)
                        with source.open_input_stream(at) as f:
                            while chunk := f.read(1 << 20):
                                size += out.write(chunk)
                staged.append(name)
                places.append(place)
                sizes.append(size)
        listed = f"{uuid.uuid4().hex}.list"
        pq.write_table(pa.table({"staged": pa.array(staged, pa.string()), "relative_path": pa.array(places, pa.string()),
                                 "bytes": pa.array(sizes, pa.int64())}), f"{staging}/{listed}", filesystem=store)
        return Written(listed, len(staged))

    def commit(self, messages) -> None:
        import pyarrow.parquet as pq
        store, root = file_system(self.target)
        staging = f"{root}/_staging-{self.job}"
        lists = []

        def settle(name: str, place: str) -> None:
            store.create_dir(f"{root}/{place}".rsplit("/", 1)[0], recursive=True)
            store.move(f"{staging}/{name}", f"{root}/{place}")

        with ThreadPoolExecutor(16) as pool:
            for m in messages:
                if not m:
                    continue
                listed = pq.read_table(f"{staging}/{m.name}", filesystem=store)
                for done in [pool.submit(settle, *pair) for pair in zip(
                        listed["staged"].to_pylist(), listed["relative_path"].to_pylist())]:
                    done.result()
                lists.append(m.name)
        store.create_dir(f"{root}/_copied/{self.job}", recursive=True)
        for name in lists:
            table = pq.read_table(f"{staging}/{name}", filesystem=store).select(["relative_path", "bytes"])
            pq.write_table(table, f"{root}/_copied/{self.job}/{name.removesuffix('.list')}.parquet", filesystem=store)
        self.abort(messages)

    def abort(self, messages) -> None:
        from pyarrow import fs
        store, root = file_system(self.target)
        if store.get_file_info(f"{root}/_staging-{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/_staging-{self.job}")


class CopySink(DataSource):
    """Options ``path`` (the target folder) and ``job`` (a name of its own)."""

    @classmethod
    def name(cls) -> str:
        return "rivulet_copy"

    def writer(self, schema, overwrite: bool):
        return _CopyWriter(self.options["path"], self.options["job"])


def copy_committed(files: DataFrame, target: str) -> DataFrame:
    """Copy the files of a manifest (``operators.files.manifest``) below
    ``target``, over files that are there, all or none. Returns
    ``(relative_path, bytes)`` of what was copied."""
    spark, job = files.sparkSession, uuid.uuid4().hex
    register(spark, CopySink)
    columns = [c for c in ("path", "relative_path", "content") if c in files.columns]
    (files.select(*columns).repartition("relative_path").write.format("rivulet_copy").mode("append")
     .option("path", target).option("job", job).save())
    return spark.read.schema("relative_path string, bytes long").parquet(f"{target.rstrip('/')}/_copied/{job}")
