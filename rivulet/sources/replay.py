"""Replayable stream sources with offsets of their own and an end marker.

``rivulet_counter`` gives the numbers ``start .. end - 1``; ``rivulet_replay``
gives the rows of a folder of parquet files in order of file name and row.
The offset of both is the number of elements given, so Spark's checkpoint
holds it: a query that is stopped and started again on its checkpoint gets
every element once. A micro-batch is planned as ranges of elements which the
executors read for themselves; only file footers are read by the driver.

Element clock: ``rivulet_replay`` numbers the elements (``counter``), and
``rivulet_counter`` can give each ``stepMillis`` more than the one before as
its ``event_time``: an event time that advances with every element and goes
on where it was after a restart (see ``streaming.windows.element_clock``).

End of input: with a marker, one row follows the last element. Its event time
is ``END`` and all else is null, so a watermark on that column passes every
open window and timer; ``streaming.windows.until_end`` declares the watermark
and takes the marker out again.

Options: ``rowsPerBatch`` (0: all there is) with ``progress``, a folder on
storage shared by the drivers of all runs, in which a source that paces itself
notes the offset it has offered (Spark tells a source where a run ended only
in its checkpoint; an offer is noted before it is made, so no run offers less
than one before); ``rowsPerPartition``; ``marker``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rivulet.session import by_value

#: The event time of an end marker. Later elements count as markers too.
END = datetime(2262, 1, 1, tzinfo=timezone.utc)
END_SQL = "TIMESTAMP'2262-01-01 00:00:00Z'"


def register(spark: SparkSession, source: type) -> None:
    """Make a Python data source known to the session."""
    with by_value():
        spark.dataSource.register(source)


def file_system(path: str):
    """The pyarrow file system of a path or URI, and the path on it."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        scheme, rest = path.split(":", 1)
        return fs.FileSystem.from_uri(path if rest.startswith("//") else f"{scheme}://{rest}")
    return fs.LocalFileSystem(), path


def put_whole(path: str, content: bytes) -> None:
    """Write a small file so that it is there as a whole or not at all."""
    import uuid
    store, at = file_system(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    staged = f"{at}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(staged) as out:
        out.write(content)
    store.move(staged, at)


def get_whole(path: str) -> bytes | None:
    store, at = file_system(path)
    try:
        with store.open_input_stream(at) as f:
            return f.read()
    except FileNotFoundError:
        return None


@dataclass
class Range(InputPartition):
    """Elements ``first .. last - 1``, or the end marker (``path`` None and no
    elements). ``skip`` rows of the file come before the first."""
    first: int
    last: int
    path: str | None = None
    skip: int = 0

    def __post_init__(self):
        super().__init__(None)


class _Paced(DataSourceStreamReader):
    """Offsets {"given": n}: the elements, and one more for the marker."""

    def __init__(self, options, schema: T.StructType) -> None:
        self.per_batch = int(options.get("rowsPerBatch", 0))
        self.per_part = int(options.get("rowsPerPartition", 100_000))
        self.marker = options.get("marker")
        self.progress = options.get("progress")
        if self.per_batch and not self.progress:
            raise ValueError("rowsPerBatch needs a progress folder")
        self.schema, self.seen = schema, 0

    def first(self) -> int:
        return 0

    def total(self) -> int:
        raise NotImplementedError

    def ranges(self, first: int, last: int) -> list[Range]:
        raise NotImplementedError

    def initialOffset(self) -> dict:
        return {"given": self.first()}

    def latestOffset(self) -> dict:
        end = self.total() + bool(self.marker)
        if not self.per_batch:
            return {"given": end}
        noted = get_whole(f"{self.progress}/offered")
        offered = max(self.first(), self.seen, json.loads(noted) if noted else 0)
        offered = min(end, offered + self.per_batch)
        put_whole(f"{self.progress}/offered", json.dumps(offered).encode())
        return {"given": offered}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        total = self.total()
        self.seen = max(self.seen, end["given"])
        planned = self.ranges(start["given"], min(end["given"], total))
        if start["given"] <= total < end["given"]:
            planned.append(Range(total, total))
        return planned

    def arrow(self) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema
        return to_arrow_schema(self.schema)

    def end_of_input(self) -> pa.RecordBatch:
        schema = self.arrow()
        kind = schema.field(self.marker).type
        end = END if pa.types.is_timestamp(kind) and kind.tz else END.replace(tzinfo=None)
        return pa.RecordBatch.from_arrays(
            [pa.array([end if f.name == self.marker else None], f.type) for f in schema], schema=schema)


class _CounterReader(_Paced):
    def __init__(self, options, schema):
        super().__init__(options, schema)
        self.start, self.stop = int(options.get("start", 0)), int(options["end"])
        self.step = int(options.get("stepMillis", 1))

    def first(self) -> int:
        return self.start

    def total(self) -> int:
        return max(self.start, self.stop)

    def ranges(self, first, last):
        return [Range(a, min(a + self.per_part, last)) for a in range(first, last, self.per_part)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part.first == part.last:
            yield self.end_of_input()
            return
        schema = self.arrow()
        for a in range(part.first, part.last, 10_000):
            n = range(a, min(a + 10_000, part.last))
            micros = pa.array([(i + 1 - self.start) * self.step * 1000 for i in n], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), micros.cast(schema.field("event_time").type)],
                                             schema=schema)


class CounterSource(DataSource):
    """Columns ``n`` and ``event_time``. Options: ``end`` (exclusive),
    ``start``, ``stepMillis`` and those of the module."""

    @classmethod
    def name(cls) -> str:
        return "rivulet_counter"

    def schema(self) -> str:
        return "n long, event_time timestamp"

    def streamReader(self, schema):
        return _CounterReader(self.options, schema)


class _ReplayReader(_Paced):
    def __init__(self, options, schema):
        super().__init__(options, schema)
        self.counter, self.path, self.files = options.get("counter"), options["path"], None

    def _files(self) -> list[tuple[str, int]]:
        """Files in order of name with their rows, from the footers."""
        if self.files is None:
            import pyarrow.parquet as pq
            from pyarrow import fs
            store, at = file_system(self.path)
            found = sorted(f.path for f in store.get_file_info(fs.FileSelector(at, recursive=True))
                           if f.is_file and f.base_name.endswith(".parquet") and f.base_name[0] not in "._")
            self.files = [(f, pq.read_metadata(f, filesystem=store).num_rows) for f in found]
        return self.files

    def total(self) -> int:
        return sum(n for _, n in self._files())

    def ranges(self, first, last):
        out, before = [], 0
        for path, n in self._files():
            for a in range(max(first, before), min(last, before + n), self.per_part):
                out.append(Range(a, min(a + self.per_part, last, before + n), path, a - before))
            before += n
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part.path is None:
            yield self.end_of_input()
            return
        import pyarrow.parquet as pq
        store, _ = file_system(self.path)
        schema = self.arrow()
        stored = [f for f in schema if f.name != self.counter]
        with store.open_input_file(part.path) as f:
            parquet, skip, given = pq.ParquetFile(f), part.skip, part.first
            groups = []
            for g in range(parquet.num_row_groups):  # groups before the range are not read
                rows = parquet.metadata.row_group(g).num_rows
                if not groups and skip >= rows:
                    skip -= rows
                else:
                    groups.append(g)
            for batch in parquet.iter_batches(10_000, groups, [c.name for c in stored]):
                if skip >= len(batch):
                    skip -= len(batch)
                    continue
                batch, skip = batch.slice(skip, min(len(batch) - skip, part.last - given)), 0
                columns = {c.name: batch.column(c.name).cast(c.type) for c in stored}
                if self.counter:
                    columns[self.counter] = pa.array(range(given, given + len(batch)), schema.field(self.counter).type)
                yield pa.RecordBatch.from_arrays([columns[c.name] for c in schema], schema=schema)
                given += len(batch)
                if given == part.last:
                    return


class ReplaySource(DataSource):
    """The rows of parquet files. Options: ``path``, ``counter`` (a long
    column of the schema that numbers the elements from 0) and those of the
    module; the schema is the caller's."""

    @classmethod
    def name(cls) -> str:
        return "rivulet_replay"

    def schema(self):
        raise ValueError("give the schema of the files: spark.readStream.schema(...)")

    def streamReader(self, schema):
        return _ReplayReader(self.options, schema)


def counter_stream(spark: SparkSession, end: int, start: int = 0, step_ms: int = 1, marker: bool = False,
                   **options) -> DataFrame:
    """A stream of ``n`` and ``event_time`` (see the module)."""
    register(spark, CounterSource)
    reader = spark.readStream.format("rivulet_counter").option("start", start).option("end", end) \
        .option("stepMillis", step_ms)
    if marker:
        reader = reader.option("marker", "event_time")
    return reader.options(**options).load()


def replay_stream(spark: SparkSession, path: str, schema: T.StructType | str, marker: str | None = None,
                  counter: str | None = None, **options) -> DataFrame:
    """A stream of the rows below ``path``, in order. ``marker`` names the
    event-time column an end marker is put into; ``counter`` adds a column
    that numbers the elements."""
    register(spark, ReplaySource)
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    reader = spark.readStream.format("rivulet_replay").option("path", path)
    if counter:
        kind = kind.add(counter, T.LongType())
        reader = reader.option("counter", counter)
    if marker:
        reader = reader.option("marker", marker)
    # a marker row has nulls everywhere else
    return reader.schema(T.StructType([T.StructField(f.name, f.dataType) for f in kind])).options(**options).load()
