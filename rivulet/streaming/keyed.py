"""Stateful stream operators on ``transformWithState``: value and list state
with timers and time to live, in RocksDB (``config.use_rocksdb_state``).

The state machine, running totals and connected streams give what their forms
in ``streaming.stateful`` give; with ``idle_ms`` a key that has had no row for
so long (in processing time) loses its state and begins anew, so the state no
longer grows with every key ever seen.

``followed_by_in_time`` is the pattern ``(A B)`` over all rows in event time,
without a partition key. Time is cut into blocks. A row is kept in the state
of its block, in chunks as they arrive, and until the watermark passes the
block's end plus ``within`` nothing is decided. Then the block is ordered and
matched at once; of the rows behind it only the first is needed, which every
row near the block's end is a candidate for. No group holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rivulet.functions.codecs import EVENT_TYPES
from rivulet.operators.statemachine import STATES, STEP, UNKNOWN, VALID, segmented_compose
from rivulet.session import by_value
from rivulet.streaming.stateful import _micros, _sum_type, _without_nulls


def _frame(rows: Iterator[pd.DataFrame], columns: list[str]) -> pd.DataFrame:
    """The rows of a group; Spark renames columns that are no identifiers."""
    pdf = pd.concat(list(rows))
    pdf.columns = columns
    return pdf


class _Sorted(StatefulProcessor):
    """One value of state per key; rows of a key in order of ``seq``."""

    def __init__(self, state_schema: str, seq: str | list[str], idle_ms: int | None) -> None:
        self.state_schema, self.seq, self.idle_ms = state_schema, seq, idle_ms
        self.columns: list[str] = []  # of the stream, set when it is known

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.state_schema, self.idle_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self.state.get()[0] if self.state.exists() else None
        after, out = self.step(key, before, _frame(rows, self.columns).sort_values(self.seq))
        self.state.update((after,))
        yield out

    def close(self) -> None:
        pass


def _run(stream: DataFrame, by: str, processor: _Sorted, schema: str) -> DataFrame:
    processor.columns = stream.columns
    with by_value():
        return stream.groupBy(by).transformWithStateInPandas(
            processor, schema, "append", "ProcessingTime" if processor.idle_ms else "none")


class _Totals(_Sorted):
    def __init__(self, key, seq, value, out, number, py, *rest):
        super().__init__(*rest)
        self.key, self.at, self.value, self.out, self.number, self.py = key, seq, value, out, number, py

    def step(self, key, before, pdf):
        sums = (before or 0) + pdf[self.value].to_numpy(self.number).cumsum()
        return self.py(sums[-1]), pd.DataFrame(
            {self.key: pdf[self.key].to_numpy(), self.at: pdf[self.at].to_numpy(), self.out: sums})


def running_totals(stream: DataFrame, key: str, seq: str, value: str, out: str = "running",
                   idle_ms: int | None = None) -> DataFrame:
    """One row per input row: the key's running sum of ``value``; a null adds
    nothing."""
    dt = dict(stream.dtypes)
    kind, number, py = _sum_type(stream, value)
    processor = _Totals(key, seq, value, out, number, py, f"total {kind}", seq, idle_ms)
    return _run(_without_nulls(stream, value, kind), key, processor, f"{key} {dt[key]}, {seq} {dt[seq]}, {out} {kind}")


class _Machine(_Sorted):
    def __init__(self, key, seq, event, *rest):
        super().__init__(*rest)
        self.key, self.at, self.event = key, seq, event

    def step(self, key, before, pdf):
        current = before or 0
        code = pdf[self.event].map({e: i for i, e in enumerate(EVENT_TYPES)}).fillna(UNKNOWN).to_numpy(np.intp)
        after = segmented_compose(STEP.T[code], np.arange(len(code)) == 0)[:, current]
        states = np.concatenate([[current], after[:-1]])
        bad = ~VALID[states, code]
        return int(after[-1]), pd.DataFrame(
            {self.key: pdf[self.key].to_numpy()[bad], self.at: pdf[self.at].to_numpy()[bad],
             "state": [STATES[s] for s in states[bad]], "event": pdf[self.event].to_numpy()[bad]})


def state_machine_alerts(stream: DataFrame, key: str, seq: str, event: str, idle_ms: int | None = None) -> DataFrame:
    """Alerts ``(key, seq, state, event)``; null events are none, unknown
    letters raise an alert."""
    dt = dict(stream.dtypes)
    return _run(stream.where(F.col(event).isNotNull()), key, _Machine(key, seq, event, "state int", seq, idle_ms),
                f"{key} {dt[key]}, {seq} {dt[seq]}, state string, event string")


class _Latest(_Sorted):
    def __init__(self, key, order, *rest):
        super().__init__(*rest)
        self.key, self.order = key, order

    def handleInputRows(self, key, rows, timerValues):
        # a model update comes before the data of its time
        pdf = _frame(rows, self.columns).sort_values(["_order", "_update"], ascending=[True, False])
        update = pdf["_update"].to_numpy(bool)
        latest = pdf["_model"].astype(float).where(update).ffill()
        if self.state.exists():
            latest = latest.fillna(self.state.get()[0])
        if update.any():
            self.state.update((float(latest.iloc[-1]),))
        out = pd.DataFrame({"kind": np.where(update, "update", "prediction"),
                            self.key: pdf["_key"].astype("Int64").to_numpy(), self.order: pdf["_order"].to_numpy(),
                            "model": latest.astype(object).where(latest.notna(), None).to_numpy()})
        yield out if key[0] == 0 else out[~update]


def connected_apply(data: DataFrame, model: DataFrame, key: str, order: str, model_value: str,
                    buckets: int = 64) -> DataFrame:
    """Data rows answered with the latest model before them, and one row per
    model update. Every update goes to all ``buckets`` groups, data rows to
    one by a hash of their key; a group's state is one model."""
    rows = data.select(F.pmod(F.hash(key), F.lit(buckets)).alias("_bucket"), F.lit(False).alias("_update"),
                       F.col(key).cast("long").alias("_key"), F.col(order).cast("long").alias("_order"),
                       F.lit(None).cast("double").alias("_model"))
    updates = model.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_bucket"),
                           F.lit(True).alias("_update"), F.lit(None).cast("long").alias("_key"),
                           F.col(order).cast("long").alias("_order"), F.col(model_value).cast("double").alias("_model"))
    return _run(rows.unionByName(updates), "_bucket", _Latest(key, order, "model double", "_order", None),
                f"kind string, {key} long, {order} long, model double")


def _packed(pdf: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(pdf, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(chunk: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(chunk).read_pandas()


class _BlockOfTime(StatefulProcessor):
    def __init__(self, columns, ts, tie, block_us, within_us, kept, nexts):
        self.columns, self.ts, self.tie, self.block_us, self.within_us = columns, ts, tie, block_us, within_us
        self.kept, self.nexts = kept, nexts  # columns of the A row, of the B row

    def init(self, handle):
        self.handle = handle
        self.rows = handle.getListState("rows", "chunk binary")
        self.ahead = handle.getValueState("ahead", "chunk binary")

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows, self.columns)
        own, ahead = pdf[pdf["_own"]], pdf[~pdf["_own"]]
        if len(own):
            self.rows.appendValue((_packed(own.drop(columns=["_block", "_own"])),))
        if len(ahead):
            ahead = ahead.drop(columns=["_block", "_own"])
            if self.ahead.exists():
                ahead = pd.concat([_unpacked(self.ahead.get()[0]), ahead])
            self.ahead.update((_packed(ahead.sort_values(["_us", self.tie]).iloc[:1]),))
        # the watermark has passed all that can follow a row of the block
        self.handle.registerTimer(-(-((key[0] + 1) * self.block_us + self.within_us) // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        chunks = [_unpacked(c[0]) for c in self.rows.get()] if self.rows.exists() else []
        if chunks:
            rows = pd.concat(chunks).sort_values(["_us", self.tie])
            if self.ahead.exists():
                rows = pd.concat([rows, _unpacked(self.ahead.get()[0])])
            yield self.matches(rows.reset_index(drop=True))
        self.rows.clear()
        self.ahead.clear()

    def matches(self, rows: pd.DataFrame) -> pd.DataFrame:
        a, b, at = rows["_a"].to_numpy(bool), rows["_b"].to_numpy(bool), rows["_us"].to_numpy()
        if (a & b).any():
            raise ValueError("a row that is A and B at once would link matches across blocks of time")
        hit = np.flatnonzero(a[:-1] & b[1:] & (np.diff(at) < self.within_us))
        found = rows.loc[hit, self.kept].reset_index(drop=True)
        for c in self.nexts:
            found[f"next_{c}"] = rows[c].to_numpy()[hit + 1]
        return found

    def close(self):
        pass


def followed_by_in_time(stream: DataFrame, ts: str, tie: str, first: Column, then: Column, within: int | str,
                        carry: Sequence[str], block: int | str = "1 hour") -> DataFrame:
    """Pattern ``(A B)`` over all rows in order of ``ts`` (``tie`` orders equal
    times): an A row whose very next row is a B row less than ``within`` later.
    Returns ``ts``, ``tie`` and ``carry`` of the A row and ``next_`` of ``tie``
    and ``carry``, once the watermark (to be declared on ``ts``) is past.

    ``block`` and ``within`` are microseconds or interval text. Rows less than
    ``within`` behind a block go to it as well, so a block should be longer
    than ``within``, and short enough for its rows to fit a task. Rows without
    a time take no part; no row may be A and B at once.
    """
    block_us, within_us = _micros(block), _micros(within)
    dt = dict(stream.dtypes)
    kept = list(dict.fromkeys([ts, tie, *carry]))
    nexts = [c for c in kept if c != ts]
    own = F.floor(F.unix_micros(ts) / F.lit(block_us)).cast("long")
    behind = F.floor((F.unix_micros(ts) - F.lit(within_us)) / F.lit(block_us)).cast("long")
    cut = (stream.where(F.col(ts).isNotNull())
           .select(*kept, F.unix_micros(ts).alias("_us"), F.coalesce(first, F.lit(False)).alias("_a"),
                   F.coalesce(then, F.lit(False)).alias("_b"), own.alias("_mine"),
                   # block k needs it if it ends at most within before
                   F.explode(F.sequence(behind, own)).alias("_block"))
           .withColumn("_own", F.col("_block") == F.col("_mine")).drop("_mine")
           .where(F.col("_own") | (F.col("_us") < (F.col("_block") + 1) * block_us + within_us)))
    schema = ", ".join([*(f"`{c}` {dt[c]}" for c in kept), *(f"`next_{c}` {dt[c]}" for c in nexts)])
    with by_value():
        return cut.groupBy("_block").transformWithStateInPandas(
            _BlockOfTime(cut.columns, ts, tie, block_us, within_us, kept, nexts), schema, "append", "EventTime")
