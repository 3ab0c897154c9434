"""Stateful stream operators.

Per-record outputs (running totals, state-machine alerts) keep one small
state value per key across micro-batches with ``applyInPandasWithState``;
inside a micro-batch the function orders the key's rows by ``seq``. The
key's rows of one micro-batch form one group, so group size is bounded by
the trigger's batch limit (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``),
not by the key's total volume. State lives in the state store and is
restored from the checkpoint after a failure.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rivulet.functions.codecs import EVENT_TYPES
from rivulet.operators.statemachine import STATES, STEP, UNKNOWN, VALID, segmented_compose
from rivulet.operators.trigger import measured


def _micros(span: int | str) -> int:
    """Microseconds of an interval given as an int or as text ("1 hour")."""
    return span if isinstance(span, int) else int(pd.Timedelta(span) / pd.Timedelta(microseconds=1))


def _sum_type(stream: DataFrame, value: str) -> tuple[str, str, type]:
    """Spark type, numpy type and Python type of sums of a column."""
    whole = dict(stream.dtypes)[value] in ("tinyint", "smallint", "int", "bigint")
    return ("long", "int64", int) if whole else ("double", "float64", float)


def _without_nulls(stream: DataFrame, value: str, kind: str) -> DataFrame:
    """Nulls as zeros: in pandas they would turn integers into fractions."""
    return stream.withColumn(value, F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind)))


def running_totals(stream: DataFrame, key: str, seq: str, value: str,
                   out: str = "running") -> DataFrame:
    """One output row per input row: the key's running sum of ``value``
    across all micro-batches so far (a long for integers, else a double).
    A null adds nothing, as in the batch form."""
    kt = dict(stream.dtypes)[key]
    st = dict(stream.dtypes)[seq]
    kind, number, py = _sum_type(stream, value)
    stream = _without_nulls(stream, value, kind)

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        total = state.get[0] if state.exists else 0
        pdf = pd.concat(list(pdfs)).sort_values(seq)
        sums = total + pdf[value].to_numpy(number).cumsum()
        if len(sums):
            state.update((py(sums[-1]),))
        yield pd.DataFrame({key: pdf[key].to_numpy(), seq: pdf[seq].to_numpy(), out: sums})

    return stream.groupBy(key).applyInPandasWithState(
        fn, f"{key} {kt}, {seq} {st}, {out} {kind}", f"total {kind}", "append",
        GroupStateTimeout.NoTimeout)


def state_machine_alerts(stream: DataFrame, key: str, seq: str, event: str) -> DataFrame:
    """Alerts ``(key, seq, state, event)`` of the per-key state machine;
    the state index (Initial = 0) is the key's stream state. Null events are
    no events and unknown letters raise an alert, as in the batch form."""
    kt = dict(stream.dtypes)[key]
    st = dict(stream.dtypes)[seq]
    stream = stream.where(F.col(event).isNotNull())
    codes = {e: i for i, e in enumerate(EVENT_TYPES)}

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        cur = state.get[0] if state.exists else 0
        pdf = pd.concat(list(pdfs)).sort_values(seq)
        code = pdf[event].map(codes).fillna(UNKNOWN).to_numpy(np.intp)
        # the batch scan: after[i, s] is the state after row i from state s
        after = segmented_compose(STEP.T[code], np.arange(len(code)) == 0)[:, cur]
        before = np.concatenate([[cur], after[:-1]])
        bad = ~VALID[before, code]
        state.update((int(after[-1]) if len(after) else cur,))
        yield pd.DataFrame({key: pdf[key].to_numpy()[bad], seq: pdf[seq].to_numpy()[bad],
                            "state": [STATES[s] for s in before[bad]], "event": pdf[event].to_numpy()[bad]})

    return stream.groupBy(key).applyInPandasWithState(
        fn, f"{key} {kt}, {seq} {st}, state string, event string", "state int", "append",
        GroupStateTimeout.NoTimeout)


def count_window_sums(stream: DataFrame, key: str, seq: str, value: str, size: int, slide: int,
                      out: str = "window_sum") -> DataFrame:
    """Sliding count window per key: at every ``slide``-th row of a key,
    the sum of its last ``size`` rows. State: the key's row count and its
    last ``size - 1`` values (bounded by the window, not by the key). A null
    is a row of its window that adds nothing, as in the batch form."""
    kt, st = dict(stream.dtypes)[key], dict(stream.dtypes)[seq]
    kind, number, py = _sum_type(stream, value)
    stream = _without_nulls(stream, value, kind)

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        n, tail = (state.get[0], list(state.get[1])) if state.exists else (0, [])
        pdf = pd.concat(list(pdfs)).sort_values(seq)
        # a window's sum is a difference of running sums over tail and rows
        values = np.concatenate([np.array(tail, number), pdf[value].to_numpy(number)])
        sums = np.concatenate([[0], values.cumsum()]).astype(number)
        rn = n + np.arange(1, len(pdf) + 1)
        end = len(tail) + np.arange(1, len(pdf) + 1)
        window = sums[end] - sums[np.maximum(end - size, 0)]
        fires = rn % slide == 0
        state.update((int(n + len(pdf)), [py(v) for v in values[-(size - 1):]] if size > 1 else []))
        yield pd.DataFrame({key: pdf[key].to_numpy()[fires], seq: pdf[seq].to_numpy()[fires],
                            "rn": rn[fires], out: window[fires]})

    return stream.groupBy(key).applyInPandasWithState(
        fn, f"{key} {kt}, {seq} {st}, rn long, {out} {kind}", f"n long, tail array<{kind}>", "append",
        GroupStateTimeout.NoTimeout)


def followed_by(stream: DataFrame, key: str, seq: str, ts: str, first: str, then: str,
                kind: str, within: int | str, carry: list[str]) -> DataFrame:
    """Pattern ``(A B)``: a row of ``kind == first`` whose next row of the
    same key has ``kind == then`` less than ``within_us`` later. State: the
    key's last row (a pending A, or a marker that the last row was not A).
    ``within`` is microseconds or interval text such as ``"1 hour"``."""
    within_us = _micros(within)
    dt = dict(stream.dtypes)
    kt, st = dt[key], dt[seq]
    out_cols = [seq, ts, *carry]
    schema = (f"{key} {kt}, " + ", ".join(f"{c} {dt[c]}" for c in out_cols) + f", next_{seq} {st}")
    state_schema = "is_a boolean, " + ", ".join(f"p_{c} {dt[c]}" for c in out_cols)

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        prev = state.get if state.exists else None
        pdf = pd.concat(list(pdfs)).sort_values(seq)
        rows = pdf[out_cols]
        is_a = (pdf[kind] == first).to_numpy(bool)
        if prev is not None:  # the last row of the batches before
            rows = pd.concat([pd.DataFrame([prev[1:]], columns=out_cols), rows], ignore_index=True)
            is_a = np.concatenate([[prev[0]], is_a])
        is_b = np.concatenate([np.zeros(len(rows) - len(pdf), bool), (pdf[kind] == then).to_numpy(bool)])
        times = pd.to_datetime(rows[ts]).to_numpy("datetime64[us]").astype(np.int64)
        pair = is_a[:-1] & is_b[1:] & (np.diff(times) < within_us)
        # the B row of a match cannot be the A row of the next one: of pairs
        # in a row, every other one is a match
        at = np.arange(len(pair))
        since = at - np.maximum.accumulate(np.where(pair, -1, at)) if len(pair) else at
        hit = pair & (since % 2 == 1)
        if len(rows):
            open_a = is_a[-1] and not (len(hit) and hit[-1])
            state.update((bool(open_a), *rows.iloc[-1].tolist()))
        found = rows[:-1][hit].assign(**{f"next_{seq}": rows[seq].to_numpy()[1:][hit]})
        found.insert(0, key, k[0])
        yield found

    return stream.groupBy(key).applyInPandasWithState(
        fn, schema, state_schema, "append", GroupStateTimeout.NoTimeout)


def start_then_run(stream: DataFrame, key: str, seq: str, kind: str, a: str,
                   start_cols: list[str]) -> DataFrame:
    """Pattern ``(STRT A+)``, greedy, skip past last row: a match is emitted
    when the row after its last A arrives. Columns as in the batch form.
    State: the key's last row and its open run."""
    dt = dict(stream.dtypes)
    kt, st = dt[key], dt[seq]
    starts = ", ".join(f"start_{c} {dt[c]}" for c in start_cols)
    state_schema = (f"seen boolean, open boolean, n long, last {st}, "
                    + ", ".join(f"p_{c} {dt[c]}, s_{c} {dt[c]}" for c in start_cols))

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        blank = [None] * len(start_cols)
        seen, is_open, n, last, prev, start = False, False, 0, None, blank, blank
        if state.exists:
            seen, is_open, n, last, *rest = state.get
            prev, start = list(rest[::2]), list(rest[1::2])
        pdf = pd.concat(list(pdfs)).sort_values(seq)
        flags = (pdf[kind] == a).to_numpy(bool)
        at = [0, *(np.flatnonzero(flags[1:] != flags[:-1]) + 1).tolist(), len(pdf)]
        rows = []
        for lo, hi in zip(at, at[1:]):  # runs of equal flags, not rows
            if flags[lo]:
                if not is_open:
                    # the key's first row has none before it and is STRT itself
                    start = prev if seen else pdf[start_cols].iloc[lo].tolist()
                    n = 0 if seen else -1
                is_open, n, last = True, n + hi - lo, pdf[seq].iloc[hi - 1]
            elif is_open:
                if n > 0:
                    rows.append((k[0], *start, last, n))
                is_open = False
            seen, prev = True, pdf[start_cols].iloc[hi - 1].tolist()
        pairs = [x for p, s in zip(prev, start) for x in (p, s)]
        state.update((seen, is_open, int(n), None if last is None else int(last), *pairs))
        yield pd.DataFrame(rows, columns=[key, *(f"start_{c}" for c in start_cols), "last_a", "run_length"])

    return stream.groupBy(key).applyInPandasWithState(
        fn, f"{key} {kt}, {starts}, last_a {st}, run_length long", state_schema, "append",
        GroupStateTimeout.NoTimeout)


def delta_trigger_top(stream: DataFrame, key: str, seq: str, ts: str, speed: str, distance: str,
                      threshold: float, evict: int | str) -> DataFrame:
    """Delta trigger + time evictor + argmax per key on a stream. State:
    armed flag, distance of the last firing, and the monotonic deque of
    candidate rows inside the eviction span (bounded by that span).
    ``evict`` is microseconds or interval text such as ``"10 seconds"``.
    Rows without a seq, ts, speed or distance take no part, as in the batch
    form."""
    evict_us = _micros(evict)
    kt, st = dict(stream.dtypes)[key], dict(stream.dtypes)[seq]
    stream = measured(stream, seq, ts, speed, distance)

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        if state.exists:
            armed, last_d = state.get[0], state.get[1]
            dq = [tuple(x) for x in zip(*state.get[2:])]
        else:
            armed, last_d, dq = False, 0.0, []
        pdf = pd.concat(list(pdfs)).sort_values(seq)
        micros = pdf[ts].astype("datetime64[us]").astype("int64")
        rows = []
        for q, v, d, t in zip(pdf[seq], pdf[speed], pdf[distance], micros):
            while dq and dq[-1][1] < v:
                dq.pop()
            dq.append((int(q), float(v), float(d), int(t)))
            if not armed:
                armed, last_d = True, float(d)
                continue
            if d - last_d > threshold:
                last_d = float(d)
                cut = t - evict_us
                while dq and dq[0][3] <= cut:
                    dq.pop(0)
                if not dq:                                  # everything evicted: empty window
                    continue
                tq, tv, td, tt = dq[0]
                rows.append((k[0], int(q), tq, tv, td))
        # drop candidates that can no longer be inside any later span
        if dq:
            newest = dq[-1][3]
            dq = [x for x in dq if x[3] > newest - evict_us]
        state.update((armed, last_d, *([x[i] for x in dq] for i in range(4))))
        yield pd.DataFrame(rows, columns=[key, f"fire_{seq}", seq, speed, distance])

    return stream.groupBy(key).applyInPandasWithState(
        fn, f"{key} {kt}, fire_{seq} {st}, {seq} {st}, {speed} double, {distance} double",
        "armed boolean, last_d double, q array<long>, v array<double>, d array<double>, t array<long>",
        "append",
        GroupStateTimeout.NoTimeout)


def connected_apply(data: DataFrame, model: DataFrame, key: str, order: str,
                    model_value: str, buckets: int = 64) -> DataFrame:
    """Two connected streams: model updates and data rows. Every data row
    is answered with the latest model seen before it (in ``order``), and
    every model update yields one ``update`` row.

    The model stream is small; each update is copied to all ``buckets``
    groups, data rows are spread over the groups by a hash of ``key``, and
    each group keeps the latest model as its state, so the data side never
    meets in one task."""
    dt = dict(data.dtypes)
    tagged_data = data.select(F.pmod(F.hash(key), F.lit(buckets)).alias("_bucket"),
                              F.lit(0).alias("_tag"), F.col(key).cast("long").alias("_key"),
                              F.col(order).cast("long").alias("_order"),
                              F.lit(None).cast("double").alias("_model"))
    tagged_model = model.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_bucket"),
                                F.lit(1).alias("_tag"), F.lit(None).cast("long").alias("_key"),
                                F.col(order).cast("long").alias("_order"),
                                F.col(model_value).cast("double").alias("_model"))

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState):
        cur = state.get[0] if state.exists else None
        pdf = pd.concat(list(pdfs)).sort_values(["_order", "_tag"], ascending=[True, False])
        update = (pdf["_tag"] == 1).to_numpy()
        latest = pdf["_model"].astype(float).where(update).ffill()
        latest = latest if cur is None else latest.fillna(cur)
        if update.any():
            cur = float(latest.iloc[-1])
        state.update((cur,))
        out = pd.DataFrame({"kind": np.where(update, "update", "prediction"),
                            key: pdf["_key"].astype("Int64").to_numpy(), order: pdf["_order"].to_numpy(),
                            "model": latest.to_numpy()})
        out["model"] = out["model"].astype(object).where(out["model"].notna(), None)
        # one update row per model, not one per copy
        yield out if k[0] == 0 else out[~update]

    return tagged_data.unionByName(tagged_model).groupBy("_bucket").applyInPandasWithState(
        fn, f"kind string, {key} long, {order} long, model double", "model double", "append",
        GroupStateTimeout.NoTimeout)
