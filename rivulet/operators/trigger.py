"""Global window per key with a delta trigger, a time evictor and an
argmax output (the "top speed" job).

Semantics, per key in ``seq`` order: the first row arms the trigger; a
later row fires when its ``distance`` minus the distance of the last firing
row (or of the arming row) is more than ``threshold``. At a firing,
rows at or older than ``evict`` before the firing row are evicted, and the
kept row with the highest ``speed`` is emitted (the earliest one on ties).
``distance`` and ``ts`` must be non-decreasing in ``seq`` within a key
(cumulative distance, event time); this is checked, inside blocks and from
one block to the next. A row that has no ``seq`` or ``ts``, or whose ``speed``
or ``distance`` is null or NaN, is no measurement: it neither arms, fires,
wins nor breaks the order.

Plan - no key is ever processed whole by one task:

1. Rows are cut into blocks (``seq // width``). Because distance is
   monotone, the last firing distance ``L`` entering a block is at most the
   block's first distance, so the block's first firing can only be one of
   the rows within ``threshold`` of it (or the row just after them). Each block
   (in parallel) reports, for each such candidate, the distance of the
   last firing of the chain that starts there (``next`` pointers by binary
   search, chain ends by pointer doubling), plus its *staircase*: the rows
   not beaten by a later, strictly faster row of the block.
2. A fold over the block summaries of each key - a table ``width`` times
   smaller - gives every block its entry state: armed flag, ``L``, and the
   staircase of earlier rows that can still win an argmax in this block.
3. Every block replays itself from its entry state (in parallel): the
   firing chain, then the argmax of each firing over its eviction span,
   from one range-max table over the entry staircase and the block's rows.

Keys with few rows make blocks of few rows, many times as many as tasks. So
the Python side never works block by block: ``whole_groups`` hands it some
ten thousand rows of whole blocks at once as Arrow columns, and every step is
numpy over all of them, kept apart by where the blocks begin and end. The
entry state travels as rows of its block, not as a column of every row.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.sequence import BLK, DEFAULT_WIDTH, with_block
from rivulet.operators.windows import micros

#: Rows that ``whole_groups`` collects before it hands on the whole groups.
CHUNK = 1 << 16

#: Kinds of the rows of a block at its replay, in their order: the firing the
#: block is entered with, its entry staircase, its own rows.
LAST, EARLIER, OWN = 0, 1, 2


def _starts(batch: pa.RecordBatch, cols) -> np.ndarray:
    """Where the groups of a batch sorted by ``cols`` begin."""
    change = np.zeros(batch.num_rows, dtype=bool)
    change[0] = True
    for c in cols:
        at = batch.column(c).dictionary_encode().indices.to_numpy()
        change[1:] |= at[1:] != at[:-1]
    return np.flatnonzero(change)


def whole_groups(batches, cols, chunk: int = CHUNK):
    """Yield ``(record batch, where its groups begin)`` from the Arrow batches
    of a partition sorted by ``cols``: many whole groups at a time, in order.
    Memory: ``chunk`` rows or twice the largest group."""
    held, n, enough = [], 0, chunk
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < enough:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        starts = _starts(whole, cols)
        last = int(starts[-1])
        if last:
            yield whole.slice(0, last), starts[:-1]
        held, n = [whole.slice(last)], n - last
        enough = max(chunk, 2 * n)                          # a long group is not searched at every batch
    if held:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield whole, _starts(whole, cols)


def _ends(starts: np.ndarray, n: int) -> np.ndarray:
    return np.append(starts[1:], n)


def _per_row(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The value of each group at each of its rows."""
    return np.repeat(values, _ends(starts, n) - starts)


def _first(holds, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each pair the first index from ``lo`` on, below ``hi``, at which
    ``holds(indices, which pairs)`` (``hi`` if none); it must stay true from
    there on."""
    lo, hi = lo.copy(), hi.copy()
    todo = np.flatnonzero(lo < hi)
    while len(todo):
        mid = (lo[todo] + hi[todo]) // 2
        yes = holds(mid, todo)
        hi[todo[yes]] = mid[yes]
        lo[todo[~yes]] = mid[~yes] + 1
        todo = todo[lo[todo] < hi[todo]]
    return hi


def _first_over(d: np.ndarray, last: np.ndarray, threshold: float, lo=None, hi=None) -> np.ndarray:
    """For each value of ``last`` the first index from ``lo`` on, below
    ``hi``, with ``d - last > threshold`` (``hi`` if none), by the subtraction
    itself. Without bounds all of ``d`` is searched."""
    lo = np.zeros(len(last), dtype=np.int64) if lo is None else lo
    hi = np.full(len(last), len(d), dtype=np.int64) if hi is None else hi
    return _first(lambda at, which: d[at] - last[which] > threshold, lo, hi)


def _next_and_end(d: np.ndarray, threshold: float, starts: np.ndarray = np.zeros(1, dtype=np.int64)):
    """``nxt[i]``: first row after ``i`` in its group that fires if ``i`` was
    the last to fire (the group's end if none); ``end[i]``: last row of the
    firing chain i -> nxt[i] -> ... inside the group."""
    rows = np.arange(len(d))
    ends = _per_row(_ends(starts, len(d)), starts, len(d))
    nxt = _first_over(d, d, threshold, rows + 1, ends)
    ptr = np.where(nxt < ends, nxt, rows)
    while True:
        nptr = ptr[ptr]
        if np.array_equal(nptr, ptr):
            return nxt, ptr
        ptr = nptr


def _staircase(speed: np.ndarray, starts: np.ndarray = np.zeros(1, dtype=np.int64)) -> np.ndarray:
    """Indices of rows with no strictly faster row after them in their group."""
    n = len(speed)
    # ranks, lower by n from group to group: no later group's is above them
    rank = np.unique(speed, return_inverse=True)[1] - n * _per_row(np.arange(len(starts)), starts, n)
    later_max = np.maximum.accumulate(rank[::-1])[::-1]
    return np.flatnonzero(rank >= np.append(later_max[1:], rank[-1]))


_NOT_MONOTONE = "distance and ts must be non-decreasing in seq within a key"


def _check_monotone(d: np.ndarray, t: np.ndarray, starts: np.ndarray) -> None:
    falls = (np.diff(d) < 0) | (np.diff(t) < 0)
    falls[starts[1:] - 1] = False
    if falls.any():
        raise ValueError(_NOT_MONOTONE)


def measured(df: DataFrame, seq: str, ts: str, speed: str, distance: str) -> DataFrame:
    """The rows that are measurements."""
    real = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (speed, distance)]
    return df.where(F.col(seq).isNotNull() & F.col(ts).isNotNull() & real[0] & real[1])


def delta_trigger_top(df: DataFrame, key: str, ts: str, seq: str, speed: str,
                      distance: str, threshold: float, evict: str,
                      width: int = DEFAULT_WIDTH) -> DataFrame:
    """Return ``(key, fire_seq, seq, speed, distance, ts)`` per firing. The
    key may be null or of any simple type."""
    df = measured(df, seq, ts, speed, distance)
    ntz = dict(df.dtypes)[ts] == "timestamp_ntz"
    span = F.expr(f"timestampdiff(MICROSECOND, `{ts}` - INTERVAL {evict}, `{ts}`)")
    rows = df.select(
        F.to_json(F.struct(F.col(key).alias("k")), {"ignoreNullFields": "false"}).alias("k"), F.col(seq).cast("long").alias("q"),
        F.col(speed).cast("double").alias("v"), F.col(distance).cast("double").alias("d"),
        micros(df, ts).alias("t"), span.alias("span"))
    thr = float(threshold)
    order = ["q", "d", "t"]
    # both passes read this one exchange
    b = with_block(rows, "k", "q", width).drop("_key").repartition("k", BLK)

    # 1. per-block summaries. L entering a block is at most the block's own
    #    first distance (monotone), so the first firing is among the rows
    #    with d <= d[0] + threshold, or the row just after them.
    def summarise(batches):
        for g, starts in whole_groups(batches, ["k", BLK]):
            d, v, t, q, span = (g.column(c).to_numpy() for c in ("d", "v", "t", "q", "span"))
            n, ends = len(d), _ends(starts, len(d))
            _check_monotone(d, t, starts)
            nxt, end = _next_and_end(d, thr, starts)
            cand = np.flatnonzero(np.arange(n) <= _per_row(nxt[starts], starts, n))
            st = _staircase(v, starts)
            # not the rows that leave together with an equally fast earlier one
            same = np.zeros(len(st), dtype=bool)
            same[1:] = (v[st[1:]] == v[st[:-1]]) & (t[st[1:]] == t[st[:-1]])
            same[np.searchsorted(st, starts)] = False
            st = st[~same]
            heads = pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [g.column("k").take(heads), g.column(BLK).take(heads),
                 *_lists(cand, starts, d[cand], d[end[cand]]),
                 *map(pa.array, (t[starts], t[ends - 1], d[ends - 1], span[starts], np.maximum.reduceat(v, starts))),
                 *_lists(st, starts, q[st], v[st], d[st], t[st])], schema=_SUMMARY)

    summary_schema = ("k string, _blk long, cand_d array<double>, exit_d array<double>, "
                      "t0 long, t1 long, d1 double, span long, vmax double, st_q array<long>, st_v array<double>, "
                      "st_d array<double>, st_t array<long>")
    summaries = b.sortWithinPartitions("k", BLK, *order).mapInArrow(summarise, summary_schema)

    # 2. per-key fold over block summaries -> entry state of every block, as
    #    rows of the block: none for a key's first block
    def fold(batches):
        key, armed, last = None, False, 0.0
        before_t = before_d = None
        stairs = deque()                                    # (q, v, d, t): t rises, v does not
        out = _Entries()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in _SUMMARY.names]
            for k, blk, cand_d, exit_d, t0, t1, d1, span, vmax, st_q, st_v, st_d, st_t in zip(*cols):
                if k != key:
                    key, armed, last = k, False, 0.0
                    before_t = before_d = None
                    stairs.clear()
                if before_t is not None and (t0 < before_t or cand_d[0] < before_d):
                    raise ValueError(_NOT_MONOTONE)
                before_t, before_d = t1, d1
                while stairs and stairs[0][3] <= t0 - span:
                    stairs.popleft()
                if not armed:                               # the key's first row arms
                    armed, last = True, exit_d[0]
                else:
                    out.add(k, blk, last, stairs, t1 - span)
                    f = bisect_left(cand_d, True, key=lambda x: x - last > thr)
                    if f < len(cand_d):
                        last = exit_d[f]
                while stairs and stairs[-1][1] < vmax:
                    stairs.pop()
                stairs.extend(zip(st_q, st_v, st_d, st_t))
                if len(out.k) >= CHUNK:
                    yield out.batch()
                    out = _Entries()
        yield out.batch()

    entry_schema = "k string, _blk long, kind int, q long, v double, d double, t long, span long"
    entries = (summaries.repartition("k").sortWithinPartitions("k", BLK)
               .mapInArrow(fold, entry_schema))

    # 3. replay every block from its entry state
    def replay(batches):
        for g, starts in whole_groups(batches, ["k", BLK]):
            kind, d, v, t, q, span = (g.column(c).to_numpy() for c in ("kind", "d", "v", "t", "q", "span"))
            n, ends = len(d), _ends(starts, len(d))
            own = kind == OWN
            first = starts + np.add.reduceat(~own, starts, dtype=np.int64)   # each block's first own row
            end = _per_row(ends, starts, n)
            nxt = _first_over(d, d, thr, np.where(own, np.arange(n) + 1, end), end)
            entered = kind[starts] == LAST
            at = np.where(entered, _first_over(d, d[starts], thr, first, ends), nxt[first])   # row 0 only arms
            fires, block = [], np.arange(len(starts))
            while True:
                going = at < ends[block]
                at, block = at[going], block[going]
                if not len(at):
                    break
                fires.append((at, block))
                at = nxt[at]
            if not fires:
                continue
            fire, block = (np.concatenate(x) for x in zip(*fires))
            cut = t[fire] - span[first[block]]
            lo = _first(lambda at, which: t[at] > cut[which], starts[block], fire + 1)
            kept = lo <= fire                               # else everything evicted: empty window
            fire, lo = fire[kept], lo[kept]
            if not len(fire):
                continue
            top = _range_argmax(_range_argmax_table(v, int((fire - lo).max()) + 1), v, lo, fire)
            yield pa.RecordBatch.from_arrays(
                [g.column("k").take(pa.array(fire)), *map(pa.array, (q[fire], q[top], v[top], d[top], t[top]))],
                names=["k", "fire_q", "q", "v", "d", "t"])

    fired = (b.select("k", BLK, F.lit(OWN).alias("kind"), *order[:1], "v", "d", "t", "span").union(entries)
             .repartition("k", BLK).sortWithinPartitions("k", BLK, "kind", *order)
             .mapInArrow(replay, "k string, fire_q long, q long, v double, d double, t long"))
    back = F.from_json("k", f"k {dict(df.dtypes)[key]}")["k"]
    return fired.select(back.alias(key), F.col("fire_q").alias(f"fire_{seq}"),
                        F.col("q").alias(seq), F.col("v").alias(speed), F.col("d").alias(distance),
                        (F.expr("timestampadd(MICROSECOND, t, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
                         if ntz else F.timestamp_micros("t")).alias(ts))


_DOUBLES, _LONGS = pa.list_(pa.float64()), pa.list_(pa.int64())
_SUMMARY = pa.schema({"k": pa.string(), BLK: pa.int64(), "cand_d": _DOUBLES, "exit_d": _DOUBLES, "t0": pa.int64(),
                      "t1": pa.int64(), "d1": pa.float64(), "span": pa.int64(), "vmax": pa.float64(),
                      "st_q": _LONGS, "st_v": _DOUBLES, "st_d": _DOUBLES, "st_t": _LONGS})


def _lists(at: np.ndarray, starts: np.ndarray, *values: np.ndarray) -> list[pa.ListArray]:
    """Per group the list of the values that stand at its rows ``at``."""
    bounds = pa.array(np.append(np.searchsorted(at, starts), len(at)), pa.int32())
    return [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in values]


class _Entries:
    """Entry states as rows of their blocks."""

    def __init__(self):
        self.k, self.blk, self.kind, self.q, self.v, self.d, self.t = ([] for _ in range(7))

    def add(self, k, blk, last, stairs, cut):
        """The stairs up to ``cut``, which a firing of the block may evict,
        and the one after them, which no firing evicts and which beats the
        rest. However long the staircase, a row is evicted in one block, so
        there are at most as many entry rows as rows and twice the blocks."""
        kept = []
        for stair in stairs:
            kept.append(stair)
            if stair[3] > cut:
                break
        n = len(kept)
        self.k += [k] * (n + 1)
        self.blk += [blk] * (n + 1)
        self.kind += [LAST] + [EARLIER] * n
        head = (0, -np.inf, last, -(1 << 63))               # before every eviction span
        for col, x in zip((self.q, self.v, self.d, self.t), zip(head, *kept)):
            col += x

    def batch(self) -> pa.RecordBatch:
        i, f = pa.int64(), pa.float64()
        return pa.RecordBatch.from_arrays(
            [pa.array(self.k, pa.string()), pa.array(self.blk, i), pa.array(self.kind, pa.int32()), pa.array(self.q, i),
             pa.array(self.v, f), pa.array(self.d, f), pa.array(self.t, i), pa.array([0] * len(self.k), i)],
            names=["k", BLK, "kind", "q", "v", "d", "t", "span"])


def _range_argmax_table(v: np.ndarray, longest: int | None = None) -> list[np.ndarray]:
    """Sparse table of argmax indices for ranges of up to ``longest`` rows
    (any by default); ties resolve to the earlier row."""
    levels = [np.arange(len(v))]
    k = 1
    while 2 * k <= (len(v) if longest is None else longest):
        prev = levels[-1]
        a, b = prev[:len(v) - 2 * k + 1], prev[k:len(v) - k + 1]
        levels.append(np.where(v[a] >= v[b], a, b))
        k *= 2
    return levels


def _range_argmax(levels, v, lo, hi) -> np.ndarray:
    """Index of the earliest largest value of each range ``lo`` to ``hi``."""
    lo, hi = np.atleast_1d(lo), np.atleast_1d(hi)
    k = np.frexp(hi - lo + 1)[1] - 1                        # floor of the logarithm
    top = np.empty(len(lo), dtype=np.int64)
    for level in np.unique(k):
        m = k == level
        a, b = levels[level][lo[m]], levels[level][hi[m] - (1 << int(level)) + 1]
        top[m] = np.where(v[a] >= v[b], a, b)
    return top
