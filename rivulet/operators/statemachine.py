"""Per-key finite-state machine with alerts, split across blocks.

Semantics: every key starts in ``Initial``. For each event (in ``seq``
order) the state moves along its transition; an event without a transition
raises an alert ``(key, state, event)`` and leaves the state unchanged; a
move into ``Terminal`` clears the key back to ``Initial``. A letter that the
machine does not know has no transition anywhere, so it raises an alert and
leaves the state as it is; a row whose event is null is no event at all.

Plan. Each event is a function on the (tiny) state set. The state before an
event is the composition of all earlier event functions of the key applied
to ``Initial`` - a prefix scan with an associative operator, so it can be
split:

1. a key's sequence is cut into blocks (``seq // width``); rows are
   hash-partitioned on ``(key, block)`` and sorted, and a vectorised
   segmented scan (``mapInPandas``, log-depth doubling in numpy) gives every
   row the composed function of the earlier rows of its block;
2. the block totals form a table ``width`` times smaller; the same scan
   over it, segmented by key, yields each block's true start state;
3. a join on ``(key, block)`` evaluates each row's prefix function at its
   block's start state; rows whose event has no transition are the alerts.

No key is ever handled whole by one task, and the result is exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.codecs import EVENT_TYPES
from rivulet.operators.sequence import BLK, DEFAULT_WIDTH, KEY, with_block

# The states and transitions of the reference state machine.
STATES = ["Initial", "W", "X", "Y", "Z"]
TRANSITIONS = {
    ("Initial", "a"): "W",
    ("Initial", "c"): "X",
    ("W", "b"): "Y",
    ("X", "b"): "Y",
    ("X", "d"): "Z",
    ("Y", "e"): "Z",
    ("Z", "g"): "Terminal",
}


#: Code of an event that is none of the known ones.
UNKNOWN = len(EVENT_TYPES)


def _tables():
    ns, ne = len(STATES), UNKNOWN + 1
    step = np.tile(np.arange(ns)[:, None], (1, ne))     # invalid: stay
    valid = np.zeros((ns, ne), dtype=bool)
    for (s, e), t in TRANSITIONS.items():
        si, ei = STATES.index(s), EVENT_TYPES.index(e)
        valid[si, ei] = True
        step[si, ei] = 0 if t == "Terminal" else STATES.index(t)
    return step.astype(np.int8), valid


STEP, VALID = _tables()
NS = len(STATES)


def segmented_compose(funcs: np.ndarray, seg_start: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition within segments.

    ``funcs[i, s]`` is the state after row ``i`` from state ``s``; the
    result ``P[i]`` is ``funcs[i] o ... o funcs[first row of i's segment]``.
    Hillis-Steele doubling: O(n log n) vectorised work, no Python loop per row.
    """
    n = len(funcs)
    p = funcs.copy()
    idx = np.arange(n)
    first = np.maximum.accumulate(np.where(seg_start, idx, 0))
    k = 1
    while k < n:
        rows = np.nonzero(idx - k >= first)[0]
        if len(rows) == 0:
            break
        nxt = p.copy()
        nxt[rows] = np.take_along_axis(p[rows], p[rows - k].astype(np.intp), axis=1)
        p = nxt
        k *= 2
    return p


def _scan_partition(group_cols: list[str], func_cols: list[str], out_prefix: str,
                    inclusive: bool = False):
    """mapInPandas body: rows arrive sorted by ``group_cols`` (+ order);
    emits, per row, the composition of the earlier rows of its group
    (``out_prefix0..``) and, with ``inclusive``, of the rows up to and
    including it (``_incl*``). Carries the open group across batches."""

    def run(batches):
        carry_key, carry_f = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            keys = pdf[group_cols].to_numpy()
            funcs = pdf[func_cols].to_numpy().astype(np.int8)
            starts = np.ones(len(pdf), dtype=bool)
            starts[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            incl = segmented_compose(funcs, starts)
            ident = np.tile(np.arange(NS, dtype=np.int8), (len(pdf), 1))
            excl = ident.copy()
            cont = ~starts
            excl[1:][cont[1:]] = incl[:-1][cont[1:]]
            if carry_key is not None and tuple(keys[0]) == carry_key:
                head = np.arange(len(pdf)) < (np.argmax(starts[1:]) + 1 if starts[1:].any() else len(pdf))
                incl[head] = incl[head][:, carry_f.astype(np.intp)]
                excl[head] = excl[head][:, carry_f.astype(np.intp)]
            carry_key, carry_f = tuple(keys[-1]), incl[-1].copy()
            out = pdf.copy()
            for s in range(NS):
                out[f"{out_prefix}{s}"] = excl[:, s].astype(np.int32)
                if inclusive:
                    out[f"_incl{s}"] = incl[:, s].astype(np.int32)
            yield out

    return run


def state_machine_alerts(events: DataFrame, key: str, seq: str, event: str,
                         width: int = DEFAULT_WIDTH) -> DataFrame:
    """Alerts ``(key, seq, state, event)`` for events with no transition.
    ``event`` holds letters ``a``..``g``; ``seq`` is unique per key."""
    events = events.where(F.col(event).isNotNull())
    letters = F.array(*[F.lit(e) for e in EVENT_TYPES])
    at = F.array_position(letters, F.col(event))
    code = F.when(at > 0, at - 1).otherwise(UNKNOWN).cast("int")
    step = F.array(*[F.lit(int(x)) for x in STEP.ravel()])
    ne = UNKNOWN + 1
    # the event's function on the state set, one column per start state
    fcols = [F.element_at(step, F.lit(s * ne) + code + 1).alias(f"_f{s}") for s in range(NS)]
    # the key as text, which tells null keys from each other's blocks and
    # compares alike on the JVM and in Python
    named = F.to_json(F.struct(F.col(key)), {"ignoreNullFields": "false"})
    b = (with_block(events.select(key, seq, F.col(event).alias("_event"), code.alias("_code"), *fcols),
                    key, seq, width)
         .withColumn(KEY, named))
    dtypes = dict(b.dtypes)
    func_cols = [f"_f{s}" for s in range(NS)]
    schema_rows = (f"{key} {dtypes[key]}, {seq} {dtypes[seq]}, _event string, _code int, "
                   + ", ".join(f"_f{s} int" for s in range(NS)) + f", {KEY} string, {BLK} long, "
                   + ", ".join(f"_b{s} int" for s in range(NS)))
    walked = (b.repartition(KEY, BLK).sortWithinPartitions(KEY, BLK, seq)
              .mapInPandas(_scan_partition([KEY, BLK], func_cols, "_b"), schema_rows))
    # block totals: the composition of a block's event functions, folded on
    # the JVM from its sorted codes (fixed-size accumulator, linear in the
    # block), so the Python scan above runs once
    evs = F.array_sort(F.collect_list(F.struct(F.col(seq).alias("q"), code.alias("c"))))
    fold = F.aggregate(evs, F.array(*[F.lit(s) for s in range(NS)]),
                       lambda acc, x: F.transform(acc, lambda st: F.element_at(step, st * ne + x["c"] + 1)))
    blocks = (with_block(events.select(key, seq, event), key, seq, width).withColumn(KEY, named)
              .groupBy(KEY, BLK).agg(fold.alias("_t"))
              .select(KEY, BLK, *[F.col("_t")[s].alias(f"_f{s}") for s in range(NS)]))
    schema_blocks = (f"{KEY} string, {BLK} long, " + ", ".join(f"_f{s} int" for s in range(NS))
                     + ", " + ", ".join(f"_s{s} int" for s in range(NS)))
    starts = (blocks.repartition(KEY).sortWithinPartitions(KEY, BLK)
              .mapInPandas(_scan_partition([KEY], func_cols, "_s"), schema_blocks)
              .select(KEY, BLK, F.col("_s0").alias("_start")))      # from Initial (= 0)
    before = F.array(*[F.col(f"_b{s}") for s in range(NS)])
    j = walked.join(starts, [KEY, BLK]).withColumn(
        "_state", F.element_at(before, F.col("_start") + 1))
    valid = F.array(*[F.lit(bool(v)) for v in VALID.ravel()])
    alerts = j.where(~F.element_at(valid, F.col("_state") * ne + F.col("_code") + 1))
    names = F.array(*[F.lit(s) for s in STATES])
    return alerts.select(key, seq, F.element_at(names, F.col("_state") + 1).alias("state"),
                         F.col("_event").alias("event"))
