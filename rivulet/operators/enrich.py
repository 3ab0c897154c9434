"""Asynchronous per-row enrichment with bounded concurrency.

When the lookup side is a table, enrichment is a join. When it is a
service, each task runs the calls through a bounded thread pool inside
``mapInPandas``: at most ``capacity`` calls in flight per task, each with a
deadline counted from its start, and output in input order (the "ordered
wait" mode) or completion order ("unordered"). A value that several rows of an
Arrow batch hold is looked up once for all of them. A failed or late call
fails the task at once, without waiting for the calls still running, and Spark
retries it; or, with ``errors="column"``, a call that fails leaves its answer
null and its message in a column of its own (a late one still fails the task).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from queue import Empty, SimpleQueue
from time import monotonic

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def async_enrich(df: DataFrame, column: str, lookup: Callable[[object], object],
                 out: str, out_type: str = "string", capacity: int = 20,
                 timeout_s: float = 10.0, ordered: bool = True, errors: str = "fail") -> DataFrame:
    """Add ``out = lookup(column)`` computed by concurrent calls, and
    ``<out>_error`` if ``errors`` is ``"column"``."""
    if errors not in ("fail", "column"):
        raise ValueError("errors must be 'fail' or 'column'")
    apart = errors == "column"
    schema = f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, `{out}` {out_type}"
    if apart:
        schema += f", `{out}_error` string"

    def run(batches):
        pool = ThreadPoolExecutor(max_workers=capacity)
        try:
            for pdf in batches:
                codes, distinct = pd.factorize(pdf[column], use_na_sentinel=False)
                done, values = _answers(pool, lookup, distinct.tolist(), capacity, timeout_s, apart)
                answer = dict(zip(done, values))
                if not ordered:  # rows in the order in which their calls ended
                    rank = np.empty(len(distinct), np.int64)
                    rank[done] = np.arange(len(done))
                    order = np.argsort(rank[codes], kind="stable")
                    pdf, codes = pdf.iloc[order].reset_index(drop=True), codes[order]
                found = [answer[c] for c in codes]
                if apart:
                    yield pdf.assign(**{out: [v for v, _ in found], f"{out}_error": [e for _, e in found]})
                else:
                    yield pdf.assign(**{out: found})
        finally:  # a call that hangs must not hold the task
            pool.shutdown(wait=False, cancel_futures=True)

    return df.mapInPandas(run, schema)


def _answers(pool: ThreadPoolExecutor, lookup, values: list, capacity: int,
             timeout_s: float, apart: bool = False) -> tuple[list[int], list]:
    """Numbers of the values and answers in completion order (with ``apart``
    pairs of an answer and a message). As many calls run as the pool has
    threads, so a call starts when it is submitted."""
    running: dict[Future, tuple[int, float]] = {}  # oldest first, so soonest deadline first
    finished: SimpleQueue[Future] = SimpleQueue()
    rows, answers, todo = [], [], iter(enumerate(values))
    while True:
        while len(running) < capacity and (item := next(todo, None)) is not None:
            call = pool.submit(lookup, item[1])
            running[call] = (item[0], monotonic() + timeout_s)
            call.add_done_callback(finished.put)
        if not running:
            return rows, answers
        oldest, (_, soonest) = next(iter(running.items()))
        try:
            call = finished.get(timeout=max(0.0, soonest - monotonic()))
        except Empty:
            raise TimeoutError("lookup timed out") from None
        if soonest <= monotonic() and not oldest.done():
            raise TimeoutError("lookup timed out")
        rows.append(running.pop(call)[0])
        if not apart:
            answers.append(call.result())
        elif call.exception() is None:
            answers.append((call.result(), None))
        else:
            answers.append((None, str(call.exception())))


def modulo_key(n: object, buckets: int = 10) -> str:
    """The sample lookup of the reference job: ``"key-" + n % buckets``."""
    return f"key-{int(n) % buckets}"
