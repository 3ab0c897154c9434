"""Property tests of the numpy helpers behind the blocked delta trigger."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.operators.trigger import (_next_and_end, _range_argmax, _range_argmax_table,
                                       _staircase)

speeds = st.lists(st.integers(0, 6), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(speeds, st.data())
def test_range_argmax_is_earliest_max(vs, data):
    v = np.asarray(vs, dtype=float)
    lo = data.draw(st.integers(0, len(v) - 1))
    hi = data.draw(st.integers(lo, len(v) - 1))
    got = _range_argmax(_range_argmax_table(v), v, lo, hi)
    seg = v[lo:hi + 1]
    assert got == lo + int(np.argmax(seg))          # argmax returns the first maximum


@settings(max_examples=200, deadline=None)
@given(speeds)
def test_staircase_keeps_rows_not_beaten_later(vs):
    v = np.asarray(vs, dtype=float)
    want = [i for i in range(len(v)) if all(v[j] <= v[i] for j in range(i + 1, len(v)))]
    assert _staircase(v).tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=1, max_size=50), st.integers(0, 30))
def test_chain_ends(steps, thr):
    d = np.cumsum(np.asarray(steps, dtype=float))
    nxt, end = _next_and_end(d, float(thr))
    for i in range(len(d)):
        j = i + 1
        while j < len(d) and not d[j] > d[i] + thr:
            j += 1
        assert nxt[i] == j
        k = i
        while nxt[k] < len(d):
            k = nxt[k]
        assert end[i] == k
