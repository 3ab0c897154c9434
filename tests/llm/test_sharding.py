"""Sharding: groups stay whole, slots are gapless, shards nearly equal."""

import random
import zlib
from collections import defaultdict

import pytest

from conftest import SF01
from rivulet.llm import sharding
from rivulet.llm.queries import op5_sharding


def check(rows, docs, shards):
    want = sorted(((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == want
    load, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        assert 0 <= r.shard < shards
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(h) == 1 for h in homes.values())
    return [load[s] for s in range(shards)]


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    load = check(op5_sharding(spark, SF01).collect(), docs, 40)
    assert max(load) <= 1.01 * sum(load) / 40 and min(load) >= 0.9 * sum(load) / 40


def test_hot_group_and_odd_rows(spark):
    rnd = random.Random(2)
    docs = [(i, "hot text " * 20) for i in range(400)] + [(1000 + i, "w" * rnd.randint(1, 3000)) for i in range(700)]
    docs += [(None, None), (5000, None), (5001, ""), (1000, docs[400][1]), docs[401], (None, "hot text " * 20)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, shard string, digest int")
    load = check(sharding.shard(df, 8).collect(), docs, 8)
    rest = sorted(load)
    assert max(rest) <= 1.02 * sum(rest) / 8
    # one group of most of the bytes: alone, the others even
    docs = [(i, "hot text " * 100) for i in range(300)] + docs[400:500]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    load = sorted(check(sharding.shard(df, 8).collect(), docs, 8))
    assert load[-1] == 300 * 916 and load[-2] <= 1.03 * sum(load[:-1]) / 7
    assert sharding.shard(df.limit(0), 8).count() == 0


def naive_best_fit(sizes, capacity):
    bins, out = [], []
    for s in sizes:
        fits = [(c, i) for i, c in enumerate(bins) if c >= s]
        if fits:
            i = min(fits)[1]
        else:
            bins.append(capacity)
            i = len(bins) - 1
        bins[i] -= s
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(10))
def test_tree_packs_like_plain_best_fit(seed):
    rnd = random.Random(seed)
    sizes = sorted((rnd.randint(1, rnd.choice([10, 100, 500])) for _ in range(300)), reverse=True)
    assert sharding.pack(sizes, 500) == naive_best_fit(sizes, 500)
    assert sharding.pack(sizes, 500, 3) is None
    with pytest.raises(ValueError):
        sharding.pack([501], 500)


def test_even_edges():
    assert sharding.pack_evenly([], 5) == []
    assert sharding.pack_evenly([7], 5) == [0]
    assert sorted(sharding.pack_evenly([3, 3, 3], 3)) == [0, 1, 2]
    assert sharding.pack_evenly([100, 1, 1], 3) == [0, 1, 2]
    assert set(sharding.pack_evenly([5, 4, 3], 1)) == {0}


def test_whole_table_like_plain_best_fit(spark):
    """Sizes of all groups of the table, packed in bulk and one by one."""
    groups = defaultdict(int)
    for r in spark.read.parquet(f"{SF01}/documents.parquet").collect():
        groups[r.text] += len((r.text or "").encode()) + 16
    sizes = sorted(groups.values(), reverse=True)
    capacity = sum(sizes) // 37
    assert sharding.pack(sizes, max(capacity, sizes[0])) == naive_best_fit(sizes, max(capacity, sizes[0]))


def test_shards_follow_the_plan(spark):
    """The bytes of every shard are those that the plan gives its bin."""
    rnd = random.Random(5)
    docs = [(i, "x" * rnd.choice([1, 1, 1, 50, 700, rnd.randint(1, 4000)]) + str(i)) for i in range(900)]
    docs += [(i, "copy " * 9) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    load = check(sharding.shard(df, 12).collect(), docs, 12)
    groups = defaultdict(int)
    for _, t in docs:
        groups[t] += len(t) + 16
    want = defaultdict(int)
    for size, bin_, n in sharding.spread_counts(sharding._histogram(list(groups.values())), 12):
        want[bin_] += size * n
    assert load == [want[b] for b in range(12)]


@pytest.mark.parametrize("seed", range(5))
def test_bulk_is_best_fit_for_many_equal_sizes(seed):
    rnd = random.Random(seed)
    sizes = sorted((rnd.choice([3, 7, 11, 50]) for _ in range(500)), reverse=True)
    assert sharding.pack(sizes, 101) == naive_best_fit(sizes, 101)
