"""SimHash fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from conftest import SF001
from rivulet.llm import simhash
from rivulet.llm.queries import op8_simhash_near_dedup


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), seed=42)
         for i in range(max(len(w) - 3, 1))]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def brute_components(fps, bits=4):
    """Least index reachable, by all pairs."""
    a = np.array(fps, np.uint64)
    label = list(range(len(a)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits) + i + 1:
            x, y = root(i), root(int(j))
            label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(a))]


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        least[c] = i if least.get(c) is None else least[c] if i is None else min(least[c], i)
    return sorted(((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, comp)), key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert got(op8_simhash_near_dedup(spark, SF001)) == brute(rows)


def test_edge_rows(spark):
    rnd = random.Random(3)
    base = [rnd.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rnd.randrange(99)) for _ in range(400)]
    near = []
    for i in range(30):
        w = base[:]
        w[rnd.randrange(len(w))] = f"other{i}"
        near.append((100 - i, " ".join(w)))
    rows = near + [(None, None), (7, ""), (8, " \t\n"), (9, "A"), (10, "a"), (None, "lonely text here now ok"),
                   (11, "É é"), (12, "é é"), near[0], (5, near[3][1]), (None, near[4][1]),
                   (20, "x\xa0y z"), (21, "word " * 100_000)]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, fp string, root int")
    assert got(simhash.near_duplicates(df)) == brute(rows)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    assert kept.count() == len(set(comp))
    # the row that stays bears its component's least id
    want = sorted((brute_least(rows, comp, c) for c in set(comp)), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == want


def brute_least(rows, comp, c):
    ids = [i for (i, _), k in zip(rows, comp) if k == c and i is not None]
    return min(ids) if ids else None


def test_links_and_crowded_anchors(spark, monkeypatch):
    """Random fingerprints around a few centres; a tiny home block forces
    the split of crowded anchors."""
    rnd = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rnd.randrange(7)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    comp = brute_components(fps)
    for block in (4096, 3):
        monkeypatch.setattr(simhash, "HOME_BLOCK", block)
        pairs = simhash.links(df).collect()
        for a, b in pairs:
            assert (a ^ b).bit_count() <= 4 or ((a ^ b) & (2**64 - 1)).bit_count() <= 4
        found = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        at = {s: i for i, s in enumerate(signed)}
        label = {}
        for s, i in at.items():
            label.setdefault(found.get(s, s), set()).add(i)
        want = {}
        for i, c in enumerate(comp):
            want.setdefault(c, set()).add(i)
        assert sorted(map(sorted, label.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("home, member", [(4096, 65_536), (4096, 11), (7, 50), (50, 7)])
def test_a_hot_anchor_is_split_both_ways(spark, monkeypatch, home, member):
    """Most fingerprints share one part's anchor (a templated corpus): no
    block holds more than its homes and members, and no link is lost."""
    rnd = random.Random(9)
    monkeypatch.setattr(simhash, "HOME_BLOCK", home)
    monkeypatch.setattr(simhash, "MEMBER_BLOCK", member)
    base = rnd.getrandbits(64)
    fps = {base ^ (rnd.getrandbits(43) << 21 if rnd.random() < 0.5 else sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))))
           for _ in range(300)}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    pairs = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    label, want = {}, {}
    for i, (x, c) in enumerate(zip(signed, brute_components(fps))):
        label.setdefault(found.get(x, x), set()).add(i)
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, label.values())) == sorted(map(sorted, want.values()))
    assert len(want) < len(fps)


def test_components_of_a_long_chain(spark):
    n = 3000
    order = list(range(n))
    random.Random(1).shuffle(order)
    pairs = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    out = simhash.components(pairs).collect()
    assert {r.root for r in out} == {0} and len(out) == n - 1


def test_code_covers():
    rnd = np.random.default_rng(0)
    for bits in (21, 22):
        code = simhash.Code(bits, 2)
        x = rnd.integers(0, 1 << bits, 2000)
        home = code.home(x)
        assert (np.bitwise_count(x ^ home) <= 1).all()
        assert (code.syndrome(home) == 0).all()
        for flip in range(bits):
            y = x ^ (1 << flip)
            near = code.patterns[code.syndrome(y)]
            reached = np.where(near >= 0, y[:, None] ^ near, -1)
            assert (reached == home[:, None]).any(axis=1).all()
