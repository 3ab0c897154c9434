"""Spelling variants against a comparison of all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from conftest import SF001
from rivulet.llm import spelling as S
from rivulet.llm.queries import op13_spelling_variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    beside = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and near(w, v)] for w in n}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return sorted(((w, form[w], root(w), n[w], len(beside[w]), n.get(form[w])) for w in n), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = brute(counted(docs))
    assert sum(r[4] for r in want) and any(r[1] for r in want)
    assert got(op13_spelling_variants(spark, SF001)) == want


@pytest.mark.parametrize("letters, length", [("ab", 8), ("aé", 6), ("abcdefgh", 6)])
def test_few_letters(spark, letters, length):
    """Repeated bigrams and equal counts everywhere, chains of forms."""
    rnd = random.Random(length)
    words = {"".join(rnd.choice(letters) for _ in range(rnd.randint(length - 2, length + 1))) for _ in range(250)}
    words |= {"a" * k for k in range(4, 40)} | {"abcdefgh", "abcdefg", "abcdefgi", "abxdefgi"}
    n = {w: 5 ** rnd.randint(1, 6) for w in words if len(w) >= 4}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    want = brute(n)
    assert len({r[2] for r in want}) < len(want)
    assert got(S.variants(df)) == want


def test_odd_rows(spark):
    huge = "x" * 3000 + "y" + "z" * 3000
    docs = [(1, None), (2, ""), (None, "Straße strasse STRASSE straSSe"), (3, "éclairs Éclairs éclairs éclairs éclairs éclairs"),
            (3, f"{huge} {huge[:-1]} "), (4, "strasse " * 9), (4, "strasse " * 9), (5, "strass " * 7), (6, "short abc " * 50)]
    docs += [(i, f"{huge} {huge[1:]} {'ab' * 2000} {'ab' * 2000}a éclair5 éclairs") for i in range(10, 17)]
    df = spark.createDataFrame([(*r, "w", 1) for r in docs], "doc_id long, text string, word string, n int")
    assert got(S.group_variants(df)) == brute(counted(docs))
    assert got(S.group_variants(df.limit(0))) == []
    assert got(S.group_variants(df.where("doc_id < 3"))) == []


def test_pivots_are_the_least_disjoint_pair():
    rnd = random.Random(3)
    for _ in range(500):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(4, 9)))
        counts = {x + y: rnd.randint(1, 9) for x in "abcd" for y in "abcd"}
        order = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
        prefix, pivots = S.prefix_and_pivots(word, order, counts)
        grams = sorted((order[word[i:i + 2]], i) for i in range(len(word) - 1))
        assert prefix == [g for g in grams if g[0] <= grams[2][0]]
        cost = lambda at: sum(counts[word[i:i + 2]] for i in at)
        pairs = [p for p in itertools.combinations(sorted(i for _, i in prefix), 2) if p[1] - p[0] >= 2]
        assert tuple(pivots) in pairs and cost(pivots) == min(map(cost, pairs))
