"""Decontamination against a brute-force search of all windows."""

import hashlib
import random
import re

import pytest

from conftest import SF001
from rivulet.llm import decontaminate
from rivulet.llm.queries import op10_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(13, len(w))
        for i in range(len(w) - n + 1):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                       "contaminated").collect()), key=str)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = brute(docs, items)
    assert any(r[5] for r in want)
    assert got(op10_decontamination(spark, SF001)) == want


@pytest.mark.parametrize("seed, bound", [(1, 1_000_000), (2, 0)])
def test_small_alphabet_and_short_items(spark, monkeypatch, seed, bound):
    """Few distinct words: repeats, overlaps and ties everywhere; items of
    1, 4 and 12 words beside long ones; hashes broadcast and joined."""
    monkeypatch.setattr(decontaminate, "BROADCAST_HASHES", bound)
    rnd = random.Random(seed)
    text = lambda n, k: " ".join(rnd.choice("abcdefgh"[:k]) for _ in range(n))
    items = [(i, text(n, k)) for i, (n, k) in enumerate(
        [(20, 2), (13, 3), (14, 8), (40, 4), (12, 8), (4, 8)])] + [(9, "Zebra!"), (7, ""), (8, None), (None, text(20, 2))]
    items.append(items[0])
    docs = [(i, text(rnd.choice([0, 1, 5, 12, 13, 14, 60]), rnd.choice([2, 3, 8]))) for i in range(40)]
    docs += [(100 + i, f"{text(7, 8)}, {items[j][1].upper()}. {text(30, 8)} zebra") for i, j in enumerate((0, 1, 2, 3, 4, 5))]
    docs += [(200, None), (201, ""), (202, "... !"), (None, items[3][1]), (100, docs[-3][1]), docs[-1],
             (203, "É" + items[2][1]), (204, "word " * 30_000 + items[2][1])]
    d = frame(spark, [(*r, "x", 1) for r in docs], "doc_id long, text string, digest string, words int")
    b = frame(spark, [(*r, "x") for r in items], "item_id long, text string, hash string")
    assert got(decontaminate.report(d, b)) == brute(docs, items)


def test_empty_tables(spark):
    d = frame(spark, [(1, "a b")], "doc_id long, text string")
    b = frame(spark, [(1, "a b")], "item_id long, text string")
    none = b.limit(0)
    assert got(decontaminate.report(d, none)) == brute([(1, "a b")], [])
    assert got(decontaminate.report(d.limit(0), b)) == []
    assert decontaminate.report(d, b).first().contaminated


def test_drop_keeps_columns_and_clean_rows(spark):
    rows = [(1, "one two three", "k"), (2, "nine words " * 40, "k"), (3, None, None), (1, "one two three", "k")]
    d = frame(spark, rows, "doc_id long, text string, digest string")
    b = frame(spark, [(1, "one two three")], "item_id long, text string")
    out = decontaminate.drop_contaminated(d, b)
    assert out.columns == d.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3]
