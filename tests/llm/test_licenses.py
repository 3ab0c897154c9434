"""Licence scan against a look at every place of every text."""

import random
import re

import pytest

from conftest import SF001
from rivulet.llm import licenses as L
from rivulet.llm.queries import op12_license_scan

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, templates=L.TEMPLATES):
    out = []
    for doc_id, text in docs:
        w, found = words(text), []
        for t in templates:
            for start in range(-len(t.words), len(w)):
                hit = {i for i, x in enumerate(t.words) if 0 <= start + i < len(w) and w[start + i] == x}
                if all(i in hit for p in t.phrases for i in p) and len(hit) / len(t.words) >= L.LEAST_SHARE:
                    found.append((t, start, len(hit) / len(t.words)))
        base = [(t.label, s) for t, s, _ in found if t.base]
        out.append((doc_id, len(w), len(base), min((s for _, s in base), default=None),
                    max((s for _, s in base), default=None), ",".join(sorted({b for b, _ in base})),
                    ",".join(sorted({t.label for t, _, _ in found})), max((s for _, _, s in found), default=0.0)))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, words string, places int")


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = brute(docs)
    assert any(r[2] for r in want)
    df = op12_license_scan(spark, SF001)
    assert got(df) == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Pandas" not in plan


def test_odd_rows(spark):
    mit = " ".join(L.TEMPLATES[22].words)
    docs = [(1, None), (2, ""), (3, "..."), (None, "the MIT License"), (None, "the MIT License"),
            (4, "cc by cc by nc cc"), (5, "CC-BY-NC 4.0; cc by"), (6, "mit license license mit license"),
            (7, "gnu general public"), (8, "license gnu general public license"), (9, "MIT License " * 20_000),
            (10, mit), (11, "x " + mit.replace("obtaining a copy", "getting any copies") + " y"),
            (12, mit.replace("associated documentation files the", "and")), (13, mit[:-11]), (14, mit[11:]),
            (15, "CC\tBY\nSA"), (16, "émit license"), (17, "mit é license"), (18, "ccby"),
            (19, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                 "is hereby granted. Licensed under the Apache License, Version 2.0")]
    assert got(L.scan(frame(spark, docs))) == brute(docs)
    assert got(L.scan(frame(spark, docs).limit(0))) == []


@pytest.mark.parametrize("seed", range(3))
def test_whichever_words_are_rare(spark, seed):
    """Few words in many orders: postings agree by chance, phrases overlap and
    the rarest words change with the table."""
    rnd = random.Random(seed)
    templates = [L.template("one", "a b a b", base=True), L.template("two", "a b c", base=True),
                 L.template("three", "c a c a b b c a", "a c a", "b c"), L.template("four", "b"),
                 L.template("five", "a a b b c c a a", "b b c")]
    docs = [(i, " ".join(rnd.choices("abcd", [3, 2, 1 + 3 * seed, 1], k=rnd.choice([1, 5, 30, 80])))) for i in range(60)]
    assert got(L.scan(frame(spark, docs), templates=templates)) == brute(docs, templates)


def test_rare_words_hold_a_word_of_every_phrase():
    for t in L.TEMPLATES:
        for counts in ({w: i for i, w in enumerate(t.words)}, {w: -i for i, w in enumerate(t.words)},
                       dict.fromkeys(t.words, 0)):
            chosen = L.rare_words(t, counts)
            assert all(chosen & set(p) for p in t.phrases) and chosen <= set(t.must)


def test_templates_must_hold_their_phrases():
    with pytest.raises(ValueError):
        L.template("x", "some words", "other words")
