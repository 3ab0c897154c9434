"""Toxicity: features by hand, only allowed labels used, held-out quality,
calibration and odd rows."""

import random
import re
import string
import zlib

import numpy as np
import pytest

from conftest import SF01
from rivulet.llm import toxicity
from rivulet.llm.queries import op2_toxicity

AT = toxicity.FEATURES.index


def row(text, learned=None):
    return toxicity.features([text], learned or {})[0]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_features_by_hand():
    r = row("You are an IDIOT!! really?")
    assert r[AT("insults")] == pytest.approx(1 / 5) and r[AT("insult_count")] == pytest.approx(np.log(2))
    assert r[AT("near_you")] == pytest.approx(1 / 5) and r[AT("nearest_you")] == pytest.approx(1 / 4)
    assert r[AT("you")] == pytest.approx(1 / 5) and r[AT("shouted")] == pytest.approx(1 / 5)
    assert r[AT("exclamations")] == pytest.approx(2 / 5) and r[AT("questions")] == pytest.approx(1 / 5)
    assert r[AT("capitals")] == pytest.approx(6 / 19) and r[AT("hidden_insults")] == 0
    assert not row("").any() and not row(None).any() and not row("  \n ").any()
    assert row("a thing " * 50)[AT("log_words")] == pytest.approx(np.log(101))


@pytest.mark.parametrize("word", ["1diot", "id!ot", "st*pid", "iiidiot", "stuuupid", "$tupid", "i.d.i.o.t", "idiot###"])
def test_hidden_insults_count(word):
    assert row(f"such a {word} here")[AT("insults")] == pytest.approx(1 / 4)
    assert row(f"such a {word} here")[AT("hidden_insults")] == (0 if word == "idiot###" else pytest.approx(1 / 4))


def test_learned_words():
    r = row("some grumbly words, Grumbly!", {"grumbly": 3.0})
    assert r[AT("learned")] == pytest.approx(6 / 4) and r[AT("learned_most")] == 3.0


def test_cache_of_tokens_is_bounded(monkeypatch):
    texts = [f"w{i} idiot x{i}!" for i in range(50)]
    want = toxicity.features(texts, {})
    monkeypatch.setattr(toxicity, "_CACHE", 7)
    assert np.array_equal(toxicity.features(texts, {}), want)


def corpus(n=700, seed=0):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        y = rnd.random() < 0.3
        words = [rnd.choice(["the", "sky", "is", "blue", "today", "Zorp" if y else "calm"]) for _ in range(30)]
        if y:
            words[rnd.randrange(30)] = rnd.choice(["stupid", "trash", "scum"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(y)))
    return docs, labels


def test_held_out_labels_change_nothing(spark):
    docs, labels = corpus(300)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, q, 1 - y if held_out(i) else y) for i, q, y in labels]
    a = toxicity.report(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    b = toxicity.report(d, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    a, b = (sorted(map(tuple, x.collect())) for x in (a, b))
    assert a == b
    assert {r[0] for r in a if r[1]} == {i for i, _ in docs if held_out(i)}
    truth = {i: y for i, _, y in labels}
    right = [r[3] == truth[r[0]] for r in a if r[1]]
    assert sum(right) / len(right) > 0.95


def test_odd_rows(spark):
    docs, labels = corpus(200)
    docs += [(None, "you stupid trash"), (900, None), (901, ""), (0, "twice"), (902, "stupid " * 40_000), docs[3]]
    labels += [(None, 1, 1), (5, 1, None), (6, 1, 7), (7, 0, 0), (7, 0, 1), (10_000, 1, 1)]
    d = spark.createDataFrame([(*r, "f", 0.5) for r in docs], "doc_id long, text string, tox_features string, score double")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.report(d, lab).collect()
    assert len(out) == len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [False]
    kept = toxicity.drop_toxic(d, lab)
    assert kept.columns == d.columns
    scores = sorted((r.score for r in out))
    assert kept.count() == sum(s < 0.5 for s in scores)
    assert toxicity.report(d.limit(0), lab).count() == 0
    # one class only, or no labels: half the number of insults
    for few in (lab.where("toxic = 0"), lab.limit(0)):
        r = {x.doc_id: x.score for x in toxicity.report(d, few).collect()}
        assert r[None] == 1.0 and r[901] == 0.0 and r[902] == 1.0


def test_query_on_held_out_labels(spark):
    out = op2_toxicity(spark, SF01).toPandas()
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").count()
    assert len(out) == docs
    assert (out.held_out == out.doc_id.map(held_out)).all()
    m = out[out.held_out].merge(labels, on="doc_id")
    rank = m.score.rank()
    n1 = m.toxic.sum()
    auc = (rank[m.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(m) - n1))
    assert auc > 0.85
    assert (m.predicted == m.toxic).mean() > 0.85


def plain_features(text, learned):
    """The features spelled out token by token."""
    tokens = (text or "").split()
    if not tokens:
        return [0.0] * len(toxicity.FEATURES)
    marks = set(string.punctuation)
    insult, hidden, weights, you = [], [], [], []
    letters = capitals = shouted = exclaims = questions = punctuation = mixed = stretched = digits = 0
    for token in tokens:
        low = token.lower()
        core = low.strip(string.punctuation)
        shorter = re.sub(r"(.)\1{2,}", r"\1", low.translate(str.maketrans("0134578@$!|", "oieastbasii"))) \
            .strip("".join(marks - {"@", "$"}))
        plain = core in toxicity.INSULTS
        looks = (not plain and len(core) > 2
                 and (not core.isalpha() or re.search(r"(.)\1{2,}", core) or low != core))
        starred = {w[:i] + "*" + w[i + 1:] for w in toxicity.INSULTS if len(w) > 3 for i in range(1, len(w))}
        sly = bool(looks and (shorter in toxicity.INSULTS or low.strip("".join(marks - {"@", "$", "*"})) in starred
                              or re.sub(r"(.)\1{2,}", r"\1\1", core) in toxicity.INSULTS
                              or low.replace(".", "").replace("-", "") in toxicity.INSULTS))
        insult.append(plain or sly)
        hidden.append(sly)
        weights.append(learned.get(core) or learned.get(shorter if looks else core, 0.0))
        you.append(core in toxicity.YOU)
        here = sum(c.isalpha() for c in token)
        letters += here
        big = sum(c.isupper() for c in token)
        capitals += big
        shouted += here > 1 and big == here
        exclaims += token.count("!")
        questions += token.count("?")
        punctuation += sum(c in marks for c in token)
        mixed += not core.isalpha() and bool(re.search(r"[^\W\d_][\d@$!*|#]+[^\W\d_]", low))
        stretched += bool(re.search(r"(.)\1{2,}", core))
        digits += sum(c.isdigit() for c in token)
    gaps = [min(abs(i - j) for j, y in enumerate(you) if y) for i, x in enumerate(insult) if x and any(you)]
    n, chars = len(tokens), max(sum(map(len, tokens)), 1)
    return [np.log1p(n), sum(insult) / n, np.log1p(sum(insult)), sum(weights) / n, max(weights), sum(hidden) / n,
            sum(g <= toxicity.NEAR for g in gaps) / n, max((1 / (1 + g) for g in gaps), default=0.0), sum(you) / n,
            capitals / max(letters, 1), shouted / n, exclaims / n, questions / n, punctuation / chars, mixed / n,
            stretched / n, digits / chars]


def test_features_of_the_table_by_plain_loops(spark):
    from conftest import SF001
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    texts += ["You 1D10T!! s.t.u.p.i.d st*pid $tupiiid a1b2 IDIOT x you're", "ÉÉÉ !!! ???", None, "", "wooorthless W0RTHLESS"]
    learned = {"the": 1.75, "worthless": 2.5, "idiot": 3.25}
    got = toxicity.features(texts, learned)
    want = np.array([plain_features(t, learned) for t in texts])
    assert want.any(0).sum() >= 15
    np.testing.assert_allclose(got, want, rtol=1e-5, atol=1e-7)


def test_an_id_trains_with_one_row(spark):
    """A labelled id that holds a third of the rows: the same model as with
    one row of its text that hashes least."""
    docs, labels = corpus(400)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    hot = next(i for i, _, y in labels if y and not held_out(i))
    many = spark.createDataFrame(docs + [docs[hot]] * 200, "doc_id long, text string")
    one = spark.createDataFrame(docs, "doc_id long, text string")
    score = lambda d: {r.doc_id: r.score for r in toxicity.report(d, lab).collect()}
    assert score(many) == score(one)
