"""Importance resampling against a plain version; exact k-th largest."""

import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from conftest import SF01
from rivulet.llm import resample
from rivulet.llm.queries import op9_importance_resampling


def brute_buckets(text):
    tokens = re.findall(r"\w+|[^\w\s]+", (text or "").lower())
    one = [xxhash.xxh64_intdigest(t) >> 1 for t in tokens]
    two = [((a * 0x9E3779B97F4A7C15) % 2**64) ^ (b >> 7) for a, b in zip(one, one[1:])]
    return [h % resample.BUCKETS for h in one + two]


def brute(docs, good):
    raw, target = np.zeros(resample.BUCKETS), np.zeros(resample.BUCKETS)
    for _, t in docs:
        for b in brute_buckets(t):
            raw[b] += 1

    def order(t):
        return (42 if t is None else np.uint64(xxhash.xxh64_intdigest(t, 42)).astype(np.int64), t is not None, t or "")
    for i in good:  # an id stands for one text, the one whose hash is least
        for b in brute_buckets(min((t for j, t in docs if j == i), key=order, default="")):
            target[b] += 1
    if not target.sum():
        return [0.0] * len(docs)
    r = (np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw))))
    return [float(r[brute_buckets(t)].sum()) if brute_buckets(t) else 0.0 for _, t in docs]


def test_weights_and_selection(spark):
    rnd = random.Random(0)
    docs = [(i, " ".join(rnd.choice(["good", "fine", "text"] if i % 3 else ["###", "buy", "|"]) for _ in range(rnd.randint(0, 40))))
            for i in range(90)] + [(200, None), (None, "good"), (201, ""), (1, "again good"), (202, "é " * 9000)]
    docs.append(docs[0])
    labels = [(i, int(i % 3 > 0)) for i in range(0, 90, 2)] + [(None, 1), (5, None), (1, 1), (1, 1)]
    d = spark.createDataFrame([(*x, "s", 1.0) for x in docs], "doc_id long, text string, key string, noise double")
    lab = spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int")
    out = resample.resample(d, lab, 0.5)
    rows = out.collect()
    want = brute(docs, {i for i, y in labels if y == 1 and i is not None})
    assert sorted(round(r.log_weight, 6) for r in rows) == sorted(round(w, 6) for w in want)
    keys = sorted((r.key for r in rows), reverse=True)
    k = math.ceil(0.5 * len(docs))
    assert all(r.selected == (r.key >= keys[k - 1]) for r in rows)
    assert sum(r.selected for r in rows) >= k
    assert resample.good_share(lab) == pytest.approx(sum(y == 1 for _, y in labels) / sum(y in (0, 1) for _, y in labels))
    assert resample.good_share(lab.limit(0)) == 1.0
    # no target, no labels, no documents
    assert {r.log_weight for r in resample.resample(d, lab.limit(0), 0.5).collect()} == {0.0}
    assert resample.resample(d.limit(0), lab, 0.5).count() == 0


@pytest.mark.parametrize("exact", [4096, 5])
def test_kth_largest(spark, monkeypatch, exact):
    monkeypatch.setattr(resample, "EXACT", exact)
    rnd = random.Random(4)
    values = [rnd.choice([rnd.gauss(0, 1), 1.5, 2.0, np.nextafter(2.0, 3), 1e300, -1e300, 5e-324]) for _ in range(400)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").cache()
    for k in (1, 2, 57, 200, 399, 400):
        assert resample.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(df, "x", 401) is None
    assert resample.kth_largest(df.limit(0), "x", 1) is None


def test_gumbel_noise_is_standard(spark):
    from pyspark.sql import functions as F
    m, v = spark.range(20_000).agg(F.avg(resample.gumbel(1, F.col("id"))), F.variance(resample.gumbel(1, F.col("id")))).first()
    assert abs(m - 0.5772) < 0.05 and abs(v - math.pi**2 / 6) < 0.1


def test_query_prefers_good_documents(spark):
    out = op9_importance_resampling(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    share = {r.quality: r.s for r in out.join(labels, "doc_id").groupBy("quality").agg({"*": "count"}).join(
        out.join(labels, "doc_id").where("selected").groupBy("quality").count(), "quality")
        .selectExpr("quality", "count / `count(1)` as s").collect()}
    assert share[1] > 0.95 and share.get(0, 0) < 0.2


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_held_out_documents_and_a_draw_that_counts(spark):
    """Labels the target was not fitted on; and some documents are taken or
    left by the noise alone."""
    out = op9_importance_resampling(spark, SF01).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect() if held_out(r.doc_id)}
    good = [r.selected for r in out if labels.get(r.doc_id) == 1]
    bad = [r.selected for r in out if labels.get(r.doc_id) == 0]
    assert len(good) > 40 and sum(good) / len(good) > 0.9
    assert bad and sum(bad) / len(bad) < 0.35
    mean = {r.doc_id: r.log_weight / max(r.n_ngrams, 1) for r in out}
    k = sum(r.selected for r in out)
    plain = set(sorted(mean, key=mean.get, reverse=True)[:k])
    changed = {r.doc_id for r in out if r.selected} ^ plain
    assert 0 < len(changed) < 0.2 * len(out)


def test_the_bound_on_labelled_rows_is_one_on_rows(spark):
    """An id with many rows gives one text, whatever order they come in."""
    docs = [(1, f"text {i % 7}") for i in range(50)] + [(2, "two"), (3, None), (None, "x")]
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    one = {tuple(r) for n in (1, 4) for r in resample.one_text(
        spark.createDataFrame(docs, "id long, text string").repartition(n), ids).collect()}
    assert sorted(r[0] for r in one) == [1, 2, 3] and dict(one)[1].startswith("text") and dict(one)[3] is None


def test_length_does_not_rank(spark):
    """A text said twice over has the same key but for the noise."""
    rnd = random.Random(1)
    once = [" ".join(rnd.choice(["good", "fine", "text", "###", "buy"]) for _ in range(30)) for _ in range(40)]
    docs = [(i, t) for i, t in enumerate(once)] + [(100 + i, f"{t} {t} {t} {t}") for i, t in enumerate(once)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(t.count("good") > 6), 0) for i, t in docs[:40]], "doc_id long, quality int, toxic int")
    mean = {r.doc_id: r.log_weight / r.n_ngrams for r in resample.resample(d, lab, 0.5).collect()}
    assert max(abs(mean[i] - mean[100 + i]) for i in range(40)) < 0.15 * (max(mean.values()) - min(mean.values()))
