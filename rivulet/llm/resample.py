"""Quality by importance resampling with hashed n-gram models.

Two generative models count word unigrams and bigrams hashed into
``BUCKETS``: one of the target (documents labelled good), one of the raw text
(all documents). A document's log importance weight is the sum over its
n-grams of log(target / raw). As such sums grow with the length, by hundreds
from text to text, standard noise would change nothing and the longest texts
would be first; so the weight that is drawn by is that of ``LENGTH`` n-grams of
the document: the mean log ratio times ``LENGTH``, the inverse temperature.
Adding Gumbel noise and keeping the largest keys samples documents without
replacement in proportion to the exponential of it.

Scale. The raw model counts all documents: each task adds up one vector of
BUCKETS counts and emits it once. The target model is fitted on at most
``max_rows`` labelled documents (those whose ids hash lowest; the bound of
the classifier, not of the data; of an id with several texts the one that
hashes lowest), whose ids are broadcast to find their texts. Both models are BUCKETS numbers. The k-th largest key is found by
narrowing histograms of the keys; no global sort, no collect of keys beyond
``EXACT``.

Noise is a hash of id, text and seed: runs and retries agree.

Defined results. Null and empty texts have weight and mean 0. Rows with equal id and
text get equal keys; rows that tie with the last place are all selected, so
more than k can be. Null ids are scored like any other and never belong to
the target. Without target documents all weights are 0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, save

BUCKETS = 10_000
MAX_ROWS = 20_000
LENGTH = 64  # n-grams
EXACT = 4096
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE = 400_000


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        import xxhash
        self[token] = h = xxhash.xxh64_intdigest(token) >> 1
        return h


def ngrams(text: str | None, hashes: dict | None = None) -> np.ndarray:
    """The buckets of a text's unigrams and bigrams."""
    hashes = _Hashes() if hashes is None else hashes
    tokens = _TOKEN.findall((text or "").lower())
    one = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (one[1:] >> np.uint64(7))
    return (np.concatenate([one, two]) % np.uint64(BUCKETS)).astype(np.int64)


def counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all of ``docs``."""
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, total = _Hashes(), np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b["text"]:
                total += np.bincount(ngrams(t, hashes), minlength=BUCKETS)
                if len(hashes) > _CACHE:
                    hashes.clear()
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in (docs.select(F.col(text).alias("text")).mapInPandas(count, "bucket long, n long")
                      .groupBy("bucket").agg(F.sum("n")).collect()):  # at most BUCKETS rows
        out[bucket] = n
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(p_target / p_raw) per bucket, each count raised by one."""
    if not target.sum():
        return np.zeros(BUCKETS)
    return (np.log((target + 1) / (target.sum() + BUCKETS))
            - np.log((raw + 1) / (raw.sum() + BUCKETS)))


def weight_column(text: Column, ratios: np.ndarray) -> Column:
    """log_weight and n_ngrams of a text."""
    @F.pandas_udf("log_weight double, n_ngrams long")
    def weight(texts: pd.Series) -> pd.DataFrame:
        hashes, sums, sizes = _Hashes(), [], []
        for t in texts:
            at = ngrams(t, hashes)
            sums.append(float(ratios[at].sum()))
            sizes.append(len(at))
        return pd.DataFrame({"log_weight": np.array(sums, np.float64), "n_ngrams": np.array(sizes, np.int64)})
    return weight(text)


def one_text(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """id and text of the ``ids`` in ``docs``: one row each, the text whose
    hash is least, so that a bound on ids is one on rows."""
    found = docs.join(F.broadcast(ids), "id", "left_semi")
    return found.groupBy("id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def gumbel(seed: int, *parts: Column) -> Column:
    """Standard Gumbel noise from a hash."""
    h = F.xxhash64(F.lit(seed), *parts)
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(values: DataFrame, name: str, k: int) -> float | None:
    """The k-th largest of a column without null or NaN (a saved table)."""
    left, inside = k, values.select(F.col(name).alias("x"))
    while True:
        low, high, n = inside.agg(F.min("x"), F.max("x"), F.count("x")).first()
        if not n or left < 1 or left > n:
            return None
        if low == high:
            return low
        if n <= EXACT:
            return sorted((r[0] for r in inside.collect()), reverse=True)[left - 1]
        width = (high - low) / 1024
        if low + width == low or high - width == high:  # neighbouring doubles
            inside_high = inside.where(F.col("x") == high).count()
            if left <= inside_high:
                return high
            left, inside = left - inside_high, inside.where(F.col("x") < high)
            continue
        step = F.least(F.floor((F.col("x") - low) / width), F.lit(1023))
        hist = dict(inside.groupBy(step.alias("bin")).count().collect())  # at most 1024 rows
        for b in sorted(hist, reverse=True):
            if left <= hist[b]:
                inside = inside.where(step == b)
                break
            left -= hist[b]


def good_share(labels: DataFrame, label: str = "quality") -> float:
    """The share of labels 0 and 1 that are 1 (1 without labels)."""
    n, good = labels.where(F.col(label).isin(0, 1)).agg(F.count(F.lit(1)), F.sum(label)).first()
    return good / n if n else 1.0


def resample(docs: DataFrame, labels: DataFrame, keep: float, doc_id: str = "doc_id",
             text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS,
             seed: int = 42) -> DataFrame:
    """doc_id, log_weight, n_ngrams, key, selected for every row: the ``keep``
    share of rows (rounded up) with the largest keys is selected."""
    good = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("y"))
            .where("id is not null and y = 1").select("id").distinct()
            .orderBy(F.xxhash64("id"), "id").limit(max_rows))
    own = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    target = save(one_text(own, good), "resample-target")
    ratios = log_ratios(counts(target), counts(own))
    scored = save(own.select(
        F.col("id").alias("doc_id"), weight_column(F.col("text"), ratios).alias("w"),
        gumbel(seed, F.col("id"), F.col("text")).alias("noise")), "resample-scored")
    mean = F.col("w.log_weight") / F.greatest(F.col("w.n_ngrams"), F.lit(1))
    scored = scored.select("doc_id", "w.*", (mean * LENGTH + F.col("noise")).alias("key"))
    least = kth_largest(scored, "key", math.ceil(keep * scored.count()))
    return scored.withColumn("selected", F.lit(False) if least is None else F.col("key") >= least)
