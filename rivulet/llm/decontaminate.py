"""Benchmark decontamination by winnowing (DataFrame operations only).

Texts become words: A-Z are lower-cased, and every ASCII character that is
not a digit or a-z separates words. A *window* is 13 consecutive words of a
benchmark item; an item of fewer words (but not none) is one window. A
document word inside any occurrence of a window is *hit*.

Method. Hash every run of K words and keep, per 13 words, the smallest of
their hashes (winnowing). A span of 13 words shared by a document and an
item has the same K-word hashes in both, hence the same minimum, so joining
the kept hashes misses no shared window. Each hit is then extended: the
document's words around it are compared with the item's, window by window,
along the diagonal the hit fixes. Equality is decided on the words, so hash
collisions cost work but never a wrong result.

Items shorter than 13 words have one window of their own length m; they are
looked up by the hash of m words, one pass for each such length (at most 12).

Scale. Each text is tokenised and hashed in one pass, and its kept hashes are
looked up among the benchmark's. While those number at most
``BROADCAST_HASHES`` (counted; 8 bytes each) they are broadcast and the words
around a hit are at hand in the same row, so no text is shuffled. For larger
benchmarks only (digest, hash) pairs are shuffled, and the texts that share a
hash are read again, each once. Results are kept per distinct text, so copies
share them. Nothing that grows with the documents is collected.

Defined results. Null text has no words. Null or empty texts, and documents
without hits, return 0 words hit, no items and the hash of the empty string.
Items with a null id or null text take no part; items repeated under one id
count once. Repeated document rows each get their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import digest, save, small

WINDOW = 13  # words
K = 6        # words of a hashed run; 13 - 6 + 1 = 8 runs per window
BROADCAST_HASHES = 1_000_000
BROADCAST_TEXTS = 500_000  # digests of 16 bytes

# translate(): A-Z to a-z, every other separator to a space
_FROM = "".join(chr(c) for c in range(128)
                if not (48 <= c <= 57 or 97 <= c <= 122 or c == 32))
_TO = "".join(c.lower() if c.isupper() else " " for c in _FROM)


def words(text: Column) -> Column:
    """The words of a text, in order (null: none)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _FROM, _TO)
    return F.array_remove(F.split(spaced, " "), "")


def _shifted(array: Column, by: int, f) -> Column:
    """f(a[i], a[i + by]) for every i that has both."""
    n = F.greatest(F.size(array) - by, F.lit(0))
    return F.zip_with(F.slice(array, F.lit(1), n), F.slice(array, F.lit(1 + by), n), f)


def _hash2(x, y):
    return F.xxhash64(x, y)


def _min2(x, y):
    return F.least(x, y)


def _with_hashes(df: DataFrame, window: int) -> DataFrame:
    """Add ``h``: the hash of the K words (all ``window`` words of a shorter
    window) from each position; none if ``words`` are too few."""
    df = df.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    if window < WINDOW:
        n = F.size("h") - (window - 1)
        return df.withColumn("h", F.when(n > 0, F.transform(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            lambda i: F.xxhash64(F.slice(F.col("h"), i, window))))
            .otherwise(F.array().cast("array<bigint>")))
    # 2, then 4, then 6 words
    return (df.withColumn("h2", _shifted(F.col("h"), 1, _hash2))
            .withColumn("h4", _shifted(F.col("h2"), 2, _hash2))
            .withColumn("h", F.zip_with(
                F.slice("h4", F.lit(1), F.greatest(F.size("h4") - 2, F.lit(0))),
                F.slice("h2", F.lit(5), F.greatest(F.size("h2") - 4, F.lit(0))), _hash2))
            .drop("h2", "h4"))


def _kept(df: DataFrame, window: int) -> DataFrame:
    """Add ``hash``, a row for each distinct hash that winnowing keeps: the
    least of every 8 in a row (every hash of a shorter window)."""
    least = "h"
    for step in (1, 2, 4) if window == WINDOW else ():
        df = df.withColumn("least", _shifted(F.col(least), step, _min2))
        least = "least"
    # explode_outer: explode would make Spark test the array for emptiness
    # before, which computes all of the above a second time
    return (df.withColumn("hash", F.explode_outer(F.array_distinct(least)))
            .where(F.col("hash").isNotNull()).drop("least"))


def _sharing(docs: DataFrame, hashes: DataFrame, window: int, name: str) -> DataFrame:
    """(digest, words, h, hash): the texts that share ``hash`` with an item."""
    if hashes.count() <= BROADCAST_HASHES:
        hashed = _with_hashes(docs.select("digest", "words"), window)
        return _kept(hashed, window).join(F.broadcast(hashes), "hash")
    pairs = _kept(_with_hashes(docs.select("digest", "words"), window), window).select("digest", "hash")
    found = save(pairs.join(hashes, "hash").groupBy("digest")
                 .agg(F.collect_set("hash").alias("found")), f"{name}-found{window}")
    texts = (docs.select("digest", "text").join(found, "digest").dropDuplicates(["digest"])
             .select("digest", "found", words(F.col("text")).alias("words")))
    return _with_hashes(texts, window).withColumn("hash", F.explode_outer("found")).drop("found")


def _hits(docs: DataFrame, items: DataFrame, window: int, name: str) -> DataFrame:
    """(digest, item_id, begin, length): the places of texts where a window
    of ``window`` words of an item begins."""
    run = K if window == WINDOW else window
    hashed = _with_hashes(items, window)
    kept = _kept(hashed, window).select("item", "hash").distinct()
    # every position of an item whose hash winnowing keeps somewhere in it
    bench = save(hashed.select("item", F.posexplode_outer("h").alias("item_at", "hash"))
                 .join(kept, ["item", "hash"]).select("hash", "item", "item_at"), f"{name}-items{window}")
    hashes = save(bench.select("hash").distinct(), f"{name}-hashes{window}")
    first = lambda at: F.greatest(at - (window - run), F.lit(0))
    around = (_sharing(docs, hashes, window, name)
              .withColumn("hit", F.explode_outer(F.transform(
                  F.filter(F.sequence(F.lit(0), F.size("h") - 1),
                           lambda i: F.get("h", i) == F.col("hash")),
                  lambda i: F.struct(i.alias("at"), first(i).alias("first"),
                                     F.slice("words", first(i) + 1, 2 * window - run).alias("near")))))
              .select("digest", "hash", "hit.*"))
    # extension: item windows that hold the hit and agree in every word;
    # window s of the item would begin at document word at - item_at + s
    begin = F.col("at") - F.col("item_at") - F.col("first")
    return (around.join(bench, "hash")
            .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
            .withColumn("begin", begin)
            .withColumn("s", F.explode_outer(F.filter(
                F.sequence(F.greatest(F.col("item_at") - (window - run), F.lit(0)),
                           F.least(F.col("item_at"), F.size("item_words") - window)),
                lambda s: (F.col("begin") + s >= 0)
                & (F.slice("near", F.greatest(F.col("begin") + s, F.lit(0)) + 1, window)
                   == F.slice("item_words", s + 1, window)))))
            .where(F.col("s").isNotNull())
            .select("digest", "item_id",
                    (F.col("at") - F.col("item_at") + F.col("s")).alias("begin"),
                    F.lit(window).alias("length"))
            .distinct())


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(texts, occurrences)``.

    ``texts``: one row per distinct contaminated or touched text: digest,
    n_hit (words inside an occurring window), items (sorted ids as strings).
    ``occurrences``: digest, item_id, begin, length: every window found.
    ``digest`` is ``common.digest`` of the text.
    """
    src = docs.select(F.col(text).alias("text"), digest(F.col(text)).alias("digest"),
                      words(F.col(text)).alias("words"))
    items = save(benchmark.select(F.col(item_id).alias("item_id"),
                                  words(F.col(item_text)).alias("words"))
                 .where("item_id is not null and size(words) > 0").distinct()
                 .withColumn("item", F.monotonically_increasing_id()), "decontam-bench")
    lengths = [r[0] for r in items.select(
        F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()]  # at most 13
    found = None
    for window in sorted(lengths, reverse=True):
        part = items if window == WINDOW else items.where(F.size("words") == window)
        hits = _hits(src, part, window, "decontam")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.sparkSession.createDataFrame(
            [], f"digest binary, item_id {benchmark.schema[item_id].dataType.simpleString()}, "
                "begin int, length int")
    found = save(found, "decontam-hits")
    n_hit = (found.select("digest", F.explode(F.sequence(
        F.col("begin"), F.col("begin") + F.col("length") - 1)).alias("at"))
        .distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("n_hit")))
    by_item = (found.select("digest", F.col("item_id").cast("string").alias("item")).distinct()
               .groupBy("digest").agg(F.sort_array(F.collect_list("item")).alias("items")))
    return save(n_hit.join(by_item, "digest"), "decontam-texts"), found


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (a twentieth of its words or more are hit)."""
    texts, _ = contamination(docs, benchmark, text)
    n_words = F.size(words(F.col(text)))
    return (docs.select(F.col(doc_id).alias("doc_id"), digest(F.col(text)).alias("digest"),
                        n_words.cast("long").alias("n_words"))
            .join(texts, "digest", "left")
            .select("doc_id", "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256)
                    .alias("items_sha256"))
            .withColumn("n_items", F.greatest("n_items", F.lit(0)))
            .withColumn("contaminated",
                        (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    texts, _ = contamination(docs, benchmark, text)
    # the words of touched texts only are counted, once for each text
    touched = (docs.select(F.col(text).alias("text"), digest(F.col(text)).alias("digest"))
               .join(small(texts, BROADCAST_TEXTS), "digest")
               .select("digest", "n_hit", F.size(words(F.col("text"))).alias("n_words")))
    bad = save(touched.where(20 * F.col("n_hit") >= F.col("n_words")).select("digest").distinct(),
               "decontam-bad")
    return docs.join(small(bad, BROADCAST_TEXTS), digest(docs[text]) == bad["digest"], "left_anti")
