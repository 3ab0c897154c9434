"""Spelling variants by pivotal grams.

Two words are *near* if they differ by exactly one inserted, deleted or
replaced code point. A word's *form* is its near word of largest n (ties: the
smallest in code-point order) if that n is at least ``RATIO`` times the
word's own; its *root* is the last word reached by following forms.

Method. Bigrams are ordered by how often they stand in the vocabulary, rarest
first. A word's *prefix* is its 3 rarest bigrams (2 letters x 1 edit + 1),
with every further occurrence of the third one's kind; its *pivots* are two
disjoint bigrams of the prefix, least frequent in sum, chosen by dynamic
programming. One edit touches at most one of two disjoint bigrams, so of two
near words a pivot of either stands in the other; and it stands in the prefix
of the one whose prefix ends later in the order. So pivots are joined with
the prefixes that end no earlier.

Position limits. A pivot that survives an edit behind it keeps its position
and all before it; one that survives an edit before it keeps all behind it
and moves with the length. So a pivot is looked up under five pairs of length
and position, together with a hash of the letters on the side that stays:
what meets under a key differs by chance or on the other side alone. It is
verified inside the join: by the set of letters (an edit changes at most two),
then by edit distance. Words of more than ``CARRIED`` letters don't travel
with their keys; their pairs are verified when they are known.

Scale. Words are counted with partial aggregation; from there on everything
has the size of the vocabulary. The bigram counts are bounded by the alphabet
(90 letters, 8,100 bigrams) and go to the tasks.
Forms lead to words at least ``RATIO`` times as frequent, so chains are at
most log(n) long; roots are found by pointer doubling. A hot key is split by
Spark's skew join; a hot form meets partial aggregates.

Defined results. Null texts hold no words; a null document id is an empty
string in the hash that picks a letter to delete. Repeated rows count each
time. Words and texts of any length are read whole. An empty table gives an
empty result. Columns besides the two are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, col, save

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
EDITS = 1
GRAM = 2
PREFIX = GRAM * EDITS + 1
SHORTEST = GRAM + PREFIX - 1  # letters of a word that has a whole prefix
DELETE_ONE_IN = 199

RUNS = "[a-zÀ-ÿ]{%d,}"  # a run of letters, once A-Z are lower-cased
_UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
# (change of length, side that stays): an edit behind the pivot leaves what is
# before it, an edit before it what is behind
_LOOKUPS = ((0, 0), (1, 0), (-1, 0), (0, 1), (1, 1), (-1, 1))
_BASE, _PRIME = 0x10001, (1 << 61) - 1
_CHUNK = 50_000  # rows of keys given out at once
CARRIED = 64     # letters of a word that is verified inside the join


def _damaged(doc_id: Column, run: Column) -> Column:
    """The run without one code point, if crc32 of ``doc_id:run`` says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DELETE_ONE_IN == 0, F.concat(
        F.substr(run, F.lit(1), at), F.substr(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word and n (occurrences) of the words of ``docs``."""
    lowered = F.translate(col(text), _UPPER, _UPPER.lower())
    # a shorter run can't give a word of least_length
    runs = docs.select(col(doc_id).alias("doc"), F.explode(F.regexp_extract_all(
        lowered, F.lit(RUNS % least_length), F.lit(0))).alias("run"))
    return (runs.select(_damaged(F.col("doc"), F.col("run")).alias("word"))
            .where(F.length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def prefix_and_pivots(word: str, order: dict[str, int], counts: dict[str, int]
                      ) -> tuple[list[tuple[int, int]], list[int]]:
    """The prefix as (order of the bigram, position), sorted, and the
    positions of the two disjoint pivots of least total count."""
    grams = sorted((order[word[i:i + GRAM]], i) for i in range(len(word) - GRAM + 1))
    last = grams[PREFIX - 1][0]
    end = next((k for k in range(PREFIX, len(grams)) if grams[k][0] > last), len(grams))
    prefix = grams[:end]
    # ways[k]: the best k + 1 disjoint bigrams among those begun so far;
    # ready[k]: the same, ended before the position looked at
    places = sorted(i for _, i in prefix)
    none = (1 << 62, ())
    ways = [none] * (EDITS + 1)
    waiting: list[tuple[int, list]] = []
    ready = [none] * (EDITS + 1)
    for at in places:
        while waiting and waiting[0][0] + GRAM <= at:
            ready = waiting.pop(0)[1]
        cost = counts[word[at:at + GRAM]]
        for k in range(EDITS, -1, -1):
            before = ready[k - 1] if k else (0, ())
            ways[k] = min(ways[k], (before[0] + cost, (*before[1], at)))
        waiting.append((at, list(ways)))
    return prefix, list(ways[EDITS][1])


def _sides(word: str) -> tuple[list[int], list[int]]:
    """Hashes of every beginning and every end of the word."""
    start, end = [0], [0]
    for c in word:
        start.append((start[-1] * _BASE + ord(c)) % _PRIME)
    for c in reversed(word):
        end.append((end[-1] * _BASE + ord(c)) % _PRIME)
    return start, end[::-1]  # end[i]: hash of word[i:]


def _key(side: int, length: int, part: int) -> int:
    """61 bits of what must agree; a collision costs one comparison."""
    return ((part * 2 + side) * 1_000_003 + length) * 0x9E3779B97F4A7C15 % _PRIME


def _index(order: dict[str, int], counts: dict[str, int]):
    """Rows of the words' pivots and prefixes: id, key, last (where the
    prefix ends in the order), pivot, letters (as bits) and the word."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("last", pa.int32()), ("pivot", pa.bool_()),
                        ("letters", pa.int64()), ("word", pa.string())])

    def rows(word_id: int, word: str) -> Iterator[tuple]:
        prefix, pivots = prefix_and_pivots(word, order, counts)
        last, n = prefix[-1][0], len(word)
        start, end = _sides(word)
        letters = sum({1 << ord(c) % 63 for c in word})
        own = (letters, word if n <= CARRIED else None)
        for _, at in prefix:
            # the bigram belongs to the side that stays
            yield word_id, _key(0, n, start[at + GRAM]), last, False, *own
            yield word_id, _key(1, n, end[at]), last, False, *own
        for at in pivots:
            for more, side in _LOOKUPS:
                yield word_id, _key(side, n + more, end[at] if side else start[at + GRAM]), last, True, *own

    def out(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    def run(batches):
        held = []
        for batch in batches:
            for word_id, word in zip(batch["id"].to_pylist(), batch["word"].to_pylist()):
                for row in rows(word_id, word):
                    held.append(row)
                    if len(held) == _CHUNK:
                        yield out(held)
                        held = []
        if held:
            yield out(held)
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """Every pair of near words once: a, b (ids), word_a, word_b, n_a, n_b.
    ``words`` is a saved table of id, word and n, each word once. Words of
    less than ``SHORTEST`` letters take no part."""
    bound_batches(words.sparkSession)
    words = words.where(F.length("word") >= SHORTEST)
    grams = F.transform(F.sequence(F.lit(1), F.length("word") - (GRAM - 1)),
                        lambda i: F.substr("word", i, F.lit(GRAM)))
    # at most one row per pair of letters
    found = (words.select(F.explode(grams).alias("gram"))
             .groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r.gram: r.n for r in found}
    order = {g: i for i, g in enumerate(sorted(counts, key=lambda g: (counts[g], g)))}
    keys = save(words.select("id", "word").mapInArrow(
        _index(order, counts), "id long, key long, last int, pivot boolean, letters long, word string"),
        "spelling-keys")
    p, r = keys.where("pivot").alias("p"), keys.where("not pivot").alias("r")
    met = (p.join(r, (F.col("p.key") == F.col("r.key")) & (F.col("p.last") <= F.col("r.last"))
                  & (F.col("p.id") != F.col("r.id"))
                  & (F.bit_count(F.col("p.letters").bitwiseXOR(F.col("r.letters"))) <= 2 * EDITS)
                  & (F.coalesce(F.levenshtein("p.word", "r.word", EDITS), F.lit(1)) == 1))
           .select(F.least("p.id", "r.id").alias("a"), F.greatest("p.id", "r.id").alias("b")).distinct())
    side = lambda s: words.select(F.col("id").alias(s), F.col("word").alias(f"word_{s}"),
                                  F.col("n").alias(f"n_{s}"))
    return (met.join(side("a"), "a").join(side("b"), "b")
            .where(F.levenshtein("word_a", "word_b", EDITS) == 1))


def roots(forms: DataFrame) -> DataFrame:
    """word and root for ``forms`` (word, form): pointer doubling, each round
    written, until no pointer moves."""
    now = save(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = save(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
    return now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n for a table of distinct words
    (``word``, ``n``)."""
    words = save(words.select("word", "n").withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs = save(near_pairs(words), "spelling-pairs")

    def seen_from(x: str, y: str) -> DataFrame:
        return pairs.select(F.col(x).alias("id"), F.struct(
            (-F.col(f"n_{y}")).alias("less"), F.col(f"word_{y}").alias("word")).alias("best"))
    near = (seen_from("a", "b").unionAll(seen_from("b", "a")).groupBy("id")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best")))
    fits = -F.col("best.less") >= ratio * F.col("n")
    formed = save(words.join(near, "id", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"),
        F.when(fits, -F.col("best.less")).cast("long").alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of ``docs`` and their forms (see ``variants``)."""
    return variants(vocabulary(docs, doc_id, text))
