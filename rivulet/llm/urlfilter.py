"""URL filter: rules first, else words segmented from host names, scored by
multinomial naive Bayes.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end. A rule
``(host, path prefix, verdict)`` fits its host and all its subdomains if the
path starts with the prefix; the longest rule wins.

Segmentation. Runs of letters in a host are split into words by a unigram
Viterbi: word counts come from the pages' own texts, a string that is no word
costs as much as a word seen 10 / 10^length times. Only substrings of hosts
that have the length of some word are looked up, by a join, so the vocabulary
is never broadcast or cut; words and splits may be of any length.

Naive Bayes. Tokens are the host's words and the path's runs of letters and
digits (numbers become ``0``). The pages that a rule decides are the training
rows; seed words count ``SEED_WEIGHT`` pages each, so that a class without
rules is not empty. Counts are raised by ``ALPHA``. A page without a rule is
blocked if its log odds for block exceed those for allow.

Scale. A score depends on host and path only, so everything runs on distinct
(host, path) pairs and distinct hosts with their multiplicities; hot hosts
are one row before anything is joined. The word count is one partial
aggregation over the pages. No collect, no forced broadcast.

Defined results. Null urls and urls without ``://`` have empty host and path,
fit no rule and have no tokens: the classes' prior odds decide. Repeated rows
get equal results. Null or empty html adds no words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import save

ALPHA = 1.0
SEED_WEIGHT = 20

# Words that mark unwanted and wanted sites.
BLOCK_SEEDS = ("ads adult banner bet bets betting bonus casino cheap click clickbait crack escort farm free "
               "gamble jackpot keygen loan loans lottery nude pharma pills poker porn replica sex "
               "slots spam torrent tracker viagra warez win xxx").split()
ALLOW_SEEDS = ("academy archive blog books college docs edu education encyclopedia gov health "
               "history journal learn library museum news press research school science "
               "university weather wiki").split()


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str     # prefix, with its leading slash

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, name: str) -> Rule:
    host, _, path = name.partition("/")
    return Rule(verdict, host, "/" + path)


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), _UP, _LOW)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def winning_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # longer ones override
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n): runs of letters in the text of html."""
    low = F.lower(F.col(column))
    # every "<" before the last ">" has an end, so none is read on in vain
    rest = F.substring_index(low, ">", -1)
    tagged = F.left(low, F.length(low) - F.length(rest))
    entity = "&#?[a-z0-9]{1,10};"
    bare = F.concat(F.regexp_replace(tagged, f"<[^>]*+>|{entity}", " "), F.regexp_replace(rest, entity, " "))
    return (texts.select(F.explode(F.split(bare, r"[^\p{L}]+")).alias("word"))
            .where("word != ''")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def viterbi(run: str, found: dict[str, int], total: int) -> list[str]:
    """The likeliest split of ``run`` into words; ties: the longer last word."""
    log_total = math.log(max(total, 1))
    longest = max(map(len, found), default=0)
    best: list[tuple[float, int]] = [(0.0, 0)]
    lead, lead_score = 0, 0.0  # the best start of a string that is no word, wherever it ends
    for end in range(1, len(run) + 1):
        if end > 1 and best[end - 1][0] + math.log(10) * (end - 1) > lead_score:
            lead, lead_score = end - 1, best[end - 1][0] + math.log(10) * (end - 1)
        choices = [(best[lead][0] + math.log(10) * (1 - (end - lead)) - log_total, -lead)]
        for start in range(max(0, end - longest), end):
            n = found.get(run[start:end])
            if n:
                choices.append((best[start][0] + math.log(n) - log_total, -start))
        score, start = max(choices)
        best.append((score, -start))
    words, end = [], len(run)
    while end:
        words.append(run[best[end][1]:end])
        end = best[end][1]
    return words[::-1]


def segment(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, words): the Viterbi split of each distinct ``runs(run)``."""
    total, lengths = words.agg(F.sum("n"), F.collect_set(F.length("word"))).first()
    total, lengths = total or 0, F.array(*map(F.lit, sorted(lengths))).cast("array<int>")
    pieces = (runs.where("run != ''").select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("i"))
              .select("run", F.explode(F.transform(
                  F.filter(lengths, lambda n: n <= F.length("run") - F.col("i") + 1),
                  lambda n: F.substr("run", F.col("i"), n))).alias("word"))
              .unionByName(runs.where("run != ''").select("run", F.col("run").alias("word")))  # one without pieces stays
              .distinct())
    known = (pieces.join(words, "word", "left").groupBy("run").agg(F.map_from_entries(F.collect_list(
        F.when(F.col("n").isNotNull(), F.struct("word", "n")))).alias("found")))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"run": b["run"], "words": [
                viterbi(r, dict(f) if f is not None else {}, total) for r, f in zip(b["run"], b["found"])]})

    return known.mapInPandas(split, "run string, words array<string>")


def host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """(host, words) for every distinct ``hosts(host)``."""
    parts = hosts.select("host", F.posexplode(F.split("host", r"[^\p{L}]+")).alias("at", "run"))
    split = segment(parts.select("run").distinct(), words)
    return (parts.join(split, "run", "left").groupBy("host")
            .agg(F.flatten(F.transform(
                F.sort_array(F.collect_list(F.struct("at", F.coalesce("words", F.array().cast("array<string>")).alias("w")))),
                lambda s: s["w"])).alias("words")))


def path_words(path: Column) -> Column:
    """Runs of letters and digits of a path; digits become 0."""
    low = F.regexp_replace(F.lower(path), "[0-9]+", "0")
    return F.array_remove(F.split(low, r"[^\p{L}0]+"), "")


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict and block_odds (null where a rule
    decided) for every row of ``pages``."""
    url_ = F.col(url)
    own = pages.select(F.col(page_id).alias("page_id"), host_of(url_).alias("host"),
                       path_of(url_).alias("path"))
    name, by_rule = winning_rule(F.col("host"), F.col("path"), rules)
    places = save(own.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
                  .withColumn("rule", name).withColumn("by_rule", by_rule), "urls-places")
    words = save(word_counts(pages.select(F.col(html).alias("html")), "html"), "urls-words")
    split = save(host_words(places.select("host").distinct(), words), "urls-hosts")
    tokens = (places.join(split, "host")
              .select("host", "path", "by_rule", "pages",
                      F.explode(F.concat("words", path_words(F.col("path")))).alias("token")))

    seeds = places.sparkSession.createDataFrame(
        [(w, SEED_WEIGHT if blocked else 0, 0 if blocked else SEED_WEIGHT)
         for blocked, ws in ((True, BLOCK_SEEDS), (False, ALLOW_SEEDS)) for w in ws],
        "token string, block long, allow long")
    per = [F.sum(F.when(F.col("by_rule") == v, F.col("pages")).otherwise(0)).alias(v)
           for v in ("block", "allow")]
    stats = (tokens.where("by_rule is not null").groupBy("token").agg(*per).unionByName(seeds)
             .groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow")))
    stats = save(stats, "urls-tokens")
    kinds, n_block, n_allow = stats.agg(F.count(F.lit(1)), F.sum("block"), F.sum("allow")).first()
    rows_block, rows_allow = (v or 0 for v in places.agg(*per).first())
    log_odds = (F.log((F.col("block") + ALPHA) / (n_block + ALPHA * (kinds + 1)))
                - F.log((F.col("allow") + ALPHA) / (n_allow + ALPHA * (kinds + 1))))
    unseen = math.log((n_allow + ALPHA * (kinds + 1)) / (n_block + ALPHA * (kinds + 1)))
    prior = math.log((rows_block + 1) / (rows_allow + 1))
    scores = (tokens.where("by_rule is null").select("host", "path", "token")
              .join(stats.select("token", log_odds.alias("odds")), "token", "left")
              .groupBy("host", "path").agg(F.sum(F.round(F.coalesce("odds", F.lit(unseen)), 12)
                                                 .cast("decimal(30,12)")).cast("double").alias("odds")))
    judged = save(places.join(scores, ["host", "path"], "left").select(
        "host", "path", "rule",
        F.when(F.col("by_rule").isNull(), F.coalesce("odds", F.lit(0.0)) + prior).alias("block_odds"),
        "by_rule"), "urls-judged")
    verdict = F.coalesce("by_rule", F.when(F.col("block_odds") > 0, "block").otherwise("allow"))
    return own.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "block_odds")
