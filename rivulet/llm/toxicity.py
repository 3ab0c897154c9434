"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

Features of a text (densities are per word): words of a stated lexicon of
insults, words of a lexicon learned from labelled rows, both also after
undoing obfuscation (digits and signs for letters, one letter starred out,
stretched letters); lexicon words near a second-person pronoun; capitals;
punctuation; obfuscated words. Labels, language, source and ids are never
inputs.

Training. Labels are read only where ``crc32(doc_id as text) % 5 != 0``; the
rest is held out. At most ``max_rows`` labelled documents (those whose ids
hash lowest, so the choice does not depend on order or partitioning) train:
remainder 1 learns the lexicon, 2 and 3 the trees, 4 the isotonic
calibration, so no stage is fitted to features that already saw its labels.
This bound is the model's size, not the data's: scoring covers every row.

Scale. One pass over the texts in Arrow batches computes the features; trees
and calibration are applied on the JVM. No shuffle. The training ids (at most
``max_rows``) are broadcast to pick their texts.

Defined results. Null and empty texts have all features 0 and a score like
any other. A null doc_id is not held out and does not train. Labels other
than 0 and 1 and documents with both labels do not train. If the training
rows hold only one class, the score is half the number of insults, at most 1.
Scores within one step of the calibration keep the order of the trees.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, col, fresh, save

MAX_ROWS = 20_000   # labelled documents that train
LEARNED = 300       # words of the learned lexicon, at most
LEAST_SEEN = 3      # toxic documents a learned word occurs in, at least
NEAR = 6            # words between an insult and a pronoun, at most
TREES, DEPTH, STEP = 25, 4, 0.2

# Common insults and abuse in four languages.
INSULTS = frozenset("""
arse arsehole asshole bastard bitch bollocks brainless bullshit clown coward creep cretin crap damn
dickhead disgusting douche dumb dumbass dunce fool freak fuck fucker fucking garbage hate hideous
idiot idiotic idiots imbecile jackass jerk kill lame loser losers lowlife maggot moron moronic morons
motherfucker nasty parasite pathetic pig pissed prick psycho pussy retard retarded rubbish scum scumbag
shit shithead shitty sick skank slut stupid sucker sucks swine thug trash twat ugly useless vermin vile
wanker weirdo whore worthless wretch
abschaum arschloch blödmann depp dreck drecksau dumm dummkopf hurensohn idioten missgeburt schlampe
schwein trottel vollidiot wichser widerlich wertlos
abruti connard connasse crétin débile dégueulasse enculé imbécile merde minable ordure putain salaud
salope stupide
basura cabrón estúpido gilipollas hijoputa idiota imbécil inútil maldito mierda pendejo puta puto tonto
""".split())
# Second-person pronouns in four languages.
YOU = frozenset("""you your yours yourself u ur ya you're youre du dich dir dein deine ihr euch tu toi te
vous votre vos ton ta tes tú ti usted ustedes tu sus vosotros""".split())
_LEET = str.maketrans("0134578@$!|", "oieastbasii")
_EDGES = "".join(c for c in string.punctuation if c not in "@$")

FEATURES = ("log_words", "insults", "insult_count", "learned", "learned_most", "hidden_insults",
            "near_you", "nearest_you", "you", "capitals", "shouted", "exclamations", "questions",
            "punctuation", "obfuscated", "stretched", "digits")

_STRETCH = re.compile(r"(.)\1{2,}")
_MIXED = re.compile(r"[^\W\d_][\d@$!*|#]+[^\W\d_]")


_MARKS = re.compile("[" + re.escape(string.punctuation) + "]")
_STAR_EDGES = _EDGES.replace("*", "")
STARRED = frozenset(w[:i] + "*" + w[i + 1:] for w in INSULTS if len(w) > 3 for i in range(1, len(w)))
_CACHE = 400_000  # tokens


class _Tokens(dict):
    """Token -> row of ``table()``: its share of each count."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned, self.new = learned, []
        self.held, self.filled = np.zeros((1024, 14), np.float32), 0

    def forget(self) -> None:
        self.clear()
        self.new, self.filled = [], 0

    def table(self) -> np.ndarray:
        if self.new:
            need = self.filled + len(self.new)
            if need > len(self.held):
                self.held = np.concatenate([self.held, np.zeros((max(need, len(self.held)), 14), np.float32)])
            self.held[self.filled:need] = self.new
            self.filled, self.new = need, []
        return self.held

    def __missing__(self, token: str) -> int:
        self[token] = n = self.filled + len(self.new)
        low = token.lower()
        # most tokens are a plain word with at most some marks around it
        core = low.strip(string.punctuation)
        plain, odd = core in INSULTS, not core.isalpha()
        stretched = bool(_STRETCH.search(core))
        hidden, squeezed = False, core
        if not plain and len(core) > 2 and (odd or stretched or low != core):
            squeezed = _STRETCH.sub(r"\1", low.translate(_LEET)).strip(_EDGES)
            hidden = (squeezed in INSULTS or low.strip(_STAR_EDGES) in STARRED
                      or _STRETCH.sub(r"\1\1", core) in INSULTS
                      or low.replace(".", "").replace("-", "") in INSULTS)
        weight = self.learned.get(core) or self.learned.get(squeezed, 0.0)
        if token.isalpha():
            letters = len(token)
            digits = marks = exclaims = questions = 0
        else:
            letters, digits = sum(map(str.isalpha, token)), sum(map(str.isdigit, token))
            exclaims, questions = token.count("!"), token.count("?")
            marks = len(_MARKS.findall(token))
        capitals = 0 if token == low else sum(map(str.isupper, token))
        self.new.append((plain or hidden, weight, hidden, core in YOU, letters, capitals,
                         letters > 1 and capitals == letters, exclaims, questions, marks,
                         odd and bool(_MIXED.search(low)), stretched, digits, len(token)))
        return n


def features(texts, learned: dict[str, float], known: _Tokens | None = None) -> np.ndarray:
    """One row of ``FEATURES`` per text. ``known`` keeps tokens from call to call."""
    known = _Tokens(learned) if known is None else known
    out = np.zeros((len(texts), len(FEATURES)))
    for row, text in enumerate(texts):
        tokens = (text or "").split()
        if not tokens:
            continue
        if len(known) > _CACHE:  # bound the cache of tokens
            known.forget()
        at = np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        t = known.table()[at]
        sums, n = t.sum(0, dtype=np.float64), len(tokens)
        insult, you = np.flatnonzero(t[:, 0]), np.flatnonzero(t[:, 3])
        near, nearest = 0, 0.0
        if len(insult) and len(you):
            right = np.searchsorted(you, insult)
            gap = np.minimum(np.abs(insult - you[np.minimum(right, len(you) - 1)]),
                             np.abs(insult - you[np.maximum(right - 1, 0)]))
            near, nearest = int((gap <= NEAR).sum()), 1.0 / (1 + gap.min())
        letters, chars = max(sums[4], 1), max(sums[13], 1)
        out[row] = (np.log1p(n), sums[0] / n, np.log1p(sums[0]), sums[1] / n, t[:, 1].max(),
                    sums[2] / n, near / n, nearest, sums[3] / n, sums[5] / letters, sums[6] / n,
                    sums[7] / n, sums[8] / n, sums[9] / chars, sums[10] / n, sums[11] / n,
                    sums[12] / chars)
    return out


def feature_column(text: Column, learned: dict[str, float]) -> Column:
    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = _Tokens(learned)
        for texts in batches:
            yield pd.Series(list(features(texts, learned, known)))
    return of(text)


def _remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


@dataclass
class Model:
    learned: dict[str, float] = field(default_factory=dict)
    trees: GBTClassificationModel | None = None
    steps: IsotonicRegressionModel | None = None

    def add_score(self, docs: DataFrame, text: str, name: str) -> DataFrame:
        """``docs`` with column ``name``: the score. All columns stay."""
        bound_batches(docs.sparkSession)
        names: dict[str, str] = {}
        for base in ("tox_features", "tox_raw", "tox_probability", "tox_prediction", "tox_step"):
            names[base] = fresh([*docs.columns, *names.values()], base)
        vec, raw, prob, pred, step = names.values()
        feats = feature_column(col(text), self.learned)
        if self.trees is None:
            at = FEATURES.index("insult_count")
            return docs.withColumn(name, F.least(F.lit(1.0), F.round(F.expm1(F.get(feats, F.lit(at)))) / 2))
        df = docs.withColumn(vec, array_to_vector(feats))
        df = self.trees.copy().setFeaturesCol(vec).setRawPredictionCol(raw) \
            .setProbabilityCol(prob).setPredictionCol(pred).transform(df)
        df = df.withColumn(prob, vector_to_array(col(prob))[1])
        score = col(prob)
        if self.steps is not None:
            df = self.steps.copy().setFeaturesCol(prob).setPredictionCol(step).transform(df)
            score = 0.999 * col(step) + 0.001 * col(prob)
        return (df.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)))
                .drop(*[n for n in (vec, raw, prob, pred, step) if n in df.columns]))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """Train on the rows of ``labels`` that are not held out."""
    bound_batches(docs.sparkSession)
    chosen = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)")
              .where(_remainder(F.col("id")) != 0)
              .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top")).where("y = top")
              .orderBy(F.xxhash64("id"), "id").limit(max_rows)
              .select("id", "y", _remainder(F.col("id")).alias("fold")))
    # one text per id, the one whose hash is least: the bound holds for rows
    rows = save(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
                .join(F.broadcast(chosen), "id").groupBy("id", "y", "fold")
                .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "toxicity-rows")

    seen = rows.where("fold = 1").select("y", F.explode(F.array_distinct(F.transform(
        F.split(F.lower(F.col("text")), r"\s+"),
        lambda w: F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", "")))).alias("word"))
    n1, n0 = rows.where("fold = 1").agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    learned: dict[str, float] = {}
    if n1 and n0:
        odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
        words = (seen.where("word != ''").groupBy("word")
                 .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
                 .where(F.col("toxic") >= LEAST_SEEN).select("word", odds.alias("weight"))
                 .where("weight > 1.5").orderBy(F.desc("weight"), "word").limit(LEARNED))
        learned = {w: float(v) for w, v in words.collect()}

    ready = save(rows.where("fold != 1").select(
        "fold", F.col("y").cast("double").alias("label"),
        feature_column(F.col("text"), learned).alias("x")), "toxicity-features") \
        .coalesce(1).sortWithinPartitions("fold", "label", "x")  # bounded, and one order
    grow = ready.where("fold in (2, 3)").select("label", array_to_vector("x").alias("x"))
    if grow.select("label").distinct().count() < 2:
        return Model(learned)
    trees = GBTClassifier(featuresCol="x", labelCol="label", maxIter=TREES, maxDepth=DEPTH,
                          stepSize=STEP, minInstancesPerNode=5, seed=42).fit(grow)
    model = Model(learned, trees)
    calm = trees.transform(ready.where("fold = 4").select("label", array_to_vector("x").alias("x"))) \
        .select("label", vector_to_array("probability")[1].alias("p"))
    if calm.select("label").distinct().count() == 2:
        model.steps = IsotonicRegression(featuresCol="p", labelCol="label").fit(calm)
    return model


def report(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
           max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fit(docs, labels, doc_id, text, max_rows=max_rows)
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return model.add_score(own, "text", "score").select(
        "doc_id", F.coalesce(_remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, all columns kept."""
    score = fresh(docs.columns, "tox_score")
    return (fit(docs, labels, doc_id, text).add_score(docs, text, score)
            .where(col(score) < 0.5).drop(score))
