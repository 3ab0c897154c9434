"""Exact top-k inner products with an impact-ordered index.

Vectors are quantised, component x to ``floor(256 * x)``. A *posting segment*
holds the vectors with one value v in one dimension d; for a query q all of
them gain the same impact ``q[d] * v``. Score-at-a-time: segments are taken
in falling order of impact, through a list of levels; after the level c every
segment of impact c or more has been added up, so a vector's score is at most
its sum plus c for each dimension not yet seen. The best sums so far are
scored exactly, which proves a least score for place k; once the vectors that
could still reach it are few (or the levels end) they are scored exactly and
the search stops. The levels decide how much is read, never the result.

Scale. Vectors are dealt into blocks of about ``VECTORS`` by a hash of their
id, queries into runs of about ``QUERIES``. A task holds one block, indexes it
once, and the queries of a run stream past it, so memory holds a block and a
batch whatever a run's length; vectors are copied once per run, and every query
is held against every vector, as it must be. The best k of each pair are merged per query.

Vectors with a component of ``INDEXED`` or more in size are beyond the index's
range. They are dealt into the same blocks and scored exactly, pair by pair: in
64 bits where no sum can leave them, else in Python's integers.

Defined results. Vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; components of any finite size do. A
score beyond 64 bits ranks by its exact value and is given as null, since the
column can't hold it. Repeated rows (same id, same vector) count once; different vectors under one id are separate candidates,
and each is a query; no vector of the query's own id is a candidate. Vectors
of different lengths are not compared. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches

SCALE = 256
LIMIT = math.inf         # components are smaller than this
INDEXED = 1 << 16        # and those of indexed vectors than this
VECTORS, QUERIES = 8192, 131_072
_SHIFT = 1 << 26         # keeps the dimensions apart in one sorted list
LEVELS = (1 / 8, 0.0, -1 / 8)  # of the highest impact
RESCORED = 4  # rescore once at most one vector in so many could still be a member


class ImpactIndex:
    """Posting segments of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, d = vectors.shape
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        values = np.take_along_axis(vectors.T, self.order, axis=1)
        # one sorted list of all dimensions, to find cuts of all at once
        self.flat = (values + (np.arange(d) * _SHIFT)[:, None]).ravel()
        self.values = values.astype(float)  # exact: below 2**24

    def _cuts(self, dims: np.ndarray, q: np.ndarray, level: float) -> np.ndarray:
        """Per dimension the place that parts impacts >= level from the rest."""
        n = len(self.ids)
        up = q > 0
        least = np.clip(np.where(up, np.ceil(level / q), np.floor(level / q)), -INDEXED * SCALE, INDEXED * SCALE)
        key = least.astype(np.int64) + dims * _SHIFT
        at = np.where(up, np.searchsorted(self.flat, key, "left"),
                      np.searchsorted(self.flat, key, "right"))
        return np.clip(at - dims * n, 0, n)

    def _seen(self, dims: np.ndarray, done: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Per vector in how many of ``dims`` its segment has been added."""
        n = len(self.ids)
        met = [self.order[d, at:] if up else self.order[d, :at] for d, at, up in zip(dims, done, q > 0)]
        return np.bincount(np.concatenate(met), minlength=n) if met else np.zeros(n, np.int64)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best vectors that don't bear id ``own``."""
        n = len(self.ids)
        others = self.ids != own
        dims = np.flatnonzero(query)
        q = query[dims]
        sums = np.zeros(n)
        done = np.where(q > 0, n, 0)
        reach = np.where(q > 0, self.values[dims, -1], self.values[dims, 0]) * q if n else q
        top = max(reach.max(), 1) if len(reach) else 1
        # rounding of sums beyond 53 bits
        slack = 1 + 1e-9 * float(np.abs(q).astype(float).sum()) * INDEXED * SCALE / (1 << 20)
        last = len(LEVELS)
        for step in range(last + 1):
            level = LEVELS[step] * top if step < last else -np.inf
            cut = self._cuts(dims, q, level) if step < last else np.where(q > 0, 0, n)
            low, high = np.minimum(cut, done), np.maximum(cut, done)
            done = cut
            new = np.flatnonzero(high > low)
            if len(new):
                at = np.concatenate([self.order[dims[i], low[i]:high[i]] for i in new])
                gain = np.concatenate([self.values[dims[i], low[i]:high[i]] * q[i] for i in new])
                sums += np.bincount(at, gain, n)
            if step == last or not level:
                bound = sums
            else:
                # how many dimensions of each vector were met so far
                seen = self._seen(dims, done, q)
                bound = sums + level * (len(dims) - seen)
            # the k-th exact score among the best sums is a proven least
            trial = np.flatnonzero(others)
            if len(trial) > 4 * k:
                trial = trial[np.argpartition(bound[trial], -2 * k)[-2 * k:]]
            scores = self.vectors[trial] @ query
            least = np.partition(scores, -k)[-k] if len(scores) >= k else -np.inf
            could = np.flatnonzero((bound >= least - slack) & others)
            if len(could) <= max(8 * k, n // RESCORED) or step == last:
                scores = self.vectors[could] @ query
                best = np.lexsort((self.ids[could], -scores))[:k]
                return self.ids[could[best]], scores[best]
        raise AssertionError("the last level always ends the search")


def _whole(scaled: np.ndarray) -> list[int]:
    """A quantised vector from its SCALE-th parts, as Python ints."""
    return [int(x * SCALE) if abs(x) < 2**44 else int(x) * SCALE for x in scaled.tolist()]


class Pairs:
    """Vectors of any finite size, given as quantised vector / SCALE; scored
    pair by pair."""

    def __init__(self, ids: np.ndarray, scaled: np.ndarray):
        self.ids, self.scaled = ids, scaled
        self.most = np.abs(scaled).max(axis=1, initial=0)

    def search(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """Score and id of the k best vectors that don't bear id ``own``."""
        others = self.ids != own
        with np.errstate(over="ignore"):
            reach = (np.maximum(self.most * SCALE, 1) * max(np.abs(query).max(initial=0) * SCALE, 1)
                     * max(len(query), 1))
        at = np.flatnonzero(others & (reach < 2.0**62))
        best = []
        if len(at):
            scores = (self.scaled[at] * SCALE).astype(np.int64) @ (query * SCALE).astype(np.int64)
            top = np.lexsort((self.ids[at], -scores))[:k]
            best += zip(scores[top].tolist(), self.ids[at[top]].tolist())
        large = np.flatnonzero(others & ~(reach < 2.0**62))
        if len(large):
            q = _whole(query)
            best += ((-s, i) for s, i in heapq.nsmallest(k, (
                (-sum(map(mul, _whole(self.scaled[j]), q)), int(self.ids[j])) for j in large)))
        return best


def _sortable(score: int) -> tuple[int | None, int, str]:
    """score, side and key: beyond 64 bits the score is null, side tells where
    it lies, and key rises with it."""
    if -(1 << 63) <= score < 1 << 63:
        return score, 0, ""
    digits = f"{abs(score):x}"
    key = f"{len(digits):04x}{digits}"
    if score > 0:
        return None, 1, key
    return None, -1, key.translate(str.maketrans("0123456789abcdef", "fedcba9876543210"))


def _sizes(rows: pd.DataFrame) -> pd.Series:
    return rows["q"].where(rows["q"].notna(), rows["wide"]).map(len)


def _stacked(vectors: pd.Series, d: int, kind: type) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(kind).reshape(len(vectors), d)


class _Block:
    """The vectors of a block, indexed once for all queries that pass by."""

    def __init__(self, vectors: pd.DataFrame, k: int):
        self.vectors, self.k, self.made = vectors, k, {}
        self.sizes = _sizes(vectors) if len(vectors) else pd.Series([], dtype="int64")

    def _of(self, d: int):
        if d not in self.made:
            block = self.vectors[(self.sizes == d).to_numpy()]
            near, far = block[block["wide"].isna()], block[block["wide"].notna()]
            self.made[d] = (
                ImpactIndex(near["vec_id"].to_numpy(np.int64), _stacked(near["q"], d, np.int64)) if len(near) else None,
                Pairs(far["vec_id"].to_numpy(np.int64), _stacked(far["wide"], d, float)) if len(far) else None)
        return self.made[d]

    def search(self, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, part in queries.groupby(_sizes(queries)):
            index, beyond = self._of(d)
            pairs = Pairs(index.ids, index.vectors / SCALE) if index and part["wide"].notna().any() else None
            for query_id, twin, q, wide in zip(part["vec_id"], part["twin"], part["q"], part["wide"]):
                best = []
                if index and wide is None:
                    ids, scores = index.search(np.asarray(q, np.int64), query_id, self.k)
                    best += zip(scores.tolist(), ids.tolist())
                scaled = np.asarray(q, float) / SCALE if wide is None else np.asarray(wide, float)
                if pairs and wide is not None:
                    best += pairs.search(scaled, query_id, self.k)
                if beyond:
                    best += beyond.search(scaled, query_id, self.k)
                    best = sorted(best, key=lambda b: (-b[0], b[1]))[:self.k]
                out += [(query_id, twin, i, *_sortable(s)) for s, i in best]
        found = pd.DataFrame(out, columns=["query_id", "twin", "vec_id", "score", "side", "key"], dtype=object)
        return found.astype({"query_id": "int64", "twin": "int64", "vec_id": "int64", "score": "Int64",
                             "side": "int32"})


def _search_blocks(k: int):
    """Rows sorted by (v, u, asks): of each (v, u) first the vectors of block
    v, which are held, then the queries of run u, which stream by."""
    def run(batches):
        last, held, block = None, [], None
        for b in batches:
            key = b[["v", "u", "asks"]].to_numpy(np.int64)
            if not len(key):
                continue
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            at = [0, *cuts.tolist(), len(b)]
            for i, j in zip(at, at[1:]):
                if tuple(key[i, :2]) != last:
                    last, held, block = tuple(key[i, :2]), [], None
                if not key[i, 2]:
                    held.append(b.iloc[i:j])
                    continue
                if block is None:
                    block, held = _Block(pd.concat(held) if held else b.iloc[:0], k), []
                yield block.search(b.iloc[i:j])
    return run


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, q (the quantised vector) or wide (its SCALE-th part as doubles,
    if it is beyond the index's range), twin (its hash), each row once."""
    sound = F.forall(F.col("e"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    near = F.forall(F.col("e"), lambda x: F.abs(x) < INDEXED)
    # from 2**44 on a double has no bits below 1 / SCALE
    part = F.transform("e", lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * SCALE).cast("double") / SCALE).otherwise(x))
    return (vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
            .where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & sound)
            .select("vec_id", F.when(near, F.transform("e", lambda x: F.floor(x * SCALE).cast("int"))).alias("q"),
                    F.when(~near, part).alias("wide"))
            .distinct().withColumn("twin", F.xxhash64("q", "wide")))


def search(vectors: DataFrame, is_query, k: int, vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """The k best other vectors of every vector for which ``is_query`` (a
    condition on ``vec_id``) holds: query_id, rank, vec_id, score."""
    rows = quantised(vectors, vec_id, embedding)
    n, m = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    v_blocks, q_blocks = max(1, -(-n // VECTORS)), max(1, -(-m // QUERIES))
    block = F.xxhash64("vec_id", "twin")
    left = (rows.withColumn("v", F.pmod(block, F.lit(v_blocks)))
            .withColumn("u", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).withColumn("asks", F.lit(False)))
    right = (rows.where(is_query).withColumn("u", F.pmod(block, F.lit(q_blocks)).cast("int"))
             .withColumn("v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(v_blocks - 1).cast("long"))))
             .withColumn("asks", F.lit(True)))
    bound_batches(vectors.sparkSession)
    found = (left.unionByName(right).repartition("v", "u").sortWithinPartitions("v", "u", "asks")
             .mapInPandas(_search_blocks(k), "query_id long, twin long, vec_id long, score long, side int, key string"))
    place = Window.partitionBy("query_id", "twin").orderBy(
        F.desc("side"), F.desc("key"), F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
