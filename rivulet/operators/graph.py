"""Iterative graph algorithms as driver loops of DataFrame supersteps.

Each superstep is declarative (joins, grouped min / sum); the driver only
decides whether to continue, from one ``isEmpty`` / aggregate per step.
Loop state is written with reliable ``checkpoint()`` into the session's
checkpoint folder, which cuts the lineage and survives executor loss; Spark
removes the files of a step once nothing refers to it. Joins and groupings
are left to Spark's planning, which splits the partitions of hub vertices.
"""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import checkpoint_dir


def _ckpt(df: DataFrame) -> DataFrame:
    return _ckpt_count(df)[0]


def _ckpt_count(df: DataFrame) -> tuple[DataFrame, int]:
    """Reliable checkpoint without computing the plan twice: the rows are
    persisted (and counted, which the loops use as their stop test) while
    the checkpoint files are written, then released."""
    checkpoint_dir(df.sparkSession)
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    n = kept.count()
    out = kept.checkpoint(eager=True)
    kept.unpersist()
    return out, n


def undirected(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Each edge plus its inverse."""
    return edges.select(F.inline(F.array(
        F.struct(F.col(src).alias("src"), F.col(dst).alias("dst")),
        F.struct(F.col(dst).alias("src"), F.col(src).alias("dst")))))


def connected_components(vertices: DataFrame, edges: DataFrame, max_iter: int | None = None,
                         vid: str = "id") -> tuple[DataFrame, int]:
    """``(vertex, component)``, the least vertex connected to each vertex, and
    the number of rounds run; ``max_iter=None`` runs to convergence.

    Star contraction: in a round every vertex links its larger neighbours to
    the least vertex it knows (large star), then itself and its smaller
    neighbours to the least of those (small star). The edges turn into stars
    around the least vertices in a number of rounds that grows with the
    logarithm of the component's size, not with its diameter. A round is two
    grouped minima and their joins over the edges left; there is no join
    with all vertices before the end.
    """
    links = _ckpt(edges.where(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    steps, before = 0, None
    while max_iter is None or steps < max_iter:
        both = undirected(links, "u", "v").select(F.col("src").alias("u"), F.col("dst").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("u"), F.min("v")).alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        links = _ckpt(large.join(least, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))))
            .where(F.col("u") != F.col("v")).distinct())
        steps += 1
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = links.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("root"))
    return (vertices.select(F.col(vid).alias("vertex")).join(roots, "vertex", "left")
            .select("vertex", F.coalesce("root", "vertex").alias("component"))), steps


def transitive_closure(edges: DataFrame, max_iter: int | None = None) -> tuple[DataFrame, int]:
    """All pairs ``(src, dst)`` joined by a directed path.

    Path doubling over shortest lengths: after round k the known paths P
    hold every pair whose shortest path has at most 2^k edges, with that
    length, and X holds the pairs at exactly 2^k. A pair at shortest length
    L in (2^k, 2^(k+1)] splits at the node 2^k steps along a shortest path
    into an X pair and a P pair, so ``X . P`` (lengths added, minimum per
    pair, known pairs removed) yields exactly the next round's new pairs.
    Only exact-2^k prefixes are extended, so each new pair is derived
    through one split point per shortest path instead of up to 2^(k-1) of
    them. Rounds: ceil(log2 of the longest shortest path) + 1. Stops when
    no pair sits at exactly 2^(k+1): a longer shortest path would have a
    prefix of that length.

    ``max_iter`` counts supersteps that each lengthen paths by one edge: the
    pairs joined by at most ``max_iter + 1`` edges are returned, with the
    number of doubling rounds run.
    """
    longest = None if max_iter is None else max_iter + 1
    first = _ckpt(edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
                  .select("src", "dst").distinct()
                  .withColumn("len", F.lit(1).cast("long")))
    pieces = [first]
    exact = first
    span = 1
    steps = 0
    while longest is None or span < longest:
        paths = reduce(DataFrame.union, pieces)
        x = exact.select(F.col("src").alias("a"), F.col("dst").alias("m"))
        p = paths.select(F.col("src").alias("m"), F.col("dst").alias("b"), F.col("len").alias("l"))
        # new pairs and known ones in one grouping: a known pair's least
        # length is at most span, and every candidate's is longer
        cand = x.join(p, "m").select(F.col("a").alias("src"), F.col("b").alias("dst"),
                                     (F.col("l") + span).alias("len"))
        if longest is not None:
            cand = cand.where(F.col("len") <= longest)
        fresh, found = _ckpt_count(cand.unionByName(paths).groupBy("src", "dst")
                                   .agg(F.min("len").alias("len")).where(F.col("len") > span))
        steps += 1
        if found == 0:
            break
        pieces.append(fresh)
        span *= 2
        exact = fresh.where(F.col("len") == span)
        if exact.isEmpty():
            break
    return reduce(DataFrame.union, pieces).select("src", "dst"), steps


def triangles(edges: DataFrame) -> DataFrame:
    """Triangles ``(v1, v2, v3)`` with ``v1 < v2 < v3`` of an undirected
    graph (self-loops and duplicate edges ignored).

    Each edge is oriented from its endpoint of lower (degree, id) rank to
    the higher one. Every triangle is then found exactly once as two
    out-edges of its lowest-ranked vertex closed by a third edge, and no
    vertex has more than sqrt(2m) out-edges, so the wedge join stays
    O(m^1.5) even around hub vertices.
    """
    canon = (edges.where(F.col("src") != F.col("dst"))
             .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
             .distinct())
    deg = (canon.select(F.explode(F.array("a", "b")).alias("v"))
           .groupBy("v").agg(F.count(F.lit(1)).alias("deg")))
    ranked = (canon.join(deg.withColumnRenamed("v", "a").withColumnRenamed("deg", "da"), "a")
              .join(deg.withColumnRenamed("v", "b").withColumnRenamed("deg", "db"), "b"))
    a_first = F.struct("da", "a") < F.struct("db", "b")
    oriented = ranked.select(F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("u"),
                             F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("w"),
                             F.when(a_first, F.col("db")).otherwise(F.col("da")).alias("dw"))
    o1, o2 = oriented.alias("o1"), oriented.alias("o2")
    wedges = o1.join(o2, (F.col("o1.u") == F.col("o2.u")) &
                     (F.struct("o1.dw", "o1.w") < F.struct("o2.dw", "o2.w"))) \
        .select(F.col("o1.u").alias("u"), F.col("o1.w").alias("x"), F.col("o2.w").alias("y"))
    closing = oriented.select(F.col("u").alias("x"), F.col("w").alias("y"))
    tri = wedges.join(closing, ["x", "y"])
    vs = F.array_sort(F.array("u", "x", "y"))
    return tri.select(vs[0].alias("v1"), vs[1].alias("v2"), vs[2].alias("v3"))


def pagerank(pages: DataFrame, links: DataFrame, num_pages: int, damping: float = 0.85,
             max_iter: int = 10, epsilon: float = 1e-4, vid: str = "id") -> tuple[DataFrame, int]:
    """Bulk-iteration PageRank with the reference's rules: start at
    ``1/num_pages``; each page splits its rank evenly over its out-links
    (duplicate links count twice); new rank = ``sum * damping +
    (1 - damping) / num_pages``; pages that receive nothing drop out;
    stop after ``max_iter`` steps or when no page that is in both the old
    and new ranks moved by more than ``epsilon``.

    Out-link weights replace the adjacency list: each link carries
    ``1 / out_degree`` of its source, so a hub never becomes one array.
    """
    deg = links.groupBy("src").agg(F.count(F.lit(1)).alias("_deg"))
    wlinks = _ckpt(links.join(deg, "src").select("src", "dst", "_deg"))
    jump = (1 - damping) / num_pages
    ranks = _ckpt(pages.select(F.col(vid).alias("id"), F.lit(1.0 / num_pages).alias("rank")))
    steps = 0
    while steps < max_iter:
        contrib = (ranks.join(wlinks, ranks.id == wlinks.src)
                   .select(F.col("dst").alias("id"), (F.col("rank") / F.col("_deg")).alias("c")))
        new = _ckpt(contrib.groupBy("id").agg((F.sum("c") * damping + F.lit(jump)).alias("rank")))
        steps += 1
        moved = new.alias("n").join(ranks.alias("o"), "id") \
            .where(F.abs(F.col("n.rank") - F.col("o.rank")) > epsilon)
        ranks = new
        if moved.isEmpty():
            break
    return ranks, steps
