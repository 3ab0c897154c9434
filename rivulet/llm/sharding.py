"""Sharding by best-fit-decreasing bin packing of indivisible groups.

All rows of a group (here: of equal texts) go to one shard. Groups, largest
first, enter the bin with the tightest remaining capacity that still holds
them, found in a balanced tree of the open bins.

``pack_counts`` uses as few bins of a fixed capacity as that rule needs;
``spread_counts`` looks for the least capacity with which a given number of
bins suffices, so the bins come out nearly equal. A group larger than an
even share cannot be cut: it gets a bin to itself and the rest is spread
evenly over the other bins.

Scale. One pass over the texts writes ids, sizes and digests. The plan is made
on the driver, on the exact histogram (size, number of groups): groups of one
size are alike, and best fit puts as many of them as it holds into the
tightest bin before it looks at the next, so they are packed in bulk, to the
same bins as one by one. Different sizes sum to no more than the data, so
there are at most the square root of twice its bytes (245,000 at 30 GB).
Groups are numbered within their size and joined with the plan; groups of
many rows (a thousandth of all or more, so at most 1,000) are sent to the
rows, the others joined by digest. Slots are numbered without a task per shard
(``common.gapless_rank``).

Defined results. Null text counts as empty. Repeated rows each get a slot.
"""

from __future__ import annotations

from collections import Counter
from random import Random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import digest, gapless_rank, save, small

ROW_OVERHEAD = 16   # bytes counted for a row besides its text
HOT_SHARE = 1000    # groups of a thousandth of the rows or more are broadcast
PLAN_ROWS = 500_000  # a longer plan is joined, not broadcast


class _Node:
    __slots__ = ("key", "weight", "left", "right")

    def __init__(self, key, weight):
        self.key, self.weight, self.left, self.right = key, weight, None, None


class BinTree:
    """Open bins ordered by (remaining capacity, bin): a treap, balanced by
    random weights (seeded, so that runs agree)."""

    def __init__(self):
        self._root, self._random = None, Random(0)

    def tightest(self, size: int):
        """The least (remaining, bin) with remaining >= size, or None."""
        node, best = self._root, None
        while node:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        return best

    def _split(self, node, key):
        if node is None:
            return None, None
        if node.key < key:
            node.right, high = self._split(node.right, key)
            return node, high
        low, node.left = self._split(node.left, key)
        return low, node

    def _join(self, low, high):
        if low is None or high is None:
            return low or high
        if low.weight > high.weight:
            low.right = self._join(low.right, high)
            return low
        high.left = self._join(low, high.left)
        return high

    def add(self, remaining: int, bin_: int) -> None:
        low, high = self._split(self._root, (remaining, bin_))
        new = _Node((remaining, bin_), self._random.random())
        self._root = self._join(self._join(low, new), high)

    def remove(self, remaining: int, bin_: int) -> None:
        low, rest = self._split(self._root, (remaining, bin_))
        _, high = self._split(rest, (remaining, bin_ + 1))
        self._root = self._join(low, high)


Run = tuple[int, int, int]  # size, bin, number of groups


def pack_counts(histogram: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[Run] | None:
    """Best fit of ``(size, number of groups)`` in falling order of size, as
    few bins as it needs; None as soon as more than ``most`` would be. A size
    beyond ``capacity`` is an error: it is indivisible."""
    tree, bins, out = BinTree(), 0, []
    for size, count in histogram:
        if size > capacity:
            raise ValueError(f"a group of {size} exceeds the capacity {capacity}")
        while count:
            fit = tree.tightest(size)
            if fit is None:
                if bins == most:
                    return None
                fit = (capacity, bins)
                bins += 1
            else:
                tree.remove(*fit)
            # with one more group this bin is the tightest still
            taken = min(count, fit[0] // size) if size else count
            tree.add(fit[0] - taken * size, fit[1])
            out.append((size, fit[1], taken))
            count -= taken
    return out


def spread_counts(histogram: list[tuple[int, int]], bins: int) -> list[Run]:
    """``(size, number of groups)``, in falling order of size, over the bins
    0 .. bins - 1, nearly even."""
    out: list[Run] = []
    left, rest = bins, sum(s * n for s, n in histogram)
    todo = list(reversed(histogram))
    while todo and left > 1 and todo[-1][0] * left > rest:
        # larger than an even share of what is left: alone
        size, count = todo.pop()
        out.append((size, bins - left, 1))
        left, rest = left - 1, rest - size
        if count > 1:
            todo.append((size, count - 1))
    if not todo:
        return out
    todo.reverse()
    first = bins - left
    low = max(-(-rest // left), todo[0][0])
    high, found = low, None
    while found is None:  # a capacity that suffices
        found = pack_counts(todo, high, left)
        low, high = (low, high) if found is not None else (high + 1, high + max(1, (high - low) * 2, high // 500))
    best, exact = found, max(1, rest // left // 2000)
    while high - low > exact:
        middle = (low + high) // 2
        found = pack_counts(todo, middle, left)
        if found is not None:
            best, high = found, middle
        else:
            low = middle + 1
    return out + [(s, first + b, n) for s, b, n in best]


def _histogram(sizes: list[int]) -> list[tuple[int, int]]:
    return sorted(Counter(sizes).items(), reverse=True)


def _one_by_one(runs: list[Run] | None) -> list[int] | None:
    return runs if runs is None else [b for _, b, n in runs for _ in range(n)]


def pack(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """``pack_counts`` of single sizes (falling order expected): their bins."""
    return _one_by_one(pack_counts(_histogram(sizes), capacity, most))


def pack_evenly(sizes: list[int], bins: int) -> list[int]:
    """``spread_counts`` of single sizes (falling order expected)."""
    return _one_by_one(spread_counts(_histogram(sizes), bins))


def shard(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = save(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"), digest(body).alias("digest")), "sharding-rows")
    groups = save(rows.groupBy("digest").agg(F.sum("size").alias("group_size"), F.count(F.lit(1)).alias("n_rows")),
                  "sharding-groups")
    # at most the square root of twice the bytes in all
    histogram = sorted(map(tuple, groups.groupBy("group_size").agg(F.count(F.lit(1))).collect()), reverse=True)
    plan, given = [], Counter()
    for size, bin_, n in spread_counts(histogram, shards):
        plan.append((size, given[size], given[size] + n, bin_))
        given[size] += n
    runs = save(spark.createDataFrame(plan, "planned_size long, since long, until long, shard int"), "sharding-plan")
    numbered = gapless_rank(groups, "group_size", ["digest"], "nth", least_parts=1)
    homes = save(numbered.join(small(runs, PLAN_ROWS), (F.col("group_size") == F.col("planned_size"))
                               & (F.col("nth") >= F.col("since")) & (F.col("nth") < F.col("until")))
                 .select("digest", "n_rows", "shard"), "sharding-homes")
    hot = F.col("n_rows") * HOT_SHARE >= rows.count()
    most = homes.where(hot).select("digest", F.col("shard").alias("hot_shard"))
    known = rows.join(F.broadcast(most), "digest", "left")
    columns = ["doc_id", "size", "text_crc32", "digest"]
    placed = save(known.where("hot_shard is not null").select(*columns, F.col("hot_shard").alias("shard")).unionAll(
        known.where("hot_shard is null").join(homes.where(~hot).select("digest", "shard"), "digest")
        .select(*columns, "shard")), "sharding-placed")
    return gapless_rank(placed, "shard", ["doc_id", "digest"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot")
