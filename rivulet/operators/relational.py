"""Relational batch operators: the TPC-H style queries, the web-log query,
blank-field profiling, word count, grouped filters and record-pair joins."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rivulet.functions.text import is_blank, nonword_tokens


def _day(d: str | dt.date) -> Column:
    """Midnight of a calendar day as a TIMESTAMP_NTZ literal (folds to a
    constant, so comparisons against it push down to the parquet scan)."""
    return F.lit(str(d)).cast("timestamp_ntz")


def revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    return F.col(price) * (F.lit(1) - F.col(discount))


def shipping_priority(lineitem: DataFrame, customer: DataFrame, orders: DataFrame,
                      segment: str = "AUTOMOBILE", date: str = "1995-03-12",
                      group_extra: Sequence[str] = ()) -> DataFrame:
    """Unsorted revenue per open order of one market segment.

    Customers of ``segment`` -> their orders placed strictly before
    ``date`` -> line items shipped strictly after ``date``; revenue summed
    per (orderkey, orderdate, *group_extra). Filters sit on the scans, the
    joins are equi-joins planned by AQE (broadcast only when the runtime
    size is under the threshold).
    """
    cust = customer.where(F.col("c_mktsegment") == segment).select("c_custkey")
    ords = (orders.where(F.col("o_orderdate") < _day(date))
            .select("o_orderkey", "o_custkey", "o_orderdate", *group_extra))
    items = (lineitem.where(F.col("l_shipdate") > _day(date))
             .select("l_orderkey", revenue().alias("_rev")))
    co = cust.join(ords, cust.c_custkey == ords.o_custkey).drop("c_custkey", "o_custkey")
    joined = co.join(items, co.o_orderkey == items.l_orderkey)
    return (joined.groupBy("l_orderkey", "o_orderdate", *group_extra)
            .agg(F.round(F.sum("_rev"), 4).alias("revenue")))


def returned_item_revenue(customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                          nation: DataFrame, after_year: int = 1990,
                          customer_cols: Sequence[str] = ("c_name",)) -> DataFrame:
    """Revenue lost to returned items per customer, with nation name.

    Revenue is summed per customer *before* the join with the customer
    table (eager aggregation keeps that join at one row per customer). The
    year test is written as a date bound, which reaches the scan; the small
    nation side is left to Spark, which broadcasts by measured size.
    """
    ords = (orders.where(F.col("o_orderdate") >= _day(dt.date(after_year + 1, 1, 1)))
            .select("o_orderkey", "o_custkey"))
    items = (lineitem.where(F.col("l_returnflag") == "R")
             .select("l_orderkey", revenue().alias("_rev")))
    per_cust = (ords.join(items, ords.o_orderkey == items.l_orderkey)
                .groupBy("o_custkey").agg(F.sum("_rev").alias("_rev")))
    nat = nation.select("n_nationkey", "n_name")
    cust = (customer.select("c_custkey", *customer_cols, "c_nationkey", "c_acctbal")
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .drop("c_nationkey", "n_nationkey"))
    return (cust.join(per_cust, cust.c_custkey == per_cust.o_custkey)
            .select("c_custkey", *customer_cols, "n_name", "c_acctbal",
                    F.round("_rev", 4).alias("revenue")))


def weblog_analysis(documents: DataFrame, ranks: DataFrame, visits: DataFrame,
                    keywords: Sequence[str], min_rank: int, key: str = "url",
                    text: str = "contents", rank: str = "rank",
                    rank_cols: Sequence[str] = ()) -> DataFrame:
    """Ranks of documents that contain every keyword, have rank above
    ``min_rank`` and were not visited (``visits`` already filtered).

    Keyword test is a case-sensitive AND of substring tests; the "not
    visited" step is a left-anti join, so left duplicates are kept.
    """
    cond = F.lit(True)
    for k in keywords:
        cond = cond & F.col(text).contains(k)
    docs = documents.where(cond).select(F.col(key).alias("_k"))
    rk = ranks.where(F.col(rank) > min_rank).select(rank, key, *rank_cols)
    hits = rk.join(docs, rk[key] == docs["_k"]).drop("_k")
    return hits.join(visits.select(key), key, "left_anti")


def blank_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[is_blank(c).alias(c) for c in cols])


def rows_without_blanks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows whose every listed field is non-blank."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~is_blank(c)
    return df.where(cond)


def blank_counts(df: DataFrame, cols: Sequence[str], prefix: str = "blank_") -> DataFrame:
    """One row: number of blank values per column (a single aggregate
    with partial sums on every task, the accumulator of the reference)."""
    return df.agg(*[F.sum(is_blank(c).cast("long")).alias(f"{prefix}{c}") for c in cols])


def observed_blanks(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``df`` with in-flight counters: when an action has run over the result,
    the observation holds ``rows`` and ``blanks``, a vector of the blank
    values per column, counted in that action's own pass."""
    seen = Observation()
    blanks = F.array(*[F.coalesce(F.sum(is_blank(c).cast("long")), F.lit(0)) for c in cols])
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), blanks.alias("blanks")), seen


def word_count(lines: DataFrame, text: str = "line") -> DataFrame:
    """Lower-case, split on non-word runs, drop empties, count per word.
    The count is a partial (map-side) aggregate, so hot words never meet
    in one task before being pre-summed."""
    words = lines.select(F.explode(nonword_tokens(text)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def group_reduce(df: DataFrame, keys: Sequence[str], value: str, fn, zero: Column | None = None) -> DataFrame:
    """Reduce ``value`` per key with ``fn(accumulated, next) -> Column``, an
    associative and commutative function of two columns of the value's type.

    A tree of groupings, so that no group is gathered whole: runs of 8,192
    rows of a key, then 8,192 of their results, then one per input partition,
    then one per key. Nulls are skipped, and a key with only nulls gets
    ``zero`` (null if not given)."""
    kind = dict(df.dtypes)[value]

    def reduced(column: str) -> Column:
        items = F.collect_list(column)
        return F.when(F.size(items) > 0, F.aggregate(
            F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0))), F.get(items, F.lit(0)),
            lambda acc, x: fn(acc, x).cast(kind)))

    out = df.select(*keys, value).withColumn("_run", F.monotonically_increasing_id())
    for bits in (13, 13, 7):  # an id holds 33 bits of row, the rest is the partition
        out = (out.groupBy(*keys, F.shiftright("_run", bits).alias("_run"))
               .agg(reduced(value).alias(value)))
    out = out.groupBy(*keys).agg(reduced(value).alias(value))
    return out if zero is None else out.withColumn(value, F.coalesce(F.col(value), zero.cast(kind)))


def group_sum_having(df: DataFrame, key: str, value: Column | str,
                     alias: str, keep: Column) -> DataFrame:
    """``groupBy(key).sum(value)`` then a filter on the sum."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(key).agg(F.sum(v).alias(alias)).where(keep)


def record_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                 left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Join two record sets and emit (left record, right record) pairs as
    two struct columns."""
    l = left.select(F.col(left_key).alias("_lk"), F.struct(*left.columns).alias(left_name))
    r = right.select(F.col(right_key).alias("_rk"), F.struct(*right.columns).alias(right_name))
    return l.join(r, l._lk == r._rk).select(left_name, right_name)


def predicate_share(df: DataFrame, predicate: Column, scale: float = 1.0) -> DataFrame:
    """Hits, total and ``scale * hits / total`` for a row predicate."""
    return df.agg(F.sum(predicate.cast("long")).alias("hits"),
                  F.count(F.lit(1)).alias("total")) \
             .withColumn("share", F.lit(scale) * F.col("hits") / F.col("total"))
