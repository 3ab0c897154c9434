"""Row-pattern matching over ordered rows (the two MATCH_RECOGNIZE forms
the reference uses), expressed as blocked neighbour scans and grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.operators.windows import micros
from rivulet.operators.sequence import BLK, DEFAULT_WIDTH, KEY, neighbour, prefix_sums, with_block


def followed_by(df: DataFrame, keys: str | Sequence[str], seq: str, ts: str,
                first: Column, then: Column, within: str, carry: Sequence[str],
                width: int = DEFAULT_WIDTH, at: Column | None = None, exclusive: bool = False) -> DataFrame:
    """Pattern ``(A B)`` with strict adjacency: an A row whose very next
    row of the same key is a B row, less than ``within`` later. Returns the
    A rows plus ``next_<c>`` for each ``carry`` column of the B row.
    Matches do not overlap: the scan goes on after the B row, so of rows
    that are A and B at once every other one starts a match. ``exclusive``
    says that no row is both, which saves looking for such chains; a row that
    is both then fails the query."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    flagged = df.withColumn("_a", first).withColumn("_b", then)
    if exclusive:
        flagged = flagged.withColumn("_b", F.when(F.col("_a") & F.col("_b"), F.raise_error(
            F.lit("a row is A and B of an exclusive pattern")).cast("boolean")).otherwise(F.col("_b")))
    cols = list(dict.fromkeys([ts, seq, "_a", "_b", *carry]))
    nb = neighbour(flagged, ks, seq, cols, "next", "_n", width, at)
    hits = nb.where(F.col("_a") & F.col("_n._b") &
                    (F.col(f"_n.{ts}") < F.col(ts) + F.expr(f"INTERVAL {within}")))
    if exclusive:
        return _with_next(hits, carry)
    # a match can only meet another one through a row that is both A and B
    linked = F.coalesce(F.col("_b"), F.lit(False)) | F.coalesce(F.col("_n._a"), F.lit(False))
    alone = hits.where(~linked)
    chains = (hits.where(linked).withColumn("_to", F.col(f"_n.{seq}")))
    prev = neighbour(chains, ks, seq, ["_to"], "prev", "_p", width, at)
    starts = (~F.coalesce(F.col("_p._to") == F.col(seq), F.lit(False))).cast("long")
    numbered = prefix_sums(prev.withColumn("_start", starts), ks, seq,
                           {"_chain": F.col("_start"), "_rn": F.lit(1).cast("long")}, width, at=at)
    firsts = numbered.where("_start = 1").select(F.struct(*ks).alias("_ck"), F.col("_chain").alias("_cc"),
                                                 F.col("_rn").alias("_from"))
    every_other = numbered.join(firsts, (F.struct(*[numbered[k] for k in ks]) == firsts["_ck"])
                                & (numbered["_chain"] == firsts["_cc"])) \
        .where((F.col("_rn") - F.col("_from")) % 2 == 0)
    return _with_next(alone.unionByName(every_other.select(*alone.columns)), carry)


def _with_next(hits: DataFrame, carry: Sequence[str]) -> DataFrame:
    for c in carry:
        hits = hits.withColumn(f"next_{c}", F.col(f"_n.{c}"))
    return hits.drop("_a", "_b", "_n")


def followed_by_in_time(df: DataFrame, ts: str, tie: str, first: Column, then: Column, within: str,
                        carry: Sequence[str], block_seconds: int = 3600, exclusive: bool = False) -> DataFrame:
    """Pattern ``(A B)`` over all rows in order of ``ts`` (``tie`` orders
    equal times). Time is cut into blocks that are ordered in parallel; only
    the first row of each block crosses them. Rows without a time take no
    part."""
    timed = df.where(F.col(ts).isNotNull()).withColumn("_all", F.lit(0)) \
        .withColumn("_at", F.struct(ts, tie))
    out = followed_by(timed, "_all", "_at", ts, first, then, within, carry,
                      block_seconds * 1_000_000, at=micros(timed, ts), exclusive=exclusive)
    return out.drop("_all", "_at")


def start_then_run(df: DataFrame, keys: str | Sequence[str], seq: str, is_a: Column,
                   start_cols: Sequence[str], width: int = DEFAULT_WIDTH) -> DataFrame:
    """Pattern ``(STRT A+)``, greedy, skip past last row, per key.

    Every maximal run of A rows yields one match whose STRT is the row just
    before the run; a run that opens the key has no such row, so its first
    A row serves as STRT and the match needs at least two rows. Output:
    keys, ``start_<c>`` for ``start_cols`` of the STRT row, ``last_a`` (the
    ``seq`` of the run's last row) and ``run_length`` (A rows matched).

    Blocked as :func:`rivulet.operators.windows.sessions`: the previous row
    and the run openings inside each block, a block summary, a carry across
    the key's blocks, then the run number; A rows are grouped by run.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    kb = [KEY, BLK]
    cols = list(dict.fromkeys(["_isa", *start_cols]))
    b = with_block(df.withColumn("_isa", F.coalesce(is_a.cast("boolean"), F.lit(False))), ks, seq, width)
    payload = F.struct(*[F.col(c) for c in cols])
    inblock = Window.partitionBy(*kb).orderBy(seq)
    lagged = F.lag(payload).over(inblock)
    rows = b.withColumn("_p", lagged).withColumn(
        "_o", (F.col("_p").isNotNull() & F.col("_isa") & ~F.col("_p._isa")).cast("long"))
    summary = rows.groupBy(*kb).agg(F.min_by("_isa", seq).alias("_first_a"),
                                    F.max_by(payload, F.col(seq)).alias("_last"),
                                    F.sum("_o").alias("_inside"))
    per_key = Window.partitionBy(KEY).orderBy(BLK)
    prev_last = F.lag("_last").over(per_key)
    first_opens = (F.col("_first_a") & (prev_last.isNull() | ~prev_last["_isa"])).cast("long")
    opened = (summary.withColumn("_carry", prev_last).withColumn("_fo", first_opens)
              .withColumn("_n", F.col("_inside") + F.col("_fo")))
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    carry = opened.select(*kb, "_carry",
                          (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.col("_fo")).alias("_base"))
    runs = (rows.join(carry, kb)
            .withColumn("_p", F.coalesce("_p", F.col("_carry")))
            .withColumn("_run", F.col("_base") + F.sum("_o").over(
                inblock.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("_isa")))
    first = F.min_by(F.struct(F.col("_p").alias("p"), *[F.col(c) for c in start_cols]), F.col(seq))
    g = runs.groupBy(*ks, "_run").agg(first.alias("_f"), F.max(seq).alias("last_a"),
                                      F.count(F.lit(1)).alias("_len"))
    at_key_start = F.col("_f.p").isNull()
    out = g.where(~at_key_start | (F.col("_len") >= 2))
    sel = [F.when(at_key_start, F.col(f"_f.{c}")).otherwise(F.col(f"_f.p.{c}")).alias(f"start_{c}")
           for c in start_cols]
    return out.select(*ks, *sel, "last_a",
                      (F.col("_len") - at_key_start.cast("long")).alias("run_length"))
