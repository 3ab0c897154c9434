"""SimHash near-duplicates by anchor-point covering.

Fingerprint. A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of 4
words joined by a space (fewer words: the whole sequence; none: fingerprint
zero), repeats included. Bit b is 1 if it is set in over half of the
shingles' XXH64 hashes (UTF-8, seed 42).

Two fingerprints are linked if at most 4 bits differ. The 64 bits are cut
into 3 parts (21, 21, 22 bits): of 4 differing bits at most 1 falls into some
part. In each part the anchors are the words of a covering code, Hamming
(15, 11) on the first 15 bits and every value on the rest, with covering
radius 1. A fingerprint's *home* is its nearest anchor (at most 1 bit away);
it is replicated to every anchor within 1 + 1 = 2 bits (14.5 on average). If
x and y differ in at most one bit of the part, y is within two bits of x's
home, so comparing each anchor's home members with all its members on the
full 64 bits loses no link.

Scale. Equal fingerprints are collapsed first, so groups of copies cost one
row. Members of an anchor meet in a sorted partition that is streamed, anchor
by anchor. Per anchor only links that merge two of its groups are emitted, a
spanning forest instead of all pairs. An anchor that is home to more than
``HOME_BLOCK`` fingerprints or has more than ``MEMBER_BLOCK`` members is split
both ways: a task gets one block of its home members and one of all members,
so none holds more than these two, and every pair meets in one task. With N distinct
fingerprints the anchors see about N * N * 3.3e-4 comparisons of two longs;
larger codes (``code_bits``) trade copies for comparisons.

Components: large-star / small-star rounds on the links, each round written
to the shared folder; rounds grow with the logarithm of the longest path.

Defined results. Null text counts as empty: fingerprint zero, linked like any
other. A null doc_id is never a component's id unless the component has no
other. Repeated rows each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, fresh, save

SHINGLE = 4
MAX_BITS = 4
SEED = 42
PARTS = ((0, 21), (21, 21), (42, 22))  # (first bit, bits)
HOME_BLOCK = 4096
MEMBER_BLOCK = 65_536
_BITS_CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, unsigned."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()  # bytes: ASCII rules only
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    hashed = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for i in range(0, n, _BITS_CHUNK):
        h = np.array([hashed(joined[a:b], SEED) for a, b in
                      zip(starts[i:i + _BITS_CHUNK], stops[i:i + _BITS_CHUNK])], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                               bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as signed longs (same 64 bits)."""
    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        fps = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(fps.view(np.int64))
    return of(text)


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


class Code:
    """A covering code on ``bits`` bits: Hamming words on the first
    ``2**r - 1`` of them, every value on the rest; covering radius 1.

    ``patterns[s]`` holds, for syndrome s, the XOR masks that lead from a
    point to every code word within ``reach`` bits (padded with -1);
    ``leader[s]`` leads to the nearest one."""

    def __init__(self, bits: int, reach: int, code_bits: int = 15):
        self.columns = [i + 1 if i < code_bits else 0 for i in range(bits)]
        by: dict[int, list[int]] = {s: [] for s in range(code_bits + 1)}
        for weight in range(reach + 1):
            for at in combinations(range(bits), weight):
                s = mask = 0
                for i in at:
                    s ^= self.columns[i]
                    mask |= 1 << i
                by[s].append(mask)
        most = max(map(len, by.values()))
        self.patterns = np.array([by[s] + [-1] * (most - len(by[s])) for s in sorted(by)], np.int64)
        self.leader = self.patterns[:, 0].copy()  # lightest mask comes first

    def syndrome(self, x: np.ndarray) -> np.ndarray:
        s = np.zeros(len(x), np.int64)
        for i, c in enumerate(self.columns):
            if c:
                s ^= ((x >> i) & 1) * c
        return s

    def home(self, x: np.ndarray) -> np.ndarray:
        return x ^ self.leader[self.syndrome(x)]


def _codes() -> list[Code]:
    return [Code(bits, 2) for _, bits in PARTS]


def _part(fp: np.ndarray, k: int) -> np.ndarray:
    first, bits = PARTS[k]
    return ((fp.view(np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _key(k: int, anchor: np.ndarray) -> np.ndarray:
    return anchor * len(PARTS) + k


def _replicas(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    codes = _codes()
    for b in batches:
        fp = b["fp"].to_numpy(np.int64)
        for k, c in enumerate(codes):
            x = _part(fp, k)
            masks = c.patterns[c.syndrome(x)]
            rows, cols = np.nonzero(masks >= 0)
            anchor = x[rows] ^ masks[rows, cols]
            yield pd.DataFrame({"anchor": _key(k, anchor), "fp": fp[rows], "home": anchor == c.home(x)[rows]})


def _forest(fps: np.ndarray, homes: np.ndarray, max_bits: int):
    """Links (a, b) that join the groups of linked members of one anchor:
    each home member is compared with all members."""
    group = np.arange(len(fps))
    for h in homes:
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[h]) <= max_bits)
        if len(near) < 2:
            continue
        met, first = np.unique(group[near], return_index=True)
        if len(met) < 2:
            continue
        joined = near[first]
        for other in joined:
            if other != h:
                yield fps[h], fps[other]
        group[np.isin(group, met)] = met[0]


def _links_of(max_bits: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def anchor_links(fps: np.ndarray, asks: np.ndarray):
            # sorted; a fingerprint may be there as a home and as a member
            own = np.unique(fps[asks])
            fps = np.unique(fps)
            return _forest(fps, np.searchsorted(fps, own), max_bits)

        out: list[tuple[int, int]] = []
        last, held = None, []
        for b in batches:
            key = b[["anchor", "home_block", "member_block"]].to_numpy(np.int64)
            asks = b["asks"].to_numpy(bool)
            fp = b["fp"].to_numpy(np.int64).view(np.uint64)
            if not len(fp):
                continue
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            at = [0, *cuts.tolist(), len(fp)]
            for i, j in zip(at, at[1:]):
                this = tuple(key[i].tolist())
                if last is not None and this != last:
                    out.extend(anchor_links(*map(np.concatenate, zip(*held))))
                    held = []
                last = this
                held.append((fp[i:j], asks[i:j]))
            if len(out) >= 10_000:
                yield _frame(out)
                out = []
        if held:
            out.extend(anchor_links(*map(np.concatenate, zip(*held))))
        if out:
            yield _frame(out)
    return links


def _frame(pairs) -> pd.DataFrame:
    a = np.array(pairs, np.uint64).view(np.int64)
    return pd.DataFrame({"a": a[:, 0], "b": a[:, 1]})


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fps(fp)``: enough of
    them that linked fingerprints stay connected. ``fps`` must be a saved
    table or cheap: it is read twice."""
    if max_bits >= 2 * len(PARTS):
        raise ValueError(f"{max_bits} differing bits need more than {len(PARTS)} parts")
    replicas = fps.mapInPandas(_replicas, "anchor long, fp long, home boolean")
    crowded = save(replicas.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count("fp").alias("members"))
                   .where((F.col("homes") > HOME_BLOCK) | (F.col("members") > MEMBER_BLOCK))
                   .select("anchor", F.greatest(F.ceil(F.col("homes") / HOME_BLOCK), F.lit(1)).cast("int").alias("rows"),
                           F.ceil(F.col("members") / MEMBER_BLOCK).cast("int").alias("columns")), "simhash-crowded")
    # block (i, j) of an anchor compares homes i with members j: a fingerprint
    # goes to its column as a member and, if at home, to its row as a home
    one, own = F.lit(1), F.col("home")
    row, column = F.pmod(F.xxhash64("fp"), F.col("rows")).cast("int"), F.pmod(F.hash("fp"), F.col("columns")).cast("int")
    as_member = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.struct(
        i.alias("home_block"), column.alias("member_block"), (own & (i == row)).alias("asks")))
    as_home = F.transform(F.filter(F.sequence(F.lit(0), F.col("columns") - 1), lambda j: own & (j != column)),
                          lambda j: F.struct(row.alias("home_block"), j.alias("member_block"), F.lit(True).alias("asks")))
    members = (replicas.join(crowded, "anchor", "left")
               .withColumn("rows", F.coalesce("rows", one)).withColumn("columns", F.coalesce("columns", one))
               .select("anchor", "fp", F.explode(F.concat(as_member, as_home)).alias("at"))
               .select("anchor", "at.*", "fp"))
    return (members.repartition("anchor", "home_block", "member_block")
            .sortWithinPartitions("anchor", "home_block", "member_block")
            .mapInPandas(_links_of(max_bits), "a long, b long"))


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the links ``pairs(a, b)``; root is the
    least node connected to it. Large-star / small-star contraction."""
    edges = save(pairs.where("a != b").select(F.greatest("a", "b").alias("u"),
                                              F.least("a", "b").alias("v")).distinct(),
                 "simhash-edges")
    before = None
    while True:
        # large star: every larger neighbour of u links to u's least neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: u and its smaller neighbours link to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = save(large.join(least, "u")
                     .select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                              F.struct(F.col("u").alias("u"), F.col("m").alias("v")))))
                     .where("u != v").distinct(), "simhash-edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """Per document row: doc_id, fingerprint (16 hex digits), component_id
    (the least doc_id reachable through linked fingerprints), root (the least
    fingerprint of the component) and key (``xxhash64`` of the text: with
    doc_id it names a row up to copies)."""
    bound_batches(docs.sparkSession)
    rows = save(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("key"),
                            fingerprint_column(F.col(text), shingle).alias("fp")), "simhash-rows")
    each = save(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = components(links(each.select("fp"), max_bits))
    linked = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    member = linked.join(each, linked["node"] == each["fp"]).select("node", "root", "least")
    found = (member.join(member.groupBy("root").agg(F.min("least").alias("component_id")), "root")
             .select(F.col("node").alias("fp"), "root", "component_id"))
    ids = save(each.join(found, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.coalesce("component_id", "least").alias("component_id")), "simhash-ids")
    return rows.join(ids, "fp").select("doc_id", fingerprint_hex(F.col("fp")).alias("fingerprint"),
                                       "component_id", "root", "key")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per component stays, all columns kept: the one
    with the least doc_id (null only if it has no other); of several rows
    with that id, one of the text whose hash is least."""
    rows = near_duplicates(docs, doc_id, text)
    kept = save(rows.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("kept"))
        .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.key").alias("kept_key")),
        "simhash-kept")
    return _keep(docs, rows, kept, doc_id, text)


def _keep(docs: DataFrame, rows: DataFrame, kept: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` named by ``kept(kept_id, kept_key)``, one each."""
    named = docs.join(
        kept, docs[doc_id].eqNullSafe(kept["kept_id"])
        & (F.xxhash64(docs[text]) == kept["kept_key"]), "left_semi")
    twice = save(rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"])
                           & (rows["key"] == kept["kept_key"]), "left_semi")
                 .groupBy("doc_id", "key").count().where("count > 1")
                 .select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key")),
                 "simhash-twice")
    if twice.isEmpty():
        return named
    # copies of a whole row: a row cannot be told from its copy, so one of
    # each (doc_id, text) is taken; only those rows are shuffled by it
    match = (docs[doc_id].eqNullSafe(twice["kept_id"])
             & (F.xxhash64(docs[text]) == twice["kept_key"]))
    key = fresh(docs.columns, "row_key")
    again = (docs.join(kept, docs[doc_id].eqNullSafe(kept["kept_id"])
                       & (F.xxhash64(docs[text]) == kept["kept_key"]), "left_semi")
             .join(twice, match, "left_semi")
             .withColumn(key, F.xxhash64(docs[text])).dropDuplicates([doc_id, key]).drop(key))
    return named.join(twice, match, "left_anti").unionByName(again)
