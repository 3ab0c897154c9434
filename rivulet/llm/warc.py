"""WARC archives: write, and read back with boundary-chain verification.

Writing. One record per row: ``response`` with an HTTP block around the
payload, or ``revisit`` (header only) for a payload of at least 1000 bytes
that another record of the archive holds in full: of equal payloads the one
with the largest id is the response. Spark's text writer lays the records
out, with the four bytes that end a record as its line separator, so tasks
commit whole files and a lost task leaves nothing behind.

Reading. The files are split by Spark at the record magic, ``WARC/1.0``,
which may also occur inside a payload. Each task lists its *candidates*, the
places where the magic stands, and where a record starting there would end.
A candidate's offset in its file is the length of what the tasks before it
read. From the start of the file the chain candidate -> successor is followed
by pointer jumping: every candidate learns its 2nd, 4th, 8th ... successor
while the set of reached ones doubles along, so a file of n records takes
log2(n) rounds. A task first follows the chain inside its own split, so the
rounds are over splits, not records. Only reached candidates are records;
magic inside a payload is never reached, whatever follows it.

A record whose payload holds no magic lies in one piece and is digested where
it is read. The others are put together from their pieces in a second read
that picks out those pieces only.

Scale. Payloads are not shuffled for writing unless the table of repeated
payloads is too large to broadcast by the session's threshold, nor for
reading, except for pieces of records that hold magic. Per split and per file
only offsets are gathered. Files are as large as the writing tasks make them;
reading splits them by bytes.

Defined results. Null html is an empty payload; a null url leaves out the
target; a null id gives a record without a page id, which cannot be referred
to. Rows that repeat the largest id of equal payloads are all responses.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.llm.common import bound_batches, save, shared_path

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# -- writing ----------------------------------------------------------------

def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            date: str = DATE) -> DataFrame:
    """One column, ``value``: the record of each row without its final END."""
    body = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        body.alias("body"), F.sha1(body).alias("digest"),
                        F.octet_length(body).alias("bytes"))
    kept = save(rows.where(F.col("bytes") >= LEAST_BYTES).select("digest", "page_id")
                .groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
                .where("n > 1 and kept is not null").select("digest", "kept"), "warc-kept")
    rows = rows.join(kept, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    # a line break or other control character in a url would end its header
    target = F.regexp_replace(F.col("url"), r"[\x00-\x20\x7F]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    head = F.concat(
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:none>"))),
        _line("WARC-Date", F.lit(date)),
        F.coalesce(_line("WARC-Target-URI", target), F.lit("")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_line("WARC-Refers-To", urn(F.col("kept"))),
                                 _line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")))
    return rows.select(F.concat(F.lit(MAGIC), head, F.lit("\r\n"), block).alias("value"))


def write(pages: DataFrame, path: str, **names) -> None:
    """Write ``pages`` as WARC files below ``path``."""
    records(pages, **names).write.option("lineSep", END).text(path)


# -- reading ----------------------------------------------------------------

_HEADER = re.compile(rb"([!-9;-~]+):[ \t]*([^\r\n]*)\r\n")


def parse_header(chunk: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """Header fields (names in lower case) after the magic and the bytes they
    take with the blank line, or None if this is no header."""
    fields, at = {}, 0
    while not chunk.startswith(b"\r\n", at):
        m = _HEADER.match(chunk, at)
        if not m:
            return None
        fields[m[1].lower()] = m[2]
        at = m.end()
    size = fields.get(b"content-length", b"")
    return (fields, at + 2) if size.isdigit() and len(size) < 16 else None


def _after_magic(chunk: bytes) -> tuple[int, dict, bytes] | None:
    """(length of the record from its magic on, fields, block as far as the
    chunk holds it) if a record could start before ``chunk``."""
    parsed = parse_header(chunk)
    if not parsed:
        return None
    fields, head = parsed
    size = int(fields[b"content-length"])
    return len(MAGIC) + head + size + len(END), fields, chunk[head:head + size]


def _page(urn: bytes) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+)>", urn)
    return int(m[1]) if m else None


def describe(fields: dict[bytes, bytes], block: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to."""
    http, _, payload = block.partition(END.encode())
    kind = fields.get(b"warc-type", b"").decode()
    if kind == "revisit":  # the payload is elsewhere: its size and digest are in the headers
        size = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", http)
        digest = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode()
        return (_page(fields.get(b"warc-record-id", b"")), int(size[1]) if size else 0, digest, kind,
                _page(fields.get(b"warc-refers-to", b"")))
    return (_page(fields.get(b"warc-record-id", b"")), len(payload), hashlib.sha1(payload).hexdigest(),
            kind, None)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The files split at the magic: file, block (where the split begins) and
    value, in reading order within a split."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("value")))


def _runs(b: pd.DataFrame) -> Iterator[tuple[str, int, pd.Series]]:
    """A batch cut where the split changes."""
    same = (b["file"] == b["file"].shift()) & (b["block"] == b["block"].shift())
    for _, run in b.groupby((~same).cumsum(), sort=False):
        yield run["file"].iloc[0], int(run["block"].iloc[0]), run["value"]


_LISTED = ("file string, block long, start long, stop long, next long, whole boolean, page_id long, "
           "payload_bytes long, payload_digest string, record_type string, refers_to long")


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per chunk. Offsets count from where the split's first chunk
    begins; start is the place of the magic before the chunk."""
    at: dict[tuple[str, int], int] = {}
    columns = [c.split()[0] for c in _LISTED.split(", ")]
    for b in batches:
        out = []
        for file, block, values in _runs(b):
            here = at.get((file, block), 0)
            for value in values:
                start, stop = here - len(MAGIC), here + len(value)
                could = _after_magic(value)
                length = could[0] if could else None
                whole = bool(could) and start + length == stop
                out.append((file, block, start, stop, start + length if could else None, whole,
                            *(describe(*could[1:]) if whole else (None,) * 5)))
                here = stop + len(MAGIC)
            at[file, block] = here
        frame = pd.DataFrame(out, columns=columns)
        for c in ("start", "stop", "next", "page_id", "payload_bytes", "refers_to"):
            frame[c] = frame[c].astype("Int64")
        yield frame


def _exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per candidate the first place at or after the end of its split that
    the chain from it leads to. Rows arrive sorted by file, split and offset;
    a split's candidates are bounded by its bytes."""
    def close(rows: list[tuple]) -> pd.DataFrame:
        file, block, start, nxt, end = (np.array(x) for x in zip(*rows))
        place = {s: i for i, s in enumerate(start.tolist())}
        out = nxt.copy()
        for i in range(len(rows) - 1, -1, -1):
            j = place.get(int(nxt[i]))
            if j is not None and j > i:
                out[i] = out[j]
        return pd.DataFrame({"file": file, "block": block, "start": start, "leads_to": out})

    held: list[tuple] = []
    for b in batches:
        for row in zip(b["file"], b["block"], b["start"], b["next"], b["end"]):
            if held and held[-1][:2] != row[:2]:
                yield close(held)
                held = []
            held.append(row)
    if held:
        yield close(held)


def _reach(candidates: DataFrame) -> DataFrame:
    """(file, block, start): the candidates reached from the start of their
    file. ``candidates``: file, block, start, next, end of the split."""
    leaps = save(candidates.where("next is not null").repartition("file", "block")
                 .sortWithinPartitions("file", "block", "start")
                 .mapInPandas(_exits, "file string, block long, start long, leads_to long"), "warc-leaps")
    # entries: where the chain enters a split; pointer jumping over splits
    hop = leaps.select("file", "start", F.col("leads_to").alias("to"))
    entries = candidates.where("start = 0").select("file", "start")
    known = None
    while True:
        entries = save(entries, "warc-entries")
        n = entries.count()
        if n == known:
            break
        known = n
        entries = entries.unionByName(entries.join(hop, ["file", "start"]).select(
            "file", F.col("to").alias("start"))).distinct()
        # a leap that lands on no candidate ends its chain
        hop = save(hop.join(hop.select("file", F.col("start").alias("to"), F.col("to").alias("beyond")),
                            ["file", "to"]).select("file", "start", F.col("beyond").alias("to")), "warc-hops")
    return entries


def _within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Follow the chain inside each split from its entry; keep what it meets."""
    def follow(rows: list[tuple]) -> pd.DataFrame:
        nxt = {r[2]: r[3] for r in rows}
        met = []
        for file, block, start, _, entered in rows:
            if entered:
                at = start
                while at in nxt and (not met or at > met[-1][2]):
                    met.append((file, block, at))
                    at = nxt[at]
        return pd.DataFrame(met, columns=["file", "block", "start"])

    held: list[tuple] = []
    for b in batches:
        for row in zip(b["file"], b["block"], b["start"], b["next"], b["entered"]):
            if held and held[-1][:2] != row[:2]:
                yield follow(held)
                held = []
            held.append(row)
    if held:
        yield follow(held)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``: file, start, page_id,
    payload_bytes, payload_digest, record_type, refers_to."""
    bound_batches(spark)
    listed = save(_chunks(spark, path).mapInPandas(_list, _LISTED), "warc-listed")
    # where each split's first chunk begins: the bytes of the splits before
    sizes = listed.groupBy("file", "block").agg((F.max("stop") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    origin = sizes.select("file", "block", "bytes",
                          F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("origin"))
    shift = lambda c: (F.col(c) + F.col("origin")).alias(c)
    placed = (listed.join(origin, ["file", "block"])
              .select("file", "block", shift("start"), shift("stop"), shift("next"), "whole",
                      (F.col("origin") + F.col("bytes") - len(MAGIC)).alias("end"), "page_id",
                      "payload_bytes", "payload_digest", "record_type", "refers_to"))
    candidates = placed.where("start >= 0").select("file", "block", "start", "next", "end")
    entered = _reach(candidates).withColumn("entered", F.lit(True))
    reached = (candidates.where("next is not null").join(entered, ["file", "start"], "left")
               .select("file", "block", "start", "next", F.coalesce("entered", F.lit(False)).alias("entered"))
               .repartition("file", "block").sortWithinPartitions("file", "block", "start")
               .mapInPandas(_within, "file string, block long, start long"))
    records_ = save(placed.drop("end").join(reached, ["file", "block", "start"], "left_semi"), "warc-reached")
    plain = records_.where("whole").select("file", "start", "page_id", "payload_bytes", "payload_digest",
                                           "record_type", "refers_to")
    broken = records_.where("not whole").select("file", "start", "next")
    if broken.isEmpty():
        return plain
    return plain.unionByName(_assembled(spark, path, placed, broken))


def _assembled(spark: SparkSession, path: str, placed: DataFrame, broken: DataFrame) -> DataFrame:
    """The records that hold magic, put together from their chunks."""
    # owner of a chunk: the broken record whose span covers it; spans of one
    # file don't overlap, so per file the last one begun before it
    marks = (placed.select("file", "start", F.lit(None).cast("long").alias("from"), F.lit(None).cast("long").alias("to"),
                           "block", F.lit(1).alias("kind"))
             .unionByName(broken.select("file", "start", F.col("start").alias("from"), F.col("next").alias("to"),
                                        F.lit(-1).cast("long").alias("block"), F.lit(0).alias("kind"))))
    upto = (Window.partitionBy("file").orderBy("start", "kind")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    owned = save(marks.withColumn("owner", F.last("from", True).over(upto))
                 .withColumn("owner_end", F.last("to", True).over(upto))
                 .where("kind = 1 and owner is not null and start < owner_end")
                 .select("file", "block", "start", "owner"), "warc-owned")
    # the second read: number the chunks of a split as the first one did
    rel = _chunks(spark, path).mapInPandas(_starts, "file string, block long, rel long, value binary")
    origin = placed.groupBy("file", "block").agg(F.min("start").alias("origin"))
    wanted = (owned.join(origin, ["file", "block"])
              .select("file", "block", (F.col("start") - F.col("origin")).alias("rel"), "start", "owner"))
    parts = rel.join(wanted, ["file", "block", "rel"])
    whole = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))

    def put_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for file, owner, chunks in zip(b["file"], b["owner"], b["parts"]):
                could = _after_magic(MAGIC.encode().join(bytes(c["value"]) for c in chunks))
                rows.append((file, owner, *describe(*could[1:])))
            frame = pd.DataFrame(rows, columns=["file", "start", "page_id", "payload_bytes", "payload_digest",
                                                "record_type", "refers_to"])
            for c in ("page_id", "payload_bytes", "refers_to"):
                frame[c] = frame[c].astype("Int64")
            yield frame

    return whole.mapInPandas(put_together, "file string, start long, page_id long, payload_bytes long, "
                                           "payload_digest string, record_type string, refers_to long")


def _starts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks with their offset from the split's first one."""
    at: dict[tuple[str, int], int] = {}
    for b in batches:
        for file, block, values in _runs(b):
            here = at.get((file, block), 0)
            rel = []
            for value in values:
                rel.append(here)
                here += len(value) + len(MAGIC)
            at[file, block] = here
            yield pd.DataFrame({"file": file, "block": block, "rel": rel, "value": list(values)})


def round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write ``pages`` to a fresh folder and read the archives back."""
    path = shared_path(pages.sparkSession, "warc")
    write(pages, path, **names)
    return read(pages.sparkSession, path)
