"""Distributed file listing and copy.

The manifest is a Spark scan of file metadata (``binaryFile`` without the
``content`` column, so no bytes are read). The copy runs on the executors:
the manifest is spread over tasks and every task streams its files from
the source to the target folder, creating parent folders and overwriting.
Each task returns one row per file, so totals (files, bytes) are a plain
aggregate. A task lost with its executor is re-run by Spark; overwriting
makes the retry safe.
"""

from __future__ import annotations

import os
import re
import shutil
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def relative_to(path: Column | str, root: str) -> Column:
    """``path`` below ``root`` (both with their scheme); an error for a path
    that is not below it, so that two files never get one name."""
    p = F.col(path) if isinstance(path, str) else path
    prefix = root.rstrip("/") + "/"
    return F.when(p.startswith(prefix), F.substr(p, F.lit(len(prefix) + 1))).otherwise(
        F.raise_error(F.concat(F.lit(f"not below {root}: "), p)).cast("string"))


def manifest(spark: SparkSession, root: str, glob: str | None = None, content: bool = False) -> DataFrame:
    """``(path, relative_path, length)`` of every file below ``root``, a
    folder of any file system Spark reads (recursive; folders are not rows).
    With ``content`` the bytes as well, for a copy from a store that only
    Spark can open (files of up to 2 GB)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    loaded = reader.load(root)
    # scans leave out files without a byte; Spark's listing, which it holds on
    # the driver in any case, has them
    paths = [re.sub("^([a-zA-Z][^:/]*):///", r"\1:/", unquote(p)) for p in loaded.inputFiles()]
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    filled = {"length": F.lit(0).cast("long")} | ({"content": F.lit(b"")} if content else {})
    more = ["content"] if content else []
    files = listed.join(loaded.select("path", *filled), "path", "left").select(
        "path", *[F.coalesce(c, empty).alias(c) for c, empty in filled.items()])
    # the root with the scheme and authority that the listed paths carry
    where = spark._jvm.org.apache.hadoop.fs.Path(root)
    full = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return files.select("path", relative_to("path", full).alias("relative_path"), "length", *more)


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def copy_files(files: DataFrame, target: str) -> DataFrame:
    """Copy every manifest row to ``target/relative_path`` on the executors.
    Returns ``(relative_path, bytes)`` per copied file. Source and target are
    paths that every executor has mounted (plain or ``file:``)."""
    target = os.path.abspath(_local(target))

    def run(batches):
        for pdf in batches:
            out_rel, out_bytes = [], []
            for path, rel in zip(pdf["path"], pdf["relative_path"]):
                dst = os.path.join(target, rel)
                os.makedirs(os.path.dirname(dst), exist_ok=True)
                with open(_local(path), "rb") as src, open(dst, "wb") as fh:
                    shutil.copyfileobj(src, fh, 1 << 20)
                out_rel.append(rel)
                out_bytes.append(os.path.getsize(dst))
            yield pd.DataFrame({"relative_path": out_rel, "bytes": out_bytes}).astype({"bytes": "int64"})

    return (files.select("path", "relative_path").repartition("relative_path")
            .mapInPandas(run, "relative_path string, bytes long"))


def copy_totals(copied: DataFrame, *by: str) -> DataFrame:
    """``(files_copied, bytes_copied)`` counters of a copy, in all or per
    group of columns."""
    return copied.groupBy(*by).agg(F.count(F.lit(1)).alias("files_copied"),
                                   F.sum("bytes").alias("bytes_copied"))
