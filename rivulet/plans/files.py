"""File-copy counters and service-enrichment queries."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from rivulet.operators.enrich import async_enrich, modulo_key
from rivulet.operators.files import copy_totals, manifest
from rivulet.plans.catalog import query
from rivulet.session import checkpoint_dir
from rivulet.sinks.ledger import copy_committed
from rivulet.sources.tables import table


@query("copy_counters", sql="""
WITH n AS (SELECT greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS n FROM pages)
SELECT page_id % n AS folder, 1::BIGINT AS files_copied,
       CAST(sum(octet_length(encode(coalesce(html, ''))) + 1) AS BIGINT) AS bytes_copied
FROM pages, n GROUP BY 1
""")
def copy_counters(spark, sf):
    """The pages written as one text file per folder, as many folders as the
    root of their number; the files copied, and counted by the copy."""
    pages = table(spark, sf, "pages")
    root = f"{checkpoint_dir(spark).rstrip('/')}/rivulet-copy/{uuid.uuid4().hex}"
    folders = max(1, math.ceil(math.sqrt(pages.count())))
    (pages.select(F.pmod("page_id", F.lit(folders)).alias("folder"), F.coalesce("html", F.lit("")).alias("value"))
     .repartition("folder").write.partitionBy("folder").text(f"{root}/from"))
    copied = copy_committed(manifest(spark, f"{root}/from", "*.txt"), f"{root}/to")
    folder = F.regexp_extract("relative_path", "^folder=([0-9]+)/", 1).cast("long")
    return copy_totals(copied.withColumn("folder", folder), "folder")


@query("file_manifest", sql="""
WITH n AS (SELECT greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS n FROM pages),
b AS (SELECT page_id % n AS f, sum(octet_length(encode(coalesce(html, ''))) + 1) AS length FROM pages, n GROUP BY 1)
SELECT 'level=' || (f % 3) || '/folder=' || f AS folder, CAST(length AS BIGINT) AS length FROM b
""")
def file_manifest(spark, sf):
    """A recursive listing of written folders, two levels deep."""
    pages = table(spark, sf, "pages")
    root = f"{checkpoint_dir(spark).rstrip('/')}/rivulet-copy/{uuid.uuid4().hex}"
    folders = max(1, math.ceil(math.sqrt(pages.count())))
    (pages.select(F.pmod("page_id", F.lit(folders)).alias("folder"), F.coalesce("html", F.lit("")).alias("value"))
     .withColumn("level", F.col("folder") % 3)
     .repartition("folder").write.partitionBy("level", "folder").text(root))
    return manifest(spark, root, "*.txt").select(
        F.regexp_replace("relative_path", "/[^/]*$", "").alias("folder"), "length")


@query("async_enrich", sql="""
SELECT 'key-' || CAST(user_id % 10 AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY 1
""")
def async_enrich_q(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id")
    enriched = async_enrich(ev, "user_id", modulo_key, "key", capacity=20, timeout_s=10.0)
    return enriched.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("async_enrich_failures", sql="""
SELECT CASE WHEN user_id % 1000 <> 7 THEN 'key-' || CAST(user_id % 10 AS VARCHAR) END AS key,
       CASE WHEN user_id % 1000 = 7 THEN 'no answer' END AS error, count(*) AS n
FROM events GROUP BY 1, 2
""")
def async_enrich_failures(spark, sf):
    """Unordered lookups by a service that fails for a share of its calls."""
    def service(n):
        if n % 1000 == 7:
            raise RuntimeError("no answer")
        return modulo_key(n)
    ev = table(spark, sf, "events").select("event_id", "user_id")
    enriched = async_enrich(ev, "user_id", service, "key", capacity=20, ordered=False, errors="column")
    return enriched.groupBy("key", F.col("key_error").alias("error")).agg(F.count(F.lit(1)).alias("n"))
