"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every rivulet job relies on. AQE re-plans joins and shuffle
# partition counts from runtime sizes; the session time zone is pinned so
# that event-time windows and epoch conversions do not depend on the host.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # availableNow with a Python stream source: run batches until nothing is
    # left, the one that closes windows included, instead of a single one
    "spark.sql.streaming.triggerAvailableNowWrapper.enabled": "true",
    # loops checkpoint every step: delete a step's files with its last reference
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rivulet", extra: dict | None = None) -> SparkSession:
    """Return a session with rivulet's base settings.

    On a cluster ``master`` is left to spark-submit; locally pass
    ``local[N]``. ``shuffle_partitions`` is left to the cluster's own setting
    unless given; size it so that one shuffle partition stays around
    128-256 MB, AQE coalesces small ones at runtime.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once a context, so
    that a job does not depend on the folder or path its driver started with."""
    sc = spark.sparkContext
    if getattr(sc, "_rivulet_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rivulet-src-"), "rivulet_src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    sc.addPyFile(archive)
    sc._rivulet_shipped = True


@contextmanager
def by_value():
    """Classes and functions of this package that are handed to Spark in this
    block travel whole. The processes in which Spark plans Python stream
    sources and sinks and transformWithState don't get the files a session was
    given, so they could not import them."""
    from pyspark import cloudpickle

    import rivulet
    cloudpickle.register_pickle_by_value(rivulet)
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(rivulet)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints.

    The cluster names it in ``spark.checkpoint.dir``; we only read it. When
    it is unset and the session runs in local mode (tests, a laptop), a
    fresh folder is created for this session. On a cluster an unset folder
    is an error: a machine-local folder would not survive losing the
    executor that wrote it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
