"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every rosterline job relies on. AQE re-plans joins at run time
# (broadcasts a side only once its real size is known, coalesces small
# shuffle partitions, splits skewed ones).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key also where an aggregate after the join must then shuffle again
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # 64 MiB: a small dimension (group list, rules, dedup'd keepers) may be
    # broadcast; the roster/accounts/people tables at 100 TB scale never are.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


# Added on a cluster (no local master). Sized for tables of tens of TB: many
# initial shuffle partitions that AQE coalesces towards ~256 MiB each, input
# splits of 256 MiB, and a skew split for any partition 5x the median and over
# 512 MiB (a business code holding a third of all rows is split, not sent to
# one task).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # semi-join reduction: a selective side (e.g. the +/-15 day picking window)
    # builds a bloom filter that prunes the other side (heads, items) in its
    # scan, before the shuffle; allow it for creation sides up to 256 MiB.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(256 * 1024 * 1024),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(50_000_000),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(256 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "rosterline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the rosterline settings.

    On a cluster ``master`` stays None and the launcher decides; tests and the
    bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if not master or not master.startswith("local"):
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_FALLBACK_DIRS: dict = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and versioned tables.

    Read ``spark.checkpoint.dir`` from the session (a cluster names a shared
    folder there). Only when it is unset and the master is local -- tests --
    is a folder made, once per session; ``spark.checkpoint.dir`` is a core
    setting that cannot be changed at run time, so the fallback is kept here
    and handed to the SparkContext. On a cluster every executor would see a
    folder of its own, so there an unset name is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        key = id(spark.sparkContext)
        if key not in _FALLBACK_DIRS:
            _FALLBACK_DIRS[key] = tempfile.mkdtemp(prefix="rosterline-ckpt-",
                                                   dir=os.environ.get("TMPDIR", "/tmp"))
        d = _FALLBACK_DIRS[key]
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d
