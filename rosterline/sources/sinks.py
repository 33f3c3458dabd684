"""Sinks: versioned table commits (SNK2), appends (SNK1), report export
(SNK3), materialisation (SNK5).

Parquet tables refuse UPDATE / DELETE / MERGE and refuse to overwrite the path
being read, so every change writes a new version directory and later steps
read that directory. A retried write of the same version rewrites the same
directory (Spark's commit protocol makes the job output all-or-nothing), so a
lost executor or a replayed step cannot leave half a version behind.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rosterline.session import checkpoint_dir


def table_root(spark: SparkSession, name: str, base: str | None = None) -> str:
    return f"{(base or checkpoint_dir(spark)).rstrip('/')}/tables/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, through the Hadoop file system of the path
    (works for local, HDFS and object-store folders alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list:
    """Names of the entries of a folder, none if it isn't there."""
    if not exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder of a managed table (expired data)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def version_path(spark: SparkSession, name: str, version: str, base: str | None = None) -> str:
    return f"{table_root(spark, name, base)}/v={version}"


def commit(df: DataFrame, spark: SparkSession, name: str, version: str, base: str | None = None,
           partition_by: list | None = None, paths: dict | None = None) -> DataFrame:
    """Write ``df`` as version ``version`` of table ``name`` and return the
    DataFrame read back from it (this also cuts the lineage)."""
    path = version_path(spark, name, version, base)
    # Only a folder that already exists can be one the data is read from; the
    # (driver-side) list of input files is consulted only in that rare case
    # (a replayed version), never for a fresh version of a large table.
    if exists(spark, path):
        target = urlparse(path).path.rstrip("/") + "/"
        if any(urlparse(f).path.startswith(target) for f in df.inputFiles()):
            raise ValueError(f"refusing to overwrite {path}: the data being written is read from it")
    if paths is not None:
        paths[name] = path
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def commit_counted(df: DataFrame, spark: SparkSession, name: str, version: str, base: str | None = None,
                   paths: dict | None = None, count: str | None = None):
    """``commit`` that also returns the number of rows written, observed
    while writing (A9: the affected-row count costs no second job); with
    ``count`` the sum of that column instead."""
    obs = Observation(f"count_{name}_{version}".replace("-", "_").replace(".", "_"))
    n = F.count(F.lit(1)) if count is None else F.coalesce(F.sum(count), F.lit(0))
    out = commit(df.observe(obs, n.alias("n")), spark, name, version, base, paths=paths)
    return out, int(obs.get["n"])


def as_of(spark: SparkSession, name: str, day: str, base: str | None = None) -> DataFrame:
    """A table as it was on ``day`` (yyyy-mm-dd): its newest version folder named by that day or an earlier one."""
    days = [x[2:] for x in children(spark, table_root(spark, name, base)) if x.startswith("v=") and x[2:] <= day]
    if not days:
        raise ValueError(f"{name} has no version of {day} or before")
    return spark.read.parquet(version_path(spark, name, max(days), base))


def export_reports(df: DataFrame, path: str) -> DataFrame:
    """SNK3: one folder of CSV for each rule, under its level (spreadsheets are
    not built); returns ``(level, rule_id, row_count)`` of what was written."""
    df.write.mode("overwrite").partitionBy("level", "rule_id").option("header", "true").csv(path)
    return df.groupBy("level", "rule_id").agg(F.count(F.lit(1)).alias("row_count"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """SNK5: ``SELECT ... INTO #temp`` then read twice -> persist + temp view."""
    df = df.persist()
    df.createOrReplaceTempView(name)
    return df
