"""Log table: retention delete (D1) and append with level (D2 / SNK4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from rosterline.functions.exprs import older_than
from rosterline.operators.change import Change, delete_where
from rosterline.params import DEFAULT_PARAMS, SyncParams
from rosterline.plans.registry import query
from rosterline.schemas import LOG_SCHEMA
from rosterline.sources.sinks import children, remove
from rosterline.sources.standins import Tables

c = F.col
P = DEFAULT_PARAMS
LEVELS = ("Information", "Warning", "Error")


def log_retention(log: DataFrame, p: SyncParams = P) -> Change:
    """Delete rows older than ``retain_days`` before ``log_as_of``.

    Kept: ``log_time >= cut OR log_time IS NULL`` -- a plain NOT(cond) would
    lose rows without a time.
    """
    return delete_where(log, older_than("log_time", p.log_as_of, p.retain_days))


def log_entries(spark: SparkSession, entries, run_ts: str, start_id: int = 0) -> DataFrame:
    """Turn (level, category, message, user_id) tuples into log rows; missing text is ''."""
    ts = dt.datetime.fromisoformat(run_ts)
    rows = []
    for i, (level, category, message, user_id) in enumerate(entries):
        if level not in LEVELS:
            raise ValueError(f"log level must be one of {LEVELS}")
        rows.append((start_id + i, ts, level, category, message, user_id))
    df = spark.createDataFrame(rows, LOG_SCHEMA)
    return df.select("log_id", "log_time", "log_level",
                     *[F.coalesce(c(x), F.lit("")).alias(x) for x in ("category", "message", "user_id")])


def append_log(log: DataFrame, entries: DataFrame) -> DataFrame:
    """SNK4 / D2: append event rows; text columns that are missing become ''."""
    e = entries.select(*[F.coalesce(c(f.name), F.lit("")).alias(f.name) if f.dataType.simpleString() == "string"
                         else c(f.name) for f in entries.schema.fields])
    return log.unionByName(e, allowMissingColumns=True)


class DailyLog:
    """SNK4 / D1 as a stored table, one folder a day: an append adds files to its days, retention
    removes whole days and rewrites the one day that the cut goes through."""

    DAY = "log_day"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> DataFrame:
        schema = StructType([*LOG_SCHEMA.fields, StructField(self.DAY, DateType())])
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(self.root).drop(self.DAY)

    def append(self, rows: DataFrame):
        """Rows without a time get a folder of their own, which retention never touches."""
        append_log(rows.limit(0), rows).withColumn(self.DAY, F.to_date("log_time")).write.mode("append").partitionBy(self.DAY).parquet(self.root)

    def retain(self, as_of: str, days: int) -> dict:
        """Delete what is older than ``days`` before ``as_of``; returns the days removed and the day rewritten."""
        cut = dt.datetime.fromisoformat(as_of) - dt.timedelta(days=days)
        edge, stored = cut.date().isoformat(), []
        for x in children(self.spark, self.root):
            if x.startswith(f"{self.DAY}=") and x.split("=")[1][:1].isdigit():
                stored.append(x.split("=")[1])
        gone = sorted(x for x in stored if x < edge)
        rewritten = None
        if edge in stored and cut.time() != dt.time():
            one = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/{self.DAY}={edge}")
            old = older_than("log_time", as_of, days)
            counts = one.agg(F.count(F.when(old, 1)).alias("old"), F.count(F.lit(1)).alias("all")).first()
            if counts["old"] == counts["all"]:
                gone.append(edge)
            elif counts["old"]:
                # Spark reads the day before it replaces it: the new files are moved in place when the job commits
                one.where(~F.coalesce(old, F.lit(False))).withColumn(self.DAY, F.lit(edge).cast("date")).write.mode("overwrite") \
                    .option("partitionOverwriteMode", "dynamic").partitionBy(self.DAY).parquet(self.root)
                rewritten = edge
        for x in gone:
            remove(self.spark, f"{self.root}/{self.DAY}={x}")
        return {"removed": gone, "rewritten": rewritten}


_CUT = f"TIMESTAMP '{P.log_as_of}' - INTERVAL {P.retain_days} DAY"


@query("log_retention", f"SELECT * FROM system_log WHERE log_time >= {_CUT} OR log_time IS NULL")
def q_log_retention(spark, d):
    return log_retention(Tables(spark, d).system_log).after


@query("log_retention_expired", f"SELECT * FROM system_log WHERE log_time < {_CUT}")
def q_log_retention_expired(spark, d):
    return log_retention(Tables(spark, d).system_log).rows


@query("log_retention_counts", f"""
SELECT count(CASE WHEN log_time < {_CUT} THEN 1 END) AS deleted_count,
       count(CASE WHEN NOT coalesce(log_time < {_CUT}, FALSE) THEN 1 END) AS kept_count
FROM system_log
""")
def q_log_retention_counts(spark, d):
    log = Tables(spark, d).system_log
    old = older_than("log_time", P.log_as_of, P.retain_days)
    return log.agg(F.count(F.when(old, 1)).alias("deleted_count"),
                   F.count(F.when(~F.coalesce(old, F.lit(False)), 1)).alias("kept_count"))


@query("log_level_counts", """
SELECT log_level, count(*) AS cnt FROM system_log GROUP BY log_level ORDER BY log_level
""")
def q_log_level_counts(spark, d):
    return (Tables(spark, d).system_log.groupBy("log_level").agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy("log_level"))
