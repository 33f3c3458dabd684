"""Dense numbering of a whole table without one ordered task (SNK6 identity column)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.sources.sinks import commit

PART = 33          # bits of ``monotonically_increasing_id`` below the partition number


def with_identity(df: DataFrame, order: list, name: str = "id", version: str = "identity", table: str = "identity",
                  base: str | None = None, start: int = 1) -> DataFrame:
    """``df`` with a column ``name`` counting its rows from ``start`` without gaps, in the order of ``order``.

    A distributed prefix sum: the rows are sorted in ranges and written with
    their place in their range; the sizes of the ranges (one row each, as many
    as there are partitions) are summed up and joined back as offsets. Equal
    values of ``order`` are numbered in any order, and a value that very many
    rows share is cut into several ranges too (a tie-breaker is the last range
    column). The written rows fix the order: a lost executor cannot change it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ties = df.withColumn("_tie", F.monotonically_increasing_id())
    sorted_ = ties.repartitionByRange(parts, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = commit(sorted_.withColumn("_at", F.monotonically_increasing_id()), spark, table, version, base)
    placed = placed.withColumn("_part", F.shiftright("_at", PART))
    sizes = placed.groupBy("_part").count().orderBy("_part").collect()          # one row a partition
    offsets, before = [], start
    for r in sizes:
        offsets.append((r["_part"], before))
        before += r["count"]
    offsets = spark.createDataFrame(offsets, "_p long, _before long")
    place = F.col("_at").bitwiseAND(F.lit((1 << PART) - 1))
    return placed.join(F.broadcast(offsets), F.col("_part") == F.col("_p")) \
        .withColumn(name, F.col("_before") + place).drop("_at", "_part", "_p", "_before").select(name, *df.columns)
