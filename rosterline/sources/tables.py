"""SRC1 / SRC4: read a table by name from parquet, csv or jdbc."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    """Where a table lives. ``fmt`` is parquet (default), csv or jdbc."""
    path: str
    fmt: str = "parquet"
    schema: StructType | None = None
    options: tuple = ()           # extra reader options as (key, value) pairs


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    reader = spark.read
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    opts = dict(spec.options)
    if spec.fmt == "parquet":
        return reader.options(**opts).parquet(spec.path)
    if spec.fmt == "csv":
        opts.setdefault("header", "true")
        return reader.options(**opts).csv(spec.path)
    if spec.fmt == "jdbc":
        # partitionColumn / lowerBound / upperBound / numPartitions in options
        # give a parallel read; without them jdbc reads in one task.
        return reader.format("jdbc").option("dbtable", spec.path).options(**opts).load()
    raise ValueError(f"unknown table format {spec.fmt!r}")


def range_predicates(column: str, bounds: list) -> list:
    """SQL conditions that cut a table into ranges of ``column`` at ``bounds``: every row meets exactly one.

    Rows without a value are in the first range; equal bounds and NULLs among
    them count once. Numbers go in as they are, other values as quoted text.
    """
    marks = sorted({b for b in bounds if b is not None})
    said = [str(b) if isinstance(b, (int, float)) and not isinstance(b, bool) else "'" + str(b).replace("'", "''") + "'" for b in marks]
    if not said:
        return ["1 = 1"]
    return [f"{column} < {said[0]} OR {column} IS NULL", *[f"{column} >= {a} AND {column} < {b}" for a, b in zip(said, said[1:])],
            f"{column} >= {said[-1]}"]


def quantile_bounds(df: DataFrame, column: str, parts: int) -> list:
    """Values of a number column that cut it into about ``parts`` equal shares (approximate quantiles, one pass)."""
    return df.approxQuantile(column, [i / parts for i in range(1, parts)], 0.25 / parts) if parts > 1 else []


def read_ranged(spark: SparkSession, spec: TableSpec, column: str, parts: int) -> DataFrame:
    """A database table read by about ``parts`` queries at once, each over a range of a number column.

    The bounds come from the column's own quantiles (its values are read once, alone), so ranges
    are even where the values aren't.
    """
    opts = dict(spec.options)
    values = spark.read.format("jdbc").option("query", f"SELECT {column} FROM {spec.path}").options(**opts).load()
    return spark.read.jdbc(opts.pop("url"), spec.path, predicates=range_predicates(column, quantile_bounds(values, values.columns[0], parts)),
                           properties=opts)


def load_seed(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """SRC4: bulk seed rows from a file with a declared schema (no inference)."""
    return read_table(spark, TableSpec(path=path, fmt=fmt, schema=schema))


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver-generated parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
