"""Audit operators: set differences, match profiles, counts, duplicate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SALTS = 16


def salt() -> Column:
    """A number below SALTS for the task that reads the row.

    Grouping by key and salt shrinks a hot key before the shuffle, yet leaves
    the result not partitioned by the key: the join that follows gets an
    exchange of its own on both sides, which AQE needs to split a skewed one.
    (An aggregate on the key itself between exchange and join prevents that.)
    Any salt gives the same result where it is used, so a retried task may draw
    another one.
    """
    return F.pmod(F.spark_partition_id(), F.lit(SALTS))


def distinct_keys(df: DataFrame, key: str, alias: str = "_mk") -> DataFrame:
    """The values of one key column, each at most SALTS times: the right side of an anti / semi join."""
    return df.select(F.col(key).alias(alias), salt().alias("_salt")).distinct().select(alias)


def missing_from(a: DataFrame, b: DataFrame, a_key: str, b_key: str, how: str = "left_anti") -> DataFrame:
    """J3 / SET1: rows of ``a`` whose key has no partner in ``b``
    (``how="left_semi"``: rows that have one, J5).

    Written as an anti-join directly: Catalyst does not turn LEFT JOIN ...
    IS NULL into one, it keeps an outer join plus a filter. A NULL key of
    ``a`` never matches, so the row is kept, as with LEFT JOIN ... IS NULL.
    A key that is hot in ``a`` is split by AQE, one that is hot in ``b`` is
    reduced before the shuffle (see ``salt``).
    """
    k = distinct_keys(b, b_key)
    return a.join(k, a[a_key] == k["_mk"], how)


def match_profile(df: DataFrame, counters: dict, total: str | None = "total") -> DataFrame:
    """A2: one pass, one row: total plus ``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` per counter.

    The sums keep SQL's rule that SUM over no rows is NULL while COUNT is 0.
    """
    aggs = []
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    for name, cond in counters.items():
        aggs.append(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(name))
    return df.agg(*aggs)


def duplicate_keys(df: DataFrame, key, table: str) -> DataFrame:
    """Q12: business keys that occur more than once (guard for joins / updates).

    ``groupBy().count()`` combines map-side, so even a key holding a third of
    all rows is reduced to one partial count per task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
              .where(F.col("occurrences") > 1)
              .select(F.lit(table).alias("table_name"),
                      F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key_value"),
                      "occurrences"))


def weighted(df: DataFrame, cols, name: str = "_w") -> DataFrame:
    """``df`` reduced to its distinct ``cols`` with their multiplicity, in at most SALTS rows each.

    Counting over a join of two tables whose key is hot on both sides would
    materialise every pair of that key. Joining one side (or both) reduced
    this way and summing the products of the multiplicities gives the same
    counts from at most SALTS rows per distinct combination, and the aggregate
    combines before the shuffle. The rows of one combination add up, so only
    sums of ``name`` may be taken over the join.
    """
    cols = list(cols)
    return df.withColumn("_salt", salt()).groupBy(*cols, "_salt").agg(F.count(F.lit(1)).alias(name)).drop("_salt")
