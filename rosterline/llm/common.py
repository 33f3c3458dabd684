"""Helpers shared by the training-data operators: input, written intermediate tables, components."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.session import checkpoint_dir
from rosterline.sources.sinks import remove

# Functions that run in Python workers travel with the job, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules["rosterline.llm"])

_folders: WeakKeyDictionary = WeakKeyDictionary()                         # of the tables that written() made
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)    # folders made inside settled()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back.

    The result has no lineage: a lost executor costs a re-read, not a
    recomputation. The folder is ``spark.checkpoint.dir`` of the session.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    if _made.get() is not None:
        _made.get().append(path)
    return out


def dropped(df: DataFrame) -> None:
    """Remove the table that ``written`` made for ``df``, once no plan reads it any more; other frames are left alone."""
    path = _folders.pop(df, None)
    if path is not None:
        remove(df.sparkSession, path)


def settled(make: Callable[[], DataFrame], what: str) -> DataFrame:
    """The written result of ``make()``; the tables that were written on the way to it are removed.

    Only for results that ``make`` alone reads: a lazy frame over one of these tables fails afterwards.
    """
    folders: list[str] = []
    token = _made.set(folders)
    try:
        result = make()
    finally:
        _made.reset(token)
    out = written(result, what)
    for path in folders:
        remove(out.sparkSession, path)
    return out


def cut(df: DataFrame) -> DataFrame:
    """The state of a loop or a small table, without its lineage."""
    return written(df, "state")


def bounded_sample(keys: DataFrame, most: int) -> DataFrame:
    """About ``most`` of ``keys(key, label, ...)``, labels 0 and 1, one row a key: those of smallest hash, of both labels.

    The labels keep their shares, but the rarer one has a tenth of the sample if it has so many keys.
    """
    n = {int(r["label"]): r["n"] for r in keys.groupBy("label").agg(F.count("*").alias("n")).collect()}      # two rows
    total = sum(n.values())
    out = None
    for label, count in sorted(n.items()):
        share = max(1, most // 10, round(most * count / total))
        part = keys.where(F.col("label") == label).orderBy(F.xxhash64("key"), "key").limit(min(share, most))
        out = part if out is None else out.union(part)
    return keys.limit(0) if out is None else out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` as ``(node, component)``; component = smallest node.

    Alternating large-star / small-star: every round is a grouped minimum
    (combined before the shuffle) and one join on the node, and the number of
    rounds grows with the logarithm of the longest chain. The minimum is grouped
    by the node and its hash, so that the join shuffles both sides by the node
    itself and AQE can split the links of a hub. Nodes without an edge
    are not returned. Self-loops are ignored; no edges gives an empty table. A round's
    links are removed once the next round's are written.
    """
    def lowest(links):
        return links.groupBy("hi", F.xxhash64("hi").alias("hash")).agg(F.min("lo").alias("m"))

    links = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    seen = None
    while True:
        mark = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(hi, lo))")).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        both = links.select("hi", "lo").union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        low = lowest(both).select(F.col("hi").alias("u"), F.least("hi", "m").alias("m"))
        large = both.join(low, both["hi"] == low["u"]).where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = large.distinct()
        low = lowest(large).select(F.col("hi").alias("u"), "m")
        small = large.join(low, large["hi"] == low["u"])
        before, links = links, cut(small.select(F.explode(F.array(
            F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo").where("hi <> lo").distinct())
        dropped(before)
    nodes = links.groupBy("hi").agg(F.min("lo").alias("component")).withColumnRenamed("hi", "node")
    return nodes.union(links.select("lo", "lo").distinct().toDF("node", "component"))
