"""Managed tables in buckets (SNK2, J1): stored by the hash of their business code.

A table is a folder ``v=<change>/_b=<bucket>`` of Parquet files that Spark's
own bucketed writer made, registered as an external bucketed table. Tables with the
same number of buckets join on the code without a shuffle, and so do their
changes, which are stored in the same buckets:

- inserted rows are one more ``v`` of the table itself,
- updates are narrow rows (code, stored values, new values) in a second table of
  the same buckets, read as one net update (``operators.change.net_of``),
- compaction rewrites the buckets that have updates; the others stay where they are.

Which (v, bucket) pairs make up the table is its ``live`` map; a version that is
written again (a retry) replaces its own folder only. A code so frequent that
its bucket is far larger than the others would be one long task: such a table is
read without its buckets (``balanced``), and AQE splits the code in a shuffle join.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from rosterline.operators.change import ORIGIN, merged, net_of, stored, stored_update
from rosterline.sources.sinks import exists, table_root

LARGE = 4.0               # times the mean rows of a bucket, and at least LARGE_ROWS, make one too large
LARGE_ROWS = 5_000_000


ROWS = 2_000_000          # of a bucket, about


def buckets_for(*tables: DataFrame) -> int:
    """One number of buckets for tables that are joined: by the rows of the largest, and enough to keep the executors busy."""
    return max([tables[0].sparkSession.sparkContext.defaultParallelism, *[-(-t.count() // ROWS) for t in tables]])


def bucket_of(key: str, buckets: int):
    """The bucket that Spark's writer puts a code in."""
    return F.pmod(F.hash(key), F.lit(buckets))


class BucketStore:
    """Versions of rows in buckets of one key: written once each, read together."""

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int, base: str | None = None):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.root = table_root(spark, name, base)
        self.ident = f"{re.sub(r'[^a-z0-9_]', '_', name.lower())}_{zlib.crc32(self.root.encode()):08x}"
        self.schema: StructType | None = None

    def _catalog_table(self, schema: StructType):
        """The catalog entry of the folder; columns that a later version adds make a new entry over the same files."""
        if self.schema is not None and set(schema.names) <= set(self.schema.names):
            return
        there = self.spark.catalog.tableExists(self.ident)           # another object of this session may have made it
        known = self.spark.table(self.ident).drop("v", "_b").schema.fields if there else []
        self.schema = StructType([*known, *[f for f in schema.fields if f.name not in {k.name for k in known}]])
        if there and len(known) == len(self.schema.fields):
            return
        parts = [tuple(x.split("=")[1] for x in r.partition.split("/")) for r in self.spark.sql(f"SHOW PARTITIONS {self.ident}").collect()] if there else []
        self.spark.sql(f"DROP TABLE IF EXISTS {self.ident}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(f"CREATE TABLE {self.ident} ({columns}, v STRING, _b INT) USING parquet PARTITIONED BY (v, _b) "
                       f"CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.root}'")
        self._add(parts)

    def _add(self, parts: list):
        if parts:
            said = " ".join(f"PARTITION (v='{v}', _b={b})" for v, b in parts)
            self.spark.sql(f"ALTER TABLE {self.ident} ADD IF NOT EXISTS {said}")

    def write(self, rows: DataFrame, version: str, count: str | None = None) -> tuple[int, list]:
        """Store ``rows`` as ``version``; returns their number (or the sum of ``count``) and the buckets they are in.

        Rows that come from tables of the same buckets are written by the tasks that made them.
        """
        n = F.count(F.lit(1)) if count is None else F.coalesce(F.sum(count), F.lit(0))
        seen = Observation(f"n_{self.ident}_{version}".replace("-", "_"))
        side = f"{self.ident}_{re.sub(r'[^a-z0-9]', '_', version.lower())}"
        path = f"{self.root}/v={version}"
        self._catalog_table(rows.schema)
        rows.withColumn("_b", bucket_of(self.key, self.buckets)).observe(seen, n.alias("n"), F.collect_set("_b").alias("b")) \
            .write.mode("overwrite").format("parquet").partitionBy("_b").bucketBy(self.buckets, self.key).sortBy(self.key) \
            .option("path", path).saveAsTable(side)
        self.spark.sql(f"DROP TABLE {side}")            # external: the files stay
        found = seen.get
        touched = sorted(found["b"])
        self._add([(version, b) for b in touched])
        return int(found["n"]), touched

    def open(self, live: dict, schema: StructType):
        """Register versions that an earlier session wrote."""
        self._catalog_table(schema)
        self._add([(v, b) for v, bs in live.items() for b in bs])

    def read(self, live: dict, bucketed: bool = True) -> DataFrame:
        """The rows of ``live`` (version to its buckets), one scan of their folders, with the columns ``v`` and ``_b``."""
        cond = F.lit(False)
        for v, bs in live.items():
            cond = cond | ((F.col("v") == v) & F.col("_b").isin(list(bs)))
        if bucketed:
            return self.spark.table(self.ident).where(cond)
        schema = StructType([*self.schema.fields, StructField("v", StringType()), StructField("_b", IntegerType())])
        return self.spark.read.schema(schema).option("basePath", self.root).parquet(*[f"{self.root}/v={v}" for v in live]).where(cond)


STATE = ("live", "order", "chain", "columns", "seq", "folder", "changes")


class ManagedTable:
    """A managed table in buckets with its chain of changes."""

    def __init__(self, spark: SparkSession, name: str, key: str, state: list, buckets: int, base: str | None = None):
        self.spark, self.name, self.key, self.state, self.buckets, self.base = spark, name, key, list(state), buckets, base
        self.rows_store = BucketStore(spark, name, key, buckets, base)
        self.updates = BucketStore(spark, f"{name}_updates", key, buckets, base)
        self.live: dict = {}            # version of rows -> its buckets
        self.order: dict = {}           # version -> number of the change that stored it
        self.chain: dict = {}           # version of an update -> its buckets
        self.columns: list = []
        self.seq = 0
        self.folder = ""                # of the last version that was no change
        self.changes: list = []         # [kind, folder] of the changes since then
        self.bucketed = True            # False: read without the buckets, for a table with a far too large one

    @classmethod
    def create(cls, df: DataFrame, name: str, key: str, state: list, buckets: int, version: str = "start", base: str | None = None):
        """Store ``df`` in buckets: one shuffle, once in the life of the table."""
        t = cls(df.sparkSession, name, key, state, buckets, base)
        t.columns = df.columns
        _, touched = t.rows_store.write(df.repartition(buckets, key), version)
        t.live, t.order, t.folder = {version: touched}, {version: 0}, f"{t.rows_store.root}/v={version}"
        return t

    def snapshot(self):
        """The same table as it is now; later changes of either don't show in the other."""
        t = ManagedTable.__new__(ManagedTable)
        t.__dict__ |= self.__dict__
        t.live, t.order, t.chain, t.columns, t.changes = dict(self.live), dict(self.order), dict(self.chain), list(self.columns), list(self.changes)
        return t

    def manifest(self) -> dict:
        """What makes up the table, as plain values."""
        schemas = [s.schema.json() if s.schema is not None else None for s in (self.rows_store, self.updates)]
        return {**{x: getattr(self, x) for x in STATE}, "schemas": schemas}

    def restore(self, doc: dict):
        """Become the table that a manifest describes; its versions are registered."""
        for x in STATE:
            setattr(self, x, doc[x])
        for store, live, schema in zip((self.rows_store, self.updates), (self.live, self.chain), doc["schemas"]):
            if schema is not None:
                store.open(live, StructType.fromJson(json.loads(schema)))

    def save(self, version: str):
        """Keep the manifest as ``version`` (say, a day): the table can be read as of it while its folders are there."""
        self.spark.createDataFrame([(version, json.dumps(self.manifest()))], "version string, doc string").coalesce(1) \
            .write.mode("overwrite").parquet(f"{table_root(self.spark, self.name + '_manifest', self.base)}/m={version}")

    @classmethod
    def load(cls, spark: SparkSession, name: str, key: str, state: list, buckets: int, version: str, base: str | None = None):
        """The table as it was saved as ``version``."""
        t = cls(spark, name, key, state, buckets, base)
        t.restore(json.loads(spark.read.parquet(f"{table_root(spark, name + '_manifest', base)}/m={version}").first()["doc"]))
        return t

    @classmethod
    def saved(cls, spark: SparkSession, name: str, version: str, base: str | None = None) -> bool:
        return exists(spark, f"{table_root(spark, name + '_manifest', base)}/m={version}/_SUCCESS")

    def balanced(self) -> bool:
        """Whether no bucket is far larger than the others (a code that very many rows share); reads footers only."""
        if not self.live:
            return True
        top = self.rows_store.read(self.live, False).groupBy("_b").count().agg(F.max("count").alias("top"), F.sum("count").alias("all")).first()
        return (top["top"] or 0) <= max(LARGE_ROWS, LARGE * (top["all"] or 0) / self.buckets)

    def net(self) -> DataFrame | None:
        """All updates since the rows were stored, as one."""
        if not self.chain:
            return None
        return net_of(self.updates.read(self.chain, self.bucketed).drop("v", "_b", "_n"), self.key)

    def stored(self) -> DataFrame:
        """The rows as they were stored, with the columns that updates name."""
        if not self.live:
            return stored(self.spark.createDataFrame([], self.rows_store.schema), 0, self.state).select(*self.columns, *ORIGIN)
        at = F.lit(None).cast("long")
        for v in self.live:
            at = F.when(F.col("v") == v, F.lit(self.order[v])).otherwise(at)
        return stored(self.rows_store.read(self.live, self.bucketed), at, self.state).select(*self.columns, *ORIGIN)

    def frame(self, origin: bool = False) -> DataFrame:
        """The table as it is: its rows with the net update; with ``origin`` also the columns that updates name."""
        rows = merged(self.stored(), self.net(), self.key)
        return rows if origin else rows.drop(*ORIGIN)

    def changed(self) -> DataFrame:
        """The rows that updates have hit since they were stored, as they are now."""
        net = self.net()
        rows = self.stored()
        return rows.limit(0).drop(*ORIGIN) if net is None else merged(rows, net, self.key, "inner").drop(*ORIGIN)

    def insert(self, rows: DataFrame, version: str) -> int:
        """Inserted rows become one more version of the table."""
        n, touched = self.rows_store.write(rows, version)
        self.seq += 1
        if n:
            self.live[version], self.order[version] = touched, self.seq
            self.columns = self.columns + [x for x in rows.columns if x not in self.columns]
            self.changes.append(["insert", f"{self.rows_store.root}/v={version}"])
        return n

    def update(self, delta: DataFrame, version: str) -> int:
        """The ``delta`` of an update over ``frame(origin=True)`` joins the chain; returns the rows it changes."""
        self.seq += 1
        n, touched = self.updates.write(stored_update(delta, self.seq, self.key), version, count="_n")
        if n:
            self.chain[version] = touched
            self.changes.append(["update", f"{self.updates.root}/v={version}"])
        return n

    def touched(self) -> list:
        """The buckets that have updates or rows of more than one version."""
        many = [b for bs in self.live.values() for b in bs]
        return sorted({b for bs in self.chain.values() for b in bs} | {b for b in many if many.count(b) > 1})

    def compact(self, version: str) -> list:
        """Rewrite the touched buckets as ``version``; every other bucket's files stay. Returns the buckets."""
        dirty = self.touched()
        if not dirty:
            return []
        part = self.snapshot()
        part.live = {v: [b for b in bs if b in set(dirty)] for v, bs in self.live.items()}
        part.live = {v: bs for v, bs in part.live.items() if bs}
        rows = part.frame()
        _, written = self.rows_store.write(rows, version)
        self.live = {v: [b for b in bs if b not in set(dirty)] for v, bs in self.live.items()} | {version: written}
        self.live = {v: bs for v, bs in self.live.items() if bs}
        self.seq += 1
        self.order = {v: n for v, n in self.order.items() if v in self.live} | {version: self.seq}
        self.chain, self.changes, self.folder = {}, [], f"{self.rows_store.root}/v={version}"
        self.columns = rows.columns
        return dirty
