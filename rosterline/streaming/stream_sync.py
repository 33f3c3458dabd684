"""Roster files arriving in a folder drive the sync pipeline per micro-batch.

``readStream`` over the roster folder -> ``foreachBatch``: each batch keeps
the last row per code (``max`` of (change time, row), an aggregate that
combines map-side, so a hot code is pre-aggregated) and of these the rows that
are newer than what earlier batches brought for the code: a file that arrives
late cannot undo a newer row. Then ``run_sync`` runs with them as the roster.

The managed tables are stored in buckets when the stream first starts. Every
batch writes only its changed rows, under version ``b<batch_id>`` in the shared
folder; the updates since the last compaction are read as one net update, whatever
their number. A one-row manifest per batch records what makes up each table; the
buckets with changes are rewritten once a table has COMPACT_AFTER deltas. A
replayed batch (a failure before the stream checkpoint committed) finds its own
manifest row and is skipped, or, if it died before writing it, goes on behind
the steps that it had finished: each batch is applied exactly once. A batch in
which a step fails is not applied: the query fails, and a restart replays it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.params import DEFAULT_PARAMS, SyncParams
from rosterline.plans.sync import MANAGED as KEYS
from rosterline.plans.sync import run_sync
from rosterline.session import checkpoint_dir
from rosterline.sources.buckets import ManagedTable, buckets_for
from rosterline.sources.sinks import children, commit

ROSTER_STREAM_SCHEMA = "empcode string, empname string, gdname4 string, isactive int, change_ts timestamp_ntz"
MANAGED = ("accounts", "logons", "people")
COMPACT_AFTER = 24        # deltas of a table


def newest_rows(batch: DataFrame) -> DataFrame:
    """The newest row of each code, as ``(empcode, _r)`` with ``_r`` = (change time, other columns);
    rows with the same change time are ordered by their values, so the choice repeats."""
    cols = [c for c in batch.columns if c not in ("empcode", "change_ts")]
    return batch.groupBy("empcode").agg(F.max(F.struct("change_ts", *cols)).alias("_r"))


def last_per_code(batch: DataFrame) -> DataFrame:
    """Keep the newest row of each code in the batch, without its change time."""
    return newest_rows(batch).select("empcode", *[f"_r.{c}" for c in batch.columns if c not in ("empcode", "change_ts")])


def not_older(newest: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows of ``newest(empcode, _r)`` that are newer than the newest one of ``seen(empcode, _r)`` for the code.

    A NULL code is a code like the others; a NULL change time is older than any.
    """
    last = seen.groupBy("empcode").agg(F.max("_r").alias("_last")).withColumnRenamed("empcode", "_code")
    both = newest.join(last, newest["empcode"].eqNullSafe(last["_code"]), "left")
    return both.where(F.col("_last").isNull() | (F.col("_r") > F.col("_last"))).select("empcode", "_r")


def _load_manifest(spark, base):
    """The newest batch's manifest row, or None before the first batch; older ones aren't read.

    Only a folder that isn't there means "no manifest"; one that can't be read
    is an error, never a fresh start."""
    done = [int(x[2:]) for x in children(spark, f"{base}/manifest") if x.startswith("b=") and "_SUCCESS" in children(spark, f"{base}/manifest/{x}")]
    return spark.read.parquet(f"{base}/manifest/b={max(done)}").first().asDict() if done else None


def stream_sync(spark: SparkSession, roster_dir: str, initial: dict, state_dir: str | None = None,
                p: SyncParams = DEFAULT_PARAMS, ckpt: str | None = None, schema: str = ROSTER_STREAM_SCHEMA,
                reader_options: dict | None = None, buckets: int | None = None):
    """Run the pipeline once per available batch of roster files (availableNow).

    ``initial`` holds the accounts / logons / people DataFrames used before the
    first batch; ``buckets`` is how many the stored tables have. ``reader_options``
    go to the stream reader (for example ``maxFilesPerTrigger``). Returns
    (tables, results) where results has one row per (batch, step).
    """
    base = (state_dir or f"{checkpoint_dir(spark).rstrip('/')}/stream_sync").rstrip("/")
    collected, held = [], {}

    def first_tables():
        """The tables before the first batch, stored once however often the stream starts."""
        n = None
        for k in MANAGED:
            if ManagedTable.saved(spark, k, "start", base):
                t = ManagedTable.load(spark, k, *KEYS[k], _buckets(spark, base, k), "start", base)
            else:
                n = n or buckets or buckets_for(*[initial[x] for x in MANAGED])
                t = ManagedTable.create(initial[k], k, *KEYS[k], n, "start", base)
                spark.createDataFrame([(n,)], "n int").coalesce(1).write.mode("overwrite").parquet(f"{base}/buckets/{k}")
                t.save("start")
            held[k] = t
        held["seen"] = None

    def current_tables():
        """(tables, last batch applied)."""
        doc = _load_manifest(spark, base)
        if doc is None:
            if not held:
                first_tables()
            return -1
        if held.get("batch") != doc["batch_id"]:
            for k in (*MANAGED, "seen"):
                key, state = KEYS.get(k, ("empcode", ["empcode"]))
                held[k] = ManagedTable(spark, k, key, state, _buckets(spark, base, "accounts"), base)
                held[k].restore(json.loads(doc[f"{k}_doc"]))
            held["batch"] = doc["batch_id"]
        return doc["batch_id"]

    def on_batch(batch: DataFrame, batch_id: int):
        last = current_tables()
        if batch_id <= last:          # already applied: replay after a restart
            return
        tables = {k: held[k].snapshot() for k in MANAGED}
        newest, seen = newest_rows(batch), held["seen"]
        if seen is not None:
            newest = not_older(newest, seen.frame())
        newest = commit(newest, spark, "roster_batch", f"b{batch_id}", base)
        tables["roster"] = newest.select("empcode", "_r.*").drop("change_ts")
        out, res = run_sync(spark, tables, p, run_id=f"b{batch_id}", base=base, compact=False, resume=True)
        failed = [f"{r.task}: {r.error}" for r in res.where(~F.col("success")).collect()]
        if failed:
            # a batch holds only its own roster rows, so no later one would make up for it:
            # nothing is marked as applied, and the stream replays the batch
            raise RuntimeError(f"batch {batch_id} failed: " + "; ".join(failed))
        if seen is None:
            seen = ManagedTable.create(newest, "seen", "empcode", ["empcode"], tables["accounts"].buckets, f"b{batch_id}", base)
        else:
            seen = seen.snapshot()
            seen.insert(newest.repartition(seen.buckets, "empcode"), f"b{batch_id}")
            if len(seen.changes) >= COMPACT_AFTER:
                last_rows = seen.frame().groupBy("empcode").agg(F.max("_r").alias("_r"))
                seen = ManagedTable.create(last_rows, "seen", "empcode", ["empcode"], seen.buckets, f"c{batch_id}", base)
        doc = {"batch_id": batch_id, "seen_doc": json.dumps(seen.manifest())}
        for k in MANAGED:             # a batch writes its changes; the buckets they are in are rewritten once in COMPACT_AFTER of them
            if len(out[k].changes) >= COMPACT_AFTER:
                out[k].compact(f"b{batch_id}")
            doc |= {k: out[k].folder, f"{k}_deltas": json.dumps(out[k].changes), f"{k}_doc": json.dumps(out[k].manifest())}
        spark.createDataFrame([doc]).coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest/b={batch_id}")
        held.update({k: out[k] for k in MANAGED} | {"seen": seen, "batch": batch_id})
        collected.append(res.withColumn("batch_id", F.lit(batch_id)))

    q = (spark.readStream.schema(schema).options(**(reader_options or {})).parquet(roster_dir)
         .writeStream.foreachBatch(on_batch)
         .option("checkpointLocation", ckpt or f"{base}/_stream_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    current_tables()
    results = None
    for r in collected:
        results = r if results is None else results.unionByName(r)
    return {k: held[k].frame() for k in MANAGED}, results


def _buckets(spark, base: str, name: str) -> int:
    return spark.read.parquet(f"{base}/buckets/{name}").first()["n"]
