"""The ordered, switchable sync pipeline.

Seven steps in fixed order, each switchable and isolated: a failing step
becomes a result row and later steps still run. Step n+1 reads what step n
wrote (accounts of step 1 feed step 2, logons of step 2 feed step 3, people
of step 4 feed step 5).

Merge on read: per step only the changed rows are computed and written to
the shared checkpoint folder (their count is read from that output). The
table a later step sees is the last compacted version plus the written
deltas (insert: union; update: join with the old rows), and each table
that changed is compacted once, at the end of the run. So a run rewrites a
large table once, not once per step; no step recomputes an earlier join; the
lineage of any step is at most seven small deltas deep; and a retried step
rewrites only its own folder.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import replace
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.params import DEFAULT_PARAMS, TASKS, SyncParams
from rosterline.plans import accounts as A
from rosterline.plans import credentials as CR
from rosterline.plans import jobs as J
from rosterline.plans import links as L
from rosterline.plans.audits import all_duplicate_keys
from rosterline.plans.logs import append_log, log_entries
from rosterline.operators.change import ORIGIN, apply_changes
from rosterline.plans.registry import query
from rosterline.schemas import SYNC_RESULT_SCHEMA
from rosterline.sources.buckets import ManagedTable, buckets_for
from rosterline.sources.sinks import as_of, commit, commit_counted, exists, table_root
from rosterline.sources.standins import Tables
from rosterline.functions.exprs import in_scope_sql
from rosterline.session import checkpoint_dir

c = F.col
P = DEFAULT_PARAMS

class View(dict):
    """The tables one step sees. ``extra``: columns that name the stored rows (tables in
    buckets); ``cut``: writes what an insert found before its rows are built."""
    extra: tuple = ()
    cut = None


# step name -> (target table, kind, tables read, builder(tables, params) -> Change)
STEPS = {
    "acct_insert_missing": ("accounts", "insert", ("roster", "accounts"),
                            lambda t, p: A.acct_insert_missing(t["roster"], t["accounts"], p, cut=t.cut)),
    "logon_insert_missing": ("logons", "insert", ("accounts", "logons"),
                             lambda t, p: CR.logon_insert_missing(t["accounts"], t["logons"], p, cut=t.cut)),
    "cred_backfill": ("logons", "update", ("logons", "accounts"),
                      lambda t, p: CR.cred_backfill(t["logons"], t["accounts"], p, mode=p.live_mode, extra=t.extra)),
    "people_insert_missing": ("people", "insert", ("roster", "people"),
                              lambda t, p: J.people_insert_missing(t["roster"], t["people"], p, cut=t.cut)),
    "people_link_account": ("people", "update", ("people", "accounts"),
                            lambda t, p: L.people_link_account(t["people"], t["accounts"], extra=t.extra)),
    "acct_disable_leavers": ("accounts", "update", ("accounts", "roster"),
                             lambda t, p: A.acct_disable_leavers(t["accounts"], t["roster"], p, extra=t.extra)),
    "people_job_status": ("people", "update", ("people", "roster"),
                          lambda t, p: J.people_job_status(t["people"], t["roster"], p, extra=t.extra)),
}
# business code of each table in buckets, and the columns that updates read or set
MANAGED = {"roster": ("empcode", ["empcode"]), "accounts": ("account", ["account", "enabled_mark"]),
           "logons": ("user_id", ["user_id", "id", "password_hash", "secret_key"]), "people": ("code", ["code", "sys_user", "job_status"])}
KEYED = (("roster", "empcode"), ("accounts", "account"), ("accounts", "id"), ("logons", "user_id"), ("logons", "id"),
         ("people", "code"), ("people", "id"))


def managed_tables(tables: dict, buckets: int | None = None, version: str = "start", base: str | None = None) -> dict:
    """The tables of a run, stored in one number of buckets of their business codes: once, not for every run."""
    buckets = buckets or buckets_for(*[df for df in tables.values() if isinstance(df, DataFrame)])
    return {x: ManagedTable.create(df, x, *MANAGED[x], buckets, version, base) if isinstance(df, DataFrame) else df for x, df in tables.items()}


def _frame(table, origin: bool = False) -> DataFrame:
    return table.frame(origin) if isinstance(table, ManagedTable) else table


class StepLog:
    """Manifest of a run: one row for each finished step, written after the step's changes are.

    A run that is started again under its id takes the finished steps from here and goes on behind them.
    """

    def __init__(self, spark: SparkSession, run_id: str, base: str | None):
        self.spark, self.root = spark, f"{table_root(spark, 'sync_steps', base)}/run={run_id}"

    def read(self, step) -> dict | None:
        path = f"{self.root}/step={step}"
        return json.loads(self.spark.read.parquet(path).first()["doc"]) if exists(self.spark, f"{path}/_SUCCESS") else None

    def write(self, step, doc: dict):
        self.spark.createDataFrame([(json.dumps(doc),)], "doc string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/step={step}")


def run_sync(spark: SparkSession, tables: dict, p: SyncParams = P, run_id: str | None = None,
             base: str | None = None, check_keys: bool = True, log: DataFrame | None = None,
             paths: dict | None = None, compact: bool = True, parallel: bool = True, resume: bool = False):
    """G1 + G3: run the enabled steps in order. Returns (tables_after, results).

    ``tables`` maps roster / accounts / logons / people to DataFrames, or to
    tables in buckets (``managed_tables``), and gives back the same kind. Deltas
    go to ``<spark.checkpoint.dir>/tables/<name>_changes/v=<run>-<step>``, the
    compacted tables to ``.../tables/<name>/v=<run>``; ``paths`` (if given)
    receives the folder of each compacted table. Changes of tables in buckets
    are stored in the same buckets: their joins on the business code need no
    shuffle, and only the buckets that changed are rewritten.

    Every step sees exactly the table versions it would see if the steps ran
    one after another (the output of the last earlier step that wrote the
    table; a failed or empty step leaves the version as it was). With
    ``parallel`` the steps whose inputs are ready run as concurrent Spark jobs
    -- {1, 4}, then {2, 5, 6}, then {3, 7} with all steps on -- which changes
    wall time, not results.

    ``compact=False`` skips the end-of-run rewrite: the returned tables are
    the input versions plus the written deltas (``paths["<table>_deltas"]``
    lists them in order with their kind), for jobs that compact periodically
    instead of every run.

    ``resume=True``: a run that broke off, started again with its ``run_id`` and
    the same tables, goes on behind its finished steps (``StepLog``). A failed
    step isn't finished.
    """
    from concurrent.futures import ThreadPoolExecutor

    run_id = run_id or uuid.uuid4().hex[:12]
    base_tables = {x: t.snapshot() if isinstance(t, ManagedTable) else t for x, t in tables.items()}
    for t in base_tables.values():            # a code that fills a bucket is left to AQE, which can split it
        if isinstance(t, ManagedTable):
            t.bucketed = t.balanced()
    results, stopped = [], []
    steps = StepLog(spark, run_id, base) if resume else None

    def check_keys_step():
        # Q12 on the input tables: duplicate keys make the joins fan out. It
        # reads only the inputs, so it runs beside the first steps.
        t0 = time.time()
        known = steps.read(0) if steps else None
        n = known["n"] if known else all_duplicate_keys(SimpleNamespace(**{x: _frame(t) for x, t in base_tables.items()}), KEYED).count()
        if steps and not known:
            steps.write(0, {"n": n})
        return (0, "duplicate_keys", True, n, f"{n} duplicated keys", None, int((time.time() - t0) * 1000))

    enabled = [(i, name) for i, name in enumerate(TASKS, start=1) if p.tasks.get(name, True)]
    futures = {}

    def producer(tbl, j):
        for i, name in reversed(enabled):
            if i < j and STEPS[name][0] == tbl:
                return i
        return None

    def version(tbl, j):
        i = producer(tbl, j)
        if i is None:
            return base_tables[tbl]
        after = futures[i].result()[0]
        return after if after is not None else version(tbl, i)

    def plain_step(i, tbl, kind, build, view):
        """A step over DataFrames: (table after, rows changed, (kind, folder of the delta))."""
        ch = build(view, p)
        dpaths = {}
        rows, n = commit_counted(ch.delta, spark, f"{tbl}_changes", f"{run_id}-{i}", base, paths=dpaths,
                                 count="_n" if kind == "update" else None)
        return apply_changes(view[tbl], rows, kind) if n else None, n, (kind, dpaths[f"{tbl}_changes"]) if n else None

    def bucket_step(i, tbl, kind, build, view):
        """A step over tables in buckets."""
        frames = View({x: _frame(t, kind == "update" and x == tbl) for x, t in view.items()})
        frames.extra = ORIGIN if kind == "update" else ()
        frames.cut = lambda df: commit(df, spark, f"{tbl}_found", f"{run_id}-{i}", base)
        after = view[tbl].snapshot()
        ch = build(frames, p)
        if kind == "update":
            n = after.update(ch.delta, f"{run_id}-{i}")
        else:
            n = after.insert(ch.delta.repartition(after.buckets, after.key), f"{run_id}-{i}")
        return after if n else None, n, None

    def finished_step(tbl, kind, known, view):
        """A step that an earlier attempt finished: its stored changes."""
        if not known["n"]:
            return None, 0, None
        if isinstance(view[tbl], ManagedTable):
            after = view[tbl].snapshot()
            after.restore(known["table"])
            return after, known["n"], None
        return apply_changes(view[tbl], spark.read.parquet(known["path"]), kind), known["n"], (kind, known["path"])

    def run_step(i, name):
        tbl, kind, reads, build = STEPS[name]
        if stopped:
            raise RuntimeError("the run was broken off")
        view = View({x: version(x, i) for x in set(reads) | {tbl}})      # waits for the inputs
        t0 = time.time()
        try:
            known = steps.read(i) if steps else None
            if known:
                after, n, delta = finished_step(tbl, kind, known, view)
            else:
                after, n, delta = (bucket_step if isinstance(view[tbl], ManagedTable) else plain_step)(i, tbl, kind, build, view)
                if steps:
                    steps.write(i, {"n": n, "path": delta and delta[1], "table": after.manifest() if isinstance(after, ManagedTable) else None})
            verb = "inserted" if kind == "insert" else "updated"
            return after, (i, name, True, n, f"{verb} {n} rows of {tbl}", None, int((time.time() - t0) * 1000)), delta
        except Exception as e:  # G3: the error becomes a result row; later steps still run
            return None, (i, name, False, 0, f"failed: {type(e).__name__}", str(e),
                          int((time.time() - t0) * 1000)), None
        except BaseException:   # an interrupt ends the run: no later step starts
            stopped.append(i)
            raise

    def compacted(x, table):
        if isinstance(table, ManagedTable):
            table = table.snapshot()
            table.compact(run_id)
            return table
        return commit(table, spark, x, run_id, base, None, paths)

    with ThreadPoolExecutor(max_workers=len(enabled) + 1 if parallel else 1) as pool:
        keys_check = pool.submit(check_keys_step) if check_keys else None
        for i, name in enabled:               # submitted in step order; each waits for its inputs
            futures[i] = pool.submit(run_step, i, name)
        outcomes = {i: futures[i].result() for i, _ in enabled}      # (after, result row, delta)
        if keys_check is not None:
            results.append(keys_check.result())
        results += [outcomes[i][1] for i, _ in enabled]
        changed = sorted({STEPS[name][0] for i, name in enabled if outcomes[i][1][2] and outcomes[i][1][3]})
        if paths is not None:
            for i, name in enabled:
                if outcomes[i][2] is not None:
                    paths.setdefault(f"{STEPS[name][0]}_deltas", []).append(outcomes[i][2])
        final = {x: version(x, len(TASKS) + 1) for x in base_tables}
        if compact:                           # one rewrite per changed table per run, tables in parallel
            done = {x: pool.submit(compacted, x, final[x]) for x in changed}
            final.update({x: f.result() for x, f in done.items()})
    res = spark.createDataFrame(results, SYNC_RESULT_SCHEMA)
    if log is not None:
        entries = [("Information" if ok else "Error", "sync", msg, None) for _, _, ok, _, msg, _, _ in results]
        final["system_log"] = commit(append_log(log, log_entries(spark, entries, p.run_ts)), spark, "system_log",
                                     run_id, base)
    return final, res


def sync_report(results: DataFrame) -> DataFrame:
    """Totals (affected rows of successes only; duration of all) and the
    per-task lines in step order, as one row."""
    line = F.concat_ws(" | ", c("task"), F.when(c("success"), F.lit("success")).otherwise(F.lit("failed")),
                       F.concat(F.lit("affected="), c("affected_rows").cast("string")),
                       F.concat(F.lit("ms="), c("duration_ms").cast("string")), c("message"))
    return results.agg(
        F.count(F.when(c("success"), 1)).alias("success_count"),
        F.count(F.when(~c("success"), 1)).alias("fail_count"),
        F.sum(F.when(c("success"), c("affected_rows")).otherwise(0)).cast("bigint").alias("total_affected"),
        F.sum("duration_ms").cast("bigint").alias("total_duration_ms"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(c("step"), line.alias("line")))),
                                 lambda x: x["line"]), "\n").alias("report"))


def due_days(spark: SparkSession, ledger: DataFrame, first_day: str, today: str) -> DataFrame:
    """Days from ``first_day`` to ``today`` that have no completed run in
    ``ledger`` (column ``run_day``): a missed day is caught up, a day already
    done is not run again."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first_day)), F.to_date(F.lit(today))))
                                 .alias("day"))
    done = ledger.select(c("run_day").alias("day")).distinct()
    return days.join(done, "day", "left_anti").orderBy("day")


def mark_run_done(spark: SparkSession, ledger: DataFrame, day: str, results: DataFrame | None = None,
                  base: str | None = None) -> DataFrame:
    """Record that the run of ``day`` completed -- also when some tasks
    failed, as the reference does -- with the number of failed tasks. The
    ledger is a table in the shared folder (the reference keeps the mark in
    memory only, so a restart forgets it). A day already in the ledger is not
    added twice."""
    failed = results.where(~F.col("success")).count() if results is not None else 0
    row = spark.createDataFrame([(day, failed)], "run_day string, failed_tasks long") \
        .select(F.to_date("run_day").alias("run_day"), "failed_tasks")
    new = row.join(ledger.select("run_day"), "run_day", "left_anti")
    # a new version folder per write: never overwrite the folder being read
    return commit(ledger.unionByName(new, allowMissingColumns=True), spark, "sync_run_ledger",
                  f"{day.replace('-', '')}-{uuid.uuid4().hex[:8]}", base)


def catch_up(spark: SparkSession, ledger: DataFrame, first_day: str, today: str, roster_at, tables: dict, p: SyncParams = P,
             base: str | None = None):
    """Run every due day, in order, on the versions of its time. Returns (tables, results with ``run_day``, ledger).

    ``roster_at(day)`` gives the roster as of a day (``sinks.as_of``). ``tables``
    are the managed tables in buckets as the last completed run left them; each
    day starts from what the day before left, is saved under its day (so that
    the tables can be read as of it) and is marked in the ledger. A catch-up that
    breaks off goes on behind the finished steps of the day it was in.
    """
    results = None
    for r in due_days(spark, ledger, first_day, today).collect():          # one row a missed day
        day = r["day"].isoformat()
        now = replace(p, run_ts=f"{day} {p.run_ts.split(' ', 1)[-1]}")
        after, res = run_sync(spark, {**tables, "roster": roster_at(day)}, now, run_id=f"d{day}", base=base, resume=True)
        tables = {x: after[x] for x in tables}
        for t in tables.values():
            t.save(day)
        ledger = mark_run_done(spark, ledger, day, res, base)
        res = res.withColumn("run_day", F.lit(r["day"]))
        results = res if results is None else results.unionByName(res)
    return tables, results, ledger


def tables_for(spark, d) -> dict:
    T = Tables(spark, d)
    return {"roster": T.roster, "accounts": T.accounts, "logons": T.logons, "people": T.people}


# -------------------------------------------------------------------- queries
def _sync_results_sql() -> str:
    i1 = A._I1_SQL.strip()
    i3 = J._I3_SQL.strip()
    scope = in_scope_sql("r.gdname4", P)
    duplicates = " UNION ALL ".join(f"SELECT CAST({k} AS VARCHAR) FROM {t} GROUP BY {k} HAVING count(*) > 1" for t, k in KEYED)
    return f"""
WITH ins1 AS ({i1}),
acc1 AS (SELECT id, account, delete_mark, enabled_mark FROM accounts
         UNION ALL SELECT id, account, delete_mark, enabled_mark FROM ins1),
ins2 AS (SELECT a.id FROM acc1 a WHERE NOT EXISTS (SELECT 1 FROM logons l WHERE l.user_id = a.id)),
log2 AS (SELECT id, user_id, password_hash FROM logons UNION ALL SELECT id, id, '' FROM ins2),
c3 AS (SELECT count(*) AS n FROM log2 l WHERE (l.password_hash IS NULL OR l.password_hash = '')
       AND EXISTS (SELECT 1 FROM acc1 a WHERE a.id = l.user_id AND (a.delete_mark IS NULL OR a.delete_mark = 0))),
ins4 AS ({i3}),
ppl4 AS (SELECT id, code, sys_user, job_status FROM people
         UNION ALL SELECT id, code, sys_user, job_status FROM ins4),
c5 AS (SELECT count(*) AS n FROM ppl4 b WHERE EXISTS (SELECT 1 FROM acc1 a WHERE a.account = b.code
       AND (b.sys_user IS NULL OR b.sys_user <> a.id))),
c6 AS (SELECT count(*) AS n FROM acc1 a WHERE EXISTS (SELECT 1 FROM roster r WHERE a.account = r.empcode
       AND {scope} AND r.isactive = 0 AND (a.enabled_mark IS NULL OR a.enabled_mark <> 0))),
c7 AS (SELECT count(*) AS n FROM ppl4 b WHERE EXISTS (SELECT 1 FROM roster r WHERE b.code = r.empcode
       AND {scope} AND (r.isactive IN (0, 1) AND b.job_status <> 1 - r.isactive OR b.job_status IS NULL AND r.isactive IS NOT NULL))),
dup AS (SELECT count(*) AS n FROM (
        {duplicates}) z)
SELECT * FROM (VALUES
  (0, 'duplicate_keys', TRUE, (SELECT n FROM dup)),
  (1, 'acct_insert_missing', TRUE, (SELECT count(*) FROM ins1)),
  (2, 'logon_insert_missing', TRUE, (SELECT count(*) FROM ins2)),
  (3, 'cred_backfill', TRUE, (SELECT n FROM c3)),
  (4, 'people_insert_missing', TRUE, (SELECT count(*) FROM ins4)),
  (5, 'people_link_account', TRUE, (SELECT n FROM c5)),
  (6, 'acct_disable_leavers', TRUE, (SELECT n FROM c6)),
  (7, 'people_job_status', TRUE, (SELECT n FROM c7))
) AS v(step, task, success, affected_rows)
"""


_SYNC_SQL = _sync_results_sql()


@query("sync_results", _SYNC_SQL)
def q_sync_results(spark, d):
    _, res = run_sync(spark, tables_for(spark, d), compact=False)
    return res.select("step", "task", "success", "affected_rows")


@query("sync_totals", f"""
WITH r AS ({_SYNC_SQL.strip()})
SELECT count(CASE WHEN success THEN 1 END) AS success_count, count(CASE WHEN NOT success THEN 1 END) AS fail_count,
       CAST(SUM(CASE WHEN success THEN affected_rows ELSE 0 END) AS BIGINT) AS total_affected
FROM r
""")
def q_sync_totals(spark, d):
    _, res = run_sync(spark, tables_for(spark, d), compact=False)
    return sync_report(res).select("success_count", "fail_count", "total_affected")


@query("sync_report", f"""
WITH r AS ({_SYNC_SQL.strip()})
SELECT count(*) FILTER (success) AS success_count, CAST(sum(affected_rows) FILTER (success) AS BIGINT) AS total_affected,
       string_agg(concat_ws(' | ', task, CASE WHEN success THEN 'success' ELSE 'failed' END, concat('affected=', affected_rows)),
                  chr(10) ORDER BY step) AS report
FROM r
""")
def q_sync_report(spark, d):
    """G2's text without the durations and messages, which differ from run to run."""
    _, res = run_sync(spark, tables_for(spark, d), compact=False)
    return sync_report(res.withColumns({"duration_ms": F.lit(None).cast("bigint"), "message": F.lit(None).cast("string")})) \
        .select("success_count", "total_affected", "report")


@query("sync_run_ledger", """
SELECT CAST(day AS DATE) AS day FROM (
  SELECT unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS day FROM events)
WHERE CAST(day AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE event_type = 'signup')
""")
def q_sync_run_ledger(spark, d):
    """G4 over the event days: those without a completed run (stand-in: a day with a signup event has one)."""
    from rosterline.sources.tables import base
    days = base(spark, d, "events").select(c("ts").cast("date").alias("run_day"), c("event_type"))
    span = days.agg(F.min("run_day").alias("lo"), F.max("run_day").alias("hi")).first()
    return due_days(spark, days.where(c("event_type") == "signup"), str(span.lo), str(span.hi))


@query("sync_catch_up", f"""
SELECT task, CAST(sum(affected_rows) AS BIGINT) AS affected_rows, CAST(2 AS BIGINT) AS days
FROM ({_SYNC_SQL.strip()}) WHERE step > 0 GROUP BY task
""")
def q_sync_catch_up(spark, d):
    """Two missed days; the roster of the first lacks half of the codes, that of the second has them all."""
    base = own_base(spark, "catch-up")
    tables = tables_for(spark, d)
    roster = tables.pop("roster")
    for day, rows in (("2024-02-02", roster.where(F.pmod(F.xxhash64("empcode"), F.lit(2)) == 0)), ("2024-02-03", roster)):
        commit(rows, spark, "roster_days", day, base)
    ledger = spark.sql("SELECT DATE '2024-02-01' AS run_day, 0L AS failed_tasks")
    _, results, _ = catch_up(spark, ledger, "2024-02-01", "2024-02-03", lambda day: as_of(spark, "roster_days", day, base),
                             managed_tables(tables, base=base), base=base)
    return results.where("step > 0").groupBy("task").agg(F.sum("affected_rows").alias("affected_rows"), F.count_distinct("run_day").alias("days"))


@query("sync_bucketed", _SYNC_SQL)
def q_sync_bucketed(spark, d):
    """The run over tables in buckets, stored for it; the buckets with changes are rewritten."""
    _, res = run_sync(spark, managed_tables(tables_for(spark, d), base=own_base(spark, "bucketed")))
    return res.select("step", "task", "success", "affected_rows")


def own_base(spark, what: str) -> str:
    """A new folder in the shared one, for tables that one query makes."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


@query("delta_net", f"""
WITH linked AS (SELECT b.code, b.sys_user, min(a.id) AS id FROM (SELECT DISTINCT code, sys_user FROM people) b
                JOIN accounts a ON a.account = b.code AND (b.sys_user IS NULL OR b.sys_user <> a.id) GROUP BY ALL),
status AS (SELECT b.code, b.job_status, min(1 - r.isactive) AS st FROM (SELECT DISTINCT code, job_status FROM people) b
           JOIN roster r ON r.empcode = b.code AND {in_scope_sql("r.gdname4", P)} AND (b.job_status IS NULL OR b.job_status <> 1 - r.isactive)
                AND r.isactive IS NOT NULL GROUP BY ALL)
SELECT b.code, CASE WHEN l.code IS NULL THEN b.sys_user ELSE l.id END AS sys_user, CASE WHEN s.code IS NULL THEN b.job_status ELSE s.st END AS job_status
FROM people b LEFT JOIN linked l ON l.code = b.code AND l.sys_user IS NOT DISTINCT FROM b.sys_user
              LEFT JOIN status s ON s.code = b.code AND s.job_status IS NOT DISTINCT FROM b.job_status
WHERE l.code IS NOT NULL OR s.code IS NOT NULL
""")
def q_delta_net(spark, d):
    """Two stored updates of the people as one: the rows they hit, with the last values, by one join."""
    T = Tables(spark, d)
    people = ManagedTable.create(T.people, "people", *MANAGED["people"], buckets_for(T.people), base=own_base(spark, "net"))
    people.update(L.people_link_account(people.frame(origin=True), T.accounts, extra=ORIGIN).delta, "link")
    people.update(J.people_job_status(people.frame(origin=True), T.roster, extra=ORIGIN).delta, "status")
    return people.changed().select("code", "sys_user", "job_status")


@query("stream_sync", f"""
SELECT task, sum(affected_rows)::BIGINT AS affected_rows FROM ({_SYNC_SQL.strip()}) WHERE step > 0 GROUP BY task
""")
def q_stream_sync(spark, d):
    """The roster arrives in two files, one batch each; rows affected by each task over both."""
    from rosterline.streaming.stream_sync import stream_sync
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    tables = tables_for(spark, d)
    roster = tables.pop("roster").withColumn("change_ts", F.to_timestamp_ntz(F.lit(P.run_ts)))
    half = F.pmod(F.xxhash64("empcode"), F.lit(2))
    for i in range(2):
        roster.where(half == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    _, results = stream_sync(spark, f"{root}/in", tables, state_dir=f"{root}/state", reader_options={"maxFilesPerTrigger": "1"})
    return results.where("step > 0").groupBy("task").agg(F.sum("affected_rows").alias("affected_rows"))
