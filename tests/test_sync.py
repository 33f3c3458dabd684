"""Sync pipeline: order, switches, failure isolation, idempotence, report,
run ledger; micro-batch stream: two batches equal one batch."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rosterline.params import DEFAULT_PARAMS
from rosterline.plans import sync as PL
from rosterline.streaming.stream_sync import stream_sync

c = F.col


def _affected(res):
    return {r.task: r.affected_rows for r in res.collect()}


def test_second_run_changes_nothing(spark, sf_small):
    t1, r1 = PL.run_sync(spark, PL.tables_for(spark, sf_small))
    a1 = _affected(r1)
    assert a1["acct_insert_missing"] == 27 and all(r.success for r in r1.collect())
    t2, r2 = PL.run_sync(spark, t1)
    a2 = _affected(r2)
    assert {k: v for k, v in a2.items() if k != "duplicate_keys"} == {k: 0 for k in a2 if k != "duplicate_keys"}
    # read-after-write: every account (also the new ones) has a logon now
    assert t2["accounts"].join(t2["logons"], t2["accounts"]["id"] == t2["logons"]["user_id"], "left_anti").count() == 0


def test_switched_off_step_changes_only_its_own_effect(spark, sf_small):
    base = PL.tables_for(spark, sf_small)
    p = DEFAULT_PARAMS.with_tasks(acct_insert_missing=False)
    t, res = PL.run_sync(spark, base, p)
    tasks = [r.task for r in res.collect()]
    assert "acct_insert_missing" not in tasks and "people_job_status" in tasks
    assert t["accounts"].count() == base["accounts"].count()


def test_failing_step_becomes_a_row_and_later_steps_run(spark, sf_small, monkeypatch):
    def boom(t, p):
        raise RuntimeError("planned failure")
    steps = dict(PL.STEPS)
    tbl, kind, reads, _ = steps["people_insert_missing"]
    steps["people_insert_missing"] = (tbl, kind, reads, boom)
    monkeypatch.setattr(PL, "STEPS", steps)
    _, res = PL.run_sync(spark, PL.tables_for(spark, sf_small))
    by = {r.task: r for r in res.collect()}
    assert by["people_insert_missing"].success is False
    assert "planned failure" in by["people_insert_missing"].error
    assert by["people_job_status"].success is True
    rep = PL.sync_report(res).collect()[0]
    assert rep.fail_count == 1 and rep.success_count == 7
    assert rep.total_affected == sum(r.affected_rows for r in res.collect() if r.success)
    assert rep.report.splitlines()[0].startswith("duplicate_keys")


def test_parallel_steps_equal_sequential_steps(spark, sf_small):
    tp, rp = PL.run_sync(spark, PL.tables_for(spark, sf_small), parallel=True)
    ts, rs = PL.run_sync(spark, PL.tables_for(spark, sf_small), parallel=False)
    strip = lambda res: sorted((r.step, r.task, r.success, r.affected_rows) for r in res.collect())
    assert strip(rp) == strip(rs)
    assert _snapshot(tp) == _snapshot(ts)


def test_uncompacted_run_equals_compacted_run(spark, sf_small):
    paths = {}
    tu, ru = PL.run_sync(spark, PL.tables_for(spark, sf_small), compact=False, paths=paths)
    tc, rc = PL.run_sync(spark, PL.tables_for(spark, sf_small))
    assert _snapshot(tu) == _snapshot(tc)
    assert [k for k, _ in paths["people_deltas"]] == ["insert", "update", "update"]
    assert not any(k in paths for k in ("accounts", "people", "logons"))     # nothing compacted


def test_run_ledger_catches_up_missed_days(spark):
    import datetime as dt
    ledger = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)], "run_day date")
    got = [r.day.isoformat() for r in PL.due_days(spark, ledger, "2024-01-01", "2024-01-04").collect()]
    assert got == ["2024-01-02", "2024-01-04"]


def test_run_ledger_marks_a_day_once_even_with_failures(spark):
    import datetime as dt
    ledger = spark.createDataFrame([(dt.date(2024, 1, 1), 0)], "run_day date, failed_tasks long")
    res = spark.createDataFrame([(1, "x", False, 0, "m", "e", 1), (2, "y", True, 3, "m", None, 1)],
                                PL.SYNC_RESULT_SCHEMA)
    l2 = PL.mark_run_done(spark, ledger, "2024-01-02", res)
    assert sorted((r.run_day.isoformat(), r.failed_tasks) for r in l2.collect()) == [
        ("2024-01-01", 0), ("2024-01-02", 1)]
    l3 = PL.mark_run_done(spark, l2, "2024-01-02", res)
    assert l3.count() == 2
    assert PL.due_days(spark, l3, "2024-01-01", "2024-01-03").first().day.isoformat() == "2024-01-03"


def test_log_rows_are_appended(spark, sf_small):
    from rosterline.sources.standins import Tables
    log = Tables(spark, sf_small).system_log
    t, res = PL.run_sync(spark, PL.tables_for(spark, sf_small), log=log)
    assert t["system_log"].count() == log.count() + res.count()
    assert t["system_log"].where(c("message") == "").count() >= log.where(c("message") == "").count()


def _roster_files(spark, sf_small, folder, split):
    from rosterline.sources.standins import Tables
    r = Tables(spark, sf_small).roster.withColumn("change_ts", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    if split:
        r.where(c("empcode") < "Customer#000000080").coalesce(1).write.parquet(os.path.join(folder, "a"))
        r.where(c("empcode") >= "Customer#000000080").coalesce(1).write.parquet(os.path.join(folder, "b"))
    else:
        r.coalesce(1).write.parquet(os.path.join(folder, "a"))


def _snapshot(tables):
    out = {}
    for k in ("accounts", "people", "logons"):
        df = tables[k]
        cols = sorted(df.columns)
        out[k] = sorted(tuple(str(r[x]) for x in cols) for r in df.select(*cols).collect())
    return out


def test_stream_compacts_after_some_deltas(spark, sf_small, monkeypatch):
    from rosterline.streaming import stream_sync as S
    monkeypatch.setattr(S, "COMPACT_AFTER", 2)
    init = {k: v for k, v in PL.tables_for(spark, sf_small).items() if k != "roster"}
    d = tempfile.mkdtemp(prefix="roster-stream-")
    _roster_files(spark, sf_small, os.path.join(d, "in"), False)
    after, _ = stream_sync(spark, os.path.join(d, "in", "a"), init, state_dir=os.path.join(d, "state"))
    row = spark.read.parquet(os.path.join(d, "state", "manifest")).first()
    assert row.people.endswith("v=b0") and row.people_deltas == "[]"
    whole, _ = PL.run_sync(spark, PL.tables_for(spark, sf_small))
    assert after["people"].count() == whole["people"].count()


def test_stream_two_batches_equal_one(spark, sf_small):
    init = {k: v for k, v in PL.tables_for(spark, sf_small).items() if k != "roster"}
    results = {}
    for split in (True, False):
        d = tempfile.mkdtemp(prefix="roster-stream-")
        src = os.path.join(d, "in")
        _roster_files(spark, sf_small, src, split)
        files = sorted(os.path.join(root, f) for root, _, fs in os.walk(src) for f in fs if f.endswith(".parquet"))
        flat = os.path.join(d, "flat")
        os.makedirs(flat)
        for i, f in enumerate(files):
            os.link(f, os.path.join(flat, f"part-{i}.parquet"))
        results[split] = stream_sync(spark, flat, init, state_dir=os.path.join(d, "state"),
                                     reader_options={"maxFilesPerTrigger": "1"})
    (t_split, r_split), (t_one, r_one) = results[True], results[False]
    assert r_split.select("batch_id").distinct().count() == 2
    assert r_one.select("batch_id").distinct().count() == 1
    assert _snapshot(t_split) == _snapshot(t_one)


def test_stream_replays_a_failed_batch(spark, sf_small, monkeypatch):
    init = {k: v for k, v in PL.tables_for(spark, sf_small).items() if k != "roster"}
    d = tempfile.mkdtemp(prefix="roster-stream-")
    _roster_files(spark, sf_small, os.path.join(d, "in"), False)
    folder, state = os.path.join(d, "in", "a"), os.path.join(d, "state")
    whole, _ = stream_sync(spark, folder, init, state_dir=os.path.join(d, "other"))
    steps = dict(PL.STEPS)

    def boom(t, p):
        raise RuntimeError("planned failure " + "x" * 5000 + " the cause")
    tbl, kind, reads, _ = steps["people_job_status"]
    with monkeypatch.context() as m:
        m.setattr(PL, "STEPS", {**steps, "people_job_status": (tbl, kind, reads, boom)})
        with pytest.raises(Exception, match="the cause"):
            stream_sync(spark, folder, init, state_dir=state)
    assert not os.path.exists(os.path.join(state, "manifest"))
    after, results = stream_sync(spark, folder, init, state_dir=state)
    assert results.where("not success").count() == 0
    assert _snapshot(after) == _snapshot(whole)


def test_stream_leaves_unchanged_tables_where_they_are(spark, sf_small):
    init = {k: v for k, v in PL.tables_for(spark, sf_small).items() if k != "roster"}
    d = tempfile.mkdtemp(prefix="roster-stream-")
    folder, state = os.path.join(d, "in"), os.path.join(d, "state")
    _roster_files(spark, sf_small, folder, False)
    stream_sync(spark, os.path.join(folder, "a"), init, state_dir=state)
    first = spark.read.parquet(f"{state}/manifest").first()
    again = spark.read.parquet(os.path.join(folder, "a")).limit(3)          # nothing new
    again.coalesce(1).write.mode("append").parquet(os.path.join(folder, "a"))
    stream_sync(spark, os.path.join(folder, "a"), init, state_dir=state)
    rows = {r.batch_id: r for r in spark.read.parquet(f"{state}/manifest").collect()}
    assert len(rows) == 2 and all(r.accounts == first.accounts and r.people == first.people for r in rows.values())


def test_last_per_code_is_deterministic_on_ties(spark):
    from rosterline.streaming.stream_sync import last_per_code
    b = spark.createDataFrame(
        [("C1", "a", "X", 1, "2024-01-01 00:00:00"), ("C1", "b", "X", 0, "2024-01-01 00:00:00"),
         ("C1", "z", "X", 1, "2023-12-31 00:00:00"), ("C2", "q", "Y", 1, "2024-01-02 00:00:00")],
        "empcode string, empname string, gdname4 string, isactive int, change_ts string") \
        .withColumn("change_ts", F.to_timestamp_ntz("change_ts"))
    got = sorted(tuple(r) for r in last_per_code(b.repartition(3)).collect())
    assert got == [("C1", "b", "X", 0), ("C2", "q", "Y", 1)]


def test_stream_ignores_rows_that_arrive_late(spark, sf_small):
    """Two files with contradicting flags of the same people, in either order of arrival: the newer row decides."""
    init = {k: v for k, v in PL.tables_for(spark, sf_small).items() if k != "roster"}
    people = init["people"].where("job_status = 0").select("code").orderBy("code").limit(5)
    old = people.select(c("code").alias("empcode"), F.lit("n").alias("empname"), F.lit("BUILDING").alias("gdname4"), F.lit(0).alias("isactive"),
                        F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")).alias("change_ts"))
    new = old.withColumns({"isactive": F.lit(1), "change_ts": F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00"))})
    out = []
    for files in ([old, new], [new, old]):
        d = tempfile.mkdtemp(prefix="roster-stream-")
        for i, df in enumerate(files):
            df.coalesce(1).write.parquet(os.path.join(d, f"tmp{i}"))
            part = next(x for x in os.listdir(os.path.join(d, f"tmp{i}")) if x.endswith(".parquet"))
            os.makedirs(os.path.join(d, "in"), exist_ok=True)
            os.link(os.path.join(d, f"tmp{i}", part), os.path.join(d, "in", f"p{i}.parquet"))
            os.utime(os.path.join(d, "in", f"p{i}.parquet"), (1_700_000_000 + i, 1_700_000_000 + i))
        after, res = stream_sync(spark, os.path.join(d, "in"), init, state_dir=os.path.join(d, "state"), reader_options={"maxFilesPerTrigger": "1"})
        assert res.select("batch_id").distinct().count() == 2
        rows = after["people"].join(people, "code", "left_semi").select("code", "job_status").collect()
        out.append(sorted(map(tuple, rows)))
        if files[0] is new:          # the late file changes nobody's status
            assert res.where("batch_id = 1 and task = 'people_job_status'").first().affected_rows == 0
    assert out[0] == out[1] and all(status == 0 for _, status in out[0])
