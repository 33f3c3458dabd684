"""Dense identities, collated keys, missed days, isolated rules, the log by day, ranged reads."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from rosterline.operators.identity import with_identity
from rosterline.plans import links as L
from rosterline.plans import reports as R
from rosterline.plans import sync as PL
from rosterline.plans.logs import DailyLog
from rosterline.schemas import LOG_SCHEMA
from rosterline.sources.buckets import ManagedTable
from rosterline.sources.sinks import as_of, commit
from rosterline.sources.standins import Tables
from rosterline.sources.tables import quantile_bounds, range_predicates

c = F.col


@pytest.mark.parametrize("hot", [False, True])
def test_identity_is_dense_and_ordered(spark, tmp_path, hot):
    rnd = random.Random(1)
    keys = [None if i % 50 == 0 else 7 if hot and i % 3 else rnd.randrange(1000) for i in range(2000)]
    df = spark.createDataFrame([(k, f"r{i}") for i, k in enumerate(keys)], "k int, name string").repartition(5)
    out = with_identity(df, ["k"], base=str(tmp_path))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    rows = sorted(out.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(1, 2001)) and sorted(r.name for r in rows) == sorted(f"r{i}" for i in range(2000))
    assert [(r.k is not None, r.k or 0) for r in rows] == sorted((k is not None, k or 0) for k in keys)
    assert with_identity(df.limit(0), ["k"], version="none", base=str(tmp_path)).count() == 0


def test_collated_join_is_on_the_collated_key(spark):
    people = spark.createDataFrame([("C1 ", "a"), ("c2", "b"), (None, "c"), (" C1", "d")], "code string, name string")
    accounts = spark.createDataFrame([("c1", "i1"), ("C2", "i2"), (None, "i3")], "account string, id string")
    df = L.link_collated(people, accounts)
    assert sorted((r.name, r.account_id, r.match) for r in df.collect()) == [("a", "i1", "case"), ("b", "i2", "case")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "UTF8_LCASE_RTRIM" in plan and "lower(" not in plan


def test_missed_days_run_on_the_versions_of_their_time(spark, sf_small, tmp_path):
    base = str(tmp_path)
    tables = PL.tables_for(spark, sf_small)
    roster = tables.pop("roster")
    gone = roster.where("isactive = 1").withColumn("isactive", F.lit(0))
    for day, rows in (("2024-03-01", roster), ("2024-03-03", gone)):
        commit(rows, spark, "roster_days", day, base)
    assert as_of(spark, "roster_days", "2024-03-02", base).count() == roster.count()
    with pytest.raises(ValueError):
        as_of(spark, "roster_days", "2024-02-28", base)
    ledger = spark.createDataFrame([(dt.date(2024, 3, 2), 0)], "run_day date, failed_tasks long")
    managed = PL.managed_tables(tables, 4, base=base)
    after, res, ledger = PL.catch_up(spark, ledger, "2024-03-01", "2024-03-03", lambda d: as_of(spark, "roster_days", d, base), managed, base=base)
    got = {(r.run_day.isoformat(), r.task): r.affected_rows for r in res.collect()}
    plain, first = PL.run_sync(spark, {**tables, "roster": roster})
    _, second = PL.run_sync(spark, {**plain, "roster": gone})
    for day, want in (("2024-03-01", first), ("2024-03-03", second)):
        assert {t: n for (d, t), n in got.items() if d == day} == {r.task: r.affected_rows for r in want.collect()}
    assert sorted(r.run_day.isoformat() for r in ledger.collect()) == ["2024-03-01", "2024-03-02", "2024-03-03"]
    # the tables as of the first day are still there
    old = ManagedTable.load(spark, "accounts", *PL.MANAGED["accounts"], 4, "2024-03-01", base)
    assert old.frame().where("enabled_mark = 0").count() == plain["accounts"].where("enabled_mark = 0").count()
    assert after["accounts"].frame().where("enabled_mark = 0").count() > old.frame().where("enabled_mark = 0").count()


def test_a_report_that_throws_in_a_task_fails_alone(spark, sf_small, tmp_path):
    T = Tables(spark, sf_small)

    def broken(T, p):
        return R.pick_tagged(T, p, (4,)).withColumn("matnr", F.raise_error(F.lit("planned failure")).cast("string"))
    whole, none = R.rule_rows_isolated(T, T.report_rules, base=str(tmp_path))
    rows, failures = R.rule_rows_isolated(T, T.report_rules, reports={**R.REPORTS, 4: broken}, base=str(tmp_path))
    key = lambda df: sorted(tuple(str(x) for x in r) for r in df.collect())
    assert key(rows) == key(whole.where("level <> 4")) and whole.where("level = 4").count() > 0
    plain, unregistered = R.rule_rows(T, T.report_rules)
    assert key(whole) == key(plain) and key(none) == key(unregistered)
    new = {r.rule_id: r for r in failures.collect()}
    want = {r.rule_id for r in R.rules_in_force(T.report_rules, 1, 100, "ent-1", "org-1").where("level = 4 and report = 'picking'").collect()}
    assert want and {k for k, r in new.items() if r.level == 4} == want and all("planned failure" in new[k].error for k in want)


def test_log_by_day_removes_days_and_rewrites_one(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(hours=6 * i), "Information", None, "m", None) for i in range(80)] + [(99, None, "Error", "c", None, "u")]
    log = DailyLog(spark, str(tmp_path / "log"))
    df = spark.createDataFrame(rows, LOG_SCHEMA)
    log.append(df.where("log_id < 40"))
    log.append(df.where("log_id >= 40"))

    def files():
        return {(d, f) for d in os.listdir(tmp_path / "log") if d.startswith("log_day") for f in os.listdir(tmp_path / "log" / d) if f.endswith(".parquet")}
    before = files()
    cut = "2024-01-20 12:00:00"
    said = log.retain(cut, 10)
    after = files()
    assert said == {"removed": [f"2024-01-{i:02d}" for i in range(1, 10)], "rewritten": "2024-01-10"}
    assert {d for d, _ in after - before} == {"log_day=2024-01-10"}                      # one day was written
    assert {x for x in before & after} == {x for x in before if x[0] > "log_day=2024-01-10"}
    left = {r.log_id for r in log.read().collect()}
    assert left == {i for i, t, *_ in rows if t is None or t >= dt.datetime(2024, 1, 10, 12)}
    assert {(r.category, r.message) for r in log.read().collect()} == {("", "m"), ("c", "")}
    assert log.retain(cut, 10) == {"removed": [], "rewritten": None}


def test_range_predicates_cover_every_row_once(spark):
    rnd = random.Random(3)
    values = [None] * 30 + [7] * 400 + [rnd.randrange(-50, 5000) for _ in range(600)]
    df = spark.createDataFrame([(v,) for v in values], "k int")
    for bounds in (quantile_bounds(df, "k", 8), [7, 7, None, 3], [], [None]):
        preds = range_predicates("k", bounds)
        parts = [df.where(p).count() for p in preds]
        assert sum(parts) == len(values)
        meets = df.select(sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in preds).alias("n")).distinct().collect()
        assert [r.n for r in meets] == [1]
    assert len(range_predicates("k", [7, 7, None, 3])) == 3 and range_predicates("k", ["o'x"])[1] == "k >= 'o''x'"
