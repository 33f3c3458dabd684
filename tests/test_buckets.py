"""Managed tables in buckets: joins without a shuffle, net updates, compaction of touched buckets, runs that go on."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterline.operators.change import ORIGIN
from rosterline.plans import accounts as A
from rosterline.plans import jobs as J
from rosterline.plans import links as L
from rosterline.plans import sync as PL
from rosterline.sources import buckets as B
from rosterline.sources.buckets import ManagedTable

c = F.col
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
PEOPLE = "id string, code string, name string, sys_user string, job_status int, group_id string"


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def values(df):
    return Counter(tuple(str(r[x]) for x in sorted(df.columns)) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_steps_on_the_code_have_no_exchange(spark, sf_small, tmp_path, no_broadcast):
    m = PL.managed_tables(PL.tables_for(spark, sf_small), 8, base=str(tmp_path))
    t = {x: m[x].frame() for x in m}
    people, accounts = m["people"].frame(origin=True), m["accounts"].frame(origin=True)
    found = {}
    keep = lambda name: lambda df: found.setdefault(name, df)
    A.acct_insert_missing(t["roster"], t["accounts"], cut=keep("step 1"))
    J.people_insert_missing(t["roster"], t["people"], cut=keep("step 4"))
    found["step 5"] = L.people_link_account(people, t["accounts"], extra=ORIGIN).delta
    found["step 6"] = A.acct_disable_leavers(accounts, t["roster"], extra=ORIGIN).delta
    found["step 7"] = J.people_job_status(people, t["roster"], extra=ORIGIN).delta
    for name, df in found.items():
        assert "Exchange" not in plan(df) and plan(df).count("Bucketed: true") == 2, (name, plan(df))
    # the second update reads the first one's changes, still without a shuffle
    m["people"].update(found["step 5"], "link")
    again = J.people_job_status(m["people"].frame(origin=True), t["roster"], extra=ORIGIN).delta
    assert "Exchange" not in plan(again) and plan(again).count("Join") == 2, plan(again)


def test_bucketed_run_equals_plain_run(spark, sf_small, tmp_path):
    tables = PL.tables_for(spark, sf_small)
    plain, res = PL.run_sync(spark, tables)
    many = PL.managed_tables(tables, 16, base=str(tmp_path))
    for compact in (False, True):
        got, res2 = PL.run_sync(spark, many, run_id=f"r{compact}", base=str(tmp_path), compact=compact)
        assert [(r.step, r.affected_rows) for r in res.collect()] == [(r.step, r.affected_rows) for r in res2.collect()]
        for x in ("accounts", "logons", "people"):
            assert values(got[x].frame()) == values(plain[x].select(*got[x].frame().columns))
            assert values(many[x].frame()) == values(tables[x])           # the input is as it was
    assert not any(got[x].chain for x in got)


def random_people(seed, n=400):
    rnd = random.Random(seed)
    return [(rnd.choice(["i", None, str(i)]), rnd.choice([None, "HOT", "HOT", f"C{i % 90}"]), "n", rnd.choice([None, "a1", "a2", "zz"]),
             rnd.choice([0, 1, None]), None) for i in range(n)]


def test_net_update_equals_the_chain(spark, tmp_path):
    """Updates and inserts in turn, with repeated, NULL and hot codes; inserted rows must not meet earlier updates."""
    rnd = random.Random(5)
    people = spark.createDataFrame(random_people(1), PEOPLE)
    table, state = ManagedTable.create(people, "people", "code", ["code", "sys_user", "job_status"], 8, base=str(tmp_path)), people
    roster = lambda: spark.createDataFrame(
        [(rnd.choice(["HOT", f"C{i}"]), "n", "BUILDING", rnd.choice([0, 1, None])) for i in range(90)],
        "empcode string, empname string, gdname4 string, isactive int")
    accounts = lambda: spark.createDataFrame(
        [(rnd.choice(["a0", "a1", "a3", f"a{i}"]), rnd.choice(["HOT", f"C{i}"]), "n", 0, 1, "o", "e") for i in range(90)],
        "id string, account string, real_name string, delete_mark int, enabled_mark int, org string, enterprise_id string")
    for i in range(3):
        r, a = roster(), accounts()
        ch = L.people_link_account(state, a)
        assert table.update(L.people_link_account(table.frame(origin=True), a, extra=ORIGIN).delta, f"l{i}") == ch.count()
        state = spark.createDataFrame(ch.after.collect(), PEOPLE)
        new = spark.createDataFrame(random_people(10 + i, 60), PEOPLE)
        table.insert(new, f"n{i}")
        state = state.union(new)
        ch = J.people_job_status(state, r)
        assert table.update(J.people_job_status(table.frame(origin=True), r, extra=ORIGIN).delta, f"s{i}") == ch.count()
        state = spark.createDataFrame(ch.after.collect(), PEOPLE)
        assert values(table.frame()) == values(state)
    assert plan(table.frame()).count("Join") == 1                 # six updates, one join
    table.compact("done")
    assert values(table.frame()) == values(state) and "Join" not in plan(table.frame())


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    people = spark.createDataFrame([(f"p{i}", f"C{i}", "n", None, 0, None) for i in range(300)], PEOPLE)
    table = ManagedTable.create(people, "people", "code", ["code", "sys_user", "job_status"], 16, base=str(tmp_path))
    before = {b for b in table.live["start"]}
    roster = spark.createDataFrame([("C7", "n", "BUILDING", 0), ("C9", "n", "BUILDING", 0)], "empcode string, empname string, gdname4 string, isactive int")
    assert table.update(J.people_job_status(table.frame(origin=True), roster, extra=ORIGIN).delta, "u1") == 2
    dirty = table.compact("c1")
    assert 1 <= len(dirty) <= 2 and set(table.live["start"]) == before - set(dirty) and table.live["c1"] == dirty
    folder = f"{table.rows_store.root}/v=c1"
    assert sorted(x for x in os.listdir(folder) if x.startswith("_b")) == sorted(f"_b={b}" for b in dirty)
    assert sorted(r.code for r in table.frame().where("job_status = 1").collect()) == ["C7", "C9"] and table.frame().count() == 300


def test_saved_table_is_read_as_of_a_version(spark, tmp_path):
    people = spark.createDataFrame([(f"p{i}", f"C{i}", "n", None, 0, None) for i in range(30)], PEOPLE)
    args = ("people", "code", ["code", "sys_user", "job_status"], 4)
    table = ManagedTable.create(people, *args, base=str(tmp_path))
    table.save("monday")
    table.insert(people.limit(5), "more")
    table.compact("c")
    table.save("tuesday")
    counts = [ManagedTable.load(spark, *args, v, str(tmp_path)).frame().count() for v in ("monday", "tuesday")]
    assert counts == [30, 35]
    spark.sql(f"DROP TABLE {table.rows_store.ident}")             # as in a new session: only the folders are left
    assert ManagedTable.load(spark, *args, "tuesday", str(tmp_path)).frame().count() == 35


def test_a_code_that_fills_a_bucket_is_read_without_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "LARGE_ROWS", 100)
    people = spark.createDataFrame([(f"p{i}", "HOT" if i % 3 else f"C{i}", "n", None, 0, None) for i in range(900)], PEOPLE)
    table = ManagedTable.create(people, "people", "code", ["code", "sys_user", "job_status"], 16, base=str(tmp_path))
    assert not table.balanced()
    table.bucketed = False
    assert table.frame().count() == 900 and "Bucketed: true" not in plan(table.frame().groupBy("code").count())


@pytest.mark.parametrize("managed", [False, True])
def test_a_broken_run_goes_on_behind_its_finished_steps(spark, sf_small, tmp_path, monkeypatch, managed):
    """The run is killed after each step in turn; started again it computes only the rest and ends with the same tables."""
    source = PL.tables_for(spark, sf_small)
    tables = PL.managed_tables(source, 8, base=str(tmp_path / "t")) if managed else source
    frame = lambda t: t.frame() if managed else t
    whole, res = PL.run_sync(spark, tables, run_id="whole", base=str(tmp_path / "t"), parallel=False)
    want, rows = {x: values(frame(whole[x])) for x in ("accounts", "logons", "people")}, [(r.step, r.affected_rows) for r in res.collect()]
    steps, names, ran = dict(PL.STEPS), list(PL.STEPS), []

    class Killed(BaseException):
        pass

    def watched(name, stop):
        tbl, kind, reads, build = steps[name]

        def run(t, p):
            if name == stop:
                raise Killed
            ran.append(name)
            return build(t, p)
        return tbl, kind, reads, run
    for stop in names[1:]:
        monkeypatch.setattr(PL, "STEPS", {n: watched(n, stop) for n in names})
        with pytest.raises(Killed):
            PL.run_sync(spark, tables, run_id="again", base=str(tmp_path / "t"), parallel=False, resume=True)
    monkeypatch.setattr(PL, "STEPS", {n: watched(n, None) for n in names})
    out, res = PL.run_sync(spark, tables, run_id="again", base=str(tmp_path / "t"), parallel=False, resume=True)
    assert {x: values(frame(out[x])) for x in want} == want
    assert [(r.step, r.affected_rows) for r in res.collect()] == rows
    assert Counter(ran) == Counter({n: 1 for n in names})          # every step was computed once over all attempts
