"""Updates on tables whose ids repeat or are NULL: no row is lost, doubled or missed."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from rosterline.operators.change import apply_changes, copies_of, update_from
from rosterline.plans import credentials as CR
from rosterline.plans import jobs as J
from rosterline.plans import sync as PL

c = F.col
ROSTER = "empcode string, empname string, gdname4 string, isactive int"
PEOPLE = "id string, code string, name string, sys_user string, job_status int, group_id string"


def values(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("people, want", [
    # one id, different codes, one of them hit
    ([("p", "C1", "x", None, 0, None), ("p", "C2", "y", None, 0, None)],
     [("p", "C1", "x", None, 1, None), ("p", "C2", "y", None, 0, None)]),
    # equal rows, all hit
    ([("p", "C1", "x", None, 0, None)] * 3, [("p", "C1", "x", None, 1, None)] * 3),
    # no id
    ([(None, "C1", "x", None, 0, None), (None, "C9", "x", None, 0, None)],
     [(None, "C1", "x", None, 1, None), (None, "C9", "x", None, 0, None)]),
    # NULLs in the other columns too
    ([(None, "C1", None, None, None, None)] * 2, [(None, "C1", None, None, 1, None)] * 2),
])
def test_job_status_without_unique_ids(spark, people, want):
    roster = spark.createDataFrame([("C1", "n", "BUILDING", 0)] * 2 + [("C1", "m", "HOUSEHOLD", 0)], ROSTER)
    target = spark.createDataFrame(people, PEOPLE)
    change = J.people_job_status(target, roster)
    assert values(change.after.select(*target.columns)) == Counter(want)
    assert values(change.rows) == Counter(w for w in want if w not in people)
    assert values(apply_changes(target, change.delta, "update")) == Counter(want)
    assert change.delta.agg(F.sum("_n")).first()[0] == change.count()


def test_every_update_keeps_the_number_of_rows(spark):
    t = spark.createDataFrame([("a", 1)] * 5 + [("a", None), (None, 1), ("b", 2)], "k string, v int")
    s = spark.createDataFrame([("a", 7), ("a", 8), ("a", 7), ("b", None)], "k string, n int")
    change = update_from(t, s, c("t.k") == c("s.k"), None, {"v": c("s.n"), "by": F.lit("me")})
    assert values(change.after) == Counter({("a", 7, "me"): 6, (None, 1, None): 1, ("b", None, "me"): 1})
    assert change.count() == 7


def test_chain_of_steps_with_a_doubled_account_id(spark, sf_small):
    tables = PL.tables_for(spark, sf_small)
    twice = tables["accounts"].orderBy("id").limit(1)
    tables["accounts"] = tables["accounts"].unionByName(twice)
    tables["logons"] = tables["logons"].join(twice.select("id"), "id", "left_anti")
    key = twice.first().id
    after, results = PL.run_sync(spark, tables)
    assert all(r.success for r in results.collect())
    logons = after["logons"].where(c("user_id") == key).collect()
    assert len(logons) == 2 and all(r.password_hash for r in logons)


def test_copies_are_numbered_in_ranges(spark, monkeypatch):
    from rosterline.operators import change
    monkeypatch.setattr(change, "COPIES", 100)
    df = spark.createDataFrame([("K", 1050), ("L", 3)], "k string, n long")
    out = copies_of(df, "n", "i")
    assert sorted(r.i for r in out.where("k = 'K'").collect()) == list(range(1, 1051))
    assert sorted(r.i for r in out.where("k = 'L'").collect()) == [1, 2, 3]
    assert out.where("k = 'K'").select(F.spark_partition_id()).distinct().count() > 1


def test_credentials_need_a_secret(spark):
    from rosterline.params import SyncParams
    logons = spark.createDataFrame([("a", "a", None, None)], "id string, user_id string, password_hash string, secret_key string")
    accounts = spark.createDataFrame([("a", 0, 1)], "id string, delete_mark int, enabled_mark int")
    with pytest.raises(ValueError):
        CR.cred_backfill(logons, accounts, SyncParams())
    one, other = (CR.cred_backfill(logons, accounts, SyncParams(default_secret="s", run_salt=x)).rows.first() for x in "ab")
    assert one.secret_key != other.secret_key and one.password_hash != other.password_hash
