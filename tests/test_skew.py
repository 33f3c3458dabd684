"""One business code holding a third of all rows: results stay exact with
shuffle joins and AQE skew splitting forced, and no plan uses a window."""

import contextlib
import io
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rosterline.operators.audit import SALTS
from rosterline.operators.change import number_copies
from rosterline.plans import accounts as A
from rosterline.plans import jobs as J

c = F.col
ROSTER = "empcode string, empname string, gdname4 string, isactive int"
PEOPLE = "id string, code string, name string, sys_user string, job_status int, group_id string"
ACCTS = "id string, account string, real_name string, delete_mark int, enabled_mark int, org string, enterprise_id string"

FORCE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    n = 3000
    roster = []
    for i in range(n):
        code = "HOT" if i % 3 == 0 else f"C{i:05d}"
        roster.append((code, f"n{i % 5}", rnd.choice(["BUILDING", "HOUSEHOLD", "MACHINERY"]),
                       rnd.choice([0, 1, None])))
    people = [(f"p{i}", f"C{i:05d}" if i else "HOT", "x", None, rnd.choice([0, 1, None]), None)
              for i in range(0, n, 2)]
    return roster, people


def _brute_job_status(roster, people, depts):
    by_code = defaultdict(list)
    for r in roster:
        by_code[r[0]].append(r)
    out = {}
    for pid, code, _, _, st, _ in people:
        news = []
        for _, _, dept, fl in by_code.get(code, []):
            if dept not in depts or fl is None:
                continue
            if st is None or (fl == 0 and st != 1) or (fl == 1 and st != 0):
                news.append(1 if fl == 0 else 0 if fl == 1 else st)
        if news:
            nn = [x for x in news if x is not None]
            out[pid] = min(nn) if nn else None
    return out


def test_update_with_hot_code_is_exact(spark, skewed):
    roster, people = skewed
    with conf(spark, FORCE):
        r = spark.createDataFrame(roster, ROSTER).repartition(8)
        p = spark.createDataFrame(people, PEOPLE).repartition(8)
        ch = J.people_job_status(p, r, scope="config")
        got = {row.id: row.job_status for row in ch.rows.collect()}
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            ch.rows.explain()
    assert got == _brute_job_status(roster, people, {"AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"})
    assert "Window" not in buf.getvalue() and "SortMergeJoin" in buf.getvalue()


def test_insert_with_hot_duplicates_is_exact(spark, skewed):
    roster, _ = skewed
    hot_copies = [("HOTDUP", "same", "BUILDING", 1)] * 1500
    with conf(spark, FORCE):
        r = spark.createDataFrame(roster + hot_copies, ROSTER).repartition(8)
        acc = spark.createDataFrame([("a0", "C00001", "x", 0, 1, "o", "e")], ACCTS)
        ch = A.acct_insert_missing(r, acc)
        got = ch.rows.select("id", "account").collect()
    expect = [x for x in roster + hot_copies
              if x[2] in ("BUILDING", "HOUSEHOLD") and x[3] == 1 and x[0] != "C00001"]
    assert len(got) == len(expect)
    assert len({g.id for g in got}) == len(got)          # every copy has its own id
    assert sum(1 for g in got if g.account == "HOTDUP") == 1500


def test_number_copies_spreads_a_hot_key(spark, monkeypatch):
    from rosterline.operators import change
    monkeypatch.setattr(change, "COPIES", 100)
    df = spark.createDataFrame([("K", 1)] * 5000 + [("L", 2)] * 3, "k string, v int")
    with conf(spark, FORCE):
        n = number_copies(df, ["k", "v"])
        per_part = n.where(c("k") == "K").groupBy(F.spark_partition_id().alias("p")).count().collect()
        nums = sorted(r.copy_no for r in n.where(c("k") == "K").select("copy_no").collect())
        small = sorted(r.copy_no for r in n.where(c("k") == "L").select("copy_no").collect())
    assert nums == list(range(1, 5001)) and small == [1, 2, 3]
    assert len(per_part) > 1          # 5000 copies of one row are produced by several tasks


def test_link_update_with_code_hot_on_both_sides(spark):
    from rosterline.plans import links as L
    rnd = random.Random(3)
    people = [(f"p{i:04d}", "HOT" if i % 3 == 0 else f"C{i}", "x",
               rnd.choice([None, "a0005", "a0001", "zz"]), 0, None) for i in range(900)]
    accts = [(f"a{i:04d}", "HOT" if i % 3 == 0 else f"C{i}", "n", 0, 1, "o", "e") for i in range(900)]
    with conf(spark, FORCE):
        ch = L.people_link_account(spark.createDataFrame(people, PEOPLE), spark.createDataFrame(accts, ACCTS))
        got = {r.id: r.sys_user for r in ch.rows.collect()}
        src = L.two_smallest_ids(spark.createDataFrame(accts, ACCTS))
        per_code = max(r["count"] for r in src.groupBy("account").count().collect())
    ids = defaultdict(list)
    for aid, code, *_ in accts:
        ids[code].append(aid)
    expect = {}
    for pid, code, _, su, _, _ in people:
        passing = [a for a in ids.get(code, []) if su is None or su != a]
        if passing:
            expect[pid] = min(passing)
    assert got == expect
    assert per_code <= 2 * SALTS  # 300 people x 300 accounts of one code meet a few source rows, not 300


def test_profiles_count_pairs_without_building_them(spark):
    from rosterline.operators.audit import match_profile
    from rosterline.plans import links as L
    rnd = random.Random(11)
    people = [(f"p{i}", "HOT" if i % 3 == 0 else f"C{i % 50}", "x",
               rnd.choice([None, "a1", "a2", "zz"]), 0, None) for i in range(600)]
    accts = [(rnd.choice(["a1", "a2", "a3", None]), "HOT" if i % 3 == 0 else f"C{i % 40}", "n", 0, 1, "o", "e")
             for i in range(600)]
    p, a = spark.createDataFrame(people, PEOPLE), spark.createDataFrame(accts, ACCTS)
    with conf(spark, FORCE):
        fast = L.link_profile(p, a).first().asDict()
        j = p.alias("b").join(a.alias("a"), c("b.code") == c("a.account"), "left")
        su, aid = c("b.sys_user"), c("a.id")
        slow = match_profile(j, {"null_count": su.isNull(), "matched_count": su.isNotNull() & (su == aid),
                                 "mismatched_count": su.isNotNull() & (su != aid)}, total="total_records").first().asDict()
        lc = {r.check_name: r.cnt for r in L.link_counts(p, a).collect()}
    assert fast == slow
    assert lc["matched_pairs"] == p.join(a, p["code"] == a["account"]).count()


def final_plan(df):
    """The plan that ran, after AQE."""
    df.write.format("noop").mode("overwrite").save()
    rows = df._jdf.queryExecution()
    df.collect()
    return rows.executedPlan().toString()


HOT, COLD = 60_000, 40_000


def hot_roster(spark, share=3):
    code = F.when(c("id") % share == 0, "HOT").otherwise(F.concat(F.lit("C"), c("id")))
    return spark.range(HOT).select(code.alias("empcode"), F.concat(F.lit("n"), c("id")).alias("empname"), F.lit("BUILDING").alias("gdname4"),
                                   F.lit(1).alias("isactive"))


def hot_people(spark, share=3):
    code = F.when(c("id") % share == 0, "HOT").otherwise(F.concat(F.lit("C"), c("id") * 2))
    return spark.range(COLD).select(F.concat(F.lit("p"), c("id")).alias("id"), code.alias("code"), F.concat(F.lit("name "), c("id")).alias("name"),
                                    F.md5(c("id").cast("string")).alias("sys_user"), F.lit(1).alias("job_status"), F.lit(None).cast("string").alias("group_id"))


def hot_accounts(spark, share=3):
    code = F.when(c("id") % share == 0, "HOT").otherwise(F.concat(F.lit("C"), c("id")))
    return spark.range(COLD).select(F.concat(F.lit("a"), c("id")).alias("id"), code.alias("account"), F.lit("n").alias("real_name"),
                                    F.lit(0).alias("delete_mark"), F.hash("id").alias("enabled_mark"), F.lit("o").alias("org"), F.lit("e").alias("enterprise_id"))


def _cases(spark):
    from rosterline.operators.audit import missing_from
    from rosterline.plans import credentials as CR
    from rosterline.plans import links as L
    from rosterline.plans import reports as R
    some = spark.range(30_000).select(F.concat(F.lit("C"), c("id") * 3).alias("account"), F.concat(F.lit("a"), c("id")).alias("id"))
    lines = spark.range(HOT).select(
        c("id").alias("picking_id"), F.when(c("id") % 3 == 0, 1).otherwise(c("id")).alias("item_id"), F.lit("s").alias("src_doc_no"),
        c("id").cast("string").alias("doc_no"), F.concat(F.lit("M"), c("id")).alias("matnr"), F.lit(1).alias("qty"),
        F.lit(None).cast("timestamp_ntz").alias("requisition_ts"), F.lit("x").alias("prep_status"))
    ids = spark.range(50_000)
    items = ids.select("id", F.lit("i").alias("item_name"), F.lit("s").alias("item_specs"))
    keepers = ids.select(c("id").alias("item_id"), F.lit("k").alias("keeper"))
    heads = ids.select("id", F.lit("r").alias("remark"))
    return {
        "missing_from": lambda: missing_from(hot_people(spark), some, "code", "account"),
        "insert_missing": lambda: A.acct_insert_missing(hot_roster(spark), hot_accounts(spark, 7).where("account <> 'HOT'")).rows,
        "update_from": lambda: J.people_job_status(hot_people(spark), hot_roster(spark)).rows,
        "people_link_account": lambda: L.people_link_account(hot_people(spark), hot_accounts(spark)).rows,
        "pick_base": lambda: R.pick_base(lines, items, heads, keepers),
        "link_profile": lambda: L.link_profile(hot_people(spark), hot_accounts(spark)),
        "logon_insert_outcome": lambda: CR.logon_insert_outcome(
            hot_accounts(spark).select(c("account").alias("id"), F.md5("id").alias("account"), F.lit(0).alias("delete_mark"), F.lit(1).alias("enabled_mark")), some.select(c("account").alias("user_id"))),
        "acct_disable_counts": lambda: A.acct_disable_counts(hot_accounts(spark), hot_roster(spark).withColumn("isactive", F.lit(0))),
    }


@pytest.mark.parametrize("name", ["missing_from", "insert_missing", "update_from", "people_link_account", "pick_base",
                                  "logon_insert_outcome", "acct_disable_counts"])
def test_a_hot_key_is_split(spark, name):
    """A third of the rows on one key: AQE splits that join, seen in the plan that ran."""
    with conf(spark, FORCE):
        plan = final_plan(_cases(spark)[name]())
    assert "skew=true" in plan, plan


def test_link_profile_leaves_both_joins_splittable(spark):
    """Its rows are too narrow here for AQE to call a partition large; both sides are plain exchanges, which it can split."""
    import re
    with conf(spark, FORCE):
        plan = _cases(spark)["link_profile"]()._jdf.queryExecution().executedPlan().toString()
    for key in ("_k", "_k2", "code"):
        assert re.search(rf"Sort \[{key}#[^\n]*\n[^\n]*Exchange hashpartitioning\({key}#", plan), plan
