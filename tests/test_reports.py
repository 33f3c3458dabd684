"""Rules in force, recipients, rule rows with a failing rule, delivery,
attendance rollup, report export, configuration loading."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rosterline.operators.frames import rename_columns, top_n
from rosterline.params import SyncParams
from rosterline.plans import attendance as AT
from rosterline.plans import reports as R
from rosterline.sources.sinks import export_reports
from rosterline.sources.standins import REPORT_RULE_SCHEMA, Tables

c = F.col


def fixed(T):
    """The rules that don't come from a table."""
    return T.report_rules.where("rule_id like 'r%'")


def test_rules_in_force_band_and_tenant(spark, sf_small):
    rules = fixed(Tables(spark, sf_small))
    got = sorted(r.rule_id for r in R.rules_in_force(rules, 1, 100, "ent-1", "org-1").collect())
    # r4 other tenant, r5 blank, r6 inactive, r7/r8 other band, r12 without report
    assert got == ["r1", "r10", "r11", "r13", "r14", "r2", "r3", "r9"]
    assert [r.rule_id for r in R.rules_in_force(rules, 101, 200, "ent-1", "org-1").collect()] == ["r7"]


def test_recipients_split_trim_and_drop_blank(spark, sf_small):
    rules = fixed(Tables(spark, sf_small))
    rec = R.rule_recipients(R.rules_in_force(rules, 1, 3, "ent-1", "org-1").where("rule_id < 'r4' and rule_id not like 'r1_'"))
    assert sorted((r.rule_id, r.recipient) for r in rec.collect()) == [
        ("r1", "u1"), ("r1", "u2"), ("r1", "u3"), ("r2", "u2"), ("r2", "u4"), ("r3", "u5")]
    raw = R.rule_recipients(rules.where(c("rule_id") == "r1"), trim_items=False)
    assert sorted(r.recipient for r in raw.collect()) == [" u2", "u1", "u3"]


def test_rule_with_unknown_level_is_recorded_and_skipped(spark, sf_small):
    T = Tables(spark, sf_small)
    rules = spark.createDataFrame([("x1", 1, "u1", None, None, True, "picking", None), ("x2", 42, "u2", None, None, True, "picking", None),
                                   ("x3", 1, "u3", None, None, True, "nothing", None)],
                                  REPORT_RULE_SCHEMA)
    rows, failures = R.rule_rows(T, rules)
    assert sorted(f.rule_id for f in failures.collect()) == ["x2", "x3"]
    assert rows.select("rule_id").distinct().collect()[0].rule_id == "x1"
    s = {r.rule_id: r.status for r in R.delivery_summary(T, rules).collect()}
    assert s == {"x1": "sent", "x2": "error", "x3": "error"}


def test_rule_rows_single_pass_equals_per_level(spark, sf_small):
    T = Tables(spark, sf_small)
    tagged = R.pick_tagged(T)
    for lv in R.LEVELS:
        a = sorted(map(tuple, tagged.where(c("level") == lv).drop("level").collect()))
        b = sorted(map(tuple, R.pick_level(T, lv).collect()))
        assert a == b, lv


def test_attendance_null_group_does_not_collide_with_total(spark):
    att = spark.createDataFrame(
        [(1, "e1", "2024-01-15", None, "normal"), (2, "e2", "2024-01-15", "G1", "late 5m"),
         (3, "e3", "2024-01-15", "G1", None), (4, "e4", "2024-01-16", "G1", "normal")],
        "row_id long, empcode string, work_date string, group_name string, status string") \
        .withColumn("work_date", F.to_date("work_date"))
    s = {(r.group_name, r.is_total): (r.due, r.present, r.unknown, r.rate)
         for r in AT.attendance_summary(att).collect()}
    assert s == {("", False): (1, 1, 0, 100.0), ("G1", False): (2, 1, 1, 50.0), (None, True): (3, 2, 1, 66.7)}
    empty = AT.attendance_total(att.where(F.lit(False))).collect()[0]
    assert empty.due == 0 and empty.rate == 0.0


def test_export_reports_partitioned_by_level(spark, sf_small):
    T = Tables(spark, sf_small)
    rows, _ = R.rule_rows(T, T.report_rules)
    out = os.path.join(tempfile.mkdtemp(prefix="reports-"), "out")
    counts = {r.rule_id: r.row_count for r in export_reports(rows, out).collect()}
    assert counts["r1"] == spark.read.option("header", "true").csv(f"{out}/level=1/rule_id=r1").count()
    dirs = sorted(d for d in os.listdir(out) if d.startswith("level="))
    assert dirs == ["level=1", "level=2", "level=3", "level=4", "level=5"]


def test_config_loading_and_validation(tmp_path):
    doc = {"dept_map": [{"dept": " BUILDING ", "factory": "1060"}, {"dept": "HOUSEHOLD", "factory": "1040"}],
           "tasks": {"cred_backfill": False}, "run_ts": "2024-03-01 02:00:00"}
    f = tmp_path / "conf.json"
    f.write_text(json.dumps(doc))
    p = SyncParams.load(str(f))
    assert p.dept_names() == ["BUILDING", "HOUSEHOLD"] and p.tasks["cred_backfill"] is False
    assert p.run_ts == "2024-03-01 02:00:00"
    with pytest.raises(ValueError):
        SyncParams.from_config({"dept_map": [{"dept": "  ", "factory": "x"}]})
    with pytest.raises(ValueError):
        SyncParams.from_config({"dept_map": []})


def test_rename_and_top_n(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    assert rename_columns(df, {"v": "Value"}).columns == ["k", "Value"]
    assert [r.k for r in top_n(df, 2, "k").collect()] == [1, 2]
    with pytest.raises(ValueError):
        top_n(df, 2)


def test_level5_rules_get_only_their_own_keeper(spark, sf_small):
    T = Tables(spark, sf_small)
    names = list(R.P.keeper_level5[:2])
    rules = spark.createDataFrame(
        [("k1", 5, "u1", None, None, True, "picking", names[0]), ("k2", 5, "u2", None, None, True, "picking", names[1]),
         ("k3", 5, "u3", None, None, True, "picking", None)], REPORT_RULE_SCHEMA)
    rows, failures = R.rule_rows(T, rules)
    assert failures.isEmpty()
    got = {}
    for r in rows.select("rule_id", "keeper_name").collect():
        got.setdefault(r.rule_id, set()).add(r.keeper_name)
    allowed = set(R.P.keeper_level5)
    assert got.get("k1", set()) <= {names[0]} and got.get("k2", set()) <= {names[1]}
    assert got.get("k3", set()) <= allowed
    total5 = R.pick_level(T, 5).count()
    assert rows.where(c("rule_id") == "k3").count() == total5      # no name: every level-5 row


def test_band_summaries_attach_every_rule(spark, sf_small):
    T = Tables(spark, sf_small)
    s = R.attendance_rule_summary(T, T.report_rules)
    groups = AT.attendance_by_group(T.attendance).count()
    assert s.count() == groups and {r.rule_id for r in s.select("rule_id").collect()} <= {"r7"}
    g = R.group_notice_summary(T, T.report_rules).collect()
    assert [r.rule_id for r in g] == ["r8"] and g[0].unmaintained_count == R.group_unmaintained(T.people).count()


def test_group_dim_list_sorted_by_name(spark, sf_small):
    from rosterline.plans import groups as G
    g = [r.group_name for r in G.group_dim_list(Tables(spark, sf_small).groups_dim).collect()]
    assert g == sorted(g) and len(g) == 23


def test_attendance_day_defaults_to_today(spark):
    import datetime as dt
    from rosterline.params import SyncParams
    today = dt.date.today()
    att = spark.createDataFrame([(1, "e", today, "G", "normal"), (2, "f", today - dt.timedelta(days=1), "G", "late")],
                                "row_id long, empcode string, work_date date, group_name string, status string")
    p = SyncParams(attendance_day=None)
    assert AT.attendance_total(att, p).first().due == 1


def _own_tables(spark, lines=40):
    """Lines in the window, each with the keepers of its item: one of level 4, two of level 5, one of none."""
    from types import SimpleNamespace
    p, n = R.P, F.col("id")
    picks = spark.range(lines).select(
        n.alias("picking_id"), (n % 4).alias("item_id"), F.lit("s").alias("src_doc_no"), n.cast("string").alias("doc_no"), F.lit("m").alias("matnr"),
        F.lit(1.0).alias("qty"), F.to_timestamp_ntz(F.lit(p.picking_as_of)).alias("requisition_ts"), F.lit("issuing").alias("prep_status"))
    names = [p.keeper_level4, *p.keeper_level5[:2], "somebody else"]
    return SimpleNamespace(
        spark=spark, picking_lines=picks, picking_heads=spark.range(lines).select("id", F.lit("1-URGENT").alias("remark")),
        items=spark.range(4).select("id", F.lit("i").alias("item_name"), F.lit("s").alias("item_specs")),
        item_keepers=spark.createDataFrame([(i, k) for i, k in enumerate(names)] + [(0, names[1])], "item_id long, keeper string"))


def _own_rules(spark, others=300):
    p = R.P
    named = [("a", 4, p.keeper_level4), ("b", 5, p.keeper_level5[0]), ("b2", 5, p.keeper_level5[0]), ("c", 5, p.keeper_level5[1]), ("d", 5, None), ("e", 1, None),
             ("f", 2, p.keeper_level4), ("g", 4, p.keeper_level5[0]), ("h", 5, ""), *[(f"o{i}", 5, f"nobody {i}") for i in range(others)]]
    return spark.createDataFrame([(r, level, "u1,u2", None, None, True, "picking", k) for r, level, k in named], REPORT_RULE_SCHEMA)


OWN_COUNTS = {"a": 10, "b": 20, "b2": 20, "c": 10, "d": 30, "e": 50}


def _keys_of_joins(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [ln for ln in text.splitlines() if "Join" in ln and "_level" in ln], text


def test_rules_are_joined_on_equal_keepers_and_those_of_others_left_out(spark):
    rows, _ = R.rule_rows(_own_tables(spark), _own_rules(spark))
    assert {r["rule_id"]: r["count"] for r in rows.groupBy("rule_id").count().collect()} == OWN_COUNTS
    joins, text = _keys_of_joins(rows)
    assert joins and all("_keeper" in ln and " OR " not in ln for ln in joins), joins      # no row meets another keeper's rules
    assert sorted(r.rule_id for r in _own_rules(spark).where(R._has_rows(R.P)).collect()) == sorted(OWN_COUNTS)


def test_isolated_rule_rows_leave_out_rules_of_other_keepers(spark, tmp_path):
    T, rules = _own_tables(spark), _own_rules(spark)
    seen, whole = [], R._with_rules

    def watched(tagged, chosen, *more):
        seen.extend(r.rule_id for r in chosen.collect())
        return whole(tagged, chosen, *more)

    def custom(T, p):       # a report of the caller's own may tag its rows with any keeper
        return R.pick_tagged(T, p, (1,)).withColumns({"level": F.lit(5), "keeper_name": F.lit("nobody 7")})
    R._with_rules = watched
    try:
        rows, _ = R.rule_rows_isolated(T, rules, base=str(tmp_path))
    finally:
        R._with_rules = whole
    assert sorted(seen) == sorted(OWN_COUNTS)
    assert {r["rule_id"]: r["count"] for r in rows.groupBy("rule_id").count().collect()} == OWN_COUNTS
    rows, _ = R.rule_rows_isolated(T, rules, reports={5: custom}, base=str(tmp_path))
    assert {r["rule_id"]: r["count"] for r in rows.groupBy("rule_id").count().collect()} == {"d": 50, "o7": 50}


def test_delivery_counts_rows_before_they_meet_the_rules(spark):
    T, rules = _own_tables(spark), _own_rules(spark, 3)
    counts, _ = R.rule_rows(T, rules, counted=True)
    assert {r.rule_id: r.n for r in counts.groupBy("rule_id").agg(F.sum("n").alias("n")).collect()} == OWN_COUNTS
    for df in (R.delivery_summary(T, rules), R.delivery_totals(T, rules), R.delivery_fanout(T, rules)):
        assert "Aggregate [level" in df._jdf.queryExecution().optimizedPlan().toString()
    summary = {r.rule_id: (r.row_count, r.status) for r in R.delivery_summary(T, rules).collect()}
    assert summary == {**{k: (n, "sent") for k, n in OWN_COUNTS.items()}, **{k: (0, "no data") for k in ("f", "g", "h", "o0", "o1", "o2")}}
    t = R.delivery_totals(T, rules).first()
    assert (t.total_recipients, t.rules_sent, t.total_rows, t.rule_count) == (12, 6, 140, 12)
    assert {(r.rule_id, r.recipient, r.row_count) for r in R.delivery_fanout(T, rules).collect()} == {(k, u, n) for k, n in OWN_COUNTS.items() for u in ("u1", "u2")}
