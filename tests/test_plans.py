"""Plan guards: what every registered query must (not) contain at scale."""

import contextlib
import re
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

LLM = set(E.llm.queries()) | {"pipeline"} if E.llm else set()
ACTION_KEYS = {"sync_results", "sync_totals", "sync_report", "stream_sync"} | LLM   # these run jobs when built, or have tests of their own
KEYS = [k for k in E.queries() if k not in ACTION_KEYS]


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_no_nested_loop_no_python_udf(spark, sf_small, key):
    p = plan(E.queries()[key](spark, sf_small))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{key}: {bad} in plan"


def test_picking_filters_pushed_and_columns_pruned(spark, sf_small, tmp_path):
    from rosterline.plans import reports as R
    from rosterline.sources.standins import Tables
    from rosterline.functions.exprs import is_open
    T = Tables(spark, sf_small)
    # the stand-in derives requisition_ts with a CASE; a real picking table
    # stores it, and then the window filter reaches the parquet scan
    path = str(tmp_path / "picking_lines")
    T.picking_lines.write.parquet(path)
    lines = spark.read.parquet(path)
    df = R.pick_base(lines, T.items, T.picking_heads, T.item_keepers,
                     R._window(R.P) & is_open("prep_status", "not_signed"))
    p = plan(df)
    blk = [b for b in p.split("Scan parquet") if "picking_lines" in b][0]
    pushed = [ln for ln in blk.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(requisition_ts" in pushed and "LessThanOrEqual(requisition_ts" in pushed
    assert "Not(EqualTo(prep_status,signed))" in pushed
    line_scan = [b for b in plan(E.queries()["pick_level1"](spark, sf_small)).split("Scan parquet")
                 if "lineitem.parquet" in b][0]
    read_schema = [ln for ln in line_scan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "l_extendedprice" not in read_schema and "l_tax" not in read_schema


def test_scope_filter_reaches_the_scan(spark, sf_small):
    p = plan(E.queries()["acct_insert_missing"](spark, sf_small))
    assert "PushedFilters: [In(c_mktsegment" in p


GROUP_KEYS = ["group_compare", "group_profile", "people_group_fill_or_fix", "group_fill_preview",
              "group_mismatch_preview", "group_name_match", "group_fill_profile"]


@pytest.mark.parametrize("key", GROUP_KEYS)
def test_group_dimension_is_broadcast_by_its_real_size(spark, sf_small, key):
    """Group ids / names have few values; no join on them is left as a shuffle join in the plan that ran."""
    df = E.queries()[key](spark, sf_small)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    smj = [ln for ln in p.splitlines() if "SortMergeJoin" in ln]
    assert not [ln for ln in smj if re.search(r"SortMergeJoin \[[^\]]*(group|gid|gname|_cur_id|dim_)", ln)], smj


def test_picking_lines_are_multiplied_by_keepers_after_the_last_shuffle_of_them(spark):
    """Heads are joined (on another key) before the items' texts and a row for each keeper are added."""
    from rosterline.plans import reports as R
    lines = spark.createDataFrame([(1, 10, "d1"), (1, 11, "d2"), (2, 10, "d3"), (None, 10, "d4"), (3, None, "d5"), (9, 99, "d6")],
                                  "picking_id long, item_id long, doc_no string") \
        .withColumns({"src_doc_no": F.lit("s"), "matnr": F.lit("m"), "qty": F.lit(1.0), "requisition_ts": F.lit(None).cast("timestamp_ntz"), "prep_status": F.lit("issuing")})
    items = spark.createDataFrame([(10, "i10", "s"), (10, "j10", "s"), (12, "i12", "s"), (None, "none", "s")], "id long, item_name string, item_specs string")
    heads = spark.createDataFrame([(1, "h1"), (2, "h2"), (2, "g2"), (None, "none")], "id long, remark string")
    keepers = spark.createDataFrame([(10, "k1"), (10, "k2"), (10, "k1"), (11, "k3"), (99, None), (None, "k4")], "item_id long, keeper string")
    df = R.pick_base(lines, items, heads, keepers)
    got = sorted((r.doc_no, str(r.item_name), str(r.keeper), str(r.remark)) for r in df.collect())
    pairs = [(i, k) for i in ("i10", "j10") for k in ("k1", "k2")]
    assert got == sorted([("d1", i, k, "h1") for i, k in pairs] + [("d2", "None", "k3", "h1")] + [("d3", i, k, h) for i, k in pairs for h in ("h2", "g2")]
                         + [("d4", i, k, "None") for i, k in pairs] + [("d5", "None", "None", "None"), ("d6", "None", "None", "None")])
    joins = [ln for ln in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in ln]
    assert len(joins) == 3 and "k_item" in joins[0] and "h_id" in joins[2], joins
