"""Rule-driven report extraction: picking reports N1-N1e, rules in force
(F13), recipients (X5, N4), rule rows (N2), delivery summary / totals /
fan-out (N5, A8, N6) and unmaintained groups (N7).

The picking report joins the line table (the big one) to heads, items and
keepers. Heads are joined first, on the picking id, while a line is one narrow
row; then items and keepers one after the other on their common key (item), so
that what they add (texts, a row for each keeper) is not shuffled again. On a
stored picking table the window and status filters are pushed into the
parquet scan; the stand-in derives the time by a CASE, which cannot be pushed.
"""

from __future__ import annotations

import uuid

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.exprs import is_blank, is_open, split_ids, within_days
from rosterline.operators.frames import rename_columns
from rosterline.params import DEFAULT_PARAMS, SyncParams
from rosterline.plans.registry import query
from rosterline.sources.sinks import commit
from rosterline.sources.standins import Tables

c = F.col
P = DEFAULT_PARAMS

BASE_COLS = ["src_doc_no", "doc_no", "matnr", "item_name", "item_specs", "qty", "requisition_ts",
             "prep_status", "keeper", "remark"]


def dedup_keepers(keepers: DataFrame) -> DataFrame:
    """Distinct (item, keeper) with a keeper; several keepers per item stay."""
    return keepers.where(c("keeper").isNotNull()).select(c("item_id").alias("k_item"), "keeper").distinct()


def pick_base(lines, items, heads, keepers, line_filter=None) -> DataFrame:
    """Lines + head + item + distinct keeper, ten columns (left joins; the keepers, which multiply the rows, last)."""
    m = lines if line_filter is None else lines.where(line_filter)
    it = items.select(c("id").alias("i_id"), "item_name", "item_specs")
    h = heads.select(c("id").alias("h_id"), "remark")
    j = (m.join(h, m["picking_id"] == h["h_id"], "left")
          .join(it, m["item_id"] == it["i_id"], "left")
          .join(dedup_keepers(keepers), m["item_id"] == c("k_item"), "left"))
    return j.select(*BASE_COLS)


def _window(p):
    return within_days("requisition_ts", p.picking_as_of, p.window_days)


def pick_level(T: Tables, level: int, p: SyncParams = P) -> DataFrame:
    """N1a-N1e. Levels 1-3: window + not signed (+ remark prefix '1' / 'G').
    Levels 4-5: window + issuing-or-NULL + keeper contains a name. Level 5 is
    one pass for all of its names: each row is tagged with every name its
    keeper contains (a projection over a fixed name list, no join)."""
    if level in (1, 2, 3):
        b = pick_base(T.picking_lines, T.items, T.picking_heads, T.item_keepers,
                      _window(p) & is_open("prep_status", "not_signed"))
        if level == 2:
            b = b.where(c("remark").startswith("1"))
        elif level == 3:
            b = b.where(c("remark").startswith("G"))
        return b.withColumn("keeper_name", F.lit(None).cast("string"))
    b = pick_base(T.picking_lines, T.items, T.picking_heads, T.item_keepers,
                  _window(p) & is_open("prep_status", "issuing_or_null"))
    names = [p.keeper_level4] if level == 4 else list(p.keeper_level5)
    arr = F.filter(F.array(*[F.lit(n) for n in names]), lambda n: c("keeper").contains(n))
    return b.select(*BASE_COLS, F.explode(arr).alias("keeper_name"))


LEVELS = (1, 2, 3, 4, 5)


def rules_in_force(rules: DataFrame, lo: int = 1, hi: int = 100, enterprise_id=None, org_id=None) -> DataFrame:
    """Active, recipients and report non-blank, level in band, tenant NULL or equal."""
    ent = c("enterprise_id").isNull() | (c("enterprise_id") == F.lit(enterprise_id))
    org = c("org_id").isNull() | (c("org_id") == F.lit(org_id))
    return rules.where(c("is_active") & (F.trim(c("user_ids")) != "") & (F.trim(c("report")) != "")
                       & c("level").between(lo, hi) & ent & org)


def rule_recipients(rules: DataFrame, trim_items: bool = True) -> DataFrame:
    """One row per (rule, recipient); blank items dropped."""
    return rules.select("rule_id", "level", F.explode(split_ids("user_ids", trim_items)).alias("recipient"))


def pick_tagged(T: Tables, p: SyncParams = P, levels=LEVELS) -> DataFrame:
    """Every report level in ONE pass over the lines: each row in the window
    is tagged with every (level, keeper_name) whose test it passes, then
    exploded. One scan and one set of joins serve all rules, instead of one
    scan of the (large) line table per rule."""
    ns = is_open("prep_status", "not_signed")
    io = is_open("prep_status", "issuing_or_null")
    b = pick_base(T.picking_lines, T.items, T.picking_heads, T.item_keepers, _window(p) & (ns | io))

    def tag(cond, level, name=None):
        return F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(name).cast("string").alias("keeper_name")))
    tags = []
    if 1 in levels:
        tags.append(tag(ns, 1))
    if 2 in levels:
        tags.append(tag(ns & c("remark").startswith("1"), 2))
    if 3 in levels:
        tags.append(tag(ns & c("remark").startswith("G"), 3))
    if 4 in levels:
        tags.append(tag(io & c("keeper").contains(p.keeper_level4), 4, p.keeper_level4))
    if 5 in levels:
        tags += [tag(io & c("keeper").contains(n), 5, n) for n in p.keeper_level5]
    if not tags:
        return b.where(F.lit(False)).select(F.lit(None).cast("int").alias("level"), *BASE_COLS,
                                             F.lit(None).cast("string").alias("keeper_name"))
    arr = F.filter(F.array(*tags), lambda x: x.isNotNull())
    return b.select(*BASE_COLS, F.explode(arr).alias("_t")).select("_t.level", *BASE_COLS, "_t.keeper_name")


REPORT = "picking"        # the registered report of levels 1-5


def _runs():
    return c("level").isin(*LEVELS) & (c("report") == REPORT)


def _has_rows(p):
    """Rules that the rows of ``pick_tagged`` can meet: of no keeper, or of one that their level tags rows with."""
    k, level = c("keeper_name"), c("level")
    return k.isNull() | ((level == 4) & (k == F.lit(p.keeper_level4))) | ((level == 5) & k.isin(*p.keeper_level5))


def _with_rules(tagged: DataFrame, chosen: DataFrame, columns=BASE_COLS) -> DataFrame:
    """Rows tagged with level and keeper_name, for each rule of their level that names no keeper or theirs.

    Each row asks twice, for the rules without a keeper and for those of its
    own: the join is on equal keys alone, and no row is compared to the rules
    of other keepers.
    """
    asks = F.array(F.struct(F.lit(False).alias("own"), F.lit("").alias("name")), F.struct(F.lit(True).alias("own"), c("keeper_name").alias("name")))
    rows = tagged.withColumn("_ask", F.explode(asks)).where(c("_ask.name").isNotNull())
    rows = rows.select(*tagged.columns, c("_ask.own").alias("_own"), c("_ask.name").alias("_name"))
    keys = chosen.select("rule_id", c("level").alias("_level"), c("keeper_name").isNotNull().alias("_named"), F.coalesce("keeper_name", F.lit("")).alias("_keeper"))
    out = rows.join(keys, (c("level") == c("_level")) & (c("_own") == c("_named")) & (c("_name") == c("_keeper")))
    return out.select("rule_id", "level", *columns, "keeper_name")


def rule_rows(T: Tables, rules: DataFrame, p: SyncParams = P, band=(1, 100),
              enterprise_id="ent-1", org_id="org-1", counted=False):
    """Every rule in force, through the registered report of its level,
    rows tagged with rule id and level. Returns (rows, failures).

    A rule whose report or level is not registered is a row of ``failures``
    (rule_id, level, error); the others go on. Rules of keepers that no report
    tags its rows with have no rows and are left out of the join
    (``_with_rules``); AQE broadcasts the others by their real size, so that
    the few levels are no hot keys, and otherwise splits them. With
    ``counted`` the rows of one level and keeper_name are counted before they
    meet the rules: one row of rule_id, level, n, keeper_name for all of them.
    """
    conf = rules_in_force(rules, band[0], band[1], enterprise_id, org_id)
    failures = conf.where(~_runs()).select("rule_id", "level", F.format_string(
        "no registered report %s for level %d", "report", "level").alias("error"))
    tagged, chosen = pick_tagged(T, p), conf.where(_runs() & _has_rows(p))
    if counted:
        return _with_rules(tagged.groupBy("level", "keeper_name").agg(F.count(F.lit(1)).alias("n")), chosen, ["n"]), failures
    return _with_rules(tagged, chosen), failures


REPORTS = {level: (lambda T, p, level=level: pick_tagged(T, p, (level,))) for level in LEVELS}


def rule_rows_isolated(T: Tables, rules: DataFrame, p: SyncParams = P, band=(1, 100), enterprise_id="ent-1", org_id="org-1",
                       reports=None, base: str | None = None):
    """N2 with each level's report as a job of its own. Returns (rows, failures) like ``rule_rows``.

    A report that fails, also while it runs, is a row of ``failures`` for each
    of its rules, and the others' rows stay. The reports run side by side under
    a job tag; if the caller is interrupted, the tag's jobs are cancelled. Each
    report's rows are written, so that a failure cannot come up later.
    """
    from concurrent.futures import ThreadPoolExecutor
    spark = T.spark
    reports = REPORTS if reports is None else reports
    run, sc = uuid.uuid4().hex[:12], spark.sparkContext
    conf = rules_in_force(rules, band[0], band[1], enterprise_id, org_id)
    known = c("level").isin(*reports) & (c("report") == REPORT)
    failures = conf.where(~known).select("rule_id", "level", F.format_string("no registered report %s for level %d", "report", "level").alias("error"))

    def one(level):
        sc.addJobTag(f"rules-{run}")
        chosen = conf.where(known & (c("level") == level))
        met = chosen.where(_has_rows(p)) if reports[level] is REPORTS.get(level) else chosen
        try:
            return commit(_with_rules(reports[level](T, p), met), spark, "rule_rows", f"{run}-{level}", base), None
        except Exception as e:
            text = str(e).strip().splitlines()
            return None, chosen.select("rule_id", F.lit(level).alias("level"), F.lit(f"{type(e).__name__}: {text[0] if text else ''}"[:500]).alias("error"))
    with ThreadPoolExecutor(max_workers=len(reports) or 1) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(one), level) for level in sorted(reports)]
        try:
            done = [j.result() for j in jobs]
        except BaseException:
            sc.cancelJobsWithTag(f"rules-{run}")
            raise
    rows = None
    for ok, bad in done:
        if bad is not None:
            failures = failures.unionByName(bad)
        else:
            rows = ok if rows is None else rows.unionByName(ok)
    if rows is None:
        rows = _with_rules(pick_tagged(T, p, ()), conf.limit(0))
    return rows, failures


def _summary_all(T: Tables, rules: DataFrame, p: SyncParams = P, band=(1, 100),
                 enterprise_id="ent-1", org_id="org-1") -> DataFrame:
    """Every rule in force with recipients, rows and status; a rule with no
    recipient after splitting has status 'skipped'."""
    rows, _ = rule_rows(T, rules, p, band, enterprise_id, org_id, counted=True)
    counts = rows.groupBy("rule_id").agg(F.sum("n").alias("row_count"))
    rif = rules_in_force(rules, band[0], band[1], enterprise_id, org_id).select(
        "rule_id", "level", F.size(split_ids("user_ids")).alias("recipient_count"), _runs().alias("_runs"))
    j = rif.join(counts, "rule_id", "left")
    n = F.coalesce(c("row_count"), F.lit(0))
    status = (F.when(c("recipient_count") == 0, F.lit("skipped"))
               .when(~c("_runs"), F.lit("error"))
               .when(n == 0, F.lit("no data")).otherwise(F.lit("sent")))
    return j.select("rule_id", "level", "recipient_count", n.alias("row_count"), status.alias("status"))


def delivery_summary(T: Tables, rules: DataFrame, p: SyncParams = P, **kw) -> DataFrame:
    """Per rule in force: level, recipients, rows, status (sent / no data / error).

    Rules with no recipient after splitting are skipped, as the reference does.
    """
    return (_summary_all(T, rules, p, **kw).where(c("status") != "skipped")
            .orderBy("level", "rule_id"))


def delivery_totals(T: Tables, rules: DataFrame, p: SyncParams = P) -> DataFrame:
    """Recipients summed over rules that had rows (once per rule, not
    distinct); the rule count includes skipped rules. One aggregate."""
    s = _summary_all(T, rules, p)
    sent = c("status") == "sent"
    return s.agg(F.sum(F.when(sent, c("recipient_count")).otherwise(0)).cast("bigint").alias("total_recipients"),
                 F.count(F.when(sent, 1)).alias("rules_sent"),
                 F.sum(F.when(c("status") != "skipped", c("row_count"))).cast("bigint").alias("total_rows"),
                 F.count(F.lit(1)).alias("rule_count"))


def delivery_fanout(T: Tables, rules: DataFrame, p: SyncParams = P) -> DataFrame:
    """Recipient x report row count of each rule that had rows."""
    s = delivery_summary(T, rules, p).where(c("status") == "sent").select("rule_id", "row_count")
    rec = rule_recipients(rules_in_force(rules, 1, 100, "ent-1", "org-1"))
    return rec.join(s, "rule_id").select("rule_id", "level", "recipient", "row_count")


BAND_RULES = 1000


def _band_rules(rules, lo, hi, enterprise_id="ent-1", org_id="org-1") -> list:
    """Rules in force of one band that have at least one recipient, at most BAND_RULES.

    Every rule of these bands repeats the same summary, so they become an
    expression of the plan; more of them than a person could have written is
    an error, not a larger plan."""
    found = (rules_in_force(rules, lo, hi, enterprise_id, org_id)
             .select("rule_id", "level", F.size(split_ids("user_ids")).alias("recipient_count"))
             .where(c("recipient_count") > 0).orderBy("level", "rule_id").limit(BAND_RULES + 1).collect())
    if len(found) > BAND_RULES:
        raise ValueError(f"more than {BAND_RULES} rules in levels {lo}-{hi}")
    return found


_RULE_T = "array<struct<rule_id:string,level:int,recipient_count:int>>"


def _for_each_rule(df: DataFrame, rule_rows: list) -> DataFrame:
    """Every row of ``df`` once per rule: the rules are a literal array that
    is exploded (a projection; no join, so nothing for Catalyst to turn into
    a nested-loop join)."""
    structs = [F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.level).cast("int").alias("level"),
                        F.lit(r.recipient_count).cast("int").alias("recipient_count")) for r in rule_rows]
    arr = F.array(*structs) if structs else F.array().cast(_RULE_T)
    return df.select(F.explode(arr).alias("_r"), *df.columns).select("_r.*", *df.columns)


def attendance_rule_summary(T: Tables, rules: DataFrame, p: SyncParams = P) -> DataFrame:
    """N2 for the attendance band (levels 101-200): every rule in force gets
    the per-group attendance summary of the report day (A6)."""
    from rosterline.plans.attendance import attendance_summary_rows
    summ = attendance_summary_rows(T.attendance, p)
    return _for_each_rule(summ, _band_rules(rules, 101, 200)).orderBy("level", "rule_id", "group_name")


def group_notice_summary(T: Tables, rules: DataFrame) -> DataFrame:
    """N2 + N7 for the unmaintained-group band (levels 201-300): per rule in
    force, recipients, number of people without a group, status."""
    n = group_unmaintained_count(T.people)
    st = F.when(c("unmaintained_count") > 0, F.lit("sent")).otherwise(F.lit("no data"))
    return (_for_each_rule(n, _band_rules(rules, 201, 300))
            .withColumn("status", st).orderBy("level", "rule_id"))


def group_unmaintained(people: DataFrame) -> DataFrame:
    """People with no group (NULL or ''), with the total on every row."""
    return (people.where(is_blank("group_id")).select("code", "name", "group_id")
            .orderBy("code"))


def group_unmaintained_count(people: DataFrame) -> DataFrame:
    return people.where(is_blank("group_id")).agg(F.count(F.lit(1)).alias("unmaintained_count"))


# -------------------------------------------------------------------- queries
_BASE_SQL = """SELECT src_doc_no, doc_no, matnr, item_name, item_specs, qty, requisition_ts, prep_status, keeper, remark
FROM picking_lines
LEFT JOIN (SELECT id AS item_id, item_name, item_specs FROM items) USING (item_id)
LEFT JOIN (SELECT item_id, keeper FROM item_keepers GROUP BY ALL HAVING keeper IS NOT NULL) USING (item_id)
LEFT JOIN (SELECT id AS picking_id, remark FROM picking_heads) USING (picking_id)"""

_WIN = (f"abs(epoch(requisition_ts) - epoch(TIMESTAMP '{P.picking_as_of}')) <= {P.window_days} * 86400")


def _level_sql(level: int) -> str:
    if level in (1, 2, 3):
        first = {1: "TRUE", 2: "starts_with(remark, '1')", 3: "starts_with(remark, 'G')"}[level]
        return f"SELECT *, CAST(NULL AS VARCHAR) AS keeper_name FROM ({_BASE_SQL}) WHERE {_WIN} AND prep_status <> 'signed' AND {first}"
    names = [P.keeper_level4] if level == 4 else list(P.keeper_level5)
    return (f"SELECT * FROM (SELECT *, unnest([{', '.join(repr(n) for n in names)}]) AS keeper_name FROM ({_BASE_SQL}) "
            f"WHERE {_WIN} AND coalesce(prep_status, 'issuing') = 'issuing') WHERE contains(keeper, keeper_name)")


@query("pick_base", _BASE_SQL)
def q_pick_base(spark, d):
    T = Tables(spark, d)
    return pick_base(T.picking_lines, T.items, T.picking_heads, T.item_keepers)


def _reg_level(level):
    key = f"pick_level{level}"
    sql = _level_sql(level) + "\nORDER BY requisition_ts, src_doc_no"

    def fn(spark, d):
        return pick_level(Tables(spark, d), level).orderBy("requisition_ts", "src_doc_no")
    fn.__name__ = f"q_{key}"
    query(key, sql)(fn)


for _lv in LEVELS:
    _reg_level(_lv)

_RIF_SQL = """SELECT rule_id, level, user_ids, report, keeper_name, level IN (1, 2, 3, 4, 5) AND report = 'picking' AS runs FROM report_rules
WHERE is_active AND trim(user_ids) <> '' AND trim(report) <> '' AND level BETWEEN 1 AND 100
  AND coalesce(enterprise_id, 'ent-1') = 'ent-1' AND coalesce(org_id, 'org-1') = 'org-1'"""

_LV_UNION = "\nUNION ALL\n".join(f"SELECT {lv} AS lvl, * FROM ({_level_sql(lv)}) l{lv}" for lv in LEVELS)

_RULE_ROWS_SQL = f"""
WITH rif AS ({_RIF_SQL}), lv AS ({_LV_UNION})
SELECT rif.rule_id, rif.level, lv.* EXCLUDE (lvl) FROM rif JOIN lv ON runs AND lvl = rif.level
  AND coalesce(rif.keeper_name, lv.keeper_name) IS NOT DISTINCT FROM lv.keeper_name
"""


@query("rule_rows", _RULE_ROWS_SQL)
def q_rule_rows(spark, d):
    T = Tables(spark, d)
    return rule_rows(T, T.report_rules)[0]


@query("rule_rows_isolated", _RULE_ROWS_SQL)
def q_rule_rows_isolated(spark, d):
    T = Tables(spark, d)
    return rule_rows_isolated(T, T.report_rules)[0]


_RECIP = "CAST(len(list_filter(string_split(user_ids, ','), lambda x: regexp_matches(trim(x), '\\S'))) AS INTEGER)"
_SUMMARY_SQL = f"""
WITH rif AS ({_RIF_SQL}), lv AS ({_LV_UNION}),
rr AS (SELECT rif.rule_id, count(*) AS n FROM rif JOIN lv ON runs AND lvl = rif.level
         AND coalesce(rif.keeper_name, lv.keeper_name) IS NOT DISTINCT FROM lv.keeper_name GROUP BY rif.rule_id),
s AS (SELECT rif.rule_id, rif.level, {_RECIP} AS recipient_count, coalesce(rr.n, 0) AS row_count, runs
      FROM rif LEFT JOIN rr ON rif.rule_id = rr.rule_id)
SELECT rule_id, level, recipient_count, row_count,
       CASE WHEN NOT runs THEN 'error' WHEN row_count = 0 THEN 'no data' ELSE 'sent' END AS status
FROM s WHERE recipient_count > 0
ORDER BY level, rule_id
"""


@query("delivery_summary", _SUMMARY_SQL)
def q_delivery_summary(spark, d):
    T = Tables(spark, d)
    return delivery_summary(T, T.report_rules)


@query("delivery_totals", f"""
WITH ds AS ({_SUMMARY_SQL.strip().rsplit('ORDER BY', 1)[0]})
SELECT CAST(coalesce(SUM(CASE WHEN status = 'sent' THEN recipient_count ELSE 0 END), 0) AS BIGINT) AS total_recipients,
       count(CASE WHEN status = 'sent' THEN 1 END) AS rules_sent,
       CAST(SUM(row_count) AS BIGINT) AS total_rows,
       (SELECT count(*) FROM ({_RIF_SQL}) z) AS rule_count
FROM ds
""")
def q_delivery_totals(spark, d):
    T = Tables(spark, d)
    return delivery_totals(T, T.report_rules)


@query("delivery_fanout", f"""
WITH ds AS ({_SUMMARY_SQL.strip().rsplit('ORDER BY', 1)[0]}),
rec AS (SELECT rule_id, level, regexp_replace(x, '^\\s+|\\s+$', '', 'g') AS recipient
        FROM ({_RIF_SQL}) r, unnest(string_split(user_ids, ',')) AS t(x)
        WHERE regexp_matches(trim(x), '\\S'))
SELECT rec.rule_id, rec.level, rec.recipient, ds.row_count
FROM rec JOIN ds ON rec.rule_id = ds.rule_id WHERE ds.status = 'sent'
""")
def q_delivery_fanout(spark, d):
    T = Tables(spark, d)
    return delivery_fanout(T, T.report_rules)


@query("group_unmaintained", """
SELECT code, name, group_id FROM people WHERE group_id IS NULL OR group_id = '' ORDER BY code
""")
def q_group_unmaintained(spark, d):
    return group_unmaintained(Tables(spark, d).people)


@query("group_unmaintained_count", """
SELECT count(*) AS unmaintained_count FROM people WHERE group_id IS NULL OR group_id = ''
""")
def q_group_unmaintained_count(spark, d):
    return group_unmaintained_count(Tables(spark, d).people)


_BAND_SQL = """SELECT rule_id, level, {recip} AS recipient_count FROM report_rules
WHERE is_active AND trim(user_ids) <> '' AND trim(report) <> '' AND level BETWEEN {lo} AND {hi}
  AND coalesce(enterprise_id, 'ent-1') = 'ent-1' AND coalesce(org_id, 'org-1') = 'org-1'"""


def _attendance_rule_sql():
    from rosterline.plans.attendance import _CNT, _ROWS, _fin_sql
    summ = _fin_sql("group_name,", f"SELECT group_name, {_CNT} FROM ({_ROWS}) r GROUP BY group_name")
    return f"""
WITH r AS ({_BAND_SQL.format(recip=_RECIP, lo=101, hi=200)}), s AS ({summ})
SELECT r.rule_id, r.level, r.recipient_count, s.* FROM r, s WHERE r.recipient_count > 0
ORDER BY r.level, r.rule_id, s.group_name
"""


@query("attendance_rule_summary", _attendance_rule_sql())
def q_attendance_rule_summary(spark, d):
    T = Tables(spark, d)
    return attendance_rule_summary(T, T.report_rules)


@query("group_notice_summary", f"""
WITH r AS ({_BAND_SQL.format(recip=_RECIP, lo=201, hi=300)}),
n AS (SELECT count(*) AS unmaintained_count FROM people WHERE group_id IS NULL OR group_id = '')
SELECT r.rule_id, r.level, r.recipient_count, n.unmaintained_count,
       CASE WHEN n.unmaintained_count > 0 THEN 'sent' ELSE 'no data' END AS status
FROM r, n WHERE r.recipient_count > 0
ORDER BY r.level, r.rule_id
""")
def q_group_notice_summary(spark, d):
    T = Tables(spark, d)
    return group_notice_summary(T, T.report_rules)


# Headings of the picking report, in column order.
HEADINGS = dict(zip(BASE_COLS, ("Source document", "Document", "Material", "Item", "Specification", "Quantity", "Requested",
                                "Preparation", "Keeper", "Remark")))


@query("pick_headed", "SELECT " + ", ".join(f'{k} AS "{v}"' for k, v in HEADINGS.items()) + f" FROM ({_level_sql(1)})")
def q_pick_headed(spark, d):
    """N1a under report headings (P10)."""
    return rename_columns(pick_level(Tables(spark, d), 1).select(*BASE_COLS), HEADINGS)


@query("rules_in_force", f"SELECT rule_id, level, user_ids, report, keeper_name FROM ({_RIF_SQL})")
def q_rules_in_force(spark, d):
    rules = rules_in_force(Tables(spark, d).report_rules, 1, 100, "ent-1", "org-1")
    return rules.select("rule_id", "level", "user_ids", "report", "keeper_name")


@query("rule_recipients", f"""
SELECT rule_id, level, regexp_replace(x, '^\\s+|\\s+$', '', 'g') AS recipient
FROM (SELECT rule_id, level, unnest(string_split(user_ids, ',')) AS x FROM ({_RIF_SQL})) WHERE regexp_matches(x, '\\S')
""")
def q_rule_recipients(spark, d):
    return rule_recipients(rules_in_force(Tables(spark, d).report_rules, 1, 100, "ent-1", "org-1"))
