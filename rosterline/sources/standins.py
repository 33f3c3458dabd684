"""Stand-in domain tables derived from the generated parquet tables.

Each view has two equal forms: a DataFrame builder (what the Spark queries
read) and the SQL text used as a CTE in the DuckDB oracle. The modulo choices
only give every operator matching and non-matching keys, NULLs and ''.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.sources.tables import base

c = F.col
lit = F.lit


def _s(col):
    return col.cast("string")


def roster(spark, d):
    t = base(spark, d, "customer")
    k = c("c_custkey")
    return t.select(
        c("c_name").alias("empcode"),
        F.concat(lit("Emp "), _s(k)).alias("empname"),
        c("c_mktsegment").alias("gdname4"),
        F.when(k % 23 == 0, lit(None).cast("int")).when(k % 5 == 0, lit(0)).otherwise(lit(1)).alias("isactive"),
    )


def accounts(spark, d):
    cu = base(spark, d, "customer")
    k = c("c_custkey")
    a = cu.where(k % 4 != 3).select(
        F.md5(F.concat(lit("su:"), c("c_name"))).alias("id"),
        c("c_name").alias("account"),
        F.concat(lit("Emp "), _s(k)).alias("real_name"),
        F.when(k % 11 == 0, lit(1)).when(k % 3 == 0, lit(None).cast("int")).otherwise(lit(0)).alias("delete_mark"),
        F.when(k % 9 == 0, lit(None).cast("int")).when(k % 7 == 0, lit(0)).otherwise(lit(1)).alias("enabled_mark"),
        lit("org-1").alias("org"), lit("ent-1").alias("enterprise_id"),
    )
    s = base(spark, d, "supplier").select(
        F.md5(F.concat(lit("su:"), c("s_name"))).alias("id"),
        c("s_name").alias("account"), c("s_name").alias("real_name"),
        lit(0).alias("delete_mark"), lit(1).alias("enabled_mark"),
        lit("org-1").alias("org"), lit("ent-1").alias("enterprise_id"),
    )
    return a.unionByName(s)


def logons(spark, d):
    cu = base(spark, d, "customer")
    k = c("c_custkey")
    uid = F.md5(F.concat(lit("su:"), c("c_name")))
    return cu.where((k % 4 != 3) & (k % 5 != 1)).select(
        uid.alias("id"), uid.alias("user_id"),
        F.when(k % 6 == 0, lit(None).cast("string")).when(k % 6 == 1, lit(""))
         .otherwise(F.md5(F.concat(lit("pw:"), c("c_name")))).alias("password_hash"),
        F.when(k % 8 == 0, lit(None).cast("string"))
         .otherwise(F.substring(F.md5(F.concat(lit("key:"), c("c_name"))), 9, 16)).alias("secret_key"),
    )


def people(spark, d):
    cu = base(spark, d, "customer")
    k = c("c_custkey")
    return cu.where(k % 6 != 5).select(
        F.md5(F.concat(lit("bp:"), c("c_name"))).alias("id"),
        c("c_name").alias("code"),
        F.concat(lit("Emp "), _s(k)).alias("name"),
        F.when(k % 8 == 0, lit(None).cast("string"))
         .when(k % 8 == 1, F.md5(F.concat(lit("stale:"), c("c_name"))))
         .otherwise(F.md5(F.concat(lit("su:"), c("c_name")))).alias("sys_user"),
        F.when(k % 10 == 0, lit(None).cast("int")).when((k % 10).isin(1, 2, 5), lit(1))
         .otherwise(lit(0)).alias("job_status"),
        F.when(k % 12 == 0, lit(None).cast("string")).when(k % 12 == 1, lit(""))
         .otherwise(_s(c("c_nationkey"))).alias("group_id"),
    )


def personnel(spark, d):
    cu = base(spark, d, "customer")
    k = c("c_custkey")
    nk = F.when(k % 13 == 0, (c("c_nationkey") + 1) % 25).otherwise(c("c_nationkey"))
    return cu.where(k % 7 != 2).select(
        k.cast("int").alias("serial_number"),
        F.concat(lit("NATION_"), _s(nk)).alias("group_name"),
        c("c_name").alias("employee_id"),
        F.when(k % 29 == 0, lit("Renamed")).otherwise(F.concat(lit("Emp "), _s(k))).alias("name"),
        lit(None).cast("date").alias("join_date"),
    )


def groups_dim(spark, d):
    n = base(spark, d, "nation")
    return n.where(~c("n_nationkey").isin(20, 21)).select(
        _s(c("n_nationkey")).alias("id"), c("n_name").alias("group_name"))


def picking_lines(spark, d):
    li = base(spark, d, "lineitem")
    return li.select(
        c("l_orderkey").alias("picking_id"), c("l_partkey").alias("item_id"),
        F.concat(lit("WO"), _s(c("l_orderkey"))).alias("src_doc_no"),
        F.concat(_s(c("l_orderkey")), lit("-"), _s(c("l_linenumber"))).alias("doc_no"),
        F.concat(lit("M"), _s(c("l_partkey"))).alias("matnr"),
        c("l_quantity").alias("qty"),
        F.when(c("l_linenumber") == 4, lit(None)).otherwise(c("l_shipdate")).alias("requisition_ts"),
        F.when(c("l_returnflag") == "A", lit("signed")).when(c("l_returnflag") == "N", lit("issuing"))
         .when(c("l_linestatus") == "F", lit(None).cast("string")).otherwise(lit("pending")).alias("prep_status"),
    )


def picking_heads(spark, d):
    o = base(spark, d, "orders")
    p = c("o_orderpriority")
    return o.select(
        c("o_orderkey").alias("id"),
        F.when(p == "5-LOW", lit("G-LOW")).when(p == "4-NOT SPECIFIED", lit(None).cast("string"))
         .otherwise(p).alias("remark"))


def items(spark, d):
    p = base(spark, d, "part")
    return p.select(c("p_partkey").alias("id"), c("p_name").alias("item_name"),
                    F.concat(c("p_brand"), lit("/"), c("p_type")).alias("item_specs"))


def item_keepers(spark, d):
    """One keeper for each five suppliers: every item has up to four, from all of its lines."""
    nth = c("l_suppkey") % 5
    return base(spark, d, "lineitem").select(c("l_partkey").alias("item_id"), F.when(
        nth != 0, F.format_string("Supplier#%09d", nth * 4 + 3)).alias("keeper")).distinct()


def attendance(spark, d):
    e = base(spark, d, "events")
    u = c("user_id")
    et = c("event_type")
    return e.select(
        c("event_id").alias("row_id"), _s(u).alias("empcode"), c("ts").cast("date").alias("work_date"),
        F.when(u % 37 == 0, lit(None).cast("string")).otherwise(F.concat(lit("G"), _s(u % 12))).alias("group_name"),
        F.when(et == "click", lit("normal")).when(et == "purchase", lit("late 5m"))
         .when(et == "error", lit("absent")).when(et == "signup", lit("leave-annual"))
         .when(c("value") < 5, lit(None).cast("string")).otherwise(lit("other")).alias("status"),
    )


def system_log(spark, d):
    e = base(spark, d, "events")
    et = c("event_type")
    return e.select(
        c("event_id").alias("log_id"), c("ts").alias("log_time"),
        F.when(et == "error", lit("Error")).when(et == "signup", lit("Warning")).otherwise(lit("Information")).alias("log_level"),
        et.alias("category"), F.coalesce(c("props"), lit("")).alias("message"), _s(c("user_id")).alias("user_id"),
    )


REPORT_RULE_SCHEMA = ("rule_id string, level int, user_ids string, enterprise_id string, org_id string, is_active boolean, "
                      "report string, keeper_name string")


def report_rules(spark, d):
    """Fixed rules for every case, and one rule of level 5 for each supplier, so that the table grows with the data."""
    k = c("s_suppkey")
    own = base(spark, d, "supplier").select(
        F.concat(lit("s"), _s(k)).alias("rule_id"), lit(5).alias("level"),
        F.when(k % 3 == 0, F.concat(lit("u"), _s(k))).when(k % 3 == 1, F.concat(lit("u"), _s(k), lit(", ,u1"))).otherwise(lit(" , ")).alias("user_ids"),
        F.when(k % 4 != 0, lit("ent-1")).alias("enterprise_id"), lit("org-1").alias("org_id"), (k % 5 != 0).alias("is_active"),
        F.when(k % 7 == 0, lit("")).otherwise(lit("picking")).alias("report"), c("s_name").alias("keeper_name"))
    return spark.sql(f"SELECT * FROM {FIXED_RULES}").union(own)


BUILDERS = {
    "roster": roster, "accounts": accounts, "logons": logons, "people": people,
    "personnel": personnel, "groups_dim": groups_dim, "picking_lines": picking_lines,
    "picking_heads": picking_heads, "items": items, "item_keepers": item_keepers,
    "attendance": attendance, "system_log": system_log, "report_rules": report_rules,
}


def _listing(spark: SparkSession, folder: str) -> tuple:
    """What a folder holds, through the Hadoop file system of its path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in found))


class Tables:
    """Lazy access to the stand-in views of one data folder: ``T.roster`` etc.

    The resolved DataFrames (plans only, no data) are shared by every query of
    the same session and folder, so files are listed and footers read once per
    session rather than once per query. They are kept by what the folder holds
    (names, sizes and times of its entries): a replaced or added file makes new
    ones.
    """

    _shared: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        key = (id(spark), spark.sparkContext.applicationId, self.sf_dir)
        state = _listing(spark, self.sf_dir)
        if Tables._shared.get(key, (None,))[0] != state:
            Tables._shared[key] = (state, {})
        self._cache = Tables._shared[key][1]

    @classmethod
    def forget(cls, sf_dir: str | None = None):
        for k in list(cls._shared):
            if sf_dir is None or k[2] == sf_dir.rstrip("/"):
                del cls._shared[k]

    def __getattr__(self, name) -> DataFrame:
        if name.startswith("_") or name not in BUILDERS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = BUILDERS[name](self.spark, self.sf_dir)
        return self._cache[name]

    def as_dict(self) -> dict:
        return {n: getattr(self, n) for n in BUILDERS}


# ---------------------------------------------------------------------------
# SQL text of the same views (DuckDB and Spark SQL), for oracle CTEs.
FIXED_RULES = """(VALUES
  ('r1', 1, 'u1, u2,u3', 'ent-1', 'org-1', TRUE, 'picking', NULL),
  ('r2', 2, 'u2,,u4', NULL, NULL, TRUE, 'picking', NULL),
  ('r3', 3, 'u5', 'ent-1', NULL, TRUE, 'picking', NULL),
  ('r4', 4, 'u1', 'ent-2', 'org-1', TRUE, 'picking', NULL),
  ('r5', 5, '   ', 'ent-1', 'org-1', TRUE, 'picking', NULL),
  ('r6', 5, 'u6', 'ent-1', 'org-1', FALSE, 'picking', NULL),
  ('r7', 101, 'u1,u7', 'ent-1', 'org-1', TRUE, 'attendance', NULL),
  ('r8', 201, 'u8', 'ent-1', 'org-1', TRUE, 'groups', NULL),
  ('r9', 4, 'u9', 'ent-1', 'org-1', TRUE, 'picking', 'Supplier#000000007'),
  ('r10', 5, 'u10,u11', 'ent-1', 'org-1', TRUE, 'picking', 'Supplier#000000011'),
  ('r11', 5, 'u12', NULL, 'org-1', TRUE, 'picking', NULL),
  ('r12', 1, 'u13', 'ent-1', 'org-1', TRUE, ' ', NULL),
  ('r13', 3, 'u14', 'ent-1', 'org-1', TRUE, 'no such report', NULL),
  ('r14', 42, 'u15', 'ent-1', 'org-1', TRUE, 'picking', NULL)
) AS t(rule_id, level, user_ids, enterprise_id, org_id, is_active, report, keeper_name)"""
VIEW_SQL = {
    "roster": """SELECT c_name AS empcode, concat('Emp ', CAST(c_custkey AS VARCHAR)) AS empname,
       c_mktsegment AS gdname4,
       CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS isactive
FROM customer""",
    "accounts": """SELECT md5(concat('su:', c_name)) AS id, c_name AS account,
       concat('Emp ', CAST(c_custkey AS VARCHAR)) AS real_name,
       CASE WHEN c_custkey % 11 = 0 THEN 1 WHEN c_custkey % 3 = 0 THEN NULL ELSE 0 END AS delete_mark,
       CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS enabled_mark,
       'org-1' AS org, 'ent-1' AS enterprise_id
FROM customer WHERE c_custkey % 4 <> 3
UNION ALL
SELECT md5(concat('su:', s_name)), s_name, s_name, 0, 1, 'org-1', 'ent-1' FROM supplier""",
    "logons": """SELECT md5(concat('su:', c_name)) AS id, md5(concat('su:', c_name)) AS user_id,
       CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN ''
            ELSE md5(concat('pw:', c_name)) END AS password_hash,
       CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE substring(md5(concat('key:', c_name)), 9, 16) END AS secret_key
FROM customer WHERE c_custkey % 4 <> 3 AND c_custkey % 5 <> 1""",
    "people": """SELECT md5(concat('bp:', c_name)) AS id, c_name AS code,
       concat('Emp ', CAST(c_custkey AS VARCHAR)) AS name,
       CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN md5(concat('stale:', c_name))
            ELSE md5(concat('su:', c_name)) END AS sys_user,
       CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 IN (1, 2, 5) THEN 1 ELSE 0 END AS job_status,
       CASE WHEN c_custkey % 12 = 0 THEN NULL WHEN c_custkey % 12 = 1 THEN ''
            ELSE CAST(c_nationkey AS VARCHAR) END AS group_id
FROM customer WHERE c_custkey % 6 <> 5""",
    "personnel": """SELECT CAST(c_custkey AS INT) AS serial_number,
       concat('NATION_', CAST(CASE WHEN c_custkey % 13 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS VARCHAR)) AS group_name,
       c_name AS employee_id,
       CASE WHEN c_custkey % 29 = 0 THEN 'Renamed' ELSE concat('Emp ', CAST(c_custkey AS VARCHAR)) END AS name,
       CAST(NULL AS DATE) AS join_date
FROM customer WHERE c_custkey % 7 <> 2""",
    "groups_dim": """SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS group_name
FROM nation WHERE n_nationkey NOT IN (20, 21)""",
    "picking_lines": """SELECT l_orderkey AS picking_id, l_partkey AS item_id,
       concat('WO', CAST(l_orderkey AS VARCHAR)) AS src_doc_no,
       concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS doc_no,
       concat('M', CAST(l_partkey AS VARCHAR)) AS matnr, l_quantity AS qty,
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_shipdate END AS requisition_ts,
       CASE WHEN l_returnflag = 'A' THEN 'signed' WHEN l_returnflag = 'N' THEN 'issuing'
            WHEN l_linestatus = 'F' THEN NULL ELSE 'pending' END AS prep_status
FROM lineitem""",
    "picking_heads": """SELECT o_orderkey AS id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'G-LOW'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS remark
FROM orders""",
    "items": """SELECT p_partkey AS id, p_name AS item_name, concat(p_brand, '/', p_type) AS item_specs FROM part""",
    "item_keepers": """SELECT DISTINCT l_partkey AS item_id,
       CASE WHEN l_suppkey % 5 <> 0 THEN printf('Supplier#%09d', l_suppkey % 5 * 4 + 3) END AS keeper FROM lineitem""",
    "attendance": """SELECT event_id AS row_id, CAST(user_id AS VARCHAR) AS empcode, CAST(ts AS DATE) AS work_date,
       CASE WHEN user_id % 37 = 0 THEN NULL ELSE concat('G', CAST(user_id % 12 AS VARCHAR)) END AS group_name,
       CASE WHEN event_type = 'click' THEN 'normal' WHEN event_type = 'purchase' THEN 'late 5m'
            WHEN event_type = 'error' THEN 'absent' WHEN event_type = 'signup' THEN 'leave-annual'
            WHEN value < 5 THEN NULL ELSE 'other' END AS status
FROM events""",
    "system_log": """SELECT event_id AS log_id, ts AS log_time,
       CASE WHEN event_type = 'error' THEN 'Error' WHEN event_type = 'signup' THEN 'Warning' ELSE 'Information' END AS log_level,
       event_type AS category, coalesce(props, '') AS message, CAST(user_id AS VARCHAR) AS user_id
FROM events""",
    "report_rules": f"""SELECT * FROM {FIXED_RULES}
UNION ALL
SELECT concat('s', s_suppkey), 5, CASE s_suppkey % 3 WHEN 0 THEN concat('u', s_suppkey) WHEN 1 THEN concat('u', s_suppkey, ', ,u1')
       ELSE ' , ' END, CASE WHEN s_suppkey % 4 <> 0 THEN 'ent-1' END, 'org-1', s_suppkey % 5 <> 0,
       CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE 'picking' END, s_name FROM supplier""",
}

_ORDER = list(VIEW_SQL)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every stand-in view it names."""
    used = [v for v in _ORDER if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{v} AS (\n{VIEW_SQL[v]}\n)" for v in used)
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
