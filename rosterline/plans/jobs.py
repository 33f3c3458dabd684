"""Person family: insert missing people (I3), job status updates (U2, U2a-d),
previews and profiles (C13, C13 simple, C13a, Q13, Q14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.exprs import (classify, decode, in_scope, in_scope_sql, job_status_expr,
                                        job_status_on_insert, map_ordered, map_ordered_sql,
                                        project_template, project_template_sql, quoted, stable_id_sql, ts_lit)
from rosterline.operators.audit import weighted
from rosterline.operators.change import Change, insert_missing, update_from
from rosterline.params import DEFAULT_PARAMS, JOB_LABELS, JOB_UNKNOWN, SyncParams
from rosterline.plans.registry import query
from rosterline.schemas import PEOPLE_FIXED, PEOPLE_SCHEMA
from rosterline.sources.standins import Tables

c = F.col
P = DEFAULT_PARAMS


# ------------------------------------------------------------------ operators
def people_insert_missing(roster: DataFrame, people: DataFrame, p: SyncParams = P,
                          dedup: bool = False, cut=None) -> Change:
    """Active, in-scope roster rows with no person row become people."""
    src = roster.where(in_scope("gdname4", p) & (c("isactive") == 1))

    def template(df):
        return project_template({
            "id": c("id"), "code": c("empcode"), "name": c("empname"),
            "sys_user": None, "job_status": job_status_on_insert("isactive"), "group_id": None,
            "factory": map_ordered("gdname4", p.dept_pairs(), p.default_factory),
            "is_quit": 0, "staff_type": "staff", "org": p.org, "enterprise_id": p.enterprise_id,
            "created_at": ts_lit(p.run_ts), "created_by": p.system_user,
            "modified_at": ts_lit(p.run_ts), "modified_by": p.system_user,
            **{k: ts_lit(p.run_ts) for k in ("committed_at", "approved_at", "approval_cancelled_at")}, **PEOPLE_FIXED,
        }, PEOPLE_SCHEMA)

    return insert_missing(src, people, "empcode", "code", template, id_table="people", dedup=dedup, cut=cut,
                          source_cols=["empcode", "empname", "gdname4", "isactive"])


def _change_test(status, flag):
    return status.isNull() | ((flag == 0) & (status != 1)) | ((flag == 1) & (status != 0))


def people_job_status(people: DataFrame, roster: DataFrame, p: SyncParams = P,
                      scope: str = "config", extra: tuple = ()) -> Change:
    """U2 family: job status follows the roster flag where NULL or contradicting.

    scope: "config" (service, U2), "dept" (one department, U2c), "all" (U2d).
    A NULL status with a flag outside {0, 1} counts as changed but stays NULL.
    ``extra``: more columns of ``people`` that tell its rows apart in the delta.
    """
    st, fl = c("t.job_status"), c("s.isactive")
    when = fl.isNotNull() & _change_test(st, fl)
    if scope == "config":
        when = in_scope("s.gdname4", p) & when
    elif scope == "dept":
        when = (c("s.gdname4") == p.single_dept) & when
    return update_from(people, roster, c("t.code") == c("s.empcode"), when,
                       {"job_status": job_status_expr(fl, st)},
                       source_cols=["empcode", "gdname4", "isactive"], target_cols=list(extra) + ["code", "job_status"], key="code")


def people_job_status_oneway(people: DataFrame, roster: DataFrame, to_left: bool) -> Change:
    """U2a (to_left) / U2b: two separate one-way updates, no scope."""
    flag, val = (0, 1) if to_left else (1, 0)
    st = c("t.job_status")
    when = (c("s.isactive") == flag) & (st.isNull() | (st != val))
    return update_from(people, roster, c("t.code") == c("s.empcode"), when,
                       {"job_status": F.lit(val)}, source_cols=["empcode", "isactive"], target_cols=["code", "job_status"], key="code")


def _status_name(x, default=JOB_UNKNOWN):
    return decode(x, JOB_LABELS, default)


def job_status_preview(people, roster) -> DataFrame:
    """People whose status would change, with decodes, target and label."""
    b, r = people.alias("b"), roster.alias("r")
    st, fl = c("b.job_status"), c("r.isactive")
    label = classify([(st.isNull() & fl.isNull(), "other"), (st.isNull(), "needs_update (was NULL)"),
                      (fl == 0, "needs_update_to_left")], "needs_update_to_active")
    return (b.join(r, c("b.code") == c("r.empcode")).where(_change_test(st, fl))
             .select(c("b.code"), c("b.name"), st.alias("current_job_status"),
                     _status_name(st).alias("current_status_name"), c("r.empcode"),
                     fl.alias("roster_isactive"), decode(fl, {0: "left", 1: "active"}, JOB_UNKNOWN).alias("roster_status_name"),
                     job_status_expr(fl).alias("target_job_status"), label.alias("status"))
             .orderBy("code"))


def job_status_preview_simple(people, roster) -> DataFrame:
    """C13 (simple): requires a known flag; a NULL status is labelled matched."""
    b, r = people.alias("b"), roster.alias("r")
    st, fl = c("b.job_status"), c("r.isactive")
    label = classify([((fl == 0) & (st != 1), "needs_update_to_left"),
                      ((fl == 1) & (st != 0), "needs_update_to_active")], "matched")
    return (b.join(r, c("b.code") == c("r.empcode")).where(fl.isNotNull() & _change_test(st, fl))
             .select(c("b.code"), c("b.name"), st.alias("current_job_status"),
                     _status_name(st, "NULL").alias("current_status_name"),
                     fl.alias("roster_isactive"), decode(fl, {0: "left", 1: "active"}).alias("roster_status_name"),
                     job_status_expr(fl).alias("target_job_status"), label.alias("status"))
             .orderBy("code"))


def job_status_inconsistent(people, roster, p: SyncParams = P) -> DataFrame:
    """Contradictions left in one department; a NULL status is not reported."""
    b, r = people.alias("b"), roster.alias("r")
    st, fl = c("b.job_status"), c("r.isactive")
    bad = ((fl == 0) & (st != 1)) | ((fl == 1) & (st != 0))
    label = classify([(fl == 0, "inconsistent (should be left)")], "inconsistent (should be active)")
    return (b.join(r, c("b.code") == c("r.empcode"))
             .where((c("r.gdname4") == p.single_dept) & fl.isNotNull() & bad)
             .select(c("b.code"), c("b.name"), st.alias("current_job_status"),
                     _status_name(st).alias("current_status_name"), fl.alias("roster_isactive"),
                     decode(fl, {0: "left", 1: "active"}, JOB_UNKNOWN).alias("roster_status_name"),
                     label.alias("status"))
             .orderBy("code"))


def job_status_distribution(people, roster) -> DataFrame:
    """Q13: count per (status, flag) of the person x roster pairs, from the
    roster reduced to (code, flag) with multiplicities (no pair is built)."""
    r = weighted(roster, ["empcode", "isactive"])
    return (people.join(r, c("code") == c("empcode"))
             .groupBy(c("job_status"), c("isactive").alias("roster_isactive"))
             .agg(F.sum("_w").cast("bigint").alias("cnt"))
             .select("job_status", _status_name(c("job_status")).alias("status_name"), "roster_isactive", "cnt")
             .orderBy("job_status", "roster_isactive"))


def job_status_profile(people, roster, p: SyncParams = P) -> DataFrame:
    """Q14: total, matched active, matched left, mismatched in one department
    (pair counts from the roster reduced to (code, flag) with multiplicities)."""
    r = weighted(roster.where(c("gdname4") == p.single_dept), ["empcode", "isactive"])
    st, fl, w = c("job_status"), c("isactive"), c("_w")
    j = people.join(r, c("code") == c("empcode"))

    def s(cond):
        return F.sum(F.when(cond, w).otherwise(0)).cast("bigint")
    return j.agg(F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias("total_records"),
                 s((st == 0) & (fl == 1)).alias("matched_active"),
                 s((st == 1) & (fl == 0)).alias("matched_left"),
                 s(((st == 0) & (fl == 0)) | ((st == 1) & (fl == 1))).alias("mismatched"),
                 F.lit("status after update").alias("description"))


# -------------------------------------------------------------------- queries
_I3_SQL = f"""
WITH src AS (
  SELECT empcode, empname, gdname4, isactive, count(*) AS n FROM roster r
  WHERE {in_scope_sql('r.gdname4', P)} AND r.isactive = 1
    AND NOT EXISTS (SELECT 1 FROM people b WHERE b.code = r.empcode)
  GROUP BY empcode, empname, gdname4, isactive
), cp AS (SELECT *, unnest(generate_series(1, n)) AS copy_no FROM src)
SELECT {project_template_sql({
    "id": stable_id_sql("'people'", 'empcode', 'empname', 'gdname4', 'isactive', 'copy_no'), "code": "empcode", "name": "empname",
    "job_status": "if(isactive = 0, 1, 0)", "factory": map_ordered_sql('gdname4', P.dept_pairs(), P.default_factory), "is_quit": 0,
    **{k: f"TIMESTAMP '{P.run_ts}'" for k in ("created_at", "modified_at", "committed_at", "approved_at", "approval_cancelled_at")},
    **quoted({"staff_type": "staff", "org": P.org, "enterprise_id": P.enterprise_id, "created_by": P.system_user,
              "modified_by": P.system_user, **PEOPLE_FIXED})}, PEOPLE_SCHEMA)}
FROM cp
"""


@query("people_insert_missing", _I3_SQL)
def q_people_insert_missing(spark, d):
    T = Tables(spark, d)
    return people_insert_missing(T.roster, T.people).rows


def _u2_sql(scope: str, flag: str = "r.isactive IS NOT NULL") -> str:
    """People whose status is unknown or not what a roster row of their code asks for."""
    return f"""
WITH asked(flag, target) AS (VALUES (0, 1), (1, 0))
SELECT b.id, b.code, b.name, b.sys_user, min(coalesce(target, b.job_status)) AS job_status, b.group_id
FROM roster r JOIN people b ON b.code = r.empcode LEFT JOIN asked ON flag = r.isactive
WHERE {scope} AND {flag} AND coalesce(b.job_status <> target, b.job_status IS NULL)
GROUP BY b.id, b.code, b.name, b.sys_user, b.job_status, b.group_id
"""


_U2_SQL = _u2_sql(in_scope_sql('r.gdname4', P))


@query("people_job_status", _U2_SQL)
def q_people_job_status(spark, d):
    T = Tables(spark, d)
    return people_job_status(T.people, T.roster).rows


@query("people_job_status_after", f"""
SELECT b.id, b.code, b.name, b.sys_user,
       CASE WHEN u.id IS NOT NULL THEN u.job_status ELSE b.job_status END AS job_status, b.group_id
FROM people b LEFT JOIN ({_U2_SQL.strip()}) u ON b.id = u.id
""")
def q_people_job_status_after(spark, d):
    T = Tables(spark, d)
    return people_job_status(T.people, T.roster).after


@query("people_job_status_left", _u2_sql("TRUE", "r.isactive = 0"))
def q_people_job_status_left(spark, d):
    T = Tables(spark, d)
    return people_job_status_oneway(T.people, T.roster, to_left=True).rows


@query("people_job_status_active", _u2_sql("TRUE", "r.isactive = 1"))
def q_people_job_status_active(spark, d):
    T = Tables(spark, d)
    return people_job_status_oneway(T.people, T.roster, to_left=False).rows


@query("people_job_status_dept", _u2_sql(f"r.gdname4 = '{P.single_dept}'"))
def q_people_job_status_dept(spark, d):
    T = Tables(spark, d)
    return people_job_status(T.people, T.roster, scope="dept").rows


@query("people_job_status_all", _u2_sql("TRUE"))
def q_people_job_status_all(spark, d):
    T = Tables(spark, d)
    return people_job_status(T.people, T.roster, scope="all").rows


# What a roster flag asks for, and the names of the two states.
_STATES = """asked(flag, target, state) AS (VALUES (0, 1, 'left'), (1, 0, 'active')),
named(status, state) AS (VALUES (0, 'active'), (1, 'left')),
met AS (SELECT b.code, b.name, b.job_status, n.state AS now, r.empcode, r.gdname4, r.isactive, asked.target, asked.state AS wanted
        FROM roster r JOIN people b ON b.code = r.empcode LEFT JOIN asked ON asked.flag = r.isactive
        LEFT JOIN named n ON n.status = b.job_status)"""


@query("job_status_preview", f"""
WITH {_STATES}
SELECT code, name, job_status AS current_job_status, coalesce(now, 'unknown') AS current_status_name, empcode,
       isactive AS roster_isactive, coalesce(wanted, 'unknown') AS roster_status_name, target AS target_job_status,
       if(job_status IS NULL, if(isactive IS NULL, 'other', 'needs_update (was NULL)'), 'needs_update_to_' || wanted) AS status
FROM met WHERE job_status IS NULL OR job_status <> target
""")
def q_job_status_preview(spark, d):
    T = Tables(spark, d)
    return job_status_preview(T.people, T.roster)


@query("job_status_preview_simple", f"""
WITH {_STATES}
SELECT code, name, job_status AS current_job_status, coalesce(now, 'NULL') AS current_status_name, isactive AS roster_isactive,
       wanted AS roster_status_name, target AS target_job_status, if(job_status IS NULL, 'matched', 'needs_update_to_' || wanted) AS status
FROM met WHERE isactive IS NOT NULL AND (job_status IS NULL OR job_status <> target)
""")
def q_job_status_preview_simple(spark, d):
    T = Tables(spark, d)
    return job_status_preview_simple(T.people, T.roster)


@query("job_status_inconsistent", f"""
WITH {_STATES}
SELECT code, name, job_status AS current_job_status, coalesce(now, 'unknown') AS current_status_name, isactive AS roster_isactive,
       wanted AS roster_status_name, format('inconsistent (should be {{}})', wanted) AS status
FROM met WHERE gdname4 = '{P.single_dept}' AND job_status <> target
""")
def q_job_status_inconsistent(spark, d):
    T = Tables(spark, d)
    return job_status_inconsistent(T.people, T.roster)


@query("job_status_distribution", f"""
WITH {_STATES}
SELECT job_status, coalesce(any_value(now), 'unknown') AS status_name, isactive AS roster_isactive, count(*) AS cnt
FROM met GROUP BY job_status, isactive
""")
def q_job_status_distribution(spark, d):
    T = Tables(spark, d)
    return job_status_distribution(T.people, T.roster)


@query("job_status_profile", f"""
WITH {_STATES}
SELECT count(*) AS total_records, count(*) FILTER (now = wanted AND wanted = 'active') AS matched_active,
       count(*) FILTER (now = wanted AND wanted = 'left') AS matched_left, count(*) FILTER (now <> wanted) AS mismatched,
       'status after update' AS description
FROM met WHERE gdname4 = '{P.single_dept}'
""")
def q_job_status_profile(spark, d):
    T = Tables(spark, d)
    return job_status_profile(T.people, T.roster)


@query("people_insert_missing_after", f"SELECT * FROM people UNION ALL BY NAME SELECT * FROM ({_I3_SQL.strip()})")
def q_people_insert_missing_after(spark, d):
    T = Tables(spark, d)
    return people_insert_missing(T.roster, T.people).after
