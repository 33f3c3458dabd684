"""Account family: insert missing accounts (I1), disable leavers (U1, U1s),
their previews and counts (C14, C14a, Q15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.exprs import (in_scope, in_scope_sql, map_ordered, map_ordered_sql,
                                        project_template, project_template_sql, quoted, stable_id_sql, ts_lit)
from rosterline.operators.audit import weighted
from rosterline.operators.change import Change, insert_missing, update_from
from rosterline.params import DEFAULT_PARAMS, SyncParams
from rosterline.plans.registry import query
from rosterline.schemas import ACCOUNT_FIXED, ACCOUNT_SCHEMA
from rosterline.sources.standins import Tables

c = F.col
P = DEFAULT_PARAMS


# ------------------------------------------------------------------ operators
def acct_insert_missing(roster: DataFrame, accounts: DataFrame, p: SyncParams = P,
                        dedup: bool = False, cut=None) -> Change:
    """Active, in-scope roster people without an account become accounts."""
    src = roster.where(in_scope("gdname4", p) & (c("isactive") == 1))

    def template(df):
        return project_template({
            "id": c("id"), "account": c("empcode"), "real_name": c("empname"),
            "gender": 0, "is_admin": 0, "role_id": p.role_id,
            "organize_id": p.organize_id, "department_id": p.organize_id,
            "delete_mark": None, "enabled_mark": 1,
            "org": p.org, "enterprise_id": p.enterprise_id,
            "factory": map_ordered("gdname4", p.dept_pairs(), p.default_factory),
            "created_at": ts_lit(p.run_ts), "created_by": p.system_user,
            "modified_at": ts_lit(p.run_ts), "modified_by": p.system_user,
            "added_at": ts_lit(p.run_ts), "added_by": p.system_user, "changed_at": ts_lit(p.run_ts), "changed_by": p.system_user,
            **ACCOUNT_FIXED,
        }, ACCOUNT_SCHEMA)

    return insert_missing(src, accounts, "empcode", "account", template, id_table="accounts",
                          dedup=dedup, cut=cut, source_cols=["empcode", "empname", "gdname4", "isactive"])


def acct_disable_leavers(accounts: DataFrame, roster: DataFrame, p: SyncParams = P,
                         scoped: bool = True, extra: tuple = ()) -> Change:
    """U1 (service) / U1s (script): leavers' accounts get enabled_mark = 0.

    Service: in scope, flag 0, mark NULL or not 0. Script: flag 0 only, so rows
    already 0 are rewritten (and counted). Nobody is ever re-enabled. ``extra``:
    more columns of ``accounts`` that tell its rows apart in the delta.
    """
    on = c("t.account") == c("s.empcode")
    if scoped:
        when = (in_scope("s.gdname4", p) & (c("s.isactive") == 0)
                & (c("t.enabled_mark").isNull() | (c("t.enabled_mark") != 0)))
    else:
        when = c("s.isactive") == 0
    return update_from(accounts, roster, on, when, {"enabled_mark": F.lit(0)},
                       source_cols=["empcode", "gdname4", "isactive"], target_cols=list(extra) + ["account", "enabled_mark"], key="account")


def acct_disable_preview(accounts: DataFrame, roster: DataFrame) -> DataFrame:
    """C14: leaver pairs whose mark is not 0 (a NULL mark drops out: F6)."""
    a, r = accounts.alias("a"), roster.alias("r")
    return (a.join(r, c("a.account") == c("r.empcode"))
             .where((c("r.isactive") == 0) & (c("a.enabled_mark") != 0))
             .select(c("a.id"), c("a.account"), c("a.real_name"),
                     c("a.enabled_mark").alias("current_enabled_mark"),
                     c("r.empcode"), c("r.gdname4"), c("r.isactive"),
                     F.lit("needs_update_to_0").alias("status")))


def acct_enabled_detail(accounts: DataFrame, roster: DataFrame) -> DataFrame:
    """Every leaver pair with a status text; a NULL mark gives NULL text."""
    a, r = accounts.alias("a"), roster.alias("r")
    st = F.when(c("a.enabled_mark") == 0, F.lit("updated to 0")).otherwise(
        F.concat(F.lit("not updated (enabled_mark="), c("a.enabled_mark").cast("string"), F.lit(")")))
    return (a.join(r, c("a.account") == c("r.empcode")).where(c("r.isactive") == 0)
             .select(c("a.id"), c("a.account"), c("a.real_name"), c("a.enabled_mark"),
                     c("r.empcode"), c("r.gdname4"), c("r.isactive"), st.alias("status"))
             .orderBy("account"))


def acct_disable_counts(accounts: DataFrame, roster: DataFrame) -> DataFrame:
    """Q15: done / not-done counts of leaver pairs (COUNT semantics: 0 on no
    rows), the roster reduced to leaver codes with multiplicities."""
    r = weighted(roster.where(c("isactive") == 0), ["empcode"])
    j = accounts.join(r, c("account") == c("empcode"))

    def n(cond):
        return F.coalesce(F.sum(F.when(cond, c("_w"))), F.lit(0)).cast("bigint")
    return j.agg(n(c("enabled_mark") == 0).alias("updated_count"),
                 n(c("enabled_mark") != 0).alias("not_updated_count"))


# -------------------------------------------------------------------- queries
_I1_SQL = f"""
WITH src AS (
  SELECT empcode, empname, gdname4, isactive, count(*) AS n
  FROM roster r
  WHERE {in_scope_sql('r.gdname4', P)} AND r.isactive = 1
    AND NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account = r.empcode)
  GROUP BY empcode, empname, gdname4, isactive
), cp AS (SELECT *, unnest(generate_series(1, n)) AS copy_no FROM src)
SELECT {project_template_sql({
    "id": stable_id_sql("'accounts'", 'empcode', 'empname', 'gdname4', 'isactive', 'copy_no'), "account": "empcode", "real_name": "empname",
    "gender": 0, "is_admin": 0, "enabled_mark": 1, "factory": map_ordered_sql('gdname4', P.dept_pairs(), P.default_factory),
    **{k: f"TIMESTAMP '{P.run_ts}'" for k in ("created_at", "modified_at", "added_at", "changed_at")},
    **{k: f"'{P.system_user}'" for k in ("created_by", "modified_by", "added_by", "changed_by")},
    **quoted({"role_id": P.role_id, "organize_id": P.organize_id, "department_id": P.organize_id, "org": P.org,
              "enterprise_id": P.enterprise_id, **ACCOUNT_FIXED})}, ACCOUNT_SCHEMA)}
FROM cp
"""


@query("acct_insert_missing", _I1_SQL)
def q_acct_insert_missing(spark, d):
    T = Tables(spark, d)
    return acct_insert_missing(T.roster, T.accounts).rows


_I1_AFTER_SQL = f"SELECT * FROM accounts UNION ALL BY NAME SELECT * FROM ({_I1_SQL.strip()})"


@query("acct_insert_missing_after", _I1_AFTER_SQL)
def q_acct_insert_missing_after(spark, d):
    T = Tables(spark, d)
    return acct_insert_missing(T.roster, T.accounts).after


_U1_SQL = f"""
SELECT a.id, a.account, a.real_name, a.delete_mark, 0 AS enabled_mark, a.org, a.enterprise_id
FROM accounts a
WHERE EXISTS (SELECT 1 FROM roster r WHERE a.account = r.empcode
              AND {in_scope_sql('r.gdname4', P)} AND r.isactive = 0
              AND (a.enabled_mark IS NULL OR a.enabled_mark <> 0))
"""


@query("acct_disable_leavers", _U1_SQL)
def q_acct_disable_leavers(spark, d):
    T = Tables(spark, d)
    return acct_disable_leavers(T.accounts, T.roster).rows


_U1S_SQL = """
SELECT a.id, a.account, a.real_name, a.delete_mark, 0 AS enabled_mark, a.org, a.enterprise_id
FROM accounts a
WHERE EXISTS (SELECT 1 FROM roster r WHERE a.account = r.empcode AND r.isactive = 0)
"""


@query("acct_disable_leavers_script", _U1S_SQL)
def q_acct_disable_leavers_script(spark, d):
    T = Tables(spark, d)
    return acct_disable_leavers(T.accounts, T.roster, scoped=False).rows


@query("acct_disable_leavers_after", f"""
SELECT a.id, a.account, a.real_name, a.delete_mark,
       CASE WHEN u.id IS NOT NULL THEN u.enabled_mark ELSE a.enabled_mark END AS enabled_mark,
       a.org, a.enterprise_id
FROM accounts a LEFT JOIN ({_U1_SQL.strip()}) u ON a.id = u.id
""")
def q_acct_disable_leavers_after(spark, d):
    T = Tables(spark, d)
    return acct_disable_leavers(T.accounts, T.roster).after


@query("acct_disable_preview", """
SELECT a.id, a.account, a.real_name, a.enabled_mark AS current_enabled_mark,
       r.empcode, r.gdname4, r.isactive, 'needs_update_to_0' AS status
FROM accounts a JOIN roster r ON a.account = r.empcode
WHERE r.isactive = 0 AND a.enabled_mark <> 0
""")
def q_acct_disable_preview(spark, d):
    T = Tables(spark, d)
    return acct_disable_preview(T.accounts, T.roster)


@query("acct_enabled_detail", """
WITH leaver AS (SELECT * FROM roster WHERE isactive = 0)
SELECT id, account, real_name, enabled_mark, empcode, gdname4, isactive,
       if(enabled_mark = 0, 'updated to 0', 'not updated (enabled_mark=' || enabled_mark || ')') AS status
FROM leaver JOIN accounts ON account = empcode
""")
def q_acct_enabled_detail(spark, d):
    T = Tables(spark, d)
    return acct_enabled_detail(T.accounts, T.roster)


@query("acct_disable_counts", """
SELECT count(CASE WHEN a.enabled_mark = 0 THEN 1 END) AS updated_count,
       count(CASE WHEN a.enabled_mark <> 0 THEN 1 END) AS not_updated_count
FROM accounts a JOIN roster r ON a.account = r.empcode
WHERE r.isactive = 0
""")
def q_acct_disable_counts(spark, d):
    T = Tables(spark, d)
    return acct_disable_counts(T.accounts, T.roster)
