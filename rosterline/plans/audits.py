"""Set-difference report (SET1, A10) and the duplicate-key audit (Q12)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.operators.audit import missing_from
from rosterline.operators.identity import with_identity
from rosterline.plans.registry import query
from rosterline.sources.standins import Tables

c = F.col


def personnel_missing(personnel: DataFrame, accounts: DataFrame) -> DataFrame:
    """SET1: personnel rows whose employee id has no account (anti-join, not
    EXCEPT: the rows carry columns the other side lacks)."""
    return missing_from(personnel, accounts, "employee_id", "account")


def personnel_missing_detail(personnel, accounts) -> DataFrame:
    return (personnel_missing(personnel, accounts)
            .select("group_name", "employee_id", "name", "serial_number").orderBy("group_name", "employee_id"))


def personnel_missing_summary(personnel, accounts) -> DataFrame:
    """A10: count per group of the difference."""
    return (personnel_missing(personnel, accounts).groupBy("group_name")
            .agg(F.count(F.lit(1)).alias("cnt")).orderBy("group_name"))


KEYED = (("roster", "empcode"), ("accounts", "account"), ("accounts", "id"), ("logons", "user_id"),
         ("people", "code"), ("people", "id"), ("personnel", "employee_id"), ("picking_lines", "doc_no"))


def all_duplicate_keys(T: Tables, keyed=KEYED) -> DataFrame:
    """Q12 over every business key the joins and updates assume unique.

    One aggregate for all tables: the (table, key) pairs of every table are
    stacked and counted together, so there is one shuffle, combined map-side
    (a key holding a third of a table is one partial count per task)."""
    stacked, keys = None, {}
    for table, key in keyed:
        keys.setdefault(table, []).append(key)
    for table, names in keys.items():         # one scan a table, whatever the number of its keys
        each = F.array(*[F.struct(F.lit(f"{table}.{k}").alias("table_name"), c(k).cast("string").alias("key_value")) for k in names])
        part = getattr(T, table).select(F.explode(each).alias("_k")).select("_k.*")
        stacked = part if stacked is None else stacked.unionByName(part)
    return (stacked.groupBy("table_name", "key_value").agg(F.count(F.lit(1)).alias("occurrences"))
            .where(c("occurrences") > 1))


@query("personnel_identity", """
SELECT row_number() OVER (ORDER BY serial_number) AS id, serial_number, employee_id, group_name FROM personnel
""")
def q_personnel_identity(spark, d):
    """SNK6: the generated identity of the personnel rows, in the order of the sheet."""
    rows = Tables(spark, d).personnel.select("serial_number", "employee_id", "group_name")
    return with_identity(rows, ["serial_number"], version=uuid.uuid4().hex[:12], table="personnel_identity")


@query("personnel_missing_detail", """
SELECT per.group_name, per.employee_id, per.name, per.serial_number FROM personnel per
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account = per.employee_id)
ORDER BY per.group_name, per.employee_id
""")
def q_personnel_missing_detail(spark, d):
    T = Tables(spark, d)
    return personnel_missing_detail(T.personnel, T.accounts)


@query("personnel_missing_summary", """
SELECT per.group_name, count(*) AS cnt FROM personnel per
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account = per.employee_id)
GROUP BY per.group_name ORDER BY per.group_name
""")
def q_personnel_missing_summary(spark, d):
    T = Tables(spark, d)
    return personnel_missing_summary(T.personnel, T.accounts)


_DUP_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}.{k}' AS table_name, CAST({k} AS VARCHAR) AS key_value, count(*) AS occurrences "
    f"FROM {t} GROUP BY {k} HAVING count(*) > 1" for t, k in KEYED)


@query("duplicate_keys", _DUP_SQL)
def q_duplicate_keys(spark, d):
    return all_duplicate_keys(Tables(spark, d))
