"""Attendance summaries (A6, A6t, A6b and a rollup form).

Per group of the report day: due, normal, late, absent, leave, unknown,
present = normal + late, rate = present * 100 / due to one decimal (half up).
A status is bucketed by its prefix, first match wins, else unknown (NULL
included); a NULL group is reported as ''.

``groupBy`` aggregates combine map-side, so a group holding a third of the
rows is reduced to one partial row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.exprs import classify, pct, pct_sql
from rosterline.params import ATTENDANCE_BUCKETS, ATTENDANCE_UNKNOWN, DEFAULT_PARAMS, SyncParams
from rosterline.plans.registry import query
from rosterline.sources.standins import Tables

c = F.col
P = DEFAULT_PARAMS


def status_bucket(col, buckets=ATTENDANCE_BUCKETS, default=ATTENDANCE_UNKNOWN):
    """Bucket by prefix in list order; NULL status -> default."""
    s = c(col) if isinstance(col, str) else col
    return classify([(s.startswith(prefix), name) for prefix, name in buckets], default)


def day_rows(att: DataFrame, day: str | None) -> DataFrame:
    """Rows of the report day (``day`` as yyyyMMdd text, X6); ``None`` means
    today (the reference's default), evaluated once per query."""
    d = F.current_date() if day is None else F.to_date(F.lit(day), "yyyyMMdd")
    return att.where(c("work_date") == d)


def attendance_status_rows(att: DataFrame, p: SyncParams = P) -> DataFrame:
    d = day_rows(att, p.attendance_day)
    return d.select("row_id", "empcode", F.coalesce(c("group_name"), F.lit("")).alias("group_name"),
                    "status", status_bucket("status").alias("bucket"))


def _counters():
    b = c("bucket")
    out = [F.count(F.lit(1)).alias("due")]
    for _, name in ATTENDANCE_BUCKETS:
        out.append(F.count(F.when(b == name, 1)).alias(name))
    out.append(F.count(F.when(b == ATTENDANCE_UNKNOWN, 1)).alias(ATTENDANCE_UNKNOWN))
    return out


def _finish(df, keys):
    present = c("normal") + c("late")
    return df.select(*keys, "due", "normal", "late", "absent", "leave", "unknown",
                     present.alias("present"), pct(present, "due").alias("rate"))


def attendance_summary_rows(att: DataFrame, p: SyncParams = P) -> DataFrame:
    """A6 without the final sort: one row per group."""
    rows = attendance_status_rows(att, p)
    return _finish(rows.groupBy("group_name").agg(*_counters()), ["group_name"])


def attendance_by_group(att: DataFrame, p: SyncParams = P) -> DataFrame:
    """One row per group, sorted by group."""
    return attendance_summary_rows(att, p).orderBy("group_name")


def attendance_total(att: DataFrame, p: SyncParams = P) -> DataFrame:
    """A6t: the same over all rows of the day; rate 0 when there are none."""
    return _finish(attendance_status_rows(att, p).agg(*_counters()), [])


def attendance_summary(att: DataFrame, p: SyncParams = P) -> DataFrame:
    """Groups plus the grand total in one aggregation (rollup + grouping()).

    The NULL group is already '' so it can never collide with the total row,
    which is flagged by ``is_total``.
    """
    rows = attendance_status_rows(att, p)
    agg = rows.rollup("group_name").agg(*_counters(), F.grouping("group_name").alias("_g"))
    return _finish(agg, ["group_name", (c("_g") == 1).alias("is_total")]).orderBy("is_total", "group_name")


# -------------------------------------------------------------------- queries
_DAY = f"work_date = strptime('{P.attendance_day}', '%Y%m%d')::DATE"
_BUCKET = ("CASE " + " ".join(f"WHEN status LIKE '{pre}%' THEN '{name}'" for pre, name in ATTENDANCE_BUCKETS)
           + f" ELSE '{ATTENDANCE_UNKNOWN}' END")
_ROWS = f"""SELECT row_id, empcode, coalesce(group_name, '') AS group_name, status, {_BUCKET} AS bucket
FROM attendance WHERE {_DAY}"""
_CNT = ("count(*) AS due, " + ", ".join(f"count(CASE WHEN bucket = '{n}' THEN 1 END) AS {n}"
                                         for n in [b for _, b in ATTENDANCE_BUCKETS] + [ATTENDANCE_UNKNOWN]))


def _fin_sql(keys: str, src: str) -> str:
    return f"""SELECT {keys} due, normal, late, absent, leave, unknown, normal + late AS present,
       {pct_sql('normal + late', 'due')} AS rate FROM ({src}) z"""


@query("attendance_status_rows", _ROWS)
def q_attendance_status_rows(spark, d):
    return attendance_status_rows(Tables(spark, d).attendance)


@query("attendance_by_group", _fin_sql("group_name,", f"SELECT group_name, {_CNT} FROM ({_ROWS}) r GROUP BY group_name")
       + " ORDER BY group_name")
def q_attendance_by_group(spark, d):
    return attendance_by_group(Tables(spark, d).attendance)


@query("attendance_total", _fin_sql("", f"SELECT {_CNT} FROM ({_ROWS}) r"))
def q_attendance_total(spark, d):
    return attendance_total(Tables(spark, d).attendance)


@query("attendance_summary", _fin_sql(
    "group_name, is_total,",
    f"SELECT group_name, GROUPING(group_name) = 1 AS is_total, {_CNT} FROM ({_ROWS}) r GROUP BY ROLLUP (group_name)")
    + " ORDER BY is_total, group_name")
def q_attendance_summary(spark, d):
    return attendance_summary(Tables(spark, d).attendance)
