"""Group family: person.group_id resolved through personnel -> group dimension.

Updates U4 (fill NULL), U4b (fill blank or fix), U5 (fix mismatches except
protected groups); comparisons C10-C10d, previews C11-C11c, C12; profiles and
lists Q6-Q11b.

The group dimension has one row a group: AQE broadcasts it when its real size
allows, and otherwise splits the groups that are hot on the other side. The
person and personnel tables are shuffled on the business code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.functions.exprs import classify, diff_text, differs, is_blank
from rosterline.operators.audit import missing_from, weighted
from rosterline.operators.change import Change, update_from
from rosterline.params import DEFAULT_PARAMS, SyncParams
from rosterline.plans.registry import query
from rosterline.sources.standins import Tables

c = F.col
P = DEFAULT_PARAMS


def _chain(personnel: DataFrame, groups: DataFrame) -> DataFrame:
    """J6 last hop: personnel rows with the dimension id of their group name."""
    g = groups.select(c("id").alias("gid"), c("group_name").alias("gname"))
    return personnel.join(g, personnel["group_name"] == g["gname"]).select(
        "employee_id", "group_name", "gid", "gname")


def _with_current(people: DataFrame, groups: DataFrame) -> DataFrame:
    """The person's current group name (dimension under a second role)."""
    cur = groups.select(c("id").alias("_cur_id"), c("group_name").alias("_cur_name"))
    return people.join(cur, people["group_id"] == cur["_cur_id"], "left").drop("_cur_id")


def _strip(ch: Change, cols) -> Change:
    return Change(rows=ch.rows.select(*cols), after=ch.after.select(*cols), delta=ch.delta)


# ------------------------------------------------------------------ operators
def people_group_fill(people, personnel, groups) -> Change:
    """U4: NULL group id -> id of the personnel group name (found in the dimension)."""
    when = c("t.group_id").isNull() & c("s.group_name").isNotNull() & c("s.gid").isNotNull()
    return update_from(people, _chain(personnel, groups), c("t.code") == c("s.employee_id"), when,
                       {"group_id": c("s.gid")},
                       source_cols=["employee_id", "group_name", "gid"], target_cols=["code", "group_id"], key="code")


def people_group_fill_or_fix(people, personnel, groups) -> Change:
    """Blank (NULL or '') or current name differs from personnel's.

    The reference writes ``A OR B AND C``; bracketed here as ``A | (B & C)``.
    A current id not in the dimension (no current name) is left alone.
    """
    tgt = _with_current(people, groups)
    blank = is_blank("t.group_id")
    fix = (~blank) & c("t._cur_name").isNotNull() & (c("t._cur_name") != c("s.group_name"))
    when = blank | (fix & c("s.group_name").isNotNull())
    ch = update_from(tgt, _chain(personnel, groups), c("t.code") == c("s.employee_id"), when,
                     {"group_id": c("s.gid")},
                     source_cols=["employee_id", "group_name", "gid"], target_cols=["code", "group_id", "_cur_name"], key="code")
    return _strip(ch, people.columns)


def people_group_fix_mismatch(people, personnel, groups, p: SyncParams = P) -> Change:
    """Non-blank and differing, except protected groups on either side."""
    tgt = _with_current(people, groups)
    prot = list(p.protected_groups)
    when = (~is_blank("t.group_id") & c("t._cur_name").isNotNull()
            & (c("t._cur_name") != c("s.group_name")) & c("s.group_name").isNotNull()
            & ~c("t._cur_name").isin(prot) & ~c("s.group_name").isin(prot))
    ch = update_from(tgt, _chain(personnel, groups), c("t.code") == c("s.employee_id"), when,
                     {"group_id": c("s.gid")},
                     source_cols=["employee_id", "group_name", "gid"], target_cols=["code", "group_id", "_cur_name"], key="code")
    return _strip(ch, people.columns)


def _pg(people, groups):
    """people LEFT JOIN dimension ON group_id: adds ``people_group``."""
    g = groups.select(c("id").alias("_gid"), c("group_name").alias("people_group"))
    return people.join(g, people["group_id"] == g["_gid"], "left").drop("_gid")


def _per(personnel):
    return personnel.select(c("employee_id"), c("name").alias("personnel_name"),
                            c("group_name").alias("personnel_group"))


def group_compare(people, personnel, groups) -> DataFrame:
    """Personnel-known people whose group differs (F7), with P7 text."""
    pg, per = c("people_group"), c("personnel_group")
    # an empty personnel group counts as "matched" here, as in the reference's report
    label = classify([(pg.isNull(), "people group empty"), (per.isNull(), "matched")], "group differs")
    return (_mismatch(people, personnel, groups)
             .select(c("code"), c("name"), pg, c("employee_id").alias("personnel_employee_id"),
                     c("personnel_name"), per, label.alias("status"),
                     diff_text(pg, per).alias("group_difference"))
             .orderBy("code"))


def group_compare_inner(people, personnel, groups) -> DataFrame:
    """Both sides present (inner joins)."""
    g = groups.select(c("id").alias("_gid"), c("group_name").alias("people_group"))
    j = people.join(g, people["group_id"] == g["_gid"]).join(_per(personnel), c("code") == c("employee_id"))
    pg, per = c("people_group"), c("personnel_group")
    label = classify([(pg.isNull(), "people group empty"), (per.isNull(), "personnel group empty")], "group differs")
    return (j.where(differs(pg, per))
             .select("code", "name", pg, "personnel_name", per, label.alias("status")).orderBy("code"))


def group_compare_detail(people, personnel, groups) -> DataFrame:
    """Labels by which group is empty, priority sort."""
    j = _pg(people, groups).join(_per(personnel), c("code") == c("employee_id"))
    pg, per = c("people_group"), c("personnel_group")
    label = classify([
        (pg.isNull() & per.isNull(), "both groups empty"), (pg.isNull(), "people group empty, personnel has one"),
        (per.isNull(), "people has group, personnel empty")], "groups differ")
    prio = F.when(pg.isNull(), 2).when(per.isNull(), 3).otherwise(1)
    return (j.where(F.coalesce(pg != per, F.lit(True)))
             .select("code", "name", c("group_id").alias("people_group_id"), pg.alias("people_group_name"),
                     "employee_id", "personnel_name", per.alias("personnel_group_name"),
                     label.alias("comparison_status"), prio.alias("priority"))
             .orderBy("priority", "code"))


def _mismatch(people, personnel, groups):
    j = _pg(people, groups).join(_per(personnel), c("code") == c("employee_id"))
    return j.where(differs(c("people_group"), c("personnel_group")))


def group_mismatch_short(people, personnel, groups) -> DataFrame:
    """Only differing rows, constant label."""
    return (_mismatch(people, personnel, groups)
            .select("code", "name", "people_group", "personnel_group", F.lit("group differs").alias("status"))
            .orderBy("code"))


def group_mismatch_core(people, personnel, groups) -> DataFrame:
    """C10d: differing rows with three labels."""
    pg, per = c("people_group"), c("personnel_group")
    label = classify([(pg.isNull(), "people group empty"), (per.isNull(), "personnel group empty")], "group differs")
    return (_mismatch(people, personnel, groups)
            .select("code", "name", "people_group", "employee_id", "personnel_name", "personnel_group",
                    label.alias("difference"))
            .orderBy("code"))


def _per_w(personnel):
    """Personnel reduced to (employee, group name) with multiplicities: the
    counts below join this instead of the rows, so a hot employee code never
    makes its pairs with the people of the same code."""
    return weighted(personnel.select("employee_id", c("group_name").alias("personnel_group")),
                    ["employee_id", "personnel_group"])


def group_mismatch_count(people, personnel, groups) -> DataFrame:
    """Q7: count of C10d."""
    j = _pg(people, groups).join(_per_w(personnel), c("code") == c("employee_id"))
    return j.where(differs(c("people_group"), c("personnel_group"))).agg(
        F.coalesce(F.sum("_w"), F.lit(0)).cast("bigint").alias("mismatched_count"),
        F.lit("group mismatches").alias("description"))


def group_profile(people, personnel, groups) -> DataFrame:
    """Q6: six counters over all people, one pass (personnel weighted)."""
    j = _pg(people, groups).join(_per_w(personnel), c("code") == c("employee_id"), "left")
    pg, per, known, w = c("people_group"), c("personnel_group"), c("employee_id").isNotNull(), c("_w")

    def s(cond, weight=w):
        return F.sum(F.when(cond, weight).otherwise(0)).cast("bigint")
    return j.agg(F.coalesce(F.sum(F.coalesce(w, F.lit(1))), F.lit(0)).cast("bigint").alias("total_records"),
                 s(c("employee_id").isNull(), F.lit(1)).alias("not_in_personnel"),
                 s(known & (pg == per)).alias("matched_groups"),
                 s(known & (pg != per)).alias("mismatched_groups"),
                 s(known & pg.isNull() & per.isNotNull()).alias("people_null_group"),
                 s(known & pg.isNotNull() & per.isNull()).alias("personnel_null_group"))


def _fill_base(people, personnel, groups, blank_mode=False):
    """people JOIN personnel LEFT JOIN dimension ON personnel group name."""
    g = groups.select(c("id").alias("target_group_id"), c("group_name").alias("target_group_name"))
    j = people.join(_per(personnel), c("code") == c("employee_id")) \
        .join(g, c("personnel_group") == c("target_group_name"), "left")
    miss = is_blank("group_id") if blank_mode else c("group_id").isNull()
    return j.where(miss & c("personnel_group").isNotNull())


def group_fill_preview(people, personnel, groups) -> DataFrame:
    """C11: what U4 would do."""
    label = classify([(c("target_group_id").isNull(), "unknown group")], "update")
    return (_fill_base(people, personnel, groups)
            .select("code", "name", c("group_id").alias("current_group_id"), "employee_id", "personnel_name",
                    "personnel_group", "target_group_id", "target_group_name", label.alias("status"))
            .orderBy("code"))


def group_fill_unknown(people, personnel, groups, blank_mode=False) -> DataFrame:
    """Personnel group name not in the dimension (NULL only / NULL or '')."""
    return (_fill_base(people, personnel, groups, blank_mode).where(c("target_group_id").isNull())
            .select("code", "name", "personnel_group", F.lit("group not in dimension").alias("status")))


def group_fix_preview(people, personnel, groups) -> DataFrame:
    """What U4b would do (target group must exist: inner join)."""
    tgt = _with_current(people, groups)
    g = groups.select(c("id").alias("target_group_id"), c("group_name").alias("target_group_name"))
    j = tgt.join(_per(personnel), c("code") == c("employee_id")).join(g, c("personnel_group") == c("target_group_name"))
    blank = is_blank("group_id")
    fix = (~blank) & c("_cur_name").isNotNull() & (c("_cur_name") != c("personnel_group"))
    label = classify([(blank, "empty, needs_update")], "group differs, needs_update")
    return (j.where(blank | (fix & c("personnel_group").isNotNull()))
             .select("code", "name", c("group_id").alias("current_group_id"), c("_cur_name").alias("current_group_name"),
                     "personnel_group", "target_group_id", "target_group_name", label.alias("status")))


def group_mismatch_preview(people, personnel, groups, p: SyncParams = P, remaining: bool = False) -> DataFrame:
    """What U5 would do; ``remaining`` is the after-check, which needs no
    target dimension row (so it can be non-empty after U5)."""
    tgt = _with_current(people, groups)
    j = tgt.join(_per(personnel), c("code") == c("employee_id"))
    prot = list(p.protected_groups)
    cond = (~is_blank("group_id") & c("_cur_name").isNotNull() & (c("_cur_name") != c("personnel_group"))
            & c("personnel_group").isNotNull() & ~c("_cur_name").isin(prot) & ~c("personnel_group").isin(prot))
    if remaining:
        return (j.where(cond).select("code", "name", c("_cur_name").alias("current_group_name"), "personnel_group",
                                     F.lit("still differs").alias("status")))
    g = groups.select(c("id").alias("target_group_id"), c("group_name").alias("target_group_name"))
    j = j.join(g, c("personnel_group") == c("target_group_name"))
    return (j.where(cond).select("code", "name", c("group_id").alias("current_group_id"),
                                 c("_cur_name").alias("current_group_name"), "employee_id", "personnel_name",
                                 "personnel_group", "target_group_id", "target_group_name",
                                 F.lit("group differs, needs_update").alias("status")))


def _fill_base_w(people, personnel, groups):
    g = groups.select(c("id").alias("target_group_id"), c("group_name").alias("target_group_name"))
    j = people.join(_per_w(personnel), c("code") == c("employee_id")) \
        .join(g, c("personnel_group") == c("target_group_name"), "left")
    return j.where(c("group_id").isNull() & c("personnel_group").isNotNull())


def group_fill_profile(people, personnel, groups) -> DataFrame:
    """Q8: total missing, can update, cannot update (personnel weighted)."""
    b, w = _fill_base_w(people, personnel, groups), c("_w")
    return b.agg(F.coalesce(F.sum(w), F.lit(0)).cast("bigint").alias("total_null_group"),
                 F.sum(F.when(c("target_group_id").isNotNull(), w).otherwise(0)).cast("bigint").alias("can_update"),
                 F.sum(F.when(c("target_group_id").isNull(), w).otherwise(0)).cast("bigint").alias("cannot_update"),
                 F.lit("people with NULL group").alias("description"))


def group_fill_remaining(people, personnel) -> DataFrame:
    """Still missing after U4."""
    j = people.join(_per_w(personnel), c("code") == c("employee_id"))
    return j.where(c("group_id").isNull() & c("personnel_group").isNotNull()).agg(
        F.coalesce(F.sum("_w"), F.lit(0)).cast("bigint").alias("remaining_null_count"),
        F.lit("NULL groups after update").alias("description"))


def group_dim_list(groups) -> DataFrame:
    """Q9: all groups by name."""
    return groups.select("id", "group_name", F.lit("available group").alias("description")).orderBy("group_name")


def group_chain_counts(people, personnel, groups) -> DataFrame:
    """Q10: blank groups; code matches; name matches; full chain (one row each).

    Pair counts are sums of products of per-key multiplicities: no join here
    builds the pairs it counts."""
    def total(df, expr, name):
        return df.agg(F.lit(name).alias("check_name"),
                      F.coalesce(F.sum(expr), F.lit(0)).cast("bigint").alias("cnt"))
    blank = people.where(is_blank("group_id")).agg(F.lit("blank_groups").alias("check_name"),
                                                   F.count(F.lit(1)).alias("cnt"))
    pw = weighted(people, ["code"], "_np")
    per_code = weighted(personnel, ["employee_id"], "_nc")
    per_name = weighted(personnel.select(c("group_name").alias("_pn")), ["_pn"], "_nn")
    per_both = weighted(personnel.select("employee_id", c("group_name").alias("_pg")), ["employee_id", "_pg"], "_nb")
    dim = weighted(groups.select(c("group_name").alias("_dn")), ["_dn"], "_nd")
    code = total(pw.join(per_code, c("code") == c("employee_id")), c("_np") * c("_nc"), "code_matches")
    name = total(per_name.join(dim, c("_pn") == c("_dn")), c("_nn") * c("_nd"), "name_matches")
    full = total(pw.join(per_both, c("code") == c("employee_id")).join(dim, c("_pg") == c("_dn")),
                 c("_np") * c("_nb") * c("_nd"), "full_chain")
    return blank.unionByName(code).unionByName(name).unionByName(full)


def people_not_in_personnel(people, personnel) -> DataFrame:
    """Blank group and not in personnel."""
    return (people.where(is_blank("group_id"))
            .transform(lambda d: missing_from(d, personnel, "code", "employee_id"))
            .select("code", "name", "group_id", F.lit("not in personnel").alias("status")).orderBy("code"))


def group_names_unknown(people, personnel, groups) -> DataFrame:
    """Q11: distinct group names without dimension row, among blank-group people."""
    return (_fill_base(people, personnel, groups, blank_mode=True).where(c("target_group_id").isNull())
            .select("personnel_group", F.lit("group not in dimension").alias("status")).distinct()
            .orderBy("personnel_group"))


def group_sizes(personnel) -> DataFrame:
    """Personnel count per group."""
    return (personnel.where(c("group_name").isNotNull()).groupBy("group_name")
            .agg(F.count(F.lit(1)).alias("cnt")).withColumn("description", F.lit("personnel group"))
            .orderBy("group_name"))


def group_name_match(personnel, groups) -> DataFrame:
    """Distinct personnel group names, found / not found in the dimension."""
    g = groups.select(c("id").alias("dim_group_id"), c("group_name").alias("dim_group_name"))
    j = personnel.where(c("group_name").isNotNull()).join(g, c("group_name") == c("dim_group_name"), "left")
    st = F.when(c("dim_group_name").isNotNull(), F.lit("found")).otherwise(F.lit("not found"))
    return (j.select(c("group_name").alias("personnel_group"), st.alias("match_status"),
                     "dim_group_name", "dim_group_id").distinct().orderBy("personnel_group"))


# -------------------------------------------------------------------- queries
def _T(spark, d):
    T = Tables(spark, d)
    return T.people, T.personnel, T.groups_dim


# A person with each personnel row of the same code: the person's own group name
# is "mine" (NULL: none or unknown), the personnel row's is "theirs".
_KNOWN = """known AS (
  SELECT b.*, own.group_name AS mine, per.employee_id, per.name AS personnel_name, per.group_name AS theirs
  FROM personnel per JOIN people b ON b.code = per.employee_id LEFT JOIN groups_dim own ON own.id = b.group_id)"""
_BLANK = "coalesce(group_id, '') = ''"
_PROT = ", ".join(f"'{g}'" for g in P.protected_groups)
_MAY_MOVE = f"NOT {_BLANK} AND mine <> theirs AND NOT list_has_any([mine, theirs], [{_PROT}])"


def _labelled(rows: str, where: str, columns: str, **labels) -> str:
    """Rows of ``known`` with a label chosen by which of the two groups is empty.

    ``labels``: neither / mine / theirs / both -> label text.
    """
    flags = {"neither": "FALSE, FALSE", "mine": "TRUE, FALSE", "theirs": "FALSE, TRUE", "both": "TRUE, TRUE"}
    values = ", ".join(f"({flags[k]}, '{v}')" for k, v in labels.items())
    return f"""
WITH {_KNOWN}, label(no_mine, no_theirs, said) AS (VALUES {values})
SELECT {columns} FROM {rows} JOIN label ON no_mine = (mine IS NULL) AND no_theirs = (theirs IS NULL)
WHERE {where}
"""


def _moved(where: str) -> str:
    """People whose group id becomes that of a personnel group (the smallest, if several fit)."""
    return f"""
WITH {_KNOWN}
SELECT id, code, name, sys_user, job_status, min(aim.gid) AS group_id
FROM known JOIN (SELECT id AS gid, group_name AS aimed FROM groups_dim) aim ON aimed = theirs
WHERE {where}
GROUP BY ALL
"""


_U4 = _moved("group_id IS NULL")


@query("people_group_fill", _U4)
def q_people_group_fill(spark, d):
    return people_group_fill(*_T(spark, d)).rows


@query("people_group_fill_after", f"""
SELECT b.id, b.code, b.name, b.sys_user, b.job_status,
       CASE WHEN u.id IS NOT NULL THEN u.group_id ELSE b.group_id END AS group_id
FROM people b LEFT JOIN ({_U4.strip()}) u ON b.id = u.id
""")
def q_people_group_fill_after(spark, d):
    return people_group_fill(*_T(spark, d)).after


@query("people_group_fill_or_fix", _moved(f"{_BLANK} OR mine <> theirs"))
def q_people_group_fill_or_fix(spark, d):
    return people_group_fill_or_fix(*_T(spark, d)).rows


@query("people_group_fix_mismatch", _moved(_MAY_MOVE))
def q_people_group_fix_mismatch(spark, d):
    return people_group_fix_mismatch(*_T(spark, d)).rows


_DIFFERENT = "mine IS DISTINCT FROM theirs"


@query("group_compare", _labelled("known", _DIFFERENT, """code, name, mine AS people_group, employee_id AS personnel_employee_id,
       personnel_name, theirs AS personnel_group, said AS status,
       format('people group: {} | personnel group: {}', coalesce(mine, 'NULL'), coalesce(theirs, 'NULL')) AS group_difference""",
                                  neither="group differs", mine="people group empty", theirs="matched"))
def q_group_compare(spark, d):
    return group_compare(*_T(spark, d))


@query("group_compare_inner", _labelled(
    "known SEMI JOIN groups_dim g ON g.id = known.group_id", _DIFFERENT,
    "code, name, mine AS people_group, personnel_name, theirs AS personnel_group, said AS status",
    neither="group differs", mine="people group empty", theirs="personnel group empty"))
def q_group_compare_inner(spark, d):
    return group_compare_inner(*_T(spark, d))


@query("group_compare_detail", f"""
SELECT * EXCLUDE (comparison), comparison[3:] AS comparison_status, CAST(comparison[1] AS INTEGER) AS priority FROM ({_labelled(
    "known", "coalesce(mine <> theirs, TRUE)",
    """code, name, group_id AS people_group_id, mine AS people_group_name, employee_id, personnel_name,
       theirs AS personnel_group_name, said AS comparison""",
    neither="1 groups differ", mine="2 people group empty, personnel has one", theirs="3 people has group, personnel empty",
    both="2 both groups empty")})
""")
def q_group_compare_detail(spark, d):
    return group_compare_detail(*_T(spark, d))


@query("group_mismatch_short", f"""
WITH {_KNOWN}
SELECT code, name, mine AS people_group, theirs AS personnel_group, 'group differs' AS status FROM known WHERE {_DIFFERENT}
""")
def q_group_mismatch_short(spark, d):
    return group_mismatch_short(*_T(spark, d))


@query("group_mismatch_core", _labelled(
    "known", _DIFFERENT, "code, name, mine AS people_group, employee_id, personnel_name, theirs AS personnel_group, said AS difference",
    neither="group differs", mine="people group empty", theirs="personnel group empty"))
def q_group_mismatch_core(spark, d):
    return group_mismatch_core(*_T(spark, d))


@query("group_mismatch_count", f"""
WITH {_KNOWN}
SELECT count(*) FILTER ({_DIFFERENT}) AS mismatched_count, 'group mismatches' AS description FROM known
""")
def q_group_mismatch_count(spark, d):
    return group_mismatch_count(*_T(spark, d))


@query("group_profile", f"""
WITH {_KNOWN}, alone AS (SELECT count(*) AS n FROM people ANTI JOIN personnel ON code = employee_id)
SELECT count(*) + any_value(n) AS total_records, any_value(n) AS not_in_personnel,
       count(*) FILTER (mine = theirs) AS matched_groups, count(*) FILTER (mine <> theirs) AS mismatched_groups,
       count(theirs) FILTER (mine IS NULL) AS people_null_group, count(mine) FILTER (theirs IS NULL) AS personnel_null_group
FROM known, alone
""")
def q_group_profile(spark, d):
    return group_profile(*_T(spark, d))


_FILL = """FROM people b JOIN personnel per ON b.code = per.employee_id
LEFT JOIN groups_dim g ON per.group_name = g.group_name"""
_AIMED = f"""{_KNOWN}, aimed AS (
  SELECT known.*, t.id AS target_group_id, t.group_name AS target_group_name
  FROM known LEFT JOIN groups_dim t ON t.group_name = known.theirs WHERE theirs IS NOT NULL)"""


@query("group_fill_preview", f"""
WITH {_AIMED}
SELECT code, name, group_id AS current_group_id, employee_id, personnel_name, theirs AS personnel_group, target_group_id,
       target_group_name, if(target_group_id IS NULL, 'unknown group', 'update') AS status
FROM aimed WHERE group_id IS NULL
""")
def q_group_fill_preview(spark, d):
    return group_fill_preview(*_T(spark, d))


@query("group_fill_unknown", f"""
SELECT b.code, b.name, per.group_name AS personnel_group, 'group not in dimension' AS status
{_FILL}
WHERE b.group_id IS NULL AND per.group_name IS NOT NULL AND g.id IS NULL
""")
def q_group_fill_unknown(spark, d):
    return group_fill_unknown(*_T(spark, d))


@query("group_fill_unknown_blank", f"""
SELECT b.code, b.name, per.group_name AS personnel_group, 'group not in dimension' AS status
{_FILL}
WHERE (b.group_id IS NULL OR b.group_id = '') AND per.group_name IS NOT NULL AND g.id IS NULL
""")
def q_group_fill_unknown_blank(spark, d):
    return group_fill_unknown(*_T(spark, d), blank_mode=True)


_FIX_COLUMNS = "code, name, group_id AS current_group_id, mine AS current_group_name, theirs AS personnel_group, target_group_id, target_group_name"


@query("group_fix_preview", f"""
WITH {_AIMED}, real AS (SELECT * FROM aimed WHERE target_group_id IS NOT NULL)
SELECT {_FIX_COLUMNS}, 'empty, needs_update' AS status FROM real WHERE {_BLANK}
UNION ALL
SELECT {_FIX_COLUMNS}, 'group differs, needs_update' FROM real WHERE NOT {_BLANK} AND mine <> theirs
""")
def q_group_fix_preview(spark, d):
    return group_fix_preview(*_T(spark, d))


@query("group_mismatch_preview", f"""
WITH {_AIMED}
SELECT {_FIX_COLUMNS}, employee_id, personnel_name, 'group differs, needs_update' AS status
FROM aimed WHERE target_group_id IS NOT NULL AND {_MAY_MOVE}
""")
def q_group_mismatch_preview(spark, d):
    return group_mismatch_preview(*_T(spark, d))


@query("group_mismatch_remaining", f"""
WITH {_KNOWN}
SELECT code, name, mine AS current_group_name, theirs AS personnel_group, 'still differs' AS status FROM known WHERE {_MAY_MOVE}
""")
def q_group_mismatch_remaining(spark, d):
    return group_mismatch_preview(*_T(spark, d), remaining=True)


@query("group_fill_profile", f"""
SELECT count(*) AS total_null_group,
       count(g.id) AS can_update, count(*) - count(g.id) AS cannot_update,
       'people with NULL group' AS description
{_FILL}
WHERE b.group_id IS NULL AND per.group_name IS NOT NULL
""")
def q_group_fill_profile(spark, d):
    return group_fill_profile(*_T(spark, d))


@query("group_fill_remaining", """
SELECT count(*) AS remaining_null_count, 'NULL groups after update' AS description
FROM people b JOIN personnel per ON b.code = per.employee_id
WHERE b.group_id IS NULL AND per.group_name IS NOT NULL
""")
def q_group_fill_remaining(spark, d):
    T = Tables(spark, d)
    return group_fill_remaining(T.people, T.personnel)


@query("group_chain_counts", """
SELECT 'blank_groups' AS check_name, count(*) AS cnt FROM people WHERE group_id IS NULL OR group_id = ''
UNION ALL SELECT 'code_matches', count(*) FROM people b JOIN personnel per ON b.code = per.employee_id
UNION ALL SELECT 'name_matches', count(*) FROM personnel per JOIN groups_dim g ON per.group_name = g.group_name
UNION ALL SELECT 'full_chain', count(*) FROM people b JOIN personnel per ON b.code = per.employee_id
  JOIN groups_dim g ON per.group_name = g.group_name
""")
def q_group_chain_counts(spark, d):
    return group_chain_counts(*_T(spark, d))


@query("people_not_in_personnel", """
SELECT b.code, b.name, b.group_id, 'not in personnel' AS status FROM people b
WHERE (b.group_id IS NULL OR b.group_id = '')
  AND NOT EXISTS (SELECT 1 FROM personnel per WHERE per.employee_id = b.code)
ORDER BY b.code
""")
def q_people_not_in_personnel(spark, d):
    T = Tables(spark, d)
    return people_not_in_personnel(T.people, T.personnel)


@query("group_names_unknown", f"""
SELECT DISTINCT per.group_name AS personnel_group, 'group not in dimension' AS status
{_FILL}
WHERE (b.group_id IS NULL OR b.group_id = '') AND per.group_name IS NOT NULL AND g.id IS NULL
ORDER BY personnel_group
""")
def q_group_names_unknown(spark, d):
    return group_names_unknown(*_T(spark, d))


@query("group_sizes", """
SELECT group_name, count(*) AS cnt, 'personnel group' AS description FROM personnel
WHERE group_name IS NOT NULL GROUP BY group_name ORDER BY group_name
""")
def q_group_sizes(spark, d):
    return group_sizes(Tables(spark, d).personnel)


@query("group_name_match", """
SELECT DISTINCT per.group_name AS personnel_group,
       CASE WHEN g.group_name IS NOT NULL THEN 'found' ELSE 'not found' END AS match_status,
       g.group_name AS dim_group_name, g.id AS dim_group_id
FROM personnel per LEFT JOIN groups_dim g ON per.group_name = g.group_name
WHERE per.group_name IS NOT NULL
ORDER BY personnel_group
""")
def q_group_name_match(spark, d):
    T = Tables(spark, d)
    return group_name_match(T.personnel, T.groups_dim)


@query("group_dim_list", """
SELECT id, group_name, 'available group' AS description FROM groups_dim
""")
def q_group_dim_list(spark, d):
    return group_dim_list(Tables(spark, d).groups_dim)
