"""Account-link family: person.sys_user -> account id.

U3 / U3a / U3b updates, classification lists C4-C9, profiles and counts Q2-Q5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.functions.exprs import classify, collated, is_live, key_norm, needs_change, strict_mismatch
from rosterline.operators.audit import missing_from, salt, weighted
from rosterline.operators.change import Change, update_from
from rosterline.operators.frames import top_n
from rosterline.plans.registry import query
from rosterline.sources.standins import Tables

c = F.col


# ------------------------------------------------------------------ operators
def people_link_account(people: DataFrame, accounts: DataFrame, mode: str = "null_or_stale", extra: tuple = ()) -> Change:
    """U3 (null_or_stale) / U3a (null) / U3b (stale): sys_user = account id.

    Any account counts (also disabled or deleted ones). Several accounts with
    one code: the smallest id wins, the person is counted once. ``extra``:
    more columns of ``people`` that tell its rows apart in the delta.
    """
    su, aid = c("t.sys_user"), c("s.id")
    when = {"null_or_stale": needs_change(su, aid),
            "null": su.isNull(),
            "stale": su.isNotNull() & (su != aid)}[mode]
    return update_from(people, two_smallest_ids(accounts), c("t.code") == c("s.account"), when,
                       {"sys_user": aid}, target_cols=list(extra) + ["code", "sys_user"], key="code")


def two_smallest_ids(accounts: DataFrame) -> DataFrame:
    """Per account code, a few of its account ids, among them the two smallest.

    That is all the link update can use: the smallest passing id is the
    smallest id, or the second smallest when the person already points at
    the smallest. Two ids are kept by (code, salt): the row-number limit is
    applied by each task before the shuffle, a hot code keeps at most
    2 x SALTS rows, and the join with the people gets an exchange of its own,
    so AQE can split a code that is hot there. An account without id counts
    as the largest id (it matches a person whose link is NULL, if the code has
    no other).
    """
    ids = accounts.select("account", "id", salt().alias("_salt")).distinct()
    rank = F.row_number().over(Window.partitionBy("account", "_salt").orderBy(c("id").asc_nulls_last()))
    return ids.withColumn("_rank", rank).where(c("_rank") <= 2).select("account", "id")


def _pair_cols(label):
    return [c("b.code"), c("b.name"), c("b.sys_user").alias("current_sys_user"),
            c("a.id").alias("target_sys_user"), c("a.account"), c("a.real_name").alias("account_name"),
            label.alias("status")]


def link_pending(people, accounts) -> DataFrame:
    """C4 (left join): NULL links (also people without account) and stale ones."""
    b, a = people.alias("b"), accounts.alias("a")
    su, aid = c("b.sys_user"), c("a.id")
    label = classify([(su.isNull(), "needs_update (NULL)")], "needs_update (differs)")
    return (b.join(a, c("b.code") == c("a.account"), "left")
             .where(su.isNull() | (aid.isNotNull() & (su != aid)))
             .select(*_pair_cols(label)).orderBy("code"))


def _inner_label(su, aid):
    return classify([(su.isNull(), "NULL, needs_update"), (su != aid, "differs, needs_update"), (su == aid, "matched")], "other")


def link_pending_inner(people, accounts, trim_keys: bool = False) -> DataFrame:
    """C4 (inner) / C8 (keys trimmed, K1): pending links among matched pairs."""
    b, a = people.alias("b"), accounts.alias("a")
    su, aid = c("b.sys_user"), c("a.id")
    on = key_norm("b.code", trim=trim_keys) == key_norm("a.account", trim=trim_keys)
    return (b.join(a, on).where(needs_change(su, aid))
             .select(*_pair_cols(_inner_label(su, aid))).orderBy("code"))


def link_collated(people, accounts) -> DataFrame:
    """Matched pairs under the server's key comparison (no case, no trailing blanks), by how they match."""
    b, a = people.alias("b"), accounts.alias("a")
    label = classify([(c("b.code") == c("a.account"), "equal"), (F.rtrim(c("b.code")) == F.rtrim(c("a.account")), "trailing blanks")], "case")
    return b.join(a, collated("b.code") == collated("a.account")).select(
        c("b.code"), c("b.name"), c("a.account"), c("a.id").alias("account_id"), label.alias("match"))


def link_all_matched(people, accounts) -> DataFrame:
    """Every matched pair with its label, sorted by label then code."""
    b, a = people.alias("b"), accounts.alias("a")
    su, aid = c("b.sys_user"), c("a.id")
    return (b.join(a, c("b.code") == c("a.account"))
             .select(*_pair_cols(_inner_label(su, aid))).orderBy("status", "code"))


def link_stale(people, accounts) -> DataFrame:
    """Non-NULL links that differ."""
    b, a = people.alias("b"), accounts.alias("a")
    su, aid = c("b.sys_user"), c("a.id")
    return (b.join(a, c("b.code") == c("a.account")).where(strict_mismatch(su, aid))
             .select(*_pair_cols(F.lit("differs"))).orderBy("code"))


def link_full_check(people, accounts) -> DataFrame:
    """Every person, five labels, priority sort."""
    b, a = people.alias("b"), accounts.alias("a")
    su, aid = c("b.sys_user"), c("a.id")
    label = classify([(aid.isNull(), "no account"), (su.isNull(), "NULL, needs_update"),
                      (su != aid, "differs, needs_update")], "matched")
    prio = F.when(aid.isNull(), 1).when(su.isNull(), 2).when(su != aid, 3).otherwise(4)
    return (b.join(a, c("b.code") == c("a.account"), "left")
             .select(*_pair_cols(label), prio.alias("priority")).orderBy("priority", "code"))


def key_format_check(people, accounts, n: int | None = None) -> DataFrame:
    """Key lengths (LEN ignores trailing blanks), byte lengths (UTF-16) and
    match type. Joined on trimmed keys (K1) so every label can occur."""
    b, a = people.alias("b"), accounts.alias("a")
    code, acct = c("b.code"), c("a.account")
    label = classify([(code == acct, "match"), (F.trim(code) == F.trim(acct), "match after trim")], "no match")
    out = (b.join(a, F.trim(code) == F.trim(acct))
            .select(code.alias("people_code"), F.length(F.rtrim(code)).alias("code_length"),
                    F.octet_length(F.encode(code, "UTF-16LE")).alias("code_bytes"),
                    acct.alias("account"), F.length(F.rtrim(acct)).alias("account_length"),
                    F.octet_length(F.encode(acct, "UTF-16LE")).alias("account_bytes"),
                    label.alias("match_status")))
    return out if n is None else top_n(out, n, "people_code", "account")


def link_profile(people, accounts) -> DataFrame:
    """Q2: total, NULL, matched, mismatched over people LEFT JOIN accounts.

    Counted without building the pairs: people meet the accounts counted by
    (code, has an id), and by (code, id) those that they link to. A linked
    pair with an id that isn't equal is a mismatch.
    """
    per_code = weighted(accounts.select(c("account").alias("_k"), c("id").isNotNull().alias("_has")), ["_k", "_has"], "_n")
    per_id = weighted(accounts.where(c("id").isNotNull()).select(c("account").alias("_k2"), c("id").alias("_v")), ["_k2", "_v"], "_n")
    linked = c("sys_user").isNotNull()
    n = F.coalesce(c("_n"), F.lit(1))                   # a person without account is one row

    def s(x):
        return F.sum(x).cast("bigint")
    by_code = people.join(per_code, c("code") == c("_k"), "left").agg(
        F.coalesce(s(n), F.lit(0)).cast("bigint").alias("total"), s(F.when(linked, 0).otherwise(n)).alias("null"),
        s(F.when(linked & c("_has"), c("_n")).otherwise(0)).alias("paired"))
    by_link = people.join(per_id, (c("code") == c("_k2")) & (c("sys_user") == c("_v"))).agg(s(c("_n")).alias("equal"))
    # two one-row aggregates, put side by side by adding them up
    both = by_code.select("total", "null", "paired", F.lit(0).cast("bigint").alias("equal")) \
        .unionByName(by_link.select("equal"), allowMissingColumns=True).agg(*[s(c(x)).alias(x) for x in ("total", "null", "paired", "equal")])
    some = c("null").isNotNull()                        # SUM over no rows is NULL
    return both.select(c("total").alias("total_records"), c("null").alias("null_count"),
                       F.when(some, c("equal")).alias("matched_count"),
                       F.when(some, c("paired") - c("equal")).alias("mismatched_count"))


def people_without_account(people, accounts) -> DataFrame:
    """Q3: people whose code has no account."""
    return (missing_from(people, accounts, "code", "account")
            .select("code", "name", "sys_user").orderBy("code"))


def accounts_without_person(people, accounts) -> DataFrame:
    """Q4: accounts whose name is no person's code."""
    return (missing_from(accounts, people, "account", "code")
            .select("account", "real_name", "id").orderBy("account"))


def link_counts(people, accounts) -> DataFrame:
    """Q5: four counts, one row each with a description.

    People are counted in one pass (both counters), accounts in one pass, and
    matched pairs by one join.
    """
    pc = people.agg(F.count(F.when(c("sys_user").isNull(), 1)).alias("null_links"),
                    F.count(F.lit(1)).alias("all_people"))
    ppl = pc.select(F.explode(F.array(
        F.struct(F.lit("null_links").alias("check_name"), c("null_links").alias("cnt")),
        F.struct(F.lit("all_people").alias("check_name"), c("all_people").alias("cnt")))).alias("x")).select("x.*")
    live = accounts.where(is_live("delete_mark", "enabled_mark", "script")).agg(
        F.lit("live_accounts").alias("check_name"), F.count(F.lit(1)).alias("cnt"))
    pw = weighted(people, ["code"], "_np")
    aw = weighted(accounts, ["account"], "_na")
    matched = pw.join(aw, c("code") == c("account")).agg(
        F.lit("matched_pairs").alias("check_name"),
        F.coalesce(F.sum(c("_np") * c("_na")), F.lit(0)).cast("bigint").alias("cnt"))
    return ppl.unionByName(live).unionByName(matched)


# -------------------------------------------------------------------- queries
def _u3_sql(test: str) -> str:
    return f"""
SELECT b.id, b.code, b.name, min(a.id) AS sys_user, b.job_status, b.group_id
FROM people b JOIN accounts a ON b.code = a.account
WHERE {test}
GROUP BY b.id, b.code, b.name, b.job_status, b.group_id
"""


_U3 = _u3_sql("b.sys_user IS NULL OR b.sys_user <> a.id")


@query("people_link_account", _U3)
def q_people_link_account(spark, d):
    T = Tables(spark, d)
    return people_link_account(T.people, T.accounts).rows


@query("people_link_account_after", f"""
SELECT b.id, b.code, b.name, CASE WHEN u.id IS NOT NULL THEN u.sys_user ELSE b.sys_user END AS sys_user,
       b.job_status, b.group_id
FROM people b LEFT JOIN ({_U3.strip()}) u ON b.id = u.id
""")
def q_people_link_account_after(spark, d):
    T = Tables(spark, d)
    return people_link_account(T.people, T.accounts).after


@query("people_link_account_null", _u3_sql("b.sys_user IS NULL"))
def q_people_link_account_null(spark, d):
    T = Tables(spark, d)
    return people_link_account(T.people, T.accounts, "null").rows


@query("people_link_account_stale", _u3_sql("b.sys_user IS NOT NULL AND b.sys_user <> a.id"))
def q_people_link_account_stale(spark, d):
    T = Tables(spark, d)
    return people_link_account(T.people, T.accounts, "stale").rows


def _pairs_sql(join: str, where: str, tests: list, labels: list, more: str = "") -> str:
    """Person-account pairs labelled by the first test that holds (NULL: it doesn't)."""
    said = ", ".join(f"'{x}'" for x in labels)
    return f"""
SELECT code, name, current_sys_user, target_sys_user, account, account_name, ([{said}])[nth] AS status{more}
FROM (SELECT b.code, b.name, b.sys_user AS current_sys_user, a.id AS target_sys_user, a.account, a.real_name AS account_name,
             list_position([{", ".join(tests)}, TRUE], TRUE) AS nth
      FROM people b {join} WHERE {where})
"""


_ON_CODE = "accounts a ON a.account = b.code"
_UNLINKED, _STALE = "b.sys_user IS NULL", "a.id <> b.sys_user"
_PAIR_LABELS = ["NULL, needs_update", "differs, needs_update", "matched"]


@query("link_pending", _pairs_sql(f"LEFT JOIN {_ON_CODE}", f"{_UNLINKED} OR {_STALE}", [_UNLINKED],
                                  ["needs_update (NULL)", "needs_update (differs)"]))
def q_link_pending(spark, d):
    T = Tables(spark, d)
    return link_pending(T.people, T.accounts)


@query("link_pending_inner", _pairs_sql(f"JOIN {_ON_CODE}", f"{_UNLINKED} OR {_STALE}", [_UNLINKED, _STALE], _PAIR_LABELS))
def q_link_pending_inner(spark, d):
    T = Tables(spark, d)
    return link_pending_inner(T.people, T.accounts)


@query("link_all_matched", _pairs_sql(f"JOIN {_ON_CODE}", "TRUE", [_UNLINKED, _STALE], _PAIR_LABELS))
def q_link_all_matched(spark, d):
    T = Tables(spark, d)
    return link_all_matched(T.people, T.accounts)


@query("link_stale", _pairs_sql(f"JOIN {_ON_CODE}", _STALE, [_STALE], ["differs", ""]))
def q_link_stale(spark, d):
    T = Tables(spark, d)
    return link_stale(T.people, T.accounts)


@query("link_full_check", _pairs_sql(f"LEFT JOIN {_ON_CODE}", "TRUE", ["a.id IS NULL", _UNLINKED, _STALE],
                                     ["no account", *_PAIR_LABELS], ", CAST(nth AS INTEGER) AS priority"))
def q_link_full_check(spark, d):
    T = Tables(spark, d)
    return link_full_check(T.people, T.accounts)


@query("link_collated", """
WITH typed AS (SELECT name, CASE WHEN job_status = 1 THEN upper(code) WHEN sys_user IS NULL THEN concat(code, '  ') ELSE code END AS code FROM people)
SELECT b.code, b.name, a.account, a.id AS account_id,
       CASE WHEN b.code = a.account THEN 'equal' WHEN rtrim(b.code) = rtrim(a.account) THEN 'trailing blanks' ELSE 'case' END AS match
FROM typed b JOIN accounts a ON lower(rtrim(b.code)) = lower(rtrim(a.account))
""")
def q_link_collated(spark, d):
    """The codes of people who left are in upper case, those of people without a link end in blanks."""
    T = Tables(spark, d)
    typed = F.when(c("job_status") == 1, F.upper("code")).when(c("sys_user").isNull(), F.concat("code", F.lit("  "))).otherwise(c("code"))
    return link_collated(T.people.withColumn("code", typed), T.accounts)


@query("link_trimmed", _pairs_sql("JOIN accounts a ON trim(a.account) = trim(b.code)", f"{_UNLINKED} OR {_STALE}",
                                  [_UNLINKED, _STALE], _PAIR_LABELS))
def q_link_trimmed(spark, d):
    T = Tables(spark, d)
    return link_pending_inner(T.people, T.accounts, trim_keys=True)


def _utf16_bytes_sql(x):
    return f"CAST(2 * length({x}) + 2 * length(regexp_replace({x}, '[\\x{{0}}-\\x{{FFFF}}]', '', 'g')) AS INTEGER)"


@query("key_format_check", f"""
SELECT b.code AS people_code, CAST(length(rtrim(b.code)) AS INTEGER) AS code_length,
       {_utf16_bytes_sql('b.code')} AS code_bytes, a.account,
       CAST(length(rtrim(a.account)) AS INTEGER) AS account_length, {_utf16_bytes_sql('a.account')} AS account_bytes,
       CASE WHEN b.code = a.account THEN 'match' WHEN trim(b.code) = trim(a.account) THEN 'match after trim'
            ELSE 'no match' END AS match_status
FROM people b JOIN accounts a ON trim(b.code) = trim(a.account)
""")
def q_key_format_check(spark, d):
    T = Tables(spark, d)
    return key_format_check(T.people, T.accounts)


_FIRST = 20


@query("key_format_first", f"""
SELECT people_code, account, match_status FROM (
  SELECT b.code AS people_code, a.account, if(b.code = a.account, 'match', 'match after trim') AS match_status
  FROM people b JOIN accounts a ON trim(b.code) = trim(a.account))
ORDER BY people_code, account LIMIT {_FIRST}
""")
def q_key_format_first(spark, d):
    """C9 as the reference prints it: the first rows only."""
    T = Tables(spark, d)
    return key_format_check(T.people, T.accounts, _FIRST).select("people_code", "account", "match_status")


@query("link_profile", f"""
SELECT count(*) AS total_records, count(*) FILTER ({_UNLINKED}) AS null_count,
       count(*) FILTER (a.id = b.sys_user) AS matched_count, count(*) FILTER ({_STALE}) AS mismatched_count
FROM people b LEFT JOIN {_ON_CODE}
""")
def q_link_profile(spark, d):
    T = Tables(spark, d)
    return link_profile(T.people, T.accounts)


@query("people_without_account", """
SELECT b.code, b.name, b.sys_user FROM people b
WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account = b.code)
ORDER BY b.code
""")
def q_people_without_account(spark, d):
    T = Tables(spark, d)
    return people_without_account(T.people, T.accounts)


@query("accounts_without_person", """
SELECT a.account, a.real_name, a.id FROM accounts a
WHERE NOT EXISTS (SELECT 1 FROM people b WHERE b.code = a.account)
ORDER BY a.account
""")
def q_accounts_without_person(spark, d):
    T = Tables(spark, d)
    return accounts_without_person(T.people, T.accounts)


@query("link_counts", """
SELECT 'null_links' AS check_name, count(*) AS cnt FROM people WHERE sys_user IS NULL
UNION ALL SELECT 'all_people', count(*) FROM people
UNION ALL SELECT 'live_accounts', count(*) FROM accounts WHERE delete_mark = 0 AND enabled_mark = 1
UNION ALL SELECT 'matched_pairs', count(*) FROM people b JOIN accounts a ON b.code = a.account
""")
def q_link_counts(spark, d):
    T = Tables(spark, d)
    return link_counts(T.people, T.accounts)
