"""Column expressions (projections P*, predicates F*, scalar helpers X*, K1).

All are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none needs a Python UDF. A few have an SQL twin (``*_sql``) that the
oracle texts use so both engines compute byte-equal values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

lit = F.lit


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- projections
def map_ordered(c, pairs, default=None) -> Column:
    """Simple CASE in list order, first equal entry wins, ``default`` in ELSE."""
    c = col(c)
    expr = None
    for k, v in pairs:
        expr = F.when(c == lit(k), lit(v)) if expr is None else expr.when(c == lit(k), lit(v))
    if expr is None:
        return lit(default)
    return expr.otherwise(lit(default))


def map_ordered_sql(c: str, pairs, default=None) -> str:
    def q(s):
        return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in pairs)
    return f"CASE {c} {whens} ELSE {q(default)} END"


def decode(c, mapping: dict, default=None) -> Column:
    """Value -> label; no default gives NULL (CASE without ELSE)."""
    c = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == lit(k), lit(v)) if expr is None else expr.when(c == lit(k), lit(v))
    return expr.otherwise(lit(default)) if default is not None else expr


def job_status_expr(isactive, current=None) -> Column:
    """Active flag -> job status (0 active -> 1 left, 1 -> 0), else ``current``."""
    a = col(isactive)
    e = F.when(a == 0, lit(1)).when(a == 1, lit(0))
    return e.otherwise(col(current)) if current is not None else e


def job_status_on_insert(isactive) -> Column:
    """P4 insert form: everything but 0 becomes 0 (NULL included)."""
    return F.when(col(isactive) == 0, lit(1)).otherwise(lit(0))


def classify(rules, default=None) -> Column:
    """P5: ordered CASE; first true condition wins, a NULL condition is not taken."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, lit(label)) if expr is None else expr.when(cond, lit(label))
    return expr.otherwise(lit(default)) if default is not None else expr


def diff_text(a, b, left="people group: ", right=" | personnel group: ") -> Column:
    """Difference text with NULL shown as the text 'NULL'."""
    return F.concat(lit(left), F.coalesce(col(a), lit("NULL")), lit(right), F.coalesce(col(b), lit("NULL")))


def project_template(mapping: dict, schema) -> list:
    """One column per target field, from ``mapping`` or a typed NULL."""
    out = []
    for f in schema.fields:
        v = mapping.get(f.name)
        if v is None:
            v = lit(None)
        elif not isinstance(v, Column):
            v = lit(v)
        out.append(v.cast(f.dataType).alias(f.name))
    return out


def project_template_sql(mapping: dict, schema) -> str:
    """The SQL of P1: ``mapping`` holds SQL texts and plain values, missing columns are typed NULLs."""
    kinds = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    out = []
    for f in schema.fields:
        v, kind = mapping.get(f.name, "NULL"), f.dataType.simpleString()
        out.append(f"CAST({v if v != '' else repr('')} AS {kinds.get(kind, kind.upper())}) AS {f.name}")
    return ",\n       ".join(out)


def quoted(values: dict) -> dict:
    """Plain values as SQL texts."""
    return {k: f"'{v}'" if isinstance(v, str) else str(v) for k, v in values.items()}


# ----------------------------------------------------------------- predicates
def in_scope(c, params) -> Column:
    """department IN the configured list."""
    return col(c).isin(params.dept_names())


def in_scope_sql(c: str, params) -> str:
    names = ", ".join("'" + n.replace("'", "''") + "'" for n in params.dept_names())
    return f"{c} IN ({names})"


def is_blank(c) -> Column:
    """NULL or ''."""
    c = col(c)
    return c.isNull() | (c == lit(""))


def needs_change(t, s) -> Column:
    """``t IS NULL OR t <> s`` as the reference writes it."""
    t, s = col(t), col(s)
    return t.isNull() | (t != s)


def strict_mismatch(t, s) -> Column:
    """``t <> s`` with three-valued logic (NULL rows drop out)."""
    return col(t) != col(s)


def differs(a, b) -> Column:
    """null-asymmetric difference == NOT (a <=> b)."""
    return ~col(a).eqNullSafe(col(b))


def is_live(delete_mark, enabled_mark, mode="service") -> Column:
    """F8: live account. service: delete NULL or 0; script: delete = 0 AND enabled = 1."""
    d, e = col(delete_mark), col(enabled_mark)
    if mode == "service":
        return d.isNull() | (d == 0)
    if mode == "script":
        return (d == 0) & (e == 1)
    raise ValueError(mode)


def ts_lit(ts: str) -> Column:
    """A fixed clock value as timestamp_ntz (matches the parquet columns)."""
    return F.to_timestamp_ntz(lit(ts))


def within_days(ts, as_of: str, days: int) -> Column:
    """as_of - days <= ts <= as_of + days; NULL ts is dropped."""
    a = ts_lit(as_of)
    t = col(ts)
    return t.isNotNull() & (t >= a - F.make_dt_interval(lit(days))) & (t <= a + F.make_dt_interval(lit(days)))


def is_open(status, mode="not_signed") -> Column:
    """``status <> 'signed'`` (drops NULL) or ``status = 'issuing' OR status IS NULL``."""
    s = col(status)
    if mode == "not_signed":
        return s != lit("signed")
    if mode == "issuing_or_null":
        return (s == lit("issuing")) | s.isNull()
    raise ValueError(mode)


def older_than(ts, as_of: str, days: int) -> Column:
    """ts < as_of - days."""
    return col(ts) < ts_lit(as_of) - F.make_dt_interval(lit(days))


def key_norm(c, trim=False, lower=False) -> Column:
    """K1: optional key normalisation (trim blanks, lower case)."""
    c = col(c)
    if trim:
        c = F.trim(c)
    if lower:
        c = F.lower(c)
    return c


COLLATION = "UTF8_LCASE_RTRIM"        # compares without case and trailing blanks, as the server's default does


def collated(c, collation: str = COLLATION) -> Column:
    """K1: a key that compares by a collation; a join on it needs no rewritten copy of the key."""
    return F.collate(col(c), collation)


# -------------------------------------------------------------------- scalars
def _id_part(p) -> Column:
    # injective: NULL -> "N", a value -> "<utf-8 bytes>:<text>" (NULL and ''
    # differ, a separator inside a value cannot shift the boundaries)
    v = col(p).cast("string")
    return F.when(v.isNull(), lit("N")).otherwise(F.concat(F.octet_length(v).cast("string"), lit(":"), v))


def _id_input(parts) -> Column:
    return F.concat_ws("|", *[_id_part(p) for p in parts])


def stable_id(*parts) -> Column:
    """Repeatable row id: md5 of the parts, cut 8-4-4-4-12, upper case."""
    h = F.md5(_id_input(parts))
    return F.upper(F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                               F.substring(h, 17, 4), F.substring(h, 21, 12)))


def stable_id_sql(*parts: str) -> str:
    inner = ", ".join(f"CASE WHEN {p} IS NULL THEN 'N' ELSE CAST(strlen(CAST({p} AS VARCHAR)) AS VARCHAR) "
                      f"|| ':' || CAST({p} AS VARCHAR) END" for p in parts)
    h = f"md5(concat_ws('|', {inner}))"
    return (f"upper(concat_ws('-', substring({h}, 1, 8), substring({h}, 9, 4), substring({h}, 13, 4), "
            f"substring({h}, 17, 4), substring({h}, 21, 12)))")


def short_key(guid) -> Column:
    """16-char key from a GUID text: drop dashes, first 16, lower."""
    return F.lower(F.substring(F.regexp_replace(col(guid), "-", ""), 1, 16))


def key_expr(row_id, run_ts: str) -> Column:
    """Secret key = middle 16 hex of md5(id || run_ts); distinct per row."""
    return F.substring(F.md5(F.concat(col(row_id), lit(run_ts))), 9, 16)


def key_expr_sql(row_id: str, run_ts: str) -> str:
    return f"substring(md5(concat({row_id}, '{run_ts}')), 9, 16)"


def digest_expr(secret, key) -> Column:
    """Keyed digest of the default secret: sha256(md5(secret) ':' key)."""
    return F.sha2(F.concat(F.md5(col(secret)), lit(":"), col(key)), 256)


def digest_expr_sql(secret: str, key: str) -> str:
    return f"sha256(concat(md5({secret}), ':', {key}))"


def split_ids(c, trim_items=True) -> Column:
    """Comma list -> array, blank items dropped; items trimmed unless told not to."""
    arr = F.split(col(c), ",")
    if trim_items:   # all whitespace (line breaks too), like a C# Trim()
        arr = F.transform(arr, lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.filter(arr, lambda x: x.rlike(r"\S"))


def pct(p, d) -> Column:
    """P * 100 / d to one decimal, half up, as double; 0 when d = 0."""
    return F.when(col(d) > 0, F.round(col(p).cast("double") * 100 / col(d), 1)).otherwise(lit(0.0))


def pct_sql(p: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN round(CAST({p} AS DOUBLE) * 100 / {d}, 1) ELSE 0.0 END"


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)
