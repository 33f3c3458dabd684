"""Change operators: insert-missing, update-from-join, delete-where, and net changes.

Each returns a ``Change``: ``rows`` (the rows inserted / updated / deleted, so
a change can be checked against an oracle), ``after`` (the whole new table) and
``delta`` (what is stored of it). Nothing is written here; ``sources.sinks`` and
``sources.buckets`` write versions, since parquet tables refuse UPDATE / DELETE
/ MERGE.

An update's outcome depends on the few target columns that its condition and
its new values read. So an update is computed over the distinct combinations of
those columns and stored as such: wide rows are neither hashed, grouped nor
shuffled, and equal rows change together by construction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.functions.exprs import col, stable_id
from rosterline.operators.audit import missing_from


@dataclass
class Change:
    rows: DataFrame       # the rows that change (after values for updates), one for each changed row
    after: DataFrame      # the full table after the change
    delta: DataFrame      # what ``apply_changes`` needs to make ``after`` again; updates with a count ``_n``

    def count(self) -> int:
        return self.rows.count()


COPIES = 10_000           # copies of one row that one task writes out


def copies_of(df: DataFrame, n: str, name: str) -> DataFrame:
    """Every row of ``df`` as often as its column ``n`` says, numbered from 1 in ``name``.

    Up to COPIES copies are made where the row is. The count of a row with more
    is cut into ranges of COPIES, and only these are dealt to all tasks, so
    neither an array nor a task grows with the copies of a row (AQE drops that
    shuffle when no row has so many).
    """
    cols = [c for c in df.columns if c != n]
    few = df.where(F.col(n) <= COPIES).select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n).cast("long"))).alias(name))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.where(F.col(n) > COPIES).select(
        *cols, n, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / COPIES))).alias("_range"))
    ranges = ranges.repartition(parts, *cols, "_range")
    first = F.col("_range") * COPIES
    return few.union(ranges.select(*cols, F.explode(F.sequence(first + 1, F.least(F.col(n), first + COPIES))).alias(name)))


def counted_copies(df: DataFrame, cols: list) -> DataFrame:
    """Distinct rows with their number ``_n``, grouped on *all* their columns: a partial
    aggregate collapses copies before the shuffle, and the shuffle spreads one
    business key with many different rows over all reducers (hash of every column)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))


def number_copies(df: DataFrame, cols: list, name: str = "copy_no") -> DataFrame:
    """Give exact duplicate rows distinct numbers 1..n without a window."""
    return copies_of(counted_copies(df, cols), "_n", name)


def insert_missing(source: DataFrame, target: DataFrame, src_key: str, tgt_key: str,
                   template, id_table: str | None = None, id_col: str = "id",
                   dedup: bool = False, source_cols: list | None = None, cut=None) -> Change:
    """Rows of ``source`` whose key has no row in ``target`` become target rows.

    - anti-join (``left_anti``): a NULL source key is kept, as with
      LEFT JOIN ... IS NULL; it never matches.
    - the target is compared as it was before the statement, so a key that
      occurs twice in the source is inserted twice (``dedup=False``); the
      copies get distinct ids via ``number_copies``.
    - ``template(df) -> list[Column]`` projects the target row (P1); it may
      use the column ``id_col`` which holds a repeatable id (X1).
    - ``cut`` (DataFrame to the same DataFrame, written) cuts the plan after
      the join, where the rows are narrow and counted.
    """
    cols = source_cols or source.columns
    missing = missing_from(source.select(*cols), target, src_key, tgt_key)
    if dedup:
        other = [c for c in cols if c != src_key]
        packed = F.min(F.struct(*other)).alias("_row") if other else F.count(F.lit(1)).alias("_row")
        missing = missing.groupBy(src_key).agg(packed) \
            .select(src_key, *[F.col(f"_row.{c}").alias(c) for c in other]) \
            .withColumn("copy_no", F.lit(1))
        missing = cut(missing) if cut else missing
    else:
        counted = counted_copies(missing, cols)
        missing = copies_of(cut(counted) if cut else counted, "_n", "copy_no")
    if id_table is not None:
        missing = missing.withColumn(id_col, stable_id(F.lit(id_table), *cols, "copy_no"))
    rows = missing.select(*template(missing))
    return Change(rows=rows, after=apply_changes(target, rows, "insert"), delta=rows)


def update_from(target: DataFrame, source: DataFrame, on: Column, when: Column | None,
                set_: dict, source_cols: list | None = None, target_cols: list | None = None,
                key: str | None = None) -> Change:
    """UPDATE t SET ... FROM t JOIN s ON ... WHERE ... with exact semantics.

    ``target`` must be aliased "t" and ``source`` "s" in ``on``/``when``/``set_``.

    - the WHERE is applied per (t, s) pair, before anything is deduplicated;
    - a target row is updated once if any pair passes; its new value comes
      from one passing pair: the smallest new value (non-NULL first);
    - "updated to NULL" differs from "not updated": the changed rows are
      exactly the rows with a passing pair, never ``coalesce(new, old)``;
    - no column needs to be unique or non-NULL: equal target rows are changed
      together and counted each, and the number of rows never changes.

    ``source_cols`` / ``target_cols``: the columns of either side that ``on`` /
    ``when`` / ``set_`` use (all if not given). Both sides are reduced to their
    distinct combinations before the join (equal ones have equal outcomes), the
    target's with their number, so a key that is hot in both tables meets few
    rows. ``key``: the target column of an equality in ``on``; the rows
    of a change are then found by it (a row that changed has no NULL there).

    ``delta`` holds one row for each combination that changes: the key, the old
    values, the new ones and the number of rows. ``rows`` and ``after`` join
    the target with it (AQE broadcasts it when the changes are few).
    """
    s_cols, t_cols, names = source_cols or source.columns, target_cols or target.columns, list(set_)
    old = [f"_t_{x}" for x in t_cols]
    combos = target.select(*t_cols).groupBy(*t_cols).agg(F.count(F.lit(1)).alias("_n"))
    pairs = combos.alias("t").join(source.select(*s_cols).distinct().alias("s"), on, "inner")
    if when is not None:
        pairs = pairs.where(when)
    pairs = pairs.select(*[F.col(f"t.{x}").alias(f"_t_{x}") for x in t_cols], F.col("t._n").alias("_n"),
                         *[set_[n].alias(f"_new_{n}") for n in names])
    value = F.col(f"_new_{names[0]}") if len(names) == 1 else F.struct(*[F.col(f"_new_{n}") for n in names])
    hits = pairs.groupBy(*old).agg(F.min(value).alias("_v"), F.max("_n").alias("_n"))
    new = {n: F.col("_v") if len(names) == 1 else F.col(f"_v._new_{n}") for n in names}
    found = [F.col(f"_t_{key}").alias(key)] if key else []
    delta = hits.select(*found, F.struct(*[F.col(f"_t_{x}").alias(x) for x in t_cols]).alias("_old"),
                        F.struct(*[new[n].alias(n) for n in names]).alias("_new"), "_n")
    # dealt by something else than the key, so that the join below gets an exchange of its own on
    # both sides, which AQE needs to split a key that is hot in the target
    dealt = delta.repartition(F.xxhash64(key)) if key else delta
    both = _matched(target, dealt, "inner")
    tcols = target.columns
    rows = both.select(*[F.col(f"_new.{x}").alias(x) if x in names else target[x] for x in tcols],
                       *[F.col(f"_new.{n}").alias(n) for n in names if n not in tcols])
    return Change(rows=rows, after=apply_changes(target, dealt, "update"), delta=delta)


def same(a: Column, b: Column) -> Column:
    """Whether two structs are equal, NULLs included, but not as an equality: a join with
    it is planned on its key alone, whose buckets or partitions it can follow."""
    return (a <= b) & (a >= b)


def _matched(target: DataFrame, delta: DataFrame, how: str) -> DataFrame:
    """``target`` joined with the update that hits each row (``_old``, ``_new``)."""
    cols = delta.schema["_old"].dataType.names
    key = [x for x in delta.columns if not x.startswith("_")]
    whole = F.struct(*[target[x].alias(x) for x in cols])
    if key:
        change = delta.select(F.col(key[0]).alias("_k"), "_old", "_new")
        return target.join(change, (target[key[0]] == change["_k"]) & same(whole, change["_old"]), how)
    change = delta.select(F.xxhash64(*[F.col(f"_old.{x}") for x in cols]).alias("_k"), "_old", "_new")
    return target.join(change, (F.xxhash64(*[target[x] for x in cols]) == change["_k"]) & (whole == change["_old"]), how)


def apply_changes(target: DataFrame, delta: DataFrame, kind: str) -> DataFrame:
    """A table after a change, from its ``delta`` alone (merge on read).

    insert: target + rows. update: every row whose columns equal (NULLs
    included) the old values of a combination gets its new values; set columns that
    the table lacks are NULL on rows that were not hit. delete: rows equal to a
    row of ``delta`` go, matched by a hash of all columns and then the columns.
    """
    if kind == "insert":
        return target.unionByName(delta, allowMissingColumns=True)
    cols = target.columns
    if kind == "delete":
        whole = F.struct(*[target[x] for x in cols])
        gone = delta.select(F.xxhash64(*cols).alias("_h"), F.struct(*cols).alias("_old")).distinct()
        return target.join(gone, (F.xxhash64(*[target[x] for x in cols]) == gone["_h"]) & (whole == gone["_old"]), "left_anti")
    names = delta.schema["_new"].dataType.names
    both = _matched(target, delta, "left")
    hit = F.col("_old").isNotNull()
    return both.select(*[F.when(hit, F.col(f"_new.{x}")).otherwise(target[x]).alias(x) if x in names else target[x] for x in cols],
                       *[F.col(f"_new.{n}").alias(n) for n in names if n not in cols])


def delete_where(target: DataFrame, cond: Column) -> Change:
    """DELETE ... WHERE cond: a row whose condition is NULL is kept."""
    deleted = target.where(cond)
    kept = target.where(~F.coalesce(cond, F.lit(False)))
    return Change(rows=deleted, after=kept, delta=deleted)


# ------------------------------------------------------------------ net changes
# A table that is stored as a first version, inserted rows and updates keeps two
# columns with each row while it is read: ``_at``, the number of the change that
# stored the row, and ``_was``, the values it was stored with. Both stay what
# they are however often the row is updated, so an update that names them says
# which stored rows it hits, and a chain of updates is merged by grouping on them.
ORIGIN = ("_at", "_was")


def stored(df: DataFrame, at, state: list) -> DataFrame:
    """Rows as stored by change number ``at`` (a number or a column); ``state``: the columns that updates read or set."""
    at = F.lit(at) if isinstance(at, int) else at
    return df.withColumns({"_at": at.cast("long"), "_was": F.struct(*[F.col(x) for x in state])})


def net_of(deltas: DataFrame, key: str) -> DataFrame:
    """A chain of updates as one: ``(key, _at, _was, new_<column> ...)``, a row for each stored combination.

    ``deltas`` holds the rows of all updates, whatever their order, with their
    number ``_seq``, the key, ``_at``, ``_was`` and a struct ``new_<column>`` of
    one field ``v`` for each set column (NULL: this update doesn't set it). Each
    column gets its value from the last update that sets it: one grouped pass.
    """
    names = [x for x in deltas.columns if x.startswith("new_")]
    return deltas.groupBy(key, *ORIGIN).agg(*[F.max_by(x, F.when(F.col(x).isNotNull(), F.col("_seq"))).alias(x) for x in names])


def stored_update(delta: DataFrame, seq: int, key: str) -> DataFrame:
    """The ``delta`` of an update over rows with ``_at`` and ``_was``, in the form that ``net_of`` merges."""
    names = delta.schema["_new"].dataType.names
    return delta.select(F.lit(seq).cast("long").alias("_seq"), key, *[F.col(f"_old.{x}").alias(x) for x in ORIGIN],
                        *[F.struct(F.col(f"_new.{n}").alias("v")).alias(f"new_{n}") for n in names], "_n")


def merged(rows: DataFrame, net: DataFrame | None, key: str, how: str = "left") -> DataFrame:
    """Stored rows as they are after their net update (``how="inner"``: only those that have one): one join, whatever the number of updates.

    An inserted row that was updated is the inserted row with its last values.
    Set columns that the table lacks are added, NULL on rows without an update.
    """
    if net is None:
        return rows
    names = [x[4:] for x in net.columns if x.startswith("new_")]
    change = net.withColumnsRenamed({key: "_k", "_at": "_net_at", "_was": "_net_was"})
    both = rows.join(change, (rows[key] == change["_k"]) & same(F.struct(rows["_at"].alias("a"), rows["_was"].alias("w")),
                                                                F.struct(change["_net_at"].alias("a"), change["_net_was"].alias("w"))), how)
    return both.select(*[F.when(F.col(f"new_{x}").isNotNull(), F.col(f"new_{x}.v")).otherwise(rows[x]).alias(x) if x in names else rows[x]
                         for x in rows.columns], *[F.col(f"new_{n}.v").alias(n) for n in names if n not in rows.columns])


__all__ = ["Change", "insert_missing", "update_from", "apply_changes", "delete_where", "copies_of", "number_copies", "stored", "net_of",
           "stored_update", "merged", "col"]
