"""Hard negatives by exact integer scores from a residue-number-system GEMM.

Vectors become integers. Their inner products with the anchors are computed as
matrix products of the components' residues modulo several small primes, in
float32: residues are drawn to the middle (at most half a prime) and multiplied
``block`` components at a time, so that every partial sum stays below 2**24 and
is exact. Chinese remaindering (mixed radix) gives the signed score back. The
number of primes follows from the largest component, so no score can wrap.

The anchors are a stated query set. They go to the tasks in blocks of about
ANCHORS, one after the other; every block meets all rows in two passes. The
first finds the best positives of an anchor, the second the first negatives
within each positive's window. A task keeps only its own best ones, so what is
shuffled is at most a few rows a task and anchor.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import cut, table, written

PRIMES = (1021, 1019, 1013, 1009, 997, 991)     # their product is just below 2**60
EXACT = 1 << 24                                 # integers up to here are exact in float32
SCORES = (math.prod(PRIMES) - 1) // 2           # bound of a score's absolute value, over 5 * 10**17
ANCHORS = 1 << 15       # of a block, about; 16 MB of integers at 64 components
AT_ONCE = 512, 2048     # anchors and rows whose scores a task holds at a time
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100      # window: LOW * positive <= WHOLE * negative <= HIGH * positive
PREPARED = "row bigint, vec_id bigint, label int, vec array<bigint>"


def primes_for(bound: int) -> tuple[int, ...]:
    """The first primes whose product exceeds twice ``bound``, so that signed values up to it are told apart."""
    if bound > SCORES:
        raise ValueError(f"scores up to {bound} are possible, more than {SCORES}")
    out = []
    while not out or math.prod(out) <= 2 * bound:
        out.append(PRIMES[len(out)])
    return tuple(out)


def residues(x: np.ndarray, prime: int) -> np.ndarray:
    """Residues between -(prime // 2) and prime // 2 as float32."""
    r = x % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


def products(a: list, b: list, primes: tuple) -> np.ndarray:
    """Signed scores (rows of a) x (rows of b) from their residue matrices, one of each for each prime."""
    digits = []
    for p, x, y in zip(primes, a, b):
        block = max(1, (EXACT - 1) // (p // 2) ** 2)
        total = np.zeros((len(x), len(y)), np.int64)
        for i in range(0, x.shape[1], block):
            total += (x[:, i:i + block] @ y[:, i:i + block].T).astype(np.int64)
        digits.append(total % p)
    # mixed radix: score = d0 + p0 * (d1 + p1 * (d2 + ...))
    for i in range(1, len(primes)):
        for j in range(i):
            digits[i] = (digits[i] - digits[j]) * pow(primes[j], -1, primes[i]) % primes[i]
    out = digits[-1]
    for p, d in zip(primes[-2::-1], digits[-2::-1]):
        out = out * p + d
    whole = math.prod(primes)
    return np.where(out > whole // 2, out - whole, out)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    flat, size = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(size)), size), at] = flat
    return out


class Best:
    """The first ``keep`` (score descending, vec_id ascending) of each slot, of all that was offered."""

    def __init__(self, slots: int, keep: int):
        self.keep, self.least = keep, np.full(slots, np.iinfo(np.int64).min)
        self.slot = self.score = self.vec = self.row = np.zeros(0, np.int64)

    def offer(self, slot, score, vec, row):
        if not len(slot):
            return
        slot, score, vec, row = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.vec, vec), (self.row, row)))
        order = np.lexsort((row, vec, -score, slot))
        slot = slot[order]
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        nth = np.arange(len(slot)) - np.repeat(starts, np.diff(np.append(starts, len(slot))))
        order, full = order[nth < self.keep], nth == self.keep - 1
        self.slot, self.score, self.vec, self.row = slot[nth < self.keep], score[order], vec[order], row[order]
        self.least[slot[full]] = self.score[np.flatnonzero(full[nth < self.keep])]


def prepared(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """``rows(vec_id, label, vec)`` as integers with a row number, the widest vector and the largest component.

    Rows with a NULL label, vec_id, vector or component, or one that isn't
    finite, take no part. Every row is its own, also one that repeats.
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & F.col("vec_id").isNotNull()).where(~bad)
    ok = ok.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("int").alias("label"),
                   F.transform("vec", lambda x: F.floor(x.cast("double") * SCALE)).alias("vec"))
    ok = written(ok, "vectors")
    most = ok.agg(F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double")))))).first()
    return ok, most[0] or 0, int(most[1] or 0)


def _search(rows: DataFrame, anchors: pa.Table, primes: tuple, width: int, positives: bool) -> DataFrame:
    """Each task's best rows: ``(slot, score, vec_id, row)``; a slot is an anchor, or an anchor's positive."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(batches):
        a = shared.value
        ids, labels = a.column("row").to_numpy(), a.column("label").to_numpy()
        vectors = _matrix(a.column("vec").combine_chunks(), width)
        if positives:
            best = Best(len(ids), POSITIVES)
        else:
            known = _matrix(a.column("scores").combine_chunks(), POSITIVES)
            filled = np.arange(POSITIVES) < a.column("scores").combine_chunks().value_lengths().to_numpy()[:, None]
            low = -(-LOW * known.astype(object) // WHOLE)            # exact whatever the score's size
            high = HIGH * known.astype(object) // WHOLE
            low, high = np.where(filled, low, 1).astype(np.int64), np.where(filled, high, 0).astype(np.int64)
            best = Best(len(ids) * POSITIVES, NEGATIVES)
        many, some = AT_ONCE
        for batch in batches:
            for at in range(0, batch.num_rows, some):
                part = batch.slice(at, some)
                row, vec, label = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row", "vec_id", "label"))
                mine = _matrix(part.column("vec"), width)
                mine = [residues(mine, p) for p in primes]
                for i in range(0, len(ids), many):
                    j = slice(i, i + many)
                    score = products([residues(vectors[j], p) for p in primes], mine, primes)
                    same = labels[j][:, None] == label[None, :]
                    if positives:
                        hit, col = np.nonzero(same & (ids[j][:, None] != row[None, :]) & (score >= best.least[j][:, None]))
                        best.offer(hit + i, score[hit, col], vec[col], row[col])
                        continue
                    for k in range(POSITIVES):
                        slot = np.arange(i, i + len(score)) * POSITIVES + k
                        least = np.maximum(low[j, k], best.least[slot])
                        hit, col = np.nonzero(~same & (score >= least[:, None]) & (score <= high[j, k][:, None]))
                        best.offer(slot[hit], score[hit, col], vec[col], row[col])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.slot, best.score, best.vec, best.row)], names=["slot", "score", "vec_id", "row"])
    found = rows.mapInArrow(search, "slot bigint, score bigint, vec_id bigint, row bigint")
    keep = POSITIVES if positives else NEGATIVES
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id", "row")
    return cut(found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= keep))


def mine(rows: DataFrame, is_anchor, anchors: int = ANCHORS) -> DataFrame:
    """``rows(vec_id, label, vec)`` to ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on vec_id, ``anchors`` the size of a block of them. For each anchor: the first
    POSITIVES other rows of its label by score (ties: smaller vec_id), and for
    each of them the first NEGATIVES rows of other labels whose score lies in
    the window. Fewer if there are fewer; an anchor without positives and a
    positive without negatives have no rows. Vectors of unequal length are
    compared as if filled with zeros. Rows with NULLs or values that aren't
    finite take no part; of repeated rows each is its own, so a repeated anchor
    has its rows as often. Scores beyond SCORES are an error. No rows, no result.
    """
    rows, width, largest = prepared(rows)
    primes = primes_for(width * largest * largest)
    queries = rows.where(is_anchor)
    blocks = -(-queries.count() // anchors)
    out = None
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("row").toArrow()      # about ``anchors`` rows
        if not block.num_rows:
            continue
        first = _search(rows, block, primes, width, True)
        by_anchor = first.groupBy("slot").agg(F.array_sort(F.collect_list(F.struct("nth", "score", "vec_id"))).alias("p")).orderBy("slot").collect()
        known = {r["slot"]: r["p"] for r in by_anchor}                                                     # POSITIVES for each anchor of the block
        scores = pa.array([[p["score"] for p in known.get(i, [])] for i in range(block.num_rows)], pa.list_(pa.int64()))
        second = _search(rows, block.append_column("scores", scores), primes, width, False)
        named = first.select((F.col("slot") * POSITIVES + F.col("nth") - 1).alias("p_slot"), F.col("vec_id").alias("positive_id"),
                             F.col("score").alias("positive_score"))
        names = queries.sparkSession.createDataFrame(
            list(enumerate(block.column("vec_id").to_pylist())), "a_slot bigint, anchor_id bigint")
        found = second.join(named, F.col("slot") == F.col("p_slot")).join(names, F.floor(F.col("slot") / POSITIVES) == F.col("a_slot")) \
            .select("anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score"))
        found = cut(found)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.sparkSession.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                                                     "negative_score bigint")
    return out


def op13(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of the embeddings; anchors have a vec_id divisible by 100."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("vec"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH rows_ AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
                  CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
           FROM rows_ a JOIN rows_ b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score,
                     row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
              FROM scores WHERE label = own),
found AS (SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
          FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.own
               AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
          WHERE nth <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""
