"""Uniform shuffle into shards of exact size through a drawn communication matrix (native).

Rows are dealt to ``parts`` logical partitions by a hash of their content. How
many rows partition p sends to shard s is drawn exactly: the counts of a
uniformly random permutation follow the multivariate hypergeometric law, which
is split down a binary tree of partitions (every node divides its shard counts
between its two halves). Each partition then permutes its rows and deals them
out by its row of the matrix; each shard permutes what it got.

Everything is drawn from hashes of a seed, so a recomputed task gives the same
rows, and no step sees more than one partition or one slice of a shard. The
matrix has ``parts`` x ``shards`` cells, both parameters, so broadcasting it is
bounded. ``parts`` and ``slices`` follow the row count (rows_per_part).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import cut, table

ROWS_PER_PART = 2_000_000
MIN_PARTS = 256
MAX_PARTS = 1 << 16


def _uniform(*parts) -> Column:
    """A number in [0, 1) with 53 bits from a hash of ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") * F.lit(2.0 ** -53)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Exact hypergeometric draw by inversion: marked rows among ``drawn`` of ``total`` rows.

    Weights are summed outward from the mode by the ratio of neighbouring
    probabilities; terms beyond 12 standard deviations are below double
    precision and left out.
    """
    def steps(n):
        n = F.floor(n).cast("int")
        return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))

    def up(p, k):       # p(k) / p(k-1)
        return (p["marks"] - k + 1) * (p["takes"] - k + 1) / (k * (p["rest"] + k))

    def down(p, k):     # p(k) / p(k+1)
        return (k + 1) * (p["rest"] + k + 1) / ((p["marks"] - k) * (p["takes"] - k))

    def weigh(p, seq, ratio, sign):
        def add(s, i):
            return _let(s["w"] * ratio(p, p["mode"] + i * sign),
                        lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")))
        return F.aggregate(seq, F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), add, lambda s: s["sum"])

    def walk(p, seq, ratio, sign, goal):
        def add(s, i):
            return _let(s["w"] * ratio(p, p["mode"] + i * sign), lambda w: F.struct(
                w.alias("w"), (s["left"] - w).alias("left"),
                F.when(s["left"] > 0, p["mode"] + i * sign).otherwise(s["pick"]).alias("pick")))
        return F.aggregate(seq, F.struct(F.lit(1.0).alias("w"), goal.alias("left"), p["mode"].alias("pick")), add,
                           lambda s: s["pick"])

    def limits(p):
        low = F.greatest(F.lit(0.0), -p["rest"])
        high = F.least(p["takes"], p["marks"])
        share = p["marks"] / F.greatest(p["pool"], F.lit(1.0))
        sd = F.sqrt(F.greatest(F.lit(0.0), p["takes"] * share * (1 - share) * (p["pool"] - p["takes"])
                               / F.greatest(p["pool"] - 1, F.lit(1.0))))
        mode = F.least(high, F.greatest(low, F.floor((p["takes"] + 1) * (p["marks"] + 1) / (p["pool"] + 2)).cast("double")))
        return F.struct(p["takes"].alias("takes"), p["marks"].alias("marks"), p["rest"].alias("rest"), low.alias("low"),
                        high.alias("high"), mode.alias("mode"), (F.ceil(sd * 12).cast("double") + 30).alias("reach"))

    def ranges(p):
        return F.struct(*[p[c].alias(c) for c in ("takes", "marks", "rest", "mode")],
                        steps(F.least(p["high"] - p["mode"], p["reach"])).alias("ups"),
                        steps(F.least(p["mode"] - p["low"], p["reach"])).alias("downs"))

    def pick(p):
        def by(w):
            return _let(u * (1 + w["above"] + w["below"]), lambda goal: F.when(goal <= 1, p["mode"])
                        .when(goal <= 1 + w["above"], walk(p, p["ups"], up, 1, goal - 1))
                        .otherwise(walk(p, p["downs"], down, -1, goal - 1 - w["above"])))
        return _let(F.struct(weigh(p, p["ups"], up, 1).alias("above"), weigh(p, p["downs"], down, -1).alias("below")), by)

    total, marked, drawn = (c.cast("double") for c in (total, marked, drawn))
    given = F.struct(total.alias("pool"), marked.alias("marks"), drawn.alias("takes"), (total - marked - drawn).alias("rest"))
    return _let(given, lambda p: _let(limits(p), lambda q: _let(ranges(q), pick))).cast("bigint")


def _split(half: Column, whole: Column, counts: Column, seed: int, level: int, node: Column) -> Column:
    """The left half's share of ``counts`` (an array over shards): one draw a shard, conditioned on those before."""
    def draw(s, i):
        mine = F.get(counts, i)
        k = hypergeometric(s["rows"], mine, s["open"], _uniform(F.lit(seed), F.lit(level), node, i))
        return _let(k, lambda k: F.struct((s["rows"] - mine).alias("rows"), (s["open"] - k).alias("open"),
                                          F.concat(s["out"], F.array(k)).alias("out")))
    start = F.struct(whole.alias("rows"), half.alias("open"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, draw, lambda s: s["out"])


def matrix(sizes: DataFrame, parts: int, shards: int, seed: int) -> DataFrame:
    """``sizes(part, n)`` to ``(part, sends array<bigint>)``: exact counts for every shard.

    Columns of the matrix sum to floor or ceil of rows / shards, rows to n.
    ``sizes`` has at most ``parts`` rows (a power of two), so it fits one row: the
    root of the tree. A node holds the sizes of its own partitions only, so a level
    of the tree is ``parts`` numbers in all.
    """
    def total(numbers):
        return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)
    empty = sizes.sparkSession.range(parts).select(F.col("id").alias("part"), F.lit(0).cast("bigint").alias("n"))
    every = sizes.select("part", "n").union(empty).groupBy("part").agg(F.sum("n").alias("n"))
    root = every.groupBy().agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("all")).select(F.col("all.n").alias("sizes"))
    tree = root.select(F.lit(0).alias("node"), "sizes", total(F.col("sizes")).alias("n"))
    base, more = F.floor(F.col("n") / shards).cast("bigint"), F.col("n") % shards
    tree = tree.withColumn("sends", F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: base + F.when(s < more, 1).otherwise(0)))
    level, width = 0, parts
    while width > 1:
        tree = tree.withColumn("half", total(F.slice("sizes", 1, width // 2)))
        tree = tree.withColumn("left", _split(F.col("half"), F.col("n"), F.col("sends"), seed, level, F.col("node")))
        tree = tree.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.slice("sizes", 1, width // 2).alias("sizes"),
                     F.col("half").alias("n"), F.col("left").alias("sends")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.slice("sizes", width // 2 + 1, width // 2).alias("sizes"),
                     (F.col("n") - F.col("half")).alias("n"),
                     F.zip_with("sends", "left", lambda a, b: a - b).alias("sends")))).alias("x")).select("x.*")
        if level == 4:          # from here on the draws run on many tasks
            tree = tree.repartition(32, "node")
        level, width = level + 1, width // 2
    return tree.select(F.col("node").alias("part"), "sends")


def shard(df: DataFrame, shards: int, *keys: str, seed: int = 42, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in its shard).

    ``keys`` are the columns whose values identify a row; rows equal in all of
    them are interchangeable. Shard sizes differ by at most one, and every
    arrangement of the rows is equally likely over seeds. NULL keys are values
    like any other; an empty ``df`` gives an empty result; columns of ``df``
    named like the added ones are replaced.
    """
    rows = df.count()
    parts = MIN_PARTS
    while parts < MAX_PARTS and parts * rows_per_part < rows:
        parts *= 2
    slices = max(64, -(-rows // (shards * rows_per_part)))
    df = df.drop("shard", "slot")
    held = F.struct(*df.columns).alias("row")
    ids = [F.col(k) for k in keys]
    dealt = df.select(held, F.pmod(F.xxhash64(F.lit(seed), *ids), F.lit(parts)).cast("int").alias("part"),
                      F.xxhash64(F.lit(seed + 1), *ids).alias("first"), F.xxhash64(F.lit(seed + 2), *ids).alias("second"))
    sends = matrix(dealt.groupBy("part").agg(F.count("*").alias("n")), parts, shards, seed)
    bounds = cut(sends.select(F.col("part").alias("p"), F.transform(
        F.sequence(F.lit(1), F.lit(shards)),
        lambda i: F.aggregate(F.slice("sends", 1, i), F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("upto")))
    local = dealt.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy("first", "second")))
    sent = local.join(F.broadcast(bounds), F.col("part") == F.col("p")) \
        .withColumn("shard", F.size(F.filter("upto", lambda c: c < F.col("at"))).cast("int")) \
        .withColumn("slice", F.pmod(F.col("second"), F.lit(slices)).cast("int"))
    sums = sent.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    base = sums.select(F.col("shard").alias("s"), F.col("slice").alias("l"),
                       (F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("before"))
    again = Window.partitionBy("shard", "slice").orderBy("second", "first")
    return sent.withColumn("rank", F.row_number().over(again)) \
        .join(F.broadcast(base), (F.col("shard") == F.col("s")) & (F.col("slice") == F.col("l"))) \
        .select("row.*", "shard", (F.col("before") + F.col("rank") - 1).cast("bigint").alias("slot"))


def op8(spark, sf_dir: str, shards: int = 8) -> DataFrame:
    """All documents in ``shards`` shards by the ``rows`` law (shard sizes at most one row apart).

    A NULL text has size 1 and crc32 0; repeated rows each get their own slot.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("text_crc32"))
    out = shard(docs, shards, "doc_id", "size", "text_crc32")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
