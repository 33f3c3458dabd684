"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two 64-bit fingerprints within ``BITS`` = 2 bits of each other share at least
six of their eight positional bytes: that is the guaranteed minimum of the
count filter. A posting list is therefore kept for every choice of six
positions and the six bytes found there, so two fingerprints meet in a list
exactly if they share six or more positional bytes; lists of one fingerprint
are dropped. Tallying pairs list by list would write n x n rows for a list of n
near copies. Instead every fingerprint left in a list is put at its 65 points
(itself and each one-bit change): two fingerprints have a point in common
exactly if they differ in two bits or fewer. A point holds at most 65
fingerprints; each links to the smallest of them that verifies, by its tally of
shared bytes and its differing bits, and components follow from these links.
"""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import components, cut, table, written

WORDS = 3
BITS = 2            # differing bits at most
SEED = 42
POSITIONS = 8
SHARED = POSITIONS - BITS


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, fp bigint)``; a text without words (or NULL) has 0."""
    def of(text):
        import numpy as np
        from xxhash import xxh64_intdigest
        found = (text or b"").lower().split()       # ASCII letters and white space only, as these are bytes
        if not found:
            return 0
        if len(found) <= words:
            hashes = [xxh64_intdigest(b" ".join(found), SEED)]
        else:
            line = b" ".join(found)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ends = np.cumsum(sizes + 1) - 1
            hashes = [xxh64_intdigest(line[s:e], SEED) for s, e in zip((ends - sizes)[:1 - words].tolist(), ends[words - 1:].tolist())]
        counts = np.zeros(64, np.int64)
        for i in range(0, len(hashes), 1 << 15):
            part = np.array(hashes[i:i + (1 << 15)], "<u8")
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
        return _signed(int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([of(t.as_py()) for t in texts], pa.int64())], names=["doc_id", "fp"])
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def tally(a: Column, b: Column) -> Column:
    """Positional bytes that two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((F.when(x.bitwiseAND(F.lit(_signed(0xFF << (8 * i)))) == 0, 1).otherwise(0) for i in range(POSITIONS)), F.lit(0))


def linked(prints: DataFrame) -> DataFrame:
    """Distinct ``prints(fp)`` to links ``(a, b)`` that connect all fingerprints within BITS bits of each other.

    Pairs within the bound are joined by a path of links, and every link is
    within the bound; not every such pair is a link itself.
    """
    masks = [_signed(sum(0xFF << (8 * i) for i in c)) for c in combinations(range(POSITIONS), SHARED)]
    lists = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("positions", "bytes"))
    in_list = Window.partitionBy("positions", "bytes")
    near = lists.withColumn("n", F.count("*").over(in_list)).where("n > 1").select("fp").distinct()
    points = near.select("fp", F.explode(F.array("fp", *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])).alias("point"))
    pairs = points.withColumn("least", F.min("fp").over(Window.partitionBy("point"))).select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return pairs.where("a <> b").where((tally(F.col("a"), F.col("b")) >= SHARED)
                                       & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS)).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, fp, component_id)``, a row for each row.

    component_id is the smallest doc_id of the component (NULL if it has none).
    Rows may repeat; a third of them may share one fingerprint: equal ones are
    reduced to their smallest doc_id before anything is indexed, and the join
    back is on written tables, so that Spark can split the hot fingerprint.
    """
    prints = written(fingerprints(docs, words), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    groups = cut(components(linked(classes.select("fp"))))
    member = classes.join(groups, classes["fp"] == groups["node"]).select("fp", "component", "first")
    heads = member.groupBy("component").agg(F.min("first").alias("head")).withColumnRenamed("component", "c")
    moved = cut(member.join(heads, member["component"] == heads["c"]).select(F.col("fp").alias("f"), "head"))
    named = written(classes.join(moved, classes["fp"] == moved["f"], "left")
                    .select(F.col("fp").alias("f"), F.when(F.col("f").isNull(), F.col("first")).otherwise(F.col("head")).alias("component_id")), "simhash-named")
    return prints.join(named, prints["fp"] == named["f"]).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document of smallest doc_id of every component, with all columns of ``docs``.

    Rows of one doc_id and equal texts are one document, of which one row stays;
    rows of one doc_id with unequal texts are documents of their own. Rows
    without doc_id are not compared and stay.
    """
    own = F.struct(F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"))
    known = docs.where("doc_id is not null")
    kept = near_duplicates(known.select(own.alias("doc_id"), "text")).where("doc_id = component_id").select("doc_id.*").distinct()
    rows = known.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("own"))
    rows = rows.join(kept, (F.col("row.doc_id") == F.col("i")) & (F.col("own") == F.col("h")), "left_semi")
    first = Window.partitionBy("row.doc_id", "own").orderBy("row.text")
    rows = rows.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")
    return rows.union(docs.where("doc_id is null"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
