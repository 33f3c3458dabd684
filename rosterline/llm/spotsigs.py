"""SpotSigs document fingerprints (native).

An anchor is a common word; its signature is the anchor with the next
``CHAIN`` content words (words that are no anchors) after it. A document is
the multiset of its signatures; likeness is the multiset Jaccard measure. The
first content words of a text are a signature too, under an empty anchor, so
every text with a letter or digit has at least one. Where two content words in a
row have no anchor before them (tables, lists, junk), the second one stands
under an empty anchor if 4 divides its hash, so that such texts have spots as well.

Built linearly in the text: one regular expression ends every unit "anchors,
content word", and a signature looks at its own unit and the next one only. No
word becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import cut, table, written

#: Common words of four languages.
ANCHORS = ("a", "an", "and", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "of", "on", "or", "that", "the",
           "this", "to", "was", "with",
           "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu",
           "au", "avec", "ce", "dans", "de", "des", "du", "elle", "est", "et", "la", "le", "les", "par", "pas", "pour", "que",
           "qui", "sur", "un", "une",
           "al", "como", "con", "del", "el", "en", "las", "lo", "los", "más", "no", "para", "por", "se", "su", "una", "y")
CHAIN = 2
HEX = 6                 # hex digits of a signature in a fingerprint
THRESHOLD = 0.8
SLICES, SLICE_ROWS = 256, 100_000   # of the document order: at least so many, of about so many rows


def _pattern(words) -> str:
    """One alternation, grouped by first letter so that most words are left after one test."""
    heads: dict[str, list[str]] = {}
    for w in sorted(words):
        heads.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(f"{h}(?:{'|'.join(sorted(t, key=lambda x: (-len(x), x)))})" for h, t in heads.items()) + ")"


def signatures(text: Column, anchors=ANCHORS) -> tuple[Column, Column]:
    """The units of a text (arrays: anchors, content word) and, from a column ``units`` that holds them, its signatures.

    Signatures are HEX-digit strings, with repeats, in the order of the text.
    """
    words = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    # every content word ends a unit: "anchor anchor word\u0001"
    marked = F.regexp_replace(words, rf"(?<= )(?!{_pattern(anchors)} )([^ ]+) +", "$1\u0001")
    units = F.transform(F.split(F.trim(marked), "\u0001"), lambda u: F.split(F.ltrim(u), " "))

    def of(u, i):
        content = F.element_at(u, -1)
        follows = F.coalesce(F.element_at(F.get(units_of, i + 1), -1), F.lit(""))
        heads = F.slice(u, 1, F.size(u) - 1)
        bare = (F.size(u) == 1) & (F.size(F.get(units_of, i - 1)) == 1) & (content != "") & (F.xxhash64(content) % 4 == 0)
        heads = F.when((i == 0) | bare, F.concat(F.array(F.lit("")), heads)).otherwise(heads)
        return F.transform(heads, lambda a: F.substring(F.lower(F.lpad(F.hex(
            F.xxhash64(a, content, follows)), 16, "0")), 1, HEX))
    units_of = F.col("units")
    return units, F.flatten(F.transform(units_of, of))


def fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: the sorted signatures of column ``text`` in one string ('' for a text without words)."""
    units, sigs = signatures(F.col(text))
    return df.withColumn("units", units).withColumn(name, F.when(
        F.regexp_like(text, F.lit(r"[\p{L}\p{N}]")), F.concat_ws(" ", F.array_sort(sigs))).otherwise(F.lit(""))).drop("units")


def packed(print_: Column) -> Column:
    """A fingerprint as bytes, half the size or less."""
    return F.unhex(F.replace(print_, F.lit(" "), F.lit("")))


def unpacked(bytes_: Column) -> Column:
    return F.rtrim(F.regexp_replace(F.lower(F.hex(bytes_)), f"(.{{{HEX}}})", "$1 "))


def occurrences(print_: Column) -> Column:
    """A fingerprint as a set: each signature with its number among its equals (signature + '#k')."""
    runs = F.regexp_extract_all(F.concat(print_, F.lit(" ")), F.lit(rf"([0-9a-f]{{{HEX}}} )\1*+"), F.lit(0))
    return F.flatten(F.transform(runs, lambda r: F.transform(
        F.sequence(F.lit(1), F.floor(F.char_length(r) / (HEX + 1)).cast("int")),
        lambda k: F.concat(F.substring(r, 1, HEX), F.lit("#"), k.cast("string")))))


def likeness(a: str, b: str) -> Column:
    """Multiset Jaccard of two occurrence sets; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0) \
        .otherwise(shared / F.greatest(F.size(F.col(a)) + F.size(F.col(b)) - shared, F.lit(1))).cast("double")


def partitions(longest: int, threshold: float = THRESHOLD) -> list[int]:
    """Lower ends of the set-length partitions 0, 1, ...: widest ranges in which a pair of neighbours can reach the threshold."""
    ends, at = [0], 1
    while at <= longest:
        ends.append(at)
        at = max(at + 1, int(at / threshold + 1e-9) + 1)
    return ends


def next_rows(docs: DataFrame, name: str, more) -> DataFrame:
    """``docs(doc_id, text)`` with what ``more`` adds, and struct ``name``: the next such row by descending doc_id, the first one after the last.

    The order is dealt to slices between percentiles of doc_id, so each task
    sorts one slice; the first row of every slice (one in SLICE_ROWS rows, or
    SLICES + 1) links the slices. Rows with one doc_id follow by text; rows without doc_id
    come last, by text.
    """
    slices = max(SLICES, docs.count() // SLICE_ROWS)
    marks = docs.agg(F.percentile_approx("doc_id", [i / slices for i in range(1, slices)], 20 * slices).alias("m")).first()["m"]
    marks = F.lit(sorted(set(marks or []))).cast("array<bigint>")
    keyed = docs.withColumn("slice", F.when(F.col("doc_id").isNull(), -1).otherwise(
        F.size(F.filter(marks, lambda m: m <= F.col("doc_id")))).cast("int"))
    top = keyed.groupBy("slice").agg(F.max("doc_id").alias("top")).withColumnRenamed("slice", "s")
    first = keyed.join(F.broadcast(top), (F.col("slice") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("top"))) \
        .groupBy("slice").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    first, keyed = more(first), more(keyed)
    row = F.struct(*[c for c in keyed.columns if c != "slice"])
    around = Window.orderBy(F.desc("slice"))
    heads = cut(first.select(F.col("slice").alias("s"), F.coalesce(
        F.lead(row).over(around), F.first(row).over(around)).alias("after")))
    inside = Window.partitionBy("slice").orderBy(F.col("doc_id").desc_nulls_last(), "text")
    return keyed.withColumn(name, F.lead(row).over(inside)).join(F.broadcast(heads), F.col("slice") == F.col("s")) \
        .drop("slice", "s").withColumn(name, F.coalesce(name, "after")).drop("after")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text)`` to ``(members(doc_id, class_id), pairs(a, b, likeness))``.

    A class is all documents of one fingerprint, named by its smallest doc_id;
    ``pairs`` holds every pair of classes with likeness >= ``threshold``. Sets
    are compared within their length partition and the one below only, shorter
    first, through an index on the rarest signatures: a set of n signatures is
    listed under its n - ceil(threshold n) + 1 rarest, and a probe is pruned by
    the length bound before the sets are compared.
    """
    prints = written(fingerprint(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "print").select("doc_id", "print"), "spots")
    members = prints.select("doc_id", F.xxhash64("print").alias("h"), "print")
    classes = written(prints.groupBy("print").agg(F.min("doc_id").alias("class_id")).withColumn("sigs", occurrences(F.col("print")))
                      .withColumn("n", F.size("sigs")), "classes")
    common = classes.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count("*").alias("df"))
    listed = classes.select("class_id", "n", F.explode("sigs").alias("sig")).join(common, "sig") \
        .groupBy("class_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("rare"))
    ends = F.lit(partitions(classes.agg(F.max("n")).first()[0] or 0, threshold)).cast("array<int>")
    rare = listed.withColumn("rare", F.slice("rare", 1, (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int"))) \
        .withColumn("part", F.size(F.filter(ends, lambda e: e <= F.col("n")))).select("class_id", "n", "part", F.explode("rare.sig").alias("sig"))
    probe = rare.select(F.col("class_id").alias("a"), F.col("n").alias("na"), F.explode(F.array("part", F.col("part") - 1)).alias("part"), "sig")
    index = rare.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), "part", "sig")
    found = probe.join(index, ["part", "sig"]).where((F.col("nb") >= threshold * F.col("na") - 1e-9) & (
        (F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a"))))).select("a", "b").distinct()
    left, right = (classes.select(F.col("class_id").alias(k), F.col("sigs").alias("s" + k)) for k in "ab")
    pairs = found.join(left, "a").join(right, "b").select("a", "b", likeness("sa", "sb").alias("likeness")).where(F.col("likeness") >= threshold)
    named = classes.select(F.col("print").alias("p"), "class_id")
    return members.join(named, members["print"] == named["p"]).select("doc_id", "class_id"), pairs


def op4(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness and that to the next document.

    The edited text has the last third of its code points replaced by the first
    as many of the next document (by descending doc_id; NULL texts are empty).
    ``set_partition`` is the length partition in which the document's set is
    compared, ``edited_partition`` the edited text's.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def printed(df):
        return fingerprint(df, "text", "print").withColumn("print", packed(F.col("print")))
    rows = next_rows(docs, "next", printed).withColumn("n_chars", F.char_length("text").cast("bigint"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - third).cast("int")),
                                              F.substr("next.text", F.lit(1), third)))
    rows = fingerprint(rows, "edited", "edited_fingerprint") \
        .withColumns({"fingerprint": unpacked(F.col("print")), "next_print": unpacked(F.col("next.print"))})
    rows = rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", *[occurrences(F.col(c)).alias(s) for c, s in (
                           ("fingerprint", "own"), ("edited_fingerprint", "changed"), ("next_print", "after"))])
    ends = F.lit(partitions(1 << 31)).cast("array<bigint>")

    def part(sigs):
        return F.size(F.filter(ends, lambda e: e <= F.size(sigs)))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness("own", "changed").alias("near_edited"), likeness("own", "after").alias("near_next"),
                       part("own").alias("set_partition"), part("changed").alias("edited_partition"))
