"""Secret scan: candidates by pattern, a random forest to remove the false positives (native).

A candidate is a run of 12 or more key characters with a digit in it, or
whatever is assigned to a name such as ``token``, quoted or up to a space, from
6 characters on. Some candidates are labelled: an assigned one is a finding, any
other address or plain number is none. The
forest learns from a bounded sample of these and judges all candidates by
length, character transitions, dictionary coverage, path marks and
neighbouring words. Dictionary, transitions and the rates of neighbouring words
are counted over all documents and all labelled candidates.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import bounded_sample, cut, table, written
from rosterline.session import checkpoint_dir

KEY = r"A-Za-z0-9_+/=.@:\-"
LEAST = 12
CANDIDATE = rf"(?<![{KEY}])(?=[{KEY}]{{{LEAST}}})[A-Za-z_+/=.@:\-]*[0-9][{KEY}]*"
NAME = "(?:token|secret|passw(?:or)?d|api_?key|access_?key)"
ASSIGNED = NAME + r"[\"']? *[:=] *[\"']?$"
# Java only, for the bounded lookbehinds; the short ones spare most places the long one
VALUE = r"[^\s\"']{5,}[^\s\"'.,;:)\]}?]"
AFTER_NAME = rf"(?<=[:= \"'])(?<=[:=] {{0,8}}[\"']?)(?<=(?i:{NAME})[\"']? {{0,8}}[:=] {{0,8}}[\"']?)"
FOUND = rf"{AFTER_NAME}(?:(?<=\")[^\"\r\n]{{6,}}(?=\")|(?<=')[^'\r\n]{{6,}}(?=')|{VALUE})" \
    rf"|(?![A-Za-z0-9_.\-]{{0,64}}?(?i:{NAME})[:=]{VALUE}){CANDIDATE}"
NOT_SECRET = r"@|^[0-9]+$|^[0-9]{1,3}(?:[.][0-9]{1,3}){3}|^https?:|^[0-9.:/\-]+$"
NEAR = 60               # characters kept on either side
SAMPLE = 20_000         # labelled candidates the forest is fitted on
TREES, DEPTH = 30, 6
FREQUENT = 3            # documents that hold a word of the dictionary
PRIOR = 5.0             # candidates of the overall rate mixed into each neighbouring word's
RARE = -12.0            # log-likelihood of a transition that no word has
FEATURES = ["length", "transitions", "coverage", "changes", "digits", "upper", "marks", "address", "quoted", "place", "before_rate", "after_rate"]


def candidates(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to ``(id, doc_id, start, text, before, after, place)``, one row a candidate.

    ``start`` counts code points; ``before`` and ``after`` are the NEAR
    characters around; ``place`` is the share of the text before it. Every row
    of a repeated document has its own candidates.
    """
    found = docs.where(F.regexp_like("text", F.lit(FOUND))).withColumn("row", F.monotonically_increasing_id())
    gaps = F.split("text", FOUND)
    pairs = F.arrays_zip(F.transform(gaps, lambda g: F.struct(F.char_length(g).alias("n"), F.left(g, F.lit(NEAR)).alias("head"),
                                                               F.right(g, F.lit(NEAR)).alias("tail"))).alias("gap"),
                         F.regexp_extract_all("text", F.lit(FOUND), F.lit(0)).alias("own"))
    rows = found.select("row", "doc_id", F.char_length("text").alias("whole"), F.posexplode(pairs).alias("nth", "x")) \
        .select("row", "doc_id", "whole", "nth", F.col("x.gap.n").alias("n"), F.col("x.gap.head").alias("head"),
                F.col("x.gap.tail").alias("before"), F.col("x.own").alias("own"))
    order = Window.partitionBy("row").orderBy("nth")
    size = F.coalesce(F.char_length("own"), F.lit(0))
    rows = rows.withColumn("start", F.sum(F.col("n") + size).over(order) - size).withColumn("after", F.lead("head").over(order))
    return rows.where("own is not null").select(
        F.concat_ws("-", "row", "nth").alias("id"), "doc_id", "start", F.col("own").alias("text"), "before",
        F.coalesce("after", F.lit("")).alias("after"), (F.col("start") / F.col("whole")).alias("place"))


def dictionary(docs: DataFrame) -> DataFrame:
    """``(word, n)``: lower-case ASCII words of 3 to 20 letters in FREQUENT documents or more."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), "[^a-z]+"))).alias("word"))
    return words.where(F.char_length("word").between(3, 20)).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)


def _letters(text):
    """Text in lower case with 0 for digits and - for other marks."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), "[^a-z0]", "-")


def _bigrams(text):
    return F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text) - 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(2)))


def measured(found: DataFrame, words: DataFrame) -> DataFrame:
    """Candidates with the features that need only themselves and the dictionary."""
    own = F.col("text")
    size = F.char_length(own)
    count = lambda p: F.regexp_count(own, F.lit(p))
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(own, "[0-9]+", "0"), "[a-z]+", "a"), "[A-Z]+", "A"), "[^0aA]+", "-")
    # transitions of ordinary words: 26 x 26 letters at most
    pairs = words.select(F.explode(_bigrams(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    first = Window.partitionBy(F.left("pair", F.lit(1)))
    law = cut(pairs.select(F.col("pair").alias("p"), F.log((F.col("n") + 1) / (F.sum("n").over(first) + 38)).alias("log")))
    steps = found.select("id", F.explode(_bigrams(_letters(own))).alias("pair")).join(F.broadcast(law), F.col("pair") == F.col("p"), "left") \
        .groupBy("id").agg(F.avg(F.coalesce("log", F.lit(RARE))).alias("transitions")).withColumnRenamed("id", "i")
    runs = found.select("id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,20}"), F.lit(0))).alias("run"))
    known = runs.join(words, runs["run"] == words["word"]).groupBy("id").agg(F.sum(F.char_length("run")).alias("known")).withColumnRenamed("id", "j")
    out = found.join(steps, F.col("id") == F.col("i"), "left").join(known, F.col("id") == F.col("j"), "left")
    return out.select(*found.columns, size.cast("double").alias("length"), F.coalesce("transitions", F.lit(RARE)).alias("transitions"),
                      (F.coalesce("known", F.lit(0)) / size).alias("coverage"), (F.char_length(classes) / size).alias("changes"),
                      (count("[0-9]") / size).alias("digits"), (count("[A-Z]") / size).alias("upper"), count(r"[/.:]").cast("double").alias("marks"),
                      F.contains(own, F.lit("@")).cast("double").alias("address"), F.col("before").rlike("[\"']$").cast("double").alias("quoted"))


def _rate(known: DataFrame, word: str, overall: float) -> DataFrame:
    sums = known.groupBy(word).agg(F.count("*").alias("n"), F.sum("label").alias("s"))
    return cut(sums.select(F.col(word).alias("w_" + word), ((F.col("s") + PRIOR * overall) / (F.col("n") + PRIOR)).alias(word + "_rate")))


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, start, n_chars, sha256, label, probability, secret)``, a row for each candidate.

    ``label`` is true or false where the candidate is labelled, ``probability``
    the forest's; ``secret`` is its verdict. Without labels nothing is a secret,
    with labels of one kind everything is of that kind; the sample has both kinds and distinct texts. NULL and empty texts
    have no candidates; the secret itself isn't returned.
    """
    docs = docs.where("text is not null")
    found = written(candidates(docs), "secret-candidates")
    own = measured(found, cut(dictionary(docs)))
    label = F.when(F.col("before").rlike(ASSIGNED), F.lit(1.0)).when(F.col("text").rlike(NOT_SECRET), F.lit(0.0))
    own = written(own.withColumns({"label": label, "before": F.lower(F.regexp_extract("before", r"([\p{L}_]+)[^\p{L}]*$", 1)),
                                   "after": F.lower(F.regexp_extract("after", r"^[^\p{L}]*([\p{L}_]+)", 1))}), "secret-features")
    known = own.where("label is not null")
    overall = known.agg(F.avg("label")).first()[0] or 0.0
    if 0 < overall < 1:
        before, after = _rate(known, "before", overall), _rate(known, "after", overall)
        full = own.join(before, own["before"] == before["w_before"], "left").join(after, own["after"] == after["w_after"], "left") \
            .fillna(overall, ["before_rate", "after_rate"])
        gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
        rows = gather.transform(full)
        # one row a text and label, so that copies cannot fill the sample
        keys = known.groupBy(F.col("text").alias("key"), "label").agg(F.min("id").alias("first"))
        chosen = F.broadcast(bounded_sample(keys, sample).select("first"))            # 1.1 x sample rows at most
        fitted = rows.join(chosen, F.col("id") == F.col("first"), "left_semi").orderBy(F.xxhash64("text"), "id").select("features", "label")
        # written and read: a fitted model keeps its session in a summary, which cannot always be sent to tasks
        path = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/secret-forest-{uuid.uuid4().hex}"
        RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=42).fit(fitted).save(path)
        model = RandomForestClassificationModel.load(path)
        judged = model.transform(rows).withColumn("p", vector_to_array("probability")[1])
    else:
        judged = own.withColumn("p", F.lit(float(overall)))
    return judged.select("doc_id", "start", F.char_length("text").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
                         (F.col("label") == 1).alias("label"), F.col("p").alias("probability"), (F.col("p") >= 0.5).alias("secret"))


def op5(spark, sf_dir: str) -> DataFrame:
    """Every candidate of every document, judged."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
