"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of a bounded sample
of its learning texts. A text is encoded, in blocks of its whole length, with
every dictionary; the language with the smallest total wins. Narrow margins
are rejected.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import table

DICT_BYTES = 128 << 10      # of a language's dictionary
SAMPLE_ROWS = 400           # of learning texts of a language that may enter its dictionary
BLOCK = 8 << 10             # characters encoded at once
LEVEL = 9
FULL_MARGIN = 0.10          # share of the second best size that counts as a score of 1
MIN_SCORE = 0.2             # below it the language is rejected; figures in the README
LANGUAGES = 256             # whose dictionaries a task holds ready at once; more are taken block by block
UNKNOWN = "und"
NO_LETTER = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    """Lower-case words between single spaces, without digits and marks."""
    return f" {NO_LETTER.sub(' ', text.lower())} "


def learn(texts: DataFrame) -> dict[str, bytes]:
    """``texts(lang, text)`` to one dictionary a language, that of most texts first.

    Copies count once. The texts come from hashing: a fraction of each
    language's texts that leaves about SAMPLE_ROWS of them, in hash order until
    DICT_BYTES are full. The driver gets at most DICT_BYTES a language. NULL
    languages and texts without letters teach nothing.
    """
    rows = texts.where("lang is not null and text is not null").where(F.regexp_like("text", F.lit(r"\p{L}")))
    rows = rows.withColumn("h", F.xxhash64("text"))
    counts = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).withColumnRenamed("lang", "l")
    drawn = rows.join(F.broadcast(counts), F.col("lang") == F.col("l")) \
        .where(F.pmod("h", F.lit(1 << 31)) / float(1 << 31) <= SAMPLE_ROWS / F.col("n")) \
        .select("lang", "n", "h", F.substring("text", 1, DICT_BYTES).alias("text")).distinct()
    order = Window.partitionBy("lang").orderBy("h", "text")
    kept = drawn.withColumn("before", F.sum(F.octet_length("text")).over(order) - F.octet_length("text")) \
        .where(F.col("before") < DICT_BYTES).groupBy("lang", "n").agg(F.array_sort(F.collect_list(F.struct("before", "text"))).alias("all")) \
        .select("lang", "n", F.substring(F.array_join(F.transform("all", lambda x: x["text"]), "\n"), 1, DICT_BYTES).alias("text"))
    found = sorted(kept.collect(), key=lambda r: (-r["n"], r["lang"]))
    return {r["lang"]: plain(r["text"]).encode()[:DICT_BYTES] for r in found}


def classify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1, the margin to the second best) and ``rejected``.

    A NULL text or one without letters is ``und`` with score 0, as is every text
    if no language was learned; ``rejected`` holds for these and for scores
    under MIN_SCORE. Columns of those names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)
    from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("rejected", BooleanType())])

    def encode(batches):
        import zstandard
        names = list(shared.value)         # ties go to the language of more texts

        def coders(at):
            out = []
            for n in names[at:at + LANGUAGES]:
                d = zstandard.ZstdCompressionDict(shared.value[n], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False))
            return out
        first = coders(0)
        alone = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]

        def sizes(t, some):
            t = plain(t)
            blocks = [t[i:i + BLOCK].encode() for i in range(0, len(t), BLOCK)]
            return [sum(len(c.compress(b)) for b in blocks) for c in some]

        def judge(t, two):
            if not two:
                return UNKNOWN, 0.0
            size, best = two[0]
            second = max(1, two[1][0] if len(two) > 1 else sizes(t.as_py(), alone)[0])
            return names[best], min(1.0, max(0, second - size) / second / FULL_MARGIN)

        for batch in batches:
            found = [[] for _ in range(batch.num_rows)]     # the two smallest (size, language) of each text, decoded one at a time
            for at in range(0, len(names), LANGUAGES):
                some = coders(at) if at else first
                for t, two in zip((x.as_py() for x in batch.column(text)), found):
                    if t is not None and any(map(str.isalpha, t)):
                        two[:] = sorted([*two, *zip(sizes(t, some), range(at, at + len(some)))])[:2]
            out = [judge(t, two) for t, two in zip(batch.column(text), found)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()),
                                              pa.array([o[0] == UNKNOWN or o[1] < MIN_SCORE for o in out], pa.bool_())],
                                             names=[*batch.schema.names, "lang_pred", "score", "rejected"])
    return docs.mapInArrow(encode, schema)


def recognized(docs: DataFrame) -> DataFrame:
    """The rows of ``docs(text, lang, ...)`` whose language is not rejected, learned from its own ``lang``; all if none was learned."""
    known = learn(docs.select("lang", "text"))
    if not known:
        return docs
    plain_ = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])       # no name of the table can clash
    rows = classify(plain_, known, f"c{docs.columns.index('text')}").where("not rejected")
    return rows.select(*plain_.columns).toDF(*docs.columns)


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the labelled ones.

    Documents without doc_id are predicted, but nothing is learned from them.
    """
    docs = table(spark, sf_dir, "documents")
    known = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()).select("lang", "text"))
    rows = classify(docs.select("doc_id", held_out().alias("held_out"), "text"), known)
    return rows.select("doc_id", "held_out", "lang_pred", "score", "rejected")
