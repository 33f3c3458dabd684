"""Corpus pipeline: ``documents`` to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; its result is written as Parquet and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from rosterline.llm import decontam, langid, lines, packing, simhash
from rosterline.llm.common import dropped, settled, table


def language(spark, docs, sf_dir):
    """Documents whose language is recognized; rejected ones (no letter, narrow margin) go."""
    return langid.recognized(docs)


def line_dedup(spark, docs, sf_dir):
    """Documents without the lines that repeat, nearly or exactly, an earlier line of the corpus; emptied ones go."""
    return lines.drop_lines(docs)


def near_dedup(spark, docs, sf_dir):
    """One document, the smallest doc_id, of every group of near copies by SimHash."""
    return simhash.one_of_each(docs)


def decontamination(spark, docs, sf_dir):
    """Documents into which no benchmark item leaks."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """Tokenized pieces of the documents with their places in packed sequences."""
    return packing.packed_documents(docs)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", pack)]

#: Compression, hashes and token ids can't be expressed in SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """All stages over ``documents``: one row a packed piece.

    A stage's own intermediate tables are removed when its result is written, and
    that result when the next one is; packing's tables stay, as its rows are read from them.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, settled(lambda: stage(spark, docs, sf_dir), f"pipeline-{name}")
        dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
