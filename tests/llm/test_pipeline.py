"""The pipeline against plain versions of its stages, on odd rows and on empty tables."""

from collections import Counter

import corpus_pipeline
import helpers
import pytest
from test_queries import gapless

from rosterline.llm import decontam, langid, lines
from rosterline.llm.common import table
from rosterline.session import checkpoint_dir
from rosterline.sources.sinks import children

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def counted(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_stages(spark, tables):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = table(spark, tables, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        PLAIN[name](counted(docs), out, spark, tables)
        path = f"{tables}/../stage-{name}.parquet"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    assert gapless(docs.collect())
    before = set(children(spark, checkpoint_dir(spark)))
    got = corpus_pipeline.run(spark, tables)
    left = {f.rsplit("-", 1)[0] for f in set(children(spark, checkpoint_dir(spark))) - before}
    assert {f for f in left if f.startswith("pipeline")} == {"pipeline-decontamination"}
    assert not any(f.startswith(("line", "simhash")) for f in left)
    key = lambda r: (r.doc_id is None, r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, got.collect()), key=repr) == sorted(map(key, docs.collect()), key=repr)


def language(before, out, spark, tables):
    kept = counted(out)
    assert not kept - before
    known = langid.learn(table(spark, tables, "documents").select("lang", "text"))
    gone = before - kept
    again = spark.createDataFrame([(r[1],) for r in gone], "text string")
    assert again.isEmpty() or langid.classify(again, known).where("not rejected").isEmpty()
    # prose stays, texts without letters go
    assert all(any(map(str.isalpha, r[1] or "")) for r in kept) and all(len(r[1] or "") < 100 for r in gone)


def line_dedup(before, out, spark, tables):
    rows = sorted(before, key=lambda r: (r[0] is None, r[0] or 0))
    texts = {t for r in rows if r[0] is not None for t in (r[1] or "").split("\n")}
    short = sorted(t for t in texts if len(t) < 3000)
    links = [(i, j) for j in range(len(short)) for i in range(j) if abs(len(short[i]) - len(short[j])) <= 2
             and (m := lines.threshold(min(len(short[i]), len(short[j])))) and helpers.distance(short[i], short[j]) <= m]
    group = dict(zip(short, helpers.connected(len(short), links)))
    first, want = {}, Counter()
    for r in rows:
        if r[0] is None:
            want[r] += before[r]
            continue
        all_ = (r[1] or "").split("\n")
        kept = [t for n, t in enumerate(all_) if len(t) < lines.LEAST or first.setdefault(group.get(t, t), (r[0], n)) == (r[0], n)]
        if kept == all_:
            want[r] += before[r]
        elif any(t.strip() for t in kept):
            want[(r[0], "\n".join(kept), *r[2:4], len("\n".join(kept)))] += before[r]
    assert counted(out) == want


def near_dedup(before, out, spark, tables):
    from xxhash import xxh64_intdigest
    rows = sorted({r for r in before if r[0] is not None})

    def print_(text):
        w = (text or "").encode().lower().split()
        h = [xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else [0]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    prints = [print_(r[1]) for r in rows]
    group = helpers.connected(len(rows), [(i, j) for j in range(len(rows)) for i in range(j) if (prints[i] ^ prints[j]).bit_count() <= 2])
    want = Counter({r: 1 for i, r in enumerate(rows) if group[i] == i}) + Counter({r: n for r, n in before.items() if r[0] is None})
    assert counted(out) == want


def decontamination(before, out, spark, tables):
    bench = [decontam.words(r.text) for r in table(spark, tables, "benchmark").collect()]
    w = [(t, min(len(t), decontam.WINDOW)) for t in bench if len(t) >= decontam.Q]
    leaked = {r for r in before if any(t[s:s + n] in decontam.words(r[1]) for t, n in w for s in range(len(t) - n + 1))}
    assert counted(out) == Counter({r: n for r, n in before.items() if r not in leaked}) and leaked


def packing(before, out, spark, tables):
    assert {r.doc_id for r in out.collect()} == {r[0] for r in before}


PLAIN = {f.__name__: f for f in (language, line_dedup, near_dedup, decontamination, packing)}


def test_empty(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_extra_columns_stay(spark, tables, stage):
    docs = table(spark, tables, "documents")
    assert set(helpers.CLASHES) - {"print"} <= set(docs.columns) | {"print"}
    assert stage[1](spark, docs, tables).columns == docs.columns
