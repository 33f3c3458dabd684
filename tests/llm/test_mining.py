"""Phrase mining, toxicity and hard negatives: plain versions, edge rows, held-out accuracy."""

import random
import re
import zlib
from collections import Counter, defaultdict

import helpers
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rosterline.llm import negatives, phrases, toxicity
from rosterline.llm import queries as Q
from rosterline.llm.wordspans import Hashes, chunks, codes, spans

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ word spans
def test_spans_and_hashes_are_those_of_the_texts():
    texts = ["", "ab cd", "", "cd", " x ", "ab" * 50, "é ü"]
    for size in (1, 6, 1000):
        seen = []
        for first, last, data, off in chunks(pa.array(texts).slice(0), size):
            word = data != 32
            start, end, doc, _ = spans(word, off)
            seen += [(first + d, bytes(data[s:e]).decode()) for s, e, d in zip(start, end, doc)]
            h = Hashes(data).of(start, end)
            assert len({(bytes(data[s:e]), int(x)) for s, e, x in zip(start, end, h)}) == len(set(h.tolist()))
        assert seen == [(i, w) for i, t in enumerate(texts) for w in t.split(" ") if w]
    ids, n = codes(np.array([5, 5, 7]))
    assert n == 2 and ids[0] == ids[1] != ids[2]
    part = pa.array(texts).slice(1, 3)
    assert [bytes(d).decode() for _, _, d, _ in chunks(part, 1)] == texts[1:4]


# ------------------------------------------------------------------ op11
def plain_collocations(docs, most=3, support=10, keep=2000, inside=50):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    rows = {}
    for (lang, w), a in f.items():
        if len(w) >= 2 and a >= support:
            rows[lang, w] = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
    dropped = set()
    for lang, w in rows:
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                if 100 * f[lang, w] >= inside * f[lang, w[i:i + m]]:
                    dropped.add((lang, w[i:i + m]))
    out = []
    for lang in n:
        kept = [(-s, -f[lang, w], " ".join(w).encode(), w, k) for (g, w), (s, k) in rows.items() if g == lang and (g, w) not in dropped]
        for rank, (s, a, text, w, k) in enumerate(sorted(kept)[:keep], start=1):
            out.append((lang, rank, text.decode(), -a, f[lang, w[:k]], f[lang, w[k:]], n[lang], -s))
    return sorted(out)


def phrase_docs(seed, n=80):
    rng = random.Random(seed)
    words = ["New", "york", "CITY", "a", "b", "c", "ä", "Ä", "x-y", " z", "…", "1", "é"]
    docs = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(rng.randrange(0, 60)))
        docs.append((text, rng.choice(["en", "en", "de", None])))
    docs += [(None, "en"), ("", None), ("new york city " * 400, "en"), ("." * 50, "de"), (" \t ", "fr"), ("w" * 30000 + " tail " + "w" * 30000, "de")]
    return docs + docs[:5] * 3


SCHEMA = "text string, lang string, n long, phrase string, size int, hash long, rank int"


def phrase_table(spark, docs):
    return spark.createDataFrame([(t, g, 1, "p", 2, 3, 4) for t, g in docs], SCHEMA).repartition(5)


def got_collocations(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("share, lowered, bits", [(0.25, 2, 1 << 26), (0.0, 2, 1 << 20), (1.0, 1, 1 << 12), (0.3, 50, 1 << 20)])
def test_collocations_do_not_depend_on_the_sample(spark, share, lowered, bits):
    """Also with an empty sample, one that proposes nothing, and a bit table so small that it lets nearly everything pass."""
    docs = phrase_docs(1)
    got = phrases.collocations(phrase_table(spark, docs), share=share, lowered=lowered, bits=bits)
    assert got_collocations(got) == plain_collocations(docs)


def test_expansion_closes_longer_phrases(spark):
    docs = phrase_docs(2, 40)
    got = phrases.collocations(phrase_table(spark, docs), most=5, support=6, keep=50, inside=70, share=0.1, lowered=3, bits=1 << 20)
    assert got_collocations(got) == plain_collocations(docs, 5, 6, 50, 70)
    _, expanded = phrases.frequent(phrase_table(spark, docs), share=0.0)
    assert expanded


def test_small_chunks_count_the_same(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 40)
    monkeypatch.setattr(phrases, "ROWS", 3)
    docs = phrase_docs(3, 30)
    words = Counter()
    for i, (text, lang) in enumerate(docs):
        for first, last, data, off in chunks(pa.array([text or ""]), 40):
            w = phrases.Words(data, off, [lang or "und"])
            if w.n:
                for b in phrases.texts_of(w, 1, [np.full(8, 255, np.uint8)]):
                    for r in b.to_pylist():
                        words[r["lang"], r["size"], r["phrase"]] += r["n"]
    want = Counter()
    for text, lang in docs:
        for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", (text or "").translate(LOWER)):
            want[lang or "und", 1, w] += 1
    assert {k: v for k, v in words.items() if k[1] == 1} == want


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000_000
    rows = [("en", 0, "", 10 * big), ("en", 1, "a", big + 7), ("en", 1, "b", big + 11), ("en", 2, "a b", big - 13)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, size int, phrase string, n bigint")).first()
    assert got.score == 1000000 * (big - 13) ** 2 // ((big + 7) * (big + 11))


# ------------------------------------------------------------------ op12
def toxic_corpus(n=1200, seed=4):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(("ta", "lo", "ri", "men", "sk")) for _ in range(rng.randrange(2, 5))) for _ in range(600)]
    bad = ["idiot", "grobian"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 9 == 0
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(10, 120))]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(("", "en", "s", "isch")))
        docs.append((i, " ".join(words).capitalize()))
        if i % 2:
            labels.append((i, rng.randrange(2), int(toxic)))
    return docs, labels


def toxic_tables(spark, path, docs, labels):
    return helpers.save(spark, path, [(i, t, "xa") for i, t in docs], labels=labels, clash=True)


def test_op12_learns_from_positives_and_unlabelled_texts(spark, tmp_path):
    docs, labels = toxic_corpus()
    odd = [(5000, None), (5001, ""), (None, "idiot idioten idiots idiotisch"), (5002, docs[0][1]), (5002, docs[0][1]), (5003, "w" * 100000 + " idiot " * 20000)]
    path = toxic_tables(spark, tmp_path, docs + odd, labels + [(None, 1, 1), (7, None, None), (9, 1, 5)])
    got = Q.queries()["op12_toxicity"](spark, path).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in docs + odd)
    by = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i, _ in docs if by[i].held_out]
    assert sum(by[i].predicted == (i % 9 == 0) for i in held) >= 0.97 * len(held)
    assert by[5000].score == by[5001].score and by[5000].predicted == 0
    assert by[None].predicted == by[5002].predicted == by[5003].predicted == 1


def test_op12_does_not_read_held_out_labels(spark, tmp_path):
    docs, labels = toxic_corpus(400)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    assert flipped != labels
    a, b = (toxic_tables(spark, tmp_path / n, docs, ls) for n, ls in (("a", labels), ("b", flipped)))
    score = lambda p: {r.doc_id: r.score for r in Q.queries()["op12_toxicity"](spark, p).collect()}
    assert score(a) == pytest.approx(score(b), abs=1e-12)


def test_copies_do_not_change_the_samples(spark):
    """One text copied more often than the samples are large leaves room for the others, and labels of one kind are no error."""
    docs, labels = toxic_corpus(600)
    schema = "doc_id bigint, text string"
    copies = [(10_000 + i, docs[0][1]) for i in range(3000)]
    marks = spark.createDataFrame([(i, t) for i, _, t in labels] + [(i, 1) for i, _ in copies], "doc_id bigint, toxic int")
    model = toxicity.learn(spark.createDataFrame(docs + copies, schema), marks, positives=200, unlabelled=400)
    got = {r.doc_id: r.predicted for r in toxicity.score(spark.createDataFrame(docs, schema), model).collect()}
    assert sum(got[i] == (i % 9 == 0) for i, _ in docs) >= 0.95 * len(docs)
    table = spark.createDataFrame(docs, schema)
    for kind in (0, 1):
        model = toxicity.learn(table, marks.where(F.col("toxic") == kind))
        rows = toxicity.score(table.limit(20), model).collect()
        assert all(0 <= r.score <= 1 for r in rows) and (kind or all(r.score == 0 and r.predicted == 0 for r in rows))


def test_training_corrects_a_negative_risk():
    """The estimator's parts against a plain evaluation, and the correction: the bracket must not run far below zero."""
    rng = np.random.default_rng(1)
    positive = [np.unique(rng.integers(0, 40, 8)) for _ in range(60)]
    unlabelled = [np.unique(rng.integers(20, 4000, 8)) for _ in range(200)] + positive[:20]
    w, bias = toxicity.train(positive, unlabelled, 0.1)
    g_p, g_u = (np.array([bias + w[x].sum() for x in xs]) for xs in (positive, unlabelled))
    rest = np.logaddexp(0, g_u).mean() - 0.1 * np.logaddexp(0, g_p).mean()
    assert rest > -0.2 and g_p.mean() > g_u.mean() + 1
    none, b = toxicity.train([], unlabelled, 0.1)
    assert not none.any() and b == pytest.approx(np.log(0.1 / 0.9))


def test_features_are_words_and_their_beginnings():
    def bag(text):
        return set(next(toxicity.present(pa.array([text]))).to_pylist()[0])
    assert bag("") == set() and bag("?? -- ..") == set()
    assert bag("Idiot idiot, IDIOT!") == bag("idiot") and len(bag("idiot")) == 2       # the word and its first four bytes
    assert len(bag("idiots") & bag("idiotic")) == 2
    assert bag("ab") != bag("ba")


# ------------------------------------------------------------------ op13
def plain_negatives(rows, anchor=100):
    ok = []
    for v, vec, label in rows:
        if v is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        ok.append((v, [int(np.floor(256 * float(np.float32(x)))) for x in vec], (label + 1) % 10 if v % 7 == 0 else label))
    out = []
    for i, (a, x, label) in enumerate(ok):
        if a % anchor:
            continue
        score = [sum(p * q for p, q in zip(x, y)) for _, y, _ in ok]
        order = sorted((j for j in range(len(ok)) if j != i), key=lambda j: (-score[j], ok[j][0]))
        for p in [j for j in order if ok[j][2] == label][:5]:
            fit = [j for j in order if ok[j][2] != label and 30 * score[p] <= 100 * score[j] <= 90 * score[p]][:10]
            out += [(a, ok[p][0], rank, ok[j][0], score[p], score[j]) for rank, j in enumerate(fit, start=1)]
    return Counter(out)


def vectors(seed, n=700, width=12, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.float32(rng.normal(0.2, scale, width))], int(rng.integers(0, 10))) for i in range(n)]


def odd_vectors():
    rows = vectors(1)
    rows += [rows[100], rows[7], (None, rows[3][1], 1), (901, None, 1), (902, [0.5, None] * 6, 2), (903, [float("nan")] * 12, 2), (904, [float("inf")] * 12, 3),
             (905, rows[5][1], None), (906, [], 4), (907, [0.1] * 3, 4), (1000, [0.0] * 12, 5), (1100, rows[200][1], rows[200][2])]
    return rows + [(2000 + i, rows[200][1], rows[200][2] + i % 2) for i in range(30)]        # ties


def test_op13(spark, tmp_path):
    rows = odd_vectors()
    path = helpers.save(spark, tmp_path, [], embeddings=rows, clash=True)
    got = Q.queries()["op13_negatives"](spark, path).collect()
    found = Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)
    assert found == plain_negatives(rows) and len(found) > 100


@pytest.mark.parametrize("anchors", [1, 3, 100])
def test_blocks_of_anchors_give_the_same(spark, monkeypatch, anchors):
    monkeypatch.setattr(negatives, "AT_ONCE", (2, 5))
    rows = vectors(2, 300, scale=3.0)
    table = spark.createDataFrame(rows, "vec_id bigint, vec array<float>, label int")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(table.withColumn("label", moved).repartition(4), F.col("vec_id") % 100 == 0, anchors).collect()
    assert Counter(tuple(r) for r in got) == plain_negatives(rows)


@pytest.mark.parametrize("largest, width", [(3, 5), (148, 64), (40_000, 200), (10_000_000, 700)])
def test_products_are_exact(largest, width):
    rng = np.random.default_rng(width)
    a, b = (rng.integers(-largest, largest + 1, (n, width)) for n in (9, 31))
    a[0], b[0], b[1] = largest, largest, -largest
    primes = negatives.primes_for(width * largest * largest)
    got = negatives.products([negatives.residues(a, p) for p in primes], [negatives.residues(b, p) for p in primes], primes)
    assert (got == a.astype(object) @ b.astype(object).T).all()
    assert all(np.abs(negatives.residues(a, p)).max() <= p // 2 for p in primes)


def test_scores_that_do_not_fit_are_an_error(spark):
    assert negatives.primes_for(0) and len(negatives.primes_for(negatives.SCORES)) == len(negatives.PRIMES)
    with pytest.raises(ValueError):
        negatives.primes_for(negatives.SCORES + 1)
    table = spark.createDataFrame([(0, [3e20], 1), (1, [1e20], 1)], "vec_id bigint, vec array<float>, label int")
    with pytest.raises(ValueError):
        negatives.mine(table, F.col("vec_id") == 0)


def test_best_keeps_the_first_of_all_that_was_offered():
    rng = random.Random(1)
    best, offers = negatives.Best(6, 4), defaultdict(list)
    for _ in range(30):
        some = [(rng.randrange(6), rng.randrange(20), rng.randrange(50), rng.randrange(10**6)) for _ in range(rng.randrange(8))]
        for s, score, vec, row in some:
            offers[s].append((-score, vec, row))
        best.offer(*(np.array([x[i] for x in some], np.int64) for i in range(4)))
    got = defaultdict(list)
    for s, score, vec, row in zip(best.slot, best.score, best.vec, best.row):
        got[s].append((-score, vec, row))
    assert got == {s: sorted(x)[:4] for s, x in offers.items()}
