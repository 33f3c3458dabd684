"""The operators' own interfaces against plain versions, and their behaviour on hot groups."""

import random
from collections import Counter, defaultdict

import helpers
import pytest
from pyspark.sql import functions as F

from rosterline.llm import chat, common, decontam, langid, lines, packing, sharding, simhash, spotsigs
from rosterline.session import checkpoint_dir
from rosterline.sources.sinks import children


def test_components(spark):
    rng = random.Random(2)
    n = 400
    links = [(i, i + 1) for i in range(120)] + [(rng.randrange(150, n), rng.randrange(150, n)) for _ in range(180)] + [(5, 5)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = helpers.connected(n, links)
    touched = {i for a, b in links if a != b for i in (a, b)}
    assert got == {i: want[i] for i in touched}
    assert common.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_tables_of_finished_steps_are_removed(spark):
    folders = lambda: set(children(spark, checkpoint_dir(spark)))
    before = folders()
    chain = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    out = common.components(chain)
    assert out.where("component = 0").count() == 301
    assert len(folders() - before) == 1             # the links of the last round, which the result is read from

    before, kept = folders(), common.cut(spark.range(7).toDF("x"))

    def make():
        inner = common.settled(lambda: common.cut(kept.selectExpr("x + 1 AS x")), "inner")
        return common.cut(inner).where("x > 3")
    got = common.settled(make, "outer")
    assert {f.rsplit("-", 1)[0] for f in folders() - before} == {"state", "outer"}
    assert sorted(r.x for r in got.collect()) == [4, 5, 6, 7] and kept.count() == 7
    common.dropped(got)
    common.dropped(got)
    common.dropped(spark.range(1))
    assert {f.rsplit("-", 1)[0] for f in folders() - before} == {"state"}


def test_the_links_of_a_hub_are_split(spark, monkeypatch):
    """A star of 60,000 links: the joins of a round are skew joins."""
    plans, conf = [], {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
                       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.autoBroadcastJoinThreshold": "-1",
                       "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    cut = common.cut

    def seen(df):
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(common, "cut", seen)
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        star = spark.range(1, 60_001).selectExpr("id AS a", "0L AS b")
        assert common.components(star).where("component = 0").count() == 60_001
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("skew=true" in p for p in plans)


def test_hypergeometric_draws_follow_the_law(spark):
    from math import comb
    total, marked, drawn, n = 40, 13, 11, 20_000
    draw = sharding.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), sharding._uniform(F.col("id")))
    got = Counter(r.k for r in spark.range(n).select(draw.alias("k")).collect())
    chi = sum((got[k] - n * p) ** 2 / (n * p) for k in range(12)
              if (p := comb(marked, k) * comb(total - marked, drawn - k) / comb(total, drawn)) * n > 5)
    assert sum(got.values()) == n and chi < 30


def test_matrix_has_exact_margins(spark):
    rng = random.Random(1)
    sizes = {p: rng.randrange(0, 200) for p in range(0, 64) if p % 5}
    m = sharding.matrix(spark.createDataFrame(list(sizes.items()), "part int, n bigint"), 64, 7, 3).collect()
    assert {r.part: sum(r.sends) for r in m} == {p: sizes.get(p, 0) for p in range(64)}
    columns = [sum(r.sends[s] for r in m) for s in range(7)]
    assert max(columns) - min(columns) <= 1 and all(x >= 0 for r in m for x in r.sends)


def test_matrix_of_many_partitions(spark):
    sizes = spark.range(4096).selectExpr("cast(id AS int) AS part", "id % 5 AS n").where("part % 7 <> 0")
    m = sharding.matrix(sizes, 4096, 3, 3).collect()
    assert {r.part: sum(r.sends) for r in m} == {p: p % 5 * (p % 7 > 0) for p in range(4096)}
    columns = [sum(r.sends[s] for r in m) for s in range(3)]
    assert max(columns) - min(columns) <= 1 and all(x >= 0 for r in m for x in r.sends)
    assert len(sharding.matrix(sizes.limit(0), 64, 3, 3).where("aggregate(sends, 0L, (a, x) -> a + x) = 0").collect()) == 64


def test_shards_keep_all_columns_and_hot_rows(spark):
    df = spark.range(3000).select((F.col("id") % 3 * F.col("id")).alias("k"), F.lit("x").alias("shard"), F.lit(1).alias("part"), F.lit(None).cast("string").alias("at"))
    out = sharding.shard(df, 5, "k")
    assert out.columns == ["k", "part", "at", "shard", "slot"]
    sizes = {r.shard: (r.n, r.m) for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("m")).collect()}
    assert sizes == {s: (600, 600) for s in range(5)}
    assert sorted(r.k for r in out.collect()) == sorted(r.k for r in df.collect())


def test_reply_tree_branches_are_ranked(spark):
    # 1 -> 2 -> 4; 2 -> 5; 1 -> 3; 9 has an unknown parent; 20 <-> 21 is a cycle
    rows = [(7, 1, None, 1.0), (7, 2, 1, 5.0), (7, 3, 1, 2.0), (7, 4, 2, 0.0), (7, 5, 2, 9.0), (7, 9, 8, None), (7, 20, 21, 1.0), (7, 21, 20, 1.0),
            (None, 1, None, 0.0)]
    m = spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, score double")
    found = defaultdict(list)
    for r in sorted(chat.paths(m, top=9).collect(), key=lambda r: r.turn):
        found[r.tree, r.branch].append(r.node)
    assert found == {(7, 1): [1, 2, 5], (7, 2): [1, 2, 4], (7, 3): [1, 3], (7, 4): [9], (None, 1): [1]}
    assert chat.paths(m, top=1).where("tree = 7").count() == 3
    assert chat.paths(m).select("tree", "leaf").distinct().count() == 5


def test_chat_round_trip(spark):
    rng = random.Random(4)
    pieces = ["<", "[", "&", "&lt;", "&amp;", "[INST]", "</s>", "<s>", "x", "\n", "ü", "\U0001F600", "&lsqb;", "\\"]
    rows = [(t, 0, i, "".join(rng.choices(pieces, k=rng.randrange(0, 4))), "".join(rng.choices(pieces, k=rng.randrange(0, 12))))
            for t in range(40) for i in range(rng.randrange(1, 6))]
    out = chat.read_back(chat.formatted(spark.createDataFrame(rows, "tree bigint, leaf bigint, turn bigint, role string, text string"), rows[0][3]))
    want, learned = defaultdict(list), defaultdict(str)
    for t, _, _, role, text in rows:
        want[t].append((role, text))
        learned[t] += text if role == rows[0][3] else ""
    got = out.collect()
    assert {r.tree: [tuple(x) for x in r.turns] for r in got} == want
    assert {r.tree: r.learned for r in got} == {t: learned[t] for t in want}


def test_spotsigs_pairs_equal_brute_force(spark):
    rng = random.Random(8)
    vocabulary = list(spotsigs.ANCHORS[:12]) + [f"w{i}" for i in range(60)]
    texts = [helpers.words(rng, rng.randrange(20, 60), vocabulary) for _ in range(40)]
    for i in range(40):
        w = texts[i].split()
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [texts[0], "", ""]
    members, pairs = spotsigs.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    prints = {r.doc_id: Counter(r.p.split()) for r in spotsigs.fingerprint(
        spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "text", "p").collect()}
    classes = {r.doc_id: r.class_id for r in members.collect()}
    assert classes == {i: min(j for j in prints if prints[j] == prints[i]) for i in prints}
    reps = sorted(set(classes.values()))
    want = {(a, b) for a in reps for b in reps if a != b and sum((prints[a] | prints[b]).values())
            and sum((prints[a] & prints[b]).values()) >= 0.8 * sum((prints[a] | prints[b]).values()) - 1e-9}
    got = {(r.a, r.b) for r in pairs.collect()}
    assert {frozenset(x) for x in got} == {frozenset(x) for x in want} and want


def test_best_fit_is_best_fit():
    rng = random.Random(3)
    lengths = [rng.randrange(1, 101) for _ in range(600)]
    got, still = packing.best_fit(lengths, 100, 8)
    free, offsets = [], []
    for n in lengths:                   # the plain version looks at every open bin
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
        elif len(free) == 8:
            free.remove(min(free))
        room = min(fits, default=100)
        offsets.append(100 - room)
        free += [room - n] * (room > n)
    assert [o for _, o in got] == offsets and len(still) == len(free)
    left = {b: 100 - o - n for (b, o), n in zip(got, lengths)}
    assert sorted(left[b] for b in still) == sorted(free)


def test_packing_rounds_and_real_sequences(spark, monkeypatch):
    from tokenizers import Tokenizer
    rng = random.Random(5)
    texts = [helpers.words(rng, rng.randrange(0, 120), ["alpha", "Beta", "gamma.", "x,y", "Δέλτα", "<|endoftext|>"]) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, None)], "doc_id bigint, text string")
    path = packing.vocabulary()
    rows = packing.pack(packing.pieces(docs, path, 256, ids=True), 256, 4, 40)
    coder = Tokenizer.from_file(path)
    want = Counter(tuple(coder.encode(t, add_special_tokens=False).ids + [1]) for t in texts + [""])
    seqs = packing.sequences(rows).collect()
    assert all(r.n_ids <= 256 and len(r.ids) == 4 * r.n_ids for r in seqs)
    whole = defaultdict(bytes)
    for r in sorted(rows.collect(), key=lambda r: r.start):
        whole[r.doc_id] += next(s.ids for s in seqs if s.sequence_id == r.sequence_id)[4 * r.offset:4 * (r.offset + r.length)]
    import numpy as np
    assert Counter(tuple(np.frombuffer(b, "<u4").tolist()) for b in whole.values()) == want
    assert len(seqs) <= 1.1 * sum(r.n_ids for r in seqs) / 256 + 1


def test_leaks_are_found_within_the_budget():
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    items = [(i, helpers.words(rng, rng.randrange(12, 60), vocabulary)) for i in range(30)]
    index = decontam.Index(items)
    for trial in range(150):
        item, text = rng.choice(items)
        w = min(len(text), decontam.WINDOW)
        s = rng.randrange(len(text) - w + 1)
        part = list(text[s:s + w])
        for _ in range(rng.randrange(int(w * decontam.EDIT_RATE) + 1)):
            p = rng.randrange(1, len(part) - 1)
            part[p:p + 1] = rng.choice([[], ["q"], [part[p], "q"]])
        host = helpers.words(rng, 200, vocabulary[:200])
        at = rng.randrange(len(host))
        found = index.leaks([host, host[:at] + " " + "".join(part) + " " + host[at:]])
        assert (1, item) in {(d, index.texts[i][0]) for d, i, _, _ in found}
        assert 0 not in {d for d, _, _, _ in found}


def test_no_leak_beyond_the_budget():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(50)]
    item = helpers.words(rng, 10, vocabulary)[:60]
    text = "".join("q" if i % 9 == 4 else c for i, c in enumerate(item))       # 7 edits in 60 characters
    assert decontam.Index([(0, item)]).leaks([text]) == []


def test_leaks_equal_brute_force(monkeypatch):
    """Fewest edits of every pair, on texts of few characters and repetitive ones; the same where runs are worked off in halves."""
    rng = random.Random(3)

    def plain(item, text):
        w = min(len(item), decontam.WINDOW)
        e = int(w * decontam.EDIT_RATE)
        return min((decontam.banded(item[s:s + w], text[max(0, at - e):at + w + 2 * e + 1], e)
                    for s in range(len(item) - w + 1) for at in range(len(text))), default=e + 1), e
    for trial in range(24):
        alphabet = ("ab ", "abcdefgh ")[trial % 2]
        items = []
        for i in range(3):
            unit = "".join(rng.choice(alphabet) for _ in range(rng.choice((2, 3, 7)) if trial % 3 == 0 else 80))
            items.append((i, decontam.words((unit * 60)[:rng.choice((12, 25, 61, 70))])))
        text = ""
        for _ in range(3):
            part = list(rng.choice(items)[1])
            for _ in range(rng.randrange(5) if part else 0):
                p = rng.randrange(len(part))
                part[p:p + 1] = rng.choice(([], [rng.choice(alphabet)], [part[p], rng.choice(alphabet)])) if len(part) > 1 else part
            text += "".join(rng.choice(alphabet) for _ in range(rng.randrange(20))) + "".join(part)
        text = decontam.words(text)
        want = {i: n for i, t in items if len(t) >= decontam.Q for n, e in [plain(t, text)] if n <= e}
        for most in (1 << 21, 8):
            monkeypatch.setattr(decontam, "RUNS", most)
            index = decontam.Index(items)
            assert {index.texts[i][0]: e for d, i, e, _ in index.leaks(["q" * 9, text]) if d == 1} == want


def test_repetitive_texts_have_few_runs():
    """3 * 10^8 hits of a text of 200,000 characters on an item of 4,200 are 70,000 runs."""
    index = decontam.Index([(0, "na " * 1400 + "na"), (1, "na no " * 700 + "na")])
    text = "na " * 70_000 + "na"
    assert sum(len(r[1]) for r in index.runs(index.codes(text))) < 75_000
    assert index.leaks(["x " + text, ""]) == [(0, 0, 0, 1)]         # the blank is within the item as well


def test_short_items_leak_as_whole_words(spark):
    docs = spark.createDataFrame([(1, "say: yes, YES!"), (2, "yesterday"), (3, "is it 4 2 now"), (4, None), (5, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(0, "Yes"), (1, "4-2"), (2, ""), (3, None), (4, "yes")], "item_id bigint, text string")
    assert sorted(map(tuple, decontam.leaks(docs, items).collect())) == [(1, 0, 0, 4), (1, 4, 0, 4), (3, 1, 0, 6)]
    assert decontam.clean(docs, items).count() == 5


@pytest.mark.parametrize("listed", [1 << 17, 16])
def test_line_links_with_hot_keys(spark, listed):
    rng = random.Random(5)
    base = helpers.words(rng, 14, ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30)])
    texts = {f"This is line number {i:04d} of a long listing with many such lines." for i in range(60)}
    for _ in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            p = rng.randrange(len(w))
            w[p:p + 1] = rng.choice([["z"], [], [w[p], "z"]])
        texts.add("".join(w))
    texts = sorted(texts | {"".join(rng.choice("ab") for _ in range(33)) for _ in range(60)})
    want = [(i, j) for j in range(len(texts)) for i in range(j) if abs(len(texts[i]) - len(texts[j])) <= 2
            and helpers.distance(texts[i], texts[j]) <= lines.threshold(min(len(texts[i]), len(texts[j])))]
    got = {(min(r), max(r)) for r in lines.links(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), listed).collect()}
    assert got <= set(want) and helpers.connected(len(texts), got) == helpers.connected(len(texts), want)


def test_edit_distance():
    rng = random.Random(9)
    for _ in range(4000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 12)))
        for most in (0, 1, 2, 3):
            assert lines.edits(a, b, most) == min(helpers.distance(a, b), most + 1)


def test_simhash_of_many_copies(spark):
    rng = random.Random(1)
    text = helpers.words(rng, 300, [f"w{i}" for i in range(200)])
    docs = [(i, text) for i in range(500)] + [(1000 + i, text + f" end{i}") for i in range(200)] + [(5000, None), (4000, " \t\n"), (None, text)]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert all(got[i] == 0 for i in range(500)) and got[5000] == got[4000] == 4000 and got[None] == 0


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc", None, 5), (2, None, None, 5)], "doc_id bigint, text string, lang string, score int")
    assert langid.recognized(docs).count() == 2
    out = langid.classify(docs, {}).collect()
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in out)


def test_copies_do_not_empty_a_dictionary(spark):
    rng = random.Random(2)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    docs = [(i, helpers.words(rng, 8, vocabulary), "xa") for i in range(300)]
    docs += [(1000 + i, helpers.words(rng, 8, ["und", "der", "zu", "ist"]), "xb") for i in range(5)]
    plenty = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    hot = spark.createDataFrame([(1, "one text of many many copies", "xa")], plenty.schema)
    one = langid.learn(plenty.union(hot))
    assert langid.learn(plenty.union(hot.crossJoin(spark.range(200_000)).drop("id"))) == one
    assert list(one) == ["xa", "xb"] and one["xa"].count(b"\n") + one["xa"].count(b" ") > 300 * 8


def test_languages_beyond_one_block(spark, monkeypatch):
    rng = random.Random(8)
    docs = []
    for i in range(7):
        vocabulary = ["".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(40)]
        docs += [(100 * i + j, helpers.words(rng, 30, vocabulary), f"x{i}") for j in range(20 - i)]
    df = spark.createDataFrame([*docs, (None, None, None), (7, "", "x1")], "doc_id bigint, text string, lang string")
    whole = sorted(map(tuple, langid.classify(df, langid.learn(df)).collect()), key=repr)
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    known = langid.learn(df)
    assert list(known) == [f"x{i}" for i in range(7)]
    assert sorted(map(tuple, langid.classify(df, known).collect()), key=repr) == whole
    assert all(r[2] == r[3] and not r[5] for r in whole if r[1])


def test_gibberish_and_unlearned_languages_are_rejected(spark):
    rng = random.Random(6)

    def language():
        parts = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 4))) for _ in range(12)]
        return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(400)]
    spoken = [language() for _ in range(4)]
    docs = [(f"x{i}", helpers.words(rng, 150, v)) for i, v in enumerate(spoken) for _ in range(100)]
    known = langid.learn(spark.createDataFrame(docs, "lang string, text string"))
    new = [(f"x{i}", helpers.words(rng, 60, v)) for i, v in enumerate(spoken) for _ in range(25)]
    new += [("gibberish", " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(150)))
            for _ in range(100)]
    new += [("unlearned", helpers.words(rng, 150, v)) for v in [language() for _ in range(20)] for _ in range(5)]
    out = langid.classify(spark.createDataFrame(new, "lang string, text string"), known).collect()
    assert all(r.lang_pred == r.lang and not r.rejected for r in out if r.lang[0] == "x")
    for kind in ("gibberish", "unlearned"):
        assert sum(r.rejected for r in out if r.lang == kind) > 85, kind


@pytest.mark.parametrize("listed", [1 << 17, 100])
def test_probes_of_short_remains_meet_every_held_line(spark, listed):
    letters = "ABCDEFGHIJKLMNOPQRST"
    left, right = "the first third of this line, then ", " and so it goes to the end of it."
    codes = sorted({a + b for a in letters for b in letters} | {"XY", "XYZ", "zXY", "VW", "qVWr", "KLqrs", "uvw"})
    texts = [left + c + right for c in codes]
    assert all(lines.threshold(len(t)) == 2 for t in texts)
    want = [(i, j) for j in range(len(texts)) for i in range(j) if helpers.distance(codes[i], codes[j]) <= 2]
    got = {(min(r), max(r)) for r in lines.links(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), listed).collect()}
    assert got <= set(want) and helpers.connected(len(texts), got) == helpers.connected(len(texts), want)


def test_short_pieces_take_few_rounds(spark, monkeypatch):
    """Pieces so short that a group of the usual size fills fewer bins than may stay open."""
    from rosterline.llm import packing
    rounds = []
    real = packing.written
    monkeypatch.setattr(packing, "written", lambda df, what: rounds.append(what) or real(df, what))
    rows = spark.range(100_000).select("id", F.lit(5).alias("length"))
    out = packing.pack(rows, limit=1024, most=64, rows_per_group=500).cache()
    assert out.count() == 100_000 and rounds.count("packed") <= 6
    bins = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("c"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert bins.where("n > 1024 or end <> n").count() == 0
    assert bins.count() <= 1.01 * 100_000 * 5 / 1020 + 1


def test_rows_of_one_doc_id_with_unequal_texts_are_documents_of_their_own(spark):
    """None of them goes because of another row's lines or text; equal ones are one document."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    texts = [helpers.words(rng, 60, vocabulary) + "\n" + helpers.words(rng, 20, vocabulary) for _ in range(4)]
    repeated = texts[3].split("\n")[0]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[2]), (5, texts[2]), (9, texts[3]), (5, repeated + "\n" + helpers.words(rng, 20, vocabulary))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()]
    assert sorted(kept) == sorted(set(rows))
    got = Counter((r.doc_id, r.text) for r in lines.drop_lines(docs).collect())
    want = Counter(rows) - Counter([rows[4]]) + Counter([(9, texts[3].split("\n")[1])])
    assert got == want


def test_fitting_samples_have_both_labels_and_distinct_values(spark):
    """One address and one URL copied far more often than the samples are large."""
    from rosterline.llm import secrets, urls
    rng = random.Random(5)
    key = lambda: "".join(rng.choice("abcdefABCDEF0123456789") for _ in range(30))
    docs = [(i, f"see token = {key()} and mail user{i}@example.org for 12{i:05d}7890123 now") for i in range(60)]
    docs += [(1000 + i, "write to the.same.person99@example.com today") for i in range(2000)]
    found = secrets.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), sample=30).collect()
    assert sum(bool(r.label) for r in found) >= 60 and all(0 <= r.probability <= 1 for r in found)
    pages = [(i, f"http://{w}.{t}/{p}/{i}") for i in range(40) for w, t, p in (("aa", "com", "x"), ("bb", "net", "es"), ("cc", "org", "y"))]
    few = urls.judge(spark.createDataFrame(pages, "page_id bigint, url string"), sample=30).collect()
    many = urls.judge(spark.createDataFrame(pages + [(10_000 + i, "http://bb.net/fr/hot") for i in range(3000)], "page_id bigint, url string"), sample=30)
    verdict = lambda rows: {r.page_id: r.verdict for r in rows if r.page_id < 10_000 and r.rule}
    assert verdict(few) == verdict(many.collect())
    for one in ("http://aa.com/x", "http://bb.net/es/"):
        rows = urls.judge(spark.createDataFrame([(1, one), (2, "http://q.org/")], "page_id bigint, url string")).collect()
        assert len({r.verdict for r in rows}) == 1
