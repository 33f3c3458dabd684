"""Every query on odd rows, on empty tables, and against plain versions."""

import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import helpers
import pytest

from rosterline.llm import queries as Q


def rows(spark, key, path):
    return Q.queries()[key](spark, path).collect()


def documents(spark, path):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("key", list(Q.queries()))
def test_empty_tables(spark, nothing, key):
    got = rows(spark, key, nothing)
    assert len(got) == (1 if key == "op10_chat" else 0)     # op10 adds conversation -7


@pytest.mark.parametrize("key", list(Q.oracle_sql()))
def test_sql(spark, sf_small, key):
    import oracle_harness
    ok, message = oracle_harness.compare(spark, key, Q.queries()[key], Q.oracle_sql()[key], sf_small)
    assert ok, message


def test_op1(spark, tables):
    import numpy as np
    from tokenizers import Tokenizer

    from rosterline.llm import packing
    coder = Tokenizer.from_file(packing.vocabulary())
    want = Counter()
    for key, text in documents(spark, tables):
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 4096):
            part = ids[at:at + 4096]
            want[key, at // 4096, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = rows(spark, "op1_packing", tables)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert gapless(got) <= -(-sum(r.length for r in got) // 4096) + 1


def gapless(got):
    placed = defaultdict(list)
    for r in got:
        placed[r.sequence_id].append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(placed)


def test_op2(spark, tables):
    from rosterline.llm.decontam import EDIT_RATE, Q as GRAM, WINDOW, words
    bench = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    want = set()
    for key, text in documents(spark, tables):
        text = words(text)
        for item, t in bench:
            w = min(len(t), WINDOW)
            if w >= GRAM and any(t[s:s + w] in text for s in range(len(t) - w + 1)):
                want.add((key, item))
    assert EDIT_RATE * WINDOW >= 1
    assert {(r.doc_id, r.item_id) for r in rows(spark, "op2_decontam", tables)} == want == {(7, 0)}


def test_op3(spark, tables):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    urls = [(r.page_id, r.url) for r in spark.read.parquet(f"{tables}/pages.parquet").collect()]
    want = Counter()
    for key, url in urls:
        rest = (url or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [k for k in rules if (host == k[:k.index("/")] or host.endswith("." + k[:k.index("/")])) and path.startswith(k[k.index("/"):])]
        rule = max(fits, key=len, default=None)
        want[key, host, path, rule, rules.get(rule)] += 1
    got = rows(spark, "op3_urls", tables)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got) == want
    assert {r.verdict for r in got} <= {"allow", "block"}


def test_op4(spark, tables):
    docs = [(k, t or "") for k, t in documents(spark, tables)]
    docs.sort(key=lambda d: (d[0] is None, -(d[0] or 0), d[1].encode()))
    want = Counter()
    for i, (key, text) in enumerate(docs):
        third = len(text) // 3
        edited = text[:len(text) - third] + docs[(i + 1) % len(docs)][1][:third]
        want[key, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    got = rows(spark, "op4_fingerprints", tables)
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = {(r.doc_id, r.n_chars): r for r in got}
    assert by[3, by[3, len(dict(docs)[3])].n_chars].fingerprint == by[60, len(dict(docs)[60])].fingerprint
    for r in got:
        a, b = Counter(r.fingerprint.split()), Counter(r.edited_fingerprint.split())
        like = sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0
        assert r.near_edited == pytest.approx(like) and 0 <= r.near_next <= 1
    prose = [r for r in got if 200 < r.n_chars < 5000]
    # words of these texts are drawn evenly, so anchors are rare; generated prose is held to more below
    assert sum(r.near_edited for r in prose) > 0.3 * len(prose) and sum(r.near_next < 0.1 for r in prose) > 0.9 * len(prose)


def test_op4_prose(spark, sf_small):
    got = [r for r in rows(spark, "op4_fingerprints", sf_small) if r.n_chars > 200]
    assert sum(r.near_edited > 0.3 for r in got) > 0.95 * len(got) and sum(r.near_next < 0.1 for r in got) > 0.99 * len(got)


def test_op5(spark, tables):
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from rosterline.llm.secrets import CANDIDATE
    spark.range(1).observe(Observation(), F.count(F.lit(1))).collect()      # then a session can't be sent to tasks
    want = Counter((k, m.start(), len(m[0]), hashlib.sha256(m[0].encode()).hexdigest()) for k, t in documents(spark, tables)
                   for m in re.finditer(CANDIDATE, t or ""))
    assert Counter(tuple(r)[:4] for r in rows(spark, "op5_secrets", tables)) == want


def test_op5_judges_unlabelled_candidates(spark):
    import random

    from rosterline.llm import secrets
    rng = random.Random(3)

    def key():
        return "".join(rng.choice("0123456789abcdef") for _ in range(40))
    prose = [helpers.words(rng, 30, ["table", "window", "garden", "paper", "letter"]) for _ in range(400)]
    texts, want = [], {}
    for i, p in enumerate(prose):
        if i % 4 == 0:
            texts.append(f'{p} token = "{key()}" {p}')
        elif i % 4 == 1:
            texts.append(f"{p} call {rng.randrange(10 ** 13, 10 ** 14)} or write to a{i}@mail{i}.example.com {p}")
        elif i % 4 == 2:
            k = key().upper() if i % 8 == 2 else key()
            texts.append(f'{p} TOKEN = "{k}" {p}')
            want[i, k] = True
        else:
            k = f"window-garden-paper-{i}"
            texts.append(f"{p} see {k} {p}")
            want[i, k] = False
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, "")], "doc_id bigint, text string")
    got = [(r.doc_id, texts[r.doc_id][r.start:r.start + r.n_chars], r.label, r.secret) for r in secrets.scan(docs).collect()]
    assert all(label == secret for _, _, label, secret in got if label is not None)
    judged = {(d, k): s for d, k, label, s in got if label is None}
    assert judged.keys() == want.keys() and sum(judged[x] == want[x] for x in want) > 0.95 * len(want)
    assert secrets.scan(docs.where("doc_id % 4 = 3 or text is null")).where("secret").count() == 0


def test_op5_assigned_values(spark):
    from rosterline.llm import secrets
    cases = [("a password: hunter2 b", "hunter2", True), ('secret: "correcthorsebatterystaple".', "correcthorsebatterystaple", True),
             ("api_key = a8Kx02mQpz", "a8Kx02mQpz", True), ("password=p!a#s$s%w, then", "p!a#s$s%w", True),
             ("passwd: 'four words of it'", "four words of it", True), ("token=abcdef0123456789 x", "abcdef0123456789", True),
             ("my_token:abcdef0123456789", "abcdef0123456789", True), ('{"password": "me@home99"}', "me@home99", True),
             ("secret = https://me:pass99@host.example/x", "https://me:pass99@host.example/x", True),
             ("Password: Hunter\U0001F600 2", "Hunter\U0001F600", None), ("write to someone99@mail.example", "someone99@mail.example", False),
             ("password=a1b2 x", "password=a1b2", None), ("x token = abc", None, None), ("the tokens are: abcdefgh", None, None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id bigint, text string")
    got = sorted((r.doc_id, cases[r.doc_id][0][r.start:r.start + r.n_chars], r.label) for r in secrets.scan(docs).collect())
    assert got == [(i, v, label) for i, (_, v, label) in enumerate(cases) if v]


def test_op6(spark, tables):
    from xxhash import xxh64_intdigest

    def print_(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", low)
        if not found:
            return 0
        hashes = [xxh64_intdigest(" ".join(found[i:i + 3]).encode(), 42) for i in range(max(1, len(found) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    docs = documents(spark, tables)
    prints = [print_(t) for _, t in docs]
    group = helpers.connected(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    least = {}
    for (key, _), g in zip(docs, group):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    want = Counter((k, f"{p:016x}", least.get(g)) for (k, _), p, g in zip(docs, prints, group))
    assert Counter(map(tuple, rows(spark, "op6_simhash", tables))) == want


def test_op7(spark, tables):
    texts = Counter(documents(spark, tables))
    got = rows(spark, "op7_langid", tables)
    assert len(got) == sum(texts.values())
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[63].lang_pred == by[64].lang_pred == by[66].lang_pred == "und" and by[66].score == 0
    assert sum(by[i].lang_pred == ("xa", "xb")[i % 2] for i in range(60)) >= 58
    assert by[62].lang_pred == "xa"


def test_op7_held_out(spark):
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("no generated tables")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in rows(spark, "op7_langid", path) if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in got) > 0.97 * len(got)


def test_op8(spark, tables):
    docs = documents(spark, tables)
    got = rows(spark, "op8_sharding", tables)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in docs)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(slots) == set(range(8)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, rows(spark, "op8_sharding", tables)), key=repr)


def test_op9(spark, tables):
    from rosterline.llm.lines import threshold
    lines = [(k, i, t) for k, text in documents(spark, tables) for i, t in enumerate((text or "").split("\n"))]
    texts = sorted({t for _, _, t in lines})
    short = [t for t in texts if len(t) < 3000]
    links = [(texts.index(a), texts.index(b)) for n, a in enumerate(short) for b in short[:n]
             if abs(len(a) - len(b)) <= threshold(min(len(a), len(b))) and threshold(min(len(a), len(b)))
             and helpers.distance(a, b) <= threshold(min(len(a), len(b)))]
    group = dict(zip(texts, helpers.connected(len(texts), links)))
    first = {}
    for k, i, t in lines:
        place = (k is None, k or 0, i, k)
        first[group[t]] = min(first.get(group[t], place), place)
    want = Counter()
    for k, i, t in lines:
        head = first[group[t]]
        want[k, i, len(t), head[3], head[2], (k, i) != (head[3], head[2])] += 1
    assert Counter(map(tuple, rows(spark, "op9_lines", tables))) == want
    assert links


def test_op10(spark, tables):
    said = defaultdict(list)
    for r in spark.read.parquet(f"{tables}/conversations.parquet").collect():
        said[r.conv_id].append((r.turn is None, r.turn or 0, r.role or "", r.text or ""))
    said[-7] = [(False, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    want = set()
    for conv, turns in said.items():
        turns.sort()
        learned = "".join(t for *_, role, t in turns if role == "assistant")
        lines = "".join(f"{role}\n{t}\n" for *_, role, t in turns)
        want.add((conv, len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    assert {tuple(r)[:5] for r in rows(spark, "op10_chat", tables)} == want
