"""Near-duplicate lines by a segment-partition edit join.

Two lines are linked within ``threshold(length of the shorter)`` edits. The
shorter line is cut into threshold + 1 segments; edits within the threshold
leave at least one of them whole, so the longer line holds it as a substring,
at a place that the lengths of both confine. Segments and probing substrings
meet on one key (length, segment number, characters). Equal lines are one line
throughout.

A key's lines are verified within the task that reads them, by banded
bit-parallel edit distance, and only links come out. A key that very many lines
share would be n x n verifications. Such a key is taken apart again: its segment, and whatever
all its lines begin and end with, is removed from every line, and what remains
is joined under the old key by three pieces at once (of threshold + 3, of which
edits leave three whole). This loses no link, since the remains of two linked
lines are within the threshold again. Candidates are verified by banded bit-parallel edit distance.
"""

from __future__ import annotations

from itertools import chain, combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from rosterline.llm.common import components, cut, table, written

STEP = 32               # characters of a line for each edit
MOST = 2                # edits at most
LEAST = 20              # shorter lines are never dropped from a document
LISTED = 1 << 17        # candidate pairs of a key that a task verifies; above it the key is taken apart
POSTING = "key bigint, id bigint, probe boolean, edits int, delta int, rest string"
FILTER_BITS = 1 << 26   # of the table of shared keys that every task gets (8 MB)
CHUNK = 1 << 18         # characters of lines that a worker hashes at once


def threshold(chars: int) -> int:
    return min(MOST, chars // STEP)


def segments(chars: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of edits + 1 even segments, the longer ones last."""
    n, at, out = edits + 1, 0, []
    for i in range(n):
        out.append((at, chars // n + (i >= n - chars % n)))
        at += out[-1][1]
    return out


def _line_keys(texts: list[str], wanted=None):
    """Keys of whole lines: of their segments, and of the substrings that probe every length within reach.

    Returns arrays (row, key, probe, start, size, edits, delta); ``wanted`` is a
    bit table of keys, others are left out.

    Substrings are hashed by differences of one running sum: characters times
    the powers of an odd number, brought to the substring's start by the inverse
    power. Equal substrings have equal keys; unequal ones that meet are told
    apart by the verification.
    """
    base = 0x9E3779B97F4A7C15
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    powers = np.full(len(chars) + 1, base, np.uint64)
    powers[0] = 1
    back = np.full(len(chars) + 1, pow(base, -1, 1 << 64), np.uint64)
    back[0] = 1
    np.cumprod(powers, out=powers)
    np.cumprod(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * powers[:-1], dtype=np.uint64)])
    length = np.array([len(t) for t in texts], np.int64)
    offset = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)[:-1]])
    out = []
    for most in range(1, MOST + 1):
        for delta in range(most + 1):
            whole = length - delta
            rows = np.flatnonzero(np.minimum(MOST, whole // STEP) == most)
            if not len(rows):
                continue
            n, w, full = most + 1, whole[rows], length[rows]
            for i in range(n):
                size = w // n + (i >= n - w % n)
                start = i * (w // n) + np.maximum(0, i - (n - w % n))
                for shift in range(max(-i, delta - (most - i)), min(i, delta + (most - i)) + 1):
                    at, held = start + shift, delta == 0 and shift == 0
                    ok = (at >= 0) & (at + size <= full)
                    r, p, z = rows[ok], at[ok], size[ok]
                    first = offset[r] + p
                    key = (sums[first + z] - sums[first]) * back[first]
                    key = (key ^ ((w[ok] * 8 + i).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xBF58476D1CE4E5B9)
                    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                    key ^= key >> np.uint64(29)
                    if wanted is not None:
                        bit = key & np.uint64(FILTER_BITS - 1)
                        keep = (wanted[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        r, p, z, key = r[keep], p[keep], z[keep], key[keep]
                    out.append((r, key.view(np.int64), np.full(len(r), not held), p, z, np.full(len(r), most), np.full(len(r), delta)))
    if not out:
        return [np.zeros(0, np.int64)] * 7
    return [np.concatenate(c) for c in zip(*out)]


def _shifts(parts: int, edits: int, delta: int) -> list[tuple[int, ...]]:
    """How far ``parts`` untouched pieces of a text can stand from their places in one that is ``delta`` longer.

    A shift changes by one with every insertion or deletion before the piece.
    """
    return [s for s in product(range(-edits, edits + 1), repeat=parts)
            if sum(abs(b - a) for a, b in zip((0, *s), (*s, delta))) <= edits]


def _rest_keys(text: str, salt: int, probe: bool, edits: int, delta: int):
    """Keys of a remainder: of three of its edits + 3 pieces at once, as edits leave three untouched.

    (key, probe, rest) with the remainder less these pieces; one too short for
    that many pieces has its edits + 1 segments one by one.
    """
    whole = len(text) - delta
    n, k = (edits + 3, 3) if whole >= edits + 3 else (edits + 1, 1)
    data, spans = text.encode("utf-32-le", "surrogatepass"), segments(whole, n - 1)
    for chosen in combinations(range(n), k):
        for shift in _shifts(k, edits, delta):
            held = not probe and not any(shift)
            at = [(spans[i][0] + d, spans[i][0] + d + spans[i][1]) for i, d in zip(chosen, shift)]
            if at[0][0] < 0 or at[-1][1] > len(text) or any(a[1] > b[0] for a, b in zip(at, at[1:])):
                continue
            mark = salt.to_bytes(8, "little", signed=True) + bytes((*chosen, n)) + whole.to_bytes(4, "little")
            key = xxh64_intdigest(mark + b"".join(data[4 * a:4 * b] for a, b in at))
            rest = "".join(text[a:b] for a, b in zip((0, *(x[1] for x in at)), (*(x[0] for x in at), len(text))))
            yield key - (1 << 64) if key >> 63 else key, not held, rest


def _parts(batch):
    """(texts, rows) of a batch, CHUNK characters at a time."""
    texts, at = batch.column("text").to_pylist(), 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < CHUNK):
            size, end = size + len(texts[end]), end + 1
        yield texts[at:end], batch.slice(at, end - at)
        at = end


def _shared(keys: DataFrame) -> DataFrame:
    """``keys(key, probe)`` under which a segment meets another text, with the number of pairs they would list."""
    sums = keys.groupBy("key").agg(F.sum(F.when(F.col("probe"), 0).otherwise(1)).alias("held"), F.count("*").alias("n"))
    return cut(sums.where("held > 0 and n > 1").select(F.col("key").alias("k"), (F.col("held") * F.col("n")).alias("pairs")))


def _line_postings(rows: DataFrame) -> DataFrame:
    """``rows(id, text)``, whole lines, as postings (key, id, probe, edits, delta, rest, pairs) of the shared keys.

    ``rest`` is the text without the posting's part. A bit table of the shared
    keys, FILTER_BITS long whatever their number, spares the tasks most of the
    postings that would only be shuffled to find that nobody shares their key.
    """
    def keys_of(batches):
        for batch in batches:
            for texts, _ in _parts(batch):
                _, key, probe, *_ = _line_keys(texts)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(probe)], names=["key", "probe"])
    keys = _shared(rows.mapInArrow(keys_of, "key bigint, probe boolean"))
    bits = keys.select(F.expr(f"k & {FILTER_BITS - 1}L").alias("slot")) \
        .select(F.expr("shiftright(slot, 3)").alias("byte"), F.expr("shiftleft(1, cast(slot & 7 AS int))").alias("bit")) \
        .groupBy("byte").agg(F.bit_or("bit").alias("bits"))
    pages = bits.groupBy(F.floor(F.col("byte") / 4096)).agg(F.collect_list("byte").alias("byte"), F.collect_list("bits").alias("bits"))
    table_ = np.zeros(FILTER_BITS // 8, np.uint8)
    for page in pages.toLocalIterator():
        table_[page["byte"]] = page["bits"]
    shared = rows.sparkSession.sparkContext.broadcast(table_.tobytes())

    def postings(batches):
        wanted = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for texts, part in _parts(batch):
                row, key, probe, start, size, edits, delta = _line_keys(texts, wanted)
                rest = [texts[r][:s] + texts[r][s + z:] for r, s, z in zip(row.tolist(), start.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), part.column("id").take(pa.array(row)), pa.array(probe), pa.array(edits.astype(np.int32)),
                     pa.array(delta.astype(np.int32)), pa.array(rest, pa.string())], names=["key", "id", "probe", "edits", "delta", "rest"])
    return rows.mapInArrow(postings, POSTING).join(keys, F.col("key") == F.col("k"))


def _rest_postings(rows: DataFrame) -> DataFrame:
    """``rows(id, text, salt, probe, edits, delta)``, remains of the lines of hot keys, as postings of the shared keys."""
    def run(batches):
        for batch in batches:
            out = [(k, r["id"], p, r["edits"], r["delta"], rest) for r in batch.to_pylist()
                   for k, p, rest in _rest_keys(r["text"], r["salt"], r["probe"], r["edits"], r["delta"])]
            kinds = pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.string()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 6, kinds)],
                                             names=["key", "id", "probe", "edits", "delta", "rest"])
    found = written(rows.repartition("id").mapInArrow(run, POSTING).distinct(), "line-rests")
    return found.join(_shared(found), F.col("key") == F.col("k"))


def _stripped(rows: DataFrame) -> DataFrame:
    """``rows(salt, text, ...)`` without what all texts of a salt begin and end with."""
    ends = rows.groupBy("salt").agg(F.min("text").alias("lo"), F.max("text").alias("hi"), F.min(F.reverse("text")).alias("rlo"),
                                    F.max(F.reverse("text")).alias("rhi"), F.min(F.char_length("text")).alias("least"))

    def run(batches):
        from os.path import commonprefix
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                head = len(commonprefix([r["lo"], r["hi"]]))
                out.append((r["salt"], head, min(len(commonprefix([r["rlo"], r["rhi"]])), r["least"] - head)))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())],
                                             names=["s", "head", "tail"])
    common = ends.mapInArrow(run, "s bigint, head int, tail int")
    return rows.join(common, F.col("salt") == F.col("s")) \
        .withColumn("text", F.substr("text", F.col("head") + 1, F.char_length("text") - F.col("head") - F.col("tail"))).drop("s", "head", "tail")


def edits(a: str, b: str, most: int) -> int:
    """Edit distance of two texts, ``most`` + 1 if it is more; bit-parallel in a band of diagonals (Hyyro 2003).

    A word of 2 * most + 2 bits holds the vertical differences of the rows
    around the diagonal and moves down one row with every character of ``b``.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    low, high = 0, min(len(a), len(b))
    while low < high and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < high - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = sorted((a[low:len(a) - tail], b[low:len(b) - tail]), key=len)
    if len(a) <= most:                      # too short for a band
        row = list(range(len(a) + 1))
        for j, c in enumerate(b):
            before, row = row, [j + 1]
            for i, x in enumerate(a):
                row.append(min(before[i] + (x != c), before[i + 1] + 1, row[i] + 1))
        return min(row[-1], most + 1)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    width = 2 * most + 2
    full, top, side = (1 << width) - 1, 1 << (width - 1), 1 << (width - 2)
    down_plus, down_minus, score, first = ((1 << (most + 1)) - 1) << (most + 1), 0, most, -most - 1
    for j, c in enumerate(b):
        same = where.get(c, 0)
        same = (same >> first if first >= 0 else same << -first) & full
        level = ((((same & down_plus) + down_plus) ^ down_plus) | same | down_minus) & full
        right_plus, right_minus = down_minus | ~(level | down_plus) & full, level & down_plus
        if j < len(a) - most:               # along the band's lowest diagonal
            score += not level & top
            if score > 2 * most + len(b) - len(a):
                return most + 1             # the rest can't make up for it
        else:                               # along the last row of a
            score += bool(right_plus & side) - bool(right_minus & side)
            side >>= 1
        level >>= 1
        down_plus, down_minus = (right_minus | ~(level | right_plus)) & full, level & right_plus
        first += 1
    return min(score, most + 1)


def _links(few: DataFrame, lines: DataFrame) -> DataFrame:
    """``few(key, id, probe)`` to links ``(a, b)`` that connect the linked lines of every key.

    A key's own lines are verified against all its lines, except where they are
    connected already, so a key of n near copies gives n - 1 links and about n
    verifications. Keys hold a bounded number of pairs (see ``links``); a task
    reads its keys one after the other.
    """
    text = lines.select(F.col("id").alias("i"), "text")
    rows = few.distinct().join(text, F.col("id") == F.col("i")).select("key", "id", "probe", "text")

    def run(batches):
        key, held = None, []
        for batch in chain(batches, [None]):
            out = []
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "probe", "text"))) if batch else [(None,)]:
                if k != key or batch is None:
                    out += _connect(held)
                    key, held = k, []
                if batch is not None:
                    held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def _connect(rows):
    """Links (a, b) that connect the linked ones of ``rows`` (id, probe, text)."""
    texts = {i: t for i, _, t in rows}
    up = {i: i for i in texts}

    def root(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i
    out = []
    for a in sorted({i for i, probe, _ in rows if not probe}):
        for b, t in texts.items():
            most = threshold(min(len(texts[a]), len(t)))
            if abs(len(texts[a]) - len(t)) <= most and root(a) != root(b) and edits(texts[a], t, most) <= most:
                up[root(a)] = root(b)
                out.append((a, b))
    return out


def _short_links(held: DataFrame, first: DataFrame, probes: DataFrame, lines: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of the ``probes(key, id)`` to the ``held(key, id)`` lines of their key, which are linked to ``first(key, a)``.

    The held lines of a key differ in a few places only. If a probe is linked to
    one of them, it is linked to all that have the same characters at the places
    which the edits leave. So held lines are grouped by their characters at every
    choice of places, and a probe is verified against one line of each group
    whose characters it has within the threshold's reach of the places.
    """
    text = lines.select(F.col("id").alias("i"), "text")
    whole = lambda rows: rows.join(text, F.col("id") == F.col("i")).drop("i")

    def differ(batches):
        for batch in batches:
            at = [[i for i, (x, y) in enumerate(zip(a, b)) if x != y]
                  for a, b in zip(batch.column("text").to_pylist(), batch.column("other").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(at, pa.list_(pa.int32()))], names=["key", "at"])
    others = whole(first.withColumnRenamed("a", "id")).select(F.col("key").alias("k"), F.col("text").alias("other"))
    places = whole(held).join(others, F.col("key") == F.col("k")).select("key", "text", "other").mapInArrow(differ, "key bigint, at array<int>")
    places = cut(places.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("at")))).alias("at"))
                 .withColumnRenamed("key", "k"))

    def groups(reach):
        def run(batches):
            for batch in batches:
                out = []
                for key, i, at, size, t in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "at", "size", "text"))):
                    most = threshold(size) if reach else 0
                    for k in range(len(at) + 1):
                        for chosen in combinations(at, k):
                            near = [range(max(0, p - most), min(len(t), p + most + 1)) for p in chosen]
                            kept = {"".join(t[j] for j in js) for js in product(*near) if all(x < y for x, y in zip(js, js[1:]))}
                            out += [(key, i, ",".join(map(str, chosen)), chars) for chars in kept]
                cols = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                                                 names=["key", "id", "places", "chars"])
        return run
    kind = "key bigint, id bigint, places string, chars string"
    sizes = whole(first.withColumnRenamed("a", "id")).select(F.col("key").alias("s"), F.char_length("text").alias("size"))
    shape = cut(places.join(sizes, F.col("k") == F.col("s")).select("k", "at", "size"))
    one = whole(held).join(shape, F.col("key") == F.col("k")).drop("k").mapInArrow(groups(False), kind) \
        .groupBy("key", "places", "chars").agg(F.min("id").alias("a"))
    found = whole(probes.distinct()).join(shape, F.col("key") == F.col("k")).drop("k").mapInArrow(groups(True), kind) \
        .join(one, ["key", "places", "chars"]).where("a <> id").select("a", F.col("id").alias("b")).distinct()
    pairs = found.join(text.toDF("i", "left"), F.col("a") == F.col("i")).drop("i").join(text.toDF("i", "right"), F.col("b") == F.col("i"))

    def verify(batches):
        for batch in batches:
            fit = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
                most = threshold(min(len(x), len(y)))
                fit.append(edits(x, y, most) <= most)
            yield batch.select(["a", "b"]).filter(pa.array(fit, pa.bool_()))
    return pairs.select("a", "b", "left", "right").mapInArrow(verify, "a bigint, b bigint")


def links(lines: DataFrame, listed: int = LISTED) -> DataFrame:
    """``lines(id, text)``, texts distinct, to links ``(a, b)``: their components are those of all pairs within the threshold.

    Every returned pair is within the threshold. A key of more than ``listed``
    pairs is taken apart until none is left; the lines of a key that were cut
    at the same places and whose remains are too short to differ in more than
    the threshold are linked in a chain, unverified.
    """
    found = []
    some = _line_postings(lines.where(F.char_length("text") >= STEP))
    while True:
        some = written(some, "line-postings")
        found.append(_links(some.where(F.col("pairs") <= listed).select("key", "id", "probe"), lines))
        hot = some.where(F.col("pairs") > listed)
        if hot.isEmpty():
            break
        rests = hot.select("id", F.col("rest").alias("text"), F.col("key").alias("salt"), "probe", "edits", "delta").distinct()
        rests = written(_stripped(cut(rests)), "line-remains")
        # too short for edits + 1 segments: lines cut at the same places cannot differ in more, probes are verified
        size = F.char_length("text")
        short = size - F.when(F.col("probe"), F.col("delta")).otherwise(0) <= F.col("edits")
        held = rests.where(short & ~F.col("probe")).select(F.col("salt").alias("key"), "id")
        first = cut(held.groupBy("key").agg(F.min("id").alias("a")))
        found.append(held.join(first, "key").where("a <> id").select("a", F.col("id").alias("b")))
        found.append(_short_links(held, first, rests.where(short & F.col("probe")).select(F.col("salt").alias("key"), "id"), lines))
        some = _rest_postings(rests.where(~short))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def line_classes(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to one row a line: ``(doc_id, line, n_chars, class_doc, class_line, repeated)``.

    Lines end at a newline and count from 0; a NULL text is one empty line. A
    class is a connected group of equal or linked lines, named by its first
    line (smallest doc_id, then line; rows without doc_id come last); the other
    lines of the class are ``repeated``. Rows of a repeated document are judged alike.
    """
    rows = docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "text"))
    rows = rows.select("doc_id", "line", "text", F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("g"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line")
    lines = written(rows.groupBy("h", "g").agg(F.min(place).alias("first"), F.any_value("text").alias("text"))
                    .withColumn("id", F.monotonically_increasing_id()), "lines")
    texts = lines.select("id", "text")
    groups = cut(components(links(texts)))
    member = lines.select("id", "first").join(groups, F.col("id") == F.col("node"))
    heads = member.groupBy("component").agg(F.min("first").alias("head")).withColumnRenamed("component", "c")
    moved = cut(member.join(heads, F.col("component") == F.col("c")).select(F.col("id").alias("i"), "head"))
    named = written(lines.select("id", "first", F.col("h").alias("lh"), F.col("g").alias("lg")).join(moved, F.col("id") == F.col("i"), "left")
                    .select("lh", "lg", F.coalesce("head", "first").alias("head")), "line-classes")
    found = rows.select("doc_id", "line", F.char_length("text").alias("n_chars"), "h", "g") \
        .join(named, (F.col("h") == F.col("lh")) & (F.col("g") == F.col("lg")))
    return found.select("doc_id", "line", "n_chars", F.col("head.doc_id").alias("class_doc"), F.col("head.line").alias("class_line"),
                        (~(F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("line") == F.col("head.line")))).alias("repeated"))


def drop_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Documents without their repeated lines of ``least`` characters or more; ``text`` and ``n_chars`` are rewritten.

    A document that loses lines and keeps none but blank ones goes. Documents
    without repeated lines keep their text, NULL included; documents without
    doc_id are kept as they are. Rows of one doc_id and equal texts are judged
    alike, rows of one doc_id with unequal texts each on its own. All columns of
    ``docs`` stay.
    """
    own = F.struct(F.col("doc_id").alias("i"), F.xxhash64("text").alias("h"))
    gone = line_classes(docs.where("doc_id is not null").select(own.alias("doc_id"), "text")).where("repeated").where(F.col("n_chars") >= least)
    gone = gone.groupBy("doc_id").agg(F.collect_set("line").alias("gone")).withColumnRenamed("doc_id", "d")
    rest = [c for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*rest).alias("row"), "text", F.xxhash64("text").alias("own")) \
        .join(gone, (F.col("row.doc_id") == F.col("d.i")) & (F.col("own") == F.col("d.h")), "left")
    parts = F.split("text", "\n")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone")), lambda i: F.get(parts, i))
    whole = whole.withColumn("kept", F.when(F.col("gone").isNotNull(), F.array_join(left, "\n")))
    whole = whole.where(F.col("kept").isNull() | F.regexp_like("kept", F.lit(r"\S")))
    new = {"text": F.coalesce("kept", "text"),
           "n_chars": F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.char_length("kept")) if "n_chars" in rest else None}
    return whole.select(*[(new[c].cast(t) if c in new else F.col("row")[c]).alias(c) for c, t in docs.dtypes])


def op9(spark, sf_dir: str) -> DataFrame:
    """Every line of every document with its class."""
    return line_classes(table(spark, sf_dir, "documents"))
