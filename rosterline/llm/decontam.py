"""Benchmark decontamination by q-gram lemma filtering.

An item leaks where a stretch of it, WINDOW characters or the whole item if
that is shorter, occurs in a document within the edit budget e. By the q-gram
lemma such a stretch of w characters shares at least w - q + 1 - q*e q-grams
with the document, all on e + 1 neighbouring diagonals (document position minus
item position). Hits are counted in overlapping diagonal bands that hold any
e + 1 neighbours; only regions in which a span of w characters reaches the
bound are kept, and each is verified by banded alignment.

Both sides are compared as lower-case words between single spaces. The
benchmark's index is sent to the tasks in blocks of at most BLOCK_CHARS
characters of item text, one pass over the documents a block.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from rosterline.llm.common import table

Q = 10
WINDOW = 60
EDIT_RATE = 0.05
BLOCK_CHARS = 8_000_000
CHUNK = 1 << 19             # characters of documents that a worker looks up at once
RUNS = 1 << 21              # runs of a text that a worker holds at once
DOC_MARK, ITEM_MARK = "\0", "\1"          # stand in no words form
NO_WORD = re.compile(r"[\W_]+")


def words(text: str | None) -> str:
    return NO_WORD.sub(" ", (text or "").lower()).strip()


def banded(pattern: str, text: str, edits: int) -> int:
    """Fewest edits between ``pattern`` and any piece of ``text`` that starts at most 2 * edits in; edits + 1 if there are more.

    Only the 4 * edits + 1 diagonals that such an alignment can touch are computed.
    """
    more, wide = edits + 1, 4 * edits + 1         # diagonal d: text position = pattern position + d - edits
    row = [0 if edits <= d <= 3 * edits and d - edits <= len(text) else more for d in range(wide)]
    for i, c in enumerate(pattern):
        new = []
        for d in range(wide):
            j = i + d - edits
            best = row[d] + (not (0 <= j < len(text) and text[j] == c)) if j < len(text) else more
            if d + 1 < wide:
                best = min(best, row[d + 1] + 1)
            if d and 0 <= j < len(text):
                best = min(best, new[d - 1] + 1)
            new.append(min(best, more))
        row = new
        if min(row) >= more:
            return more
    return min(row)


def _spread(start, n):
    """The numbers start[0], start[0] + 1, ... (n[0] of them), then those from start[1], ..."""
    import numpy as np
    before = np.cumsum(n) - n
    return np.repeat(start - before, n) + np.arange(n.sum())


class Index:
    """q-grams of a block of benchmark items, as sorted arrays.

    The items stand one after the other in ``chars``, each behind a mark that no
    text holds. Postings of a q-gram are places in ``chars``, in the order of the
    character before the q-gram (``before``) and of the one behind it (``behind``).
    """

    def __init__(self, items: list[tuple[int, str]]):
        import numpy as np
        self.texts = [(i, t) for i, t in items if len(t) >= Q]
        self.short: dict[str, list[int]] = {}
        for i, t in items:
            if 0 < len(t) < Q:
                self.short.setdefault(t, []).append(i)
        size = np.array([len(t) for _, t in self.texts], np.int64)
        self.window = np.minimum(size, WINDOW)
        self.edits = (self.window * EDIT_RATE).astype(np.int64)
        self.bound = np.maximum(1, self.window - Q + 1 - Q * self.edits)
        self.start = np.cumsum(size + 1) - size
        self.chars = self.codes(ITEM_MARK.join(["", *(t for _, t in self.texts), ""]))
        hashes = self.grams(self.chars)
        whole = np.ones(len(self.chars), bool)          # no mark within the q-gram
        for mark in np.flatnonzero(self.chars == ord(ITEM_MARK)):
            whole[max(0, mark - Q + 1):mark + 1] = False
        place = np.flatnonzero(whole[:len(hashes)])
        self.hashes, gram, self.counts = np.unique(hashes[place], return_inverse=True, return_counts=True)
        self.first = np.cumsum(self.counts) - self.counts
        self.before, self.behind = (self._by(gram, place, self.chars[place + d]) for d in (-1, Q))
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.hashes >> np.uint64(42)] = True

    @staticmethod
    def _by(gram, place, char):
        """(sorted keys of q-gram and character, their places)"""
        import numpy as np
        key = gram.astype(np.int64) << 21 | char
        order = np.argsort(key, kind="stable")
        return key[order], place[order]

    @staticmethod
    def codes(text: str):
        import numpy as np
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)

    @staticmethod
    def grams(codes):
        """A 64-bit hash for each q-gram."""
        import numpy as np
        c = codes.astype(np.uint64)
        n = len(c) - Q + 1
        h = np.zeros(max(n, 0), np.uint64)
        for i in range(Q if n > 0 else 0):
            h = h * np.uint64(0x9E3779B97F4A7C15) + c[i:i + n] + np.uint64(1)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def _ends(self, codes, at, gram, side, step):
        """(place in text, place in ``chars``) of the hits whose neighbours by ``step`` differ, as two functions: their number a place, and themselves."""
        import numpy as np
        keys, places = side
        next_ = at + step
        char = np.where((next_ >= 0) & (next_ < len(codes)), codes[np.clip(next_, 0, len(codes) - 1)], 0)
        key = gram.astype(np.int64) << 21 | char
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        first, last = self.first[gram], self.first[gram] + self.counts[gram]
        n = last - first - (high - low)

        def listed():
            two = np.concatenate([_spread(first, low - first), _spread(high, last - high)])
            p, g = np.concatenate([np.repeat(at, low - first), np.repeat(at, last - high)]), places[two]
            same = np.ones(len(p), bool)                # equal hashes of unequal q-grams are no hits
            for i in range(Q):
                same &= codes[p + i] == self.chars[g + i]
            p, g = p[same], g[same]
            order = np.lexsort((p, p - g))
            return p[order], g[order]
        return int(n.sum()), listed

    def runs(self, codes):
        """(item, first, last, diagonal) of every run: text positions that hit an item on one diagonal, none left out between.

        A run is found by its two ends, the hits whose neighbours in text and
        item differ, so repetitive texts are not expanded into their hits. A text
        of very many runs is worked off in halves that share a window.
        """
        import numpy as np
        h = self.grams(codes)
        at = np.flatnonzero(self.seen[h >> np.uint64(42)])
        gram = np.searchsorted(self.hashes, h[at])
        gram[gram == len(self.hashes)] = 0
        real = self.hashes[gram] == h[at] if len(self.hashes) else np.zeros(0, bool)
        at, gram = at[real], gram[real]
        if not len(at):
            return
        n, starts = self._ends(codes, at, gram, self.before, -1)
        if n > RUNS and len(codes) > 8 * WINDOW:
            half = len(codes) // 2
            yield from self.runs(codes[:half + WINDOW])
            for owner, first, last, diagonal in self.runs(codes[half - WINDOW:]):
                yield owner, first + half - WINDOW, last + half - WINDOW, diagonal + half - WINDOW
            return
        (p, g), (last, _) = starts(), self._ends(codes, at, gram, self.behind, Q)[1]()
        owner = np.searchsorted(self.start, g, "right") - 1
        yield owner, p, last, p - (g - self.start[owner])

    def regions(self, codes, starts):
        """(document, item, first, last, diagonal, exact) of the runs from whose positions first to last a window meets the bound.

        Documents begin at ``starts``. In a band the positions of all its runs
        count, each once. ``exact`` runs are a window long by themselves: of a pair
        that has some the first one stands for all. Of regions that are alike, by item and
        the text around them, the first one stands for all.
        """
        import numpy as np
        found = [np.zeros((0, 6), np.int64)]
        base = np.uint64(0x9E3779B97F4A7C15)
        powers, back = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes), b, np.uint64)]), dtype=np.uint64)
                        for b in (base, np.uint64(pow(int(base), -1, 1 << 64))))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers[:-1], dtype=np.uint64)])

        def distinct(rows):
            d, i, s, last, g, exact = rows.T
            pair = d * len(self.texts) + i
            order = np.lexsort((s, exact == 0, pair))
            head = order[np.concatenate([[True], pair[order][1:] != pair[order][:-1]])[:len(order)]]
            first = head[exact[head] == 1]
            rest = np.flatnonzero(~np.isin(pair, pair[first]))
            rest = rest[np.argsort(s[rest], kind="stable")]
            around = 2 * WINDOW + 4 * self.edits[i[rest]] + Q
            low, high = np.maximum(0, s[rest] - around), np.minimum(len(codes), last[rest] + around)
            key = (sums[high] - sums[low]) * back[low]
            for part in (pair, s - g, last - s, s - np.maximum(0, s - 2 * WINDOW)):
                key = (key ^ (key >> np.uint64(31)) ^ part[rest].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            return rows[np.concatenate([first, rest[np.unique(key, return_index=True)[1]]])]

        for item, p, end, diagonal in self.runs(codes):
            if not len(p):
                continue
            doc, half, wide = np.searchsorted(starts, p, "right") - 1, self.edits[item] + 1, len(codes) + 2 * WINDOW
            for shift in (0, 1):
                band = (diagonal + shift * half) // (2 * half)
                order = np.lexsort((p, band, item, doc))
                d, i, b, s, e, g = (x[order] for x in (doc, item, band, p, end, diagonal))
                group = np.concatenate([[0], np.cumsum((d[1:] != d[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1]))]) * wide
                upto = np.maximum.accumulate(e + group)             # covered up to here
                fresh = np.flatnonzero(np.concatenate([[True], s[1:] + group[1:] > upto[:-1]]))
                low, high = (s + group)[fresh], upto[np.append(fresh[1:], len(s)) - 1]
                total = np.cumsum(high - low + 1)

                def covered(x):
                    k = np.maximum(np.searchsorted(low, x, "right") - 1, 0)
                    return total[k] - np.maximum(0, high[k] - x)

                def count(x, i):
                    """Covered positions from the covered place ``x`` on, within a window of item ``i``."""
                    return covered(x + self.window[i] - Q) - covered(x) + 1
                ok = np.flatnonzero(count(s + group, i) >= self.bound[i])
                d, i, s, e, g, behind = d[ok], i[ok], s[ok], e[ok], g[ok], group[ok]
                lo, hi = s.copy(), e.copy()                         # count falls along a run
                while (lo < hi).any():
                    mid = (lo + hi + 1) // 2
                    fits = count(mid + behind, i) >= self.bound[i]
                    lo, hi = np.where(fits, mid, lo), np.where(fits, hi, mid - 1)
                found = [distinct(np.concatenate([*found, np.stack([d, i, s, lo, g, e - s + 1 >= self.window[i] - Q + 1], axis=1)]))]
        return found[0].tolist()

    def leaks(self, texts: list[str]):
        """(document, item, edits, position) of every item that leaks into a document, once a pair, at its best region (the first of the best)."""
        import numpy as np
        starts = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        tried = lru_cache(1 << 14)(banded)              # repetitive texts ask the same again
        for d, i, lo, hi, diagonal, exact in self.regions(self.codes(DOC_MARK.join(texts)), starts):
            window, edits, item, at = int(self.window[i]), int(self.edits[i]), self.texts[i][1], int(starts[d])
            if best.get((d, i), (1, 0))[0] == 0:
                continue
            if exact:
                best[d, i] = (0, lo - at)
                continue
            lo, hi, diagonal = lo - at, hi - at, diagonal - at
            # the item's stretch holds the first hit and those that meet the bound, give or take the edits between them
            first = max(0, lo + int(self.bound[i]) - 1 + Q - window - diagonal - edits)
            for s in range(min(hi - diagonal, len(item) - window), first - 1, -1):
                from_ = max(0, s + diagonal - edits)
                near = tried(item[s:s + window], texts[d][from_:from_ + window + 3 * edits + 1], edits)
                if near <= edits and (near, max(0, s + diagonal)) < best.get((d, i), (edits + 1, 0)):
                    best[d, i] = (near, max(0, s + diagonal))
        return [(d, i, e, p) for (d, i), (e, p) in best.items()]

    def whole_words(self, texts: list[str]):
        """(document, item, 0, position) of the items of fewer than Q characters, as whole words, at their first place."""
        if not self.short:
            return []
        out, most = [], max(t.count(" ") for t in self.short) + 1
        for d, text in enumerate(texts):
            found: dict[str, int] = {}
            ends = [0, *(m.end() for m in re.finditer(" ", text))]
            stops = [e - 1 for e in ends[1:]] + [len(text)]
            for k, start in enumerate(ends):
                for stop in stops[k:k + most]:
                    if stop - start >= Q:
                        break
                    if text[start:stop] in self.short:
                        found.setdefault(text[start:stop], start)
            out += [(d, i, 0, at) for t, at in found.items() for i in self.short[t]]
        return out


def _blocks(benchmark: DataFrame):
    """Items of the benchmark in words form, in blocks of about BLOCK_CHARS characters; at least one block."""
    block, size, any_ = [], 0, False
    for row in benchmark.select("item_id", "text").toLocalIterator():      # one partition at a time
        block.append((row["item_id"], words(row["text"])))
        size += len(block[-1][1])
        if size >= BLOCK_CHARS:
            yield block
            block, size, any_ = [], 0, True
    if block or not any_:
        yield block


def _found(held, batches, text, short):
    """(rows of a batch, their leaks) for parts of about CHUNK characters; with the ``short`` items, if asked.

    ``held`` is the broadcast list of the block; a worker adds the block's index to it and finds it there in its next task.
    """
    if len(held) == 1:
        held.append(Index(held[0]))
    index = held[1]
    for batch in batches:
        texts, at = batch.column(text), 0
        while at < len(texts):
            part, size, first = [], 0, at
            while at < len(texts) and (not part or size < CHUNK):
                part.append(words(texts[at].as_py()))
                size, at = size + len(part[-1]), at + 1
            rows = [(d, index.texts[i][0], e, p) for d, i, e, p in index.leaks(part)]
            yield batch.slice(first, at - first), rows + (index.whole_words(part) if short else [])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` against ``benchmark(item_id, text)``: ``(doc_id, item_id, edits, position)``, one row a leaking pair.

    ``position`` counts characters of the document's words form, of the best
    region (fewest edits, the first of several). Items of fewer than Q characters leak
    where they stand as whole words; NULL or empty texts match nothing. Rows of a
    repeated document each get their rows, and so do repeated items. A worker
    holds one text at a time whole, however long, and its runs, not its hits.
    """
    kind, item = dict(docs.dtypes)["doc_id"], benchmark.schema["item_id"].dataType
    schema = f"doc_id {kind}, item_id {item.simpleString()}, edits int, position bigint"
    item_type = to_arrow_type(item)

    def against(block):
        shared = docs.sparkSession.sparkContext.broadcast([block])

        def run(batches):
            for part, rows in _found(shared.value, batches, "text", True):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array([r[0] for r in rows], pa.int32())), pa.array([r[1] for r in rows], item_type),
                     pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64())],
                    names=["doc_id", "item_id", "edits", "position"])
        return docs.select("doc_id", "text").mapInArrow(run, schema)
    out, *more = [against(b) for b in _blocks(benchmark)]
    for found in more:
        out = out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` into whose ``text`` no benchmark item leaks, with all their columns; a NULL text stays.

    Items of fewer than Q characters ("yes", "42") drop no document: they stand in clean text everywhere.
    """
    for block in _blocks(benchmark):
        docs = _without(docs, docs.sparkSession.sparkContext.broadcast([block]), text)
    return docs


def _without(docs: DataFrame, shared, text: str) -> DataFrame:
    def run(batches):
        import numpy as np
        for part, rows in _found(shared.value, batches, text, False):
            keep = np.ones(part.num_rows, bool)
            keep[[r[0] for r in rows]] = False
            yield part.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)


def op2(spark, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair in which the item leaks."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
