"""Token pieces packed into sequences by bounded-space online best fit.

Pieces are dealt to groups at random; a group keeps at most ``OPEN`` open bins,
found through a bitset keyed by free space: the lowest set bit at or above a
piece's length is the best fit. When a piece fits nowhere and all bins are
open, the fullest one closes. What stays open at the end of a group is packed
again, together with that of the other groups, in fewer groups, until one
group is left: its open bins are the only partly filled ones at the end.
"""

from __future__ import annotations

import zlib
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from rosterline.llm.common import table, written

TOKENIZER = "word_bpe_49k.json"
LIMIT = 4096
OPEN = 256
ROWS_PER_GROUP = 25_000     # pieces that one task packs
MORE = 16                   # times as many pieces of a group if they are short, at most
END = 1                     # id after every document
WORDS_KEPT = 1_000_000        # words that a worker remembers (and as many older ones)
ROWS_AT_ONCE = 2_000        # documents of one result batch
TAIL = ".,;:!?"             # marks that the tokenizer separates from the letters before them


class WordIds(dict):
    """Ids (bytes) of the words of a text, filled as words are met; words not met for long are forgotten.

    A new word of lower-case Latin letters goes to the byte-pair model directly,
    without the tokenizer's normalizing and splitting, which leave it as it is;
    any other word goes through the tokenizer.
    """

    #: Where a byte of a word stands for itself in the model's alphabet; the others follow from 256 on, in order.
    SELF = (*range(33, 127), *range(161, 173), *range(174, 256))

    def __init__(self, coder):
        super().__init__()
        self.coder, self.older = coder, {}
        self.alphabet = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in self.SELF)}
        probe = ["probe", "straße", "élan", "às", "zyxwvut"]
        self.direct = all(self.letters(w.encode()) == self.whole(w) for w in probe)
        text = "Ab straße, (x-1) y.\nÉ z!"
        self.apart = self.whole(text) == [i for w in text.split() for i in self.whole(w)] == self.whole(text.replace("A", "a"))

    def whole(self, text: str) -> list[int]:
        return self.coder.encode(text, add_special_tokens=False).ids

    def letters(self, word: bytes) -> list[int]:
        return [t.id for t in self.coder.model.tokenize(word.decode("latin-1").translate(self.alphabet))]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            text = word.decode()
            core = text.rstrip(TAIL)
            if core != text and core.lower().isalpha():
                ids = self[core.encode()] + self[text[len(core):].encode()]
            elif self.direct and text.isalpha() and max(text) < "\u0180" and text == text.lower():
                ids = array("I", self.letters(word)).tobytes()
            else:
                ids = array("I", self.whole(text)).tobytes()
        if len(self) >= WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def text(self, text: bytes) -> bytes:
        """Ids of a text: word by word, or at once by a tokenizer for which case or white space matter."""
        if not self.apart:
            return array("I", self.whole(text.decode())).tobytes()
        if b"<|" not in text:
            text = text.lower()                  # ASCII letters only, as these are bytes
        return b"".join(map(self.__getitem__, text.replace(b"\n", b" ").split(b" ")))


def pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, piece, start, length, ids_crc32)`` and ``ids`` (little-endian unsigned 32 bits) on request.

    ``tokenizer`` is the path of a tokenizers file that every executor can read.
    A document is its text's ids and END (a NULL text: END alone); only longer
    ones are cut, at multiples of ``limit``. If the tokenizer drops white space
    and case, a text is tokenized by its space-separated parts in lower case
    (as they are, where a special token may stand), each part once a worker.
    """
    def run(batches):
        from tokenizers import Tokenizer
        known, end = WordIds(Tokenizer.from_file(tokenizer)), array("I", [END]).tobytes()

        def cut(i, text):
            data = known.text(text or b"") + end
            for n, b in enumerate(range(0, len(data), 4 * limit)):
                own = data[b:b + 4 * limit]
                yield (i, n, b // 4, len(own) // 4, zlib.crc32(own)) + ((own,) if ids else ())

        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * ids
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = part.column("text").cast(pa.binary())
                cols = [pa.array(c, k) for c, k in zip(zip(*(x for i, t in enumerate(texts) for x in cut(i, t.as_py()))), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(cols[0]), *cols[1:]], names=names)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else ""))


def best_fit(lengths, limit: int = LIMIT, most: int = OPEN):
    """(bin, offset) of every length, in order, and the set of bins that are still open at the end."""
    by_free: list[list[int]] = [[] for _ in range(limit + 1)]
    bits, open_, used, out = 0, 0, 0, []
    for n in lengths:
        fit = bits >> n
        if fit:
            free = n + (fit & -fit).bit_length() - 1
            bin_ = by_free[free].pop()
            if not by_free[free]:
                bits ^= 1 << free
        else:
            if open_ == most:                        # the fullest closes
                free = (bits & -bits).bit_length() - 1
                by_free[free].pop()
                if not by_free[free]:
                    bits ^= 1 << free
                open_ -= 1
            free, bin_ = limit, used
            used, open_ = used + 1, open_ + 1
        out.append((bin_, limit - free))
        free -= n
        if free:
            by_free[free].append(bin_)
            bits |= 1 << free
        else:
            open_ -= 1
    return out, {b for bins in by_free for b in bins}


def group_plan(rows: int, tokens: int, limit: int, most: int, rows_per_group: int) -> tuple[int, int]:
    """(rows of a group, free places up to which a bin closes).

    A group leaves up to ``most`` bins open, so it must fill several times as
    many: short pieces come in larger groups, up to MORE times the usual. Where
    even those fill few bins, the pieces are so short that a bin is as good as
    full when no more than one of them could fit. So every round leaves about half of its
    rows at most, and the number of rounds grows with the logarithm of the rows.
    """
    mean = max(1.0, tokens / max(1, rows))
    size = int(min(MORE * rows_per_group, max(rows_per_group, 8 * most * limit / mean)))
    return size, int(mean) + 1 if size * mean < 2 * most * limit else 0


def pack(rows: DataFrame, limit: int = LIMIT, most: int = OPEN, rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """``rows`` with a column ``length`` (1 .. limit) and ``sequence_id``, ``offset``: every row placed, sequences gapless from 0.

    Columns of these names are replaced. Rows that are equal in all columns are
    packed one by one. An empty input gives an empty result.
    """
    rows = rows.drop("sequence_id", "offset")
    columns = rows.columns
    # the row number is drawn when the rows are written, so that no retry deals them anew
    waiting = written(rows.select(F.struct(*columns).alias("row"), F.col("length").cast("int").alias("n"),
                                  F.monotonically_increasing_id().alias("at")), "pieces")
    def state(df):
        return df.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    (left, tokens), turn, closed = state(waiting), 0, []
    size, slack = group_plan(left, tokens, limit, most, rows_per_group)
    groups = max(1, -(-left // size))
    while True:
        last, salt, full = groups == 0, turn, slack

        def fill(key, found):
            found = found.sort_by([("n", "descending"), ("at", "ascending")] if last else "at")
            lengths = found.column("n").to_pylist()
            places, still = best_fit(lengths, limit, most)
            if full and not last:
                used = {}
                for n, (b, o) in zip(lengths, places):
                    used[b] = max(used.get(b, 0), o + n)
                still = {b for b in still if limit - used[b] > full}
            base = (salt << 56) + (key[0].as_py() << 24)
            return found.drop_columns(["group"]).append_column("sequence_id", pa.array([base + b for b, _ in places], pa.int64())) \
                .append_column("offset", pa.array([o for _, o in places], pa.int64())) \
                .append_column("open", pa.array([not last and b in still for b, _ in places], pa.bool_()))
        schema = StructType([*waiting.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType()),
                             StructField("open", BooleanType())])
        dealt = waiting.withColumn("group", F.pmod(F.xxhash64("at", F.lit(turn)), F.lit(max(1, groups))).cast("int"))
        done = written(dealt.groupBy("group").applyInArrow(fill, schema), "packed")
        closed.append(done.where("not open"))
        if last:
            break
        waiting = done.where("open").select("row", "n", "at")
        (left, tokens), turn = state(waiting), turn + 1
        size, slack = group_plan(left, tokens, limit, most, rows_per_group)
        groups = min(groups - 1, max(1, -(-left // size)))    # 0: what one group left open, longest first
    out = closed[0]
    for more in closed[1:]:
        out = out.union(more)
    return out.select("row.*", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ``ids`` to ``(sequence_id, n_ids, ids)``: the sequences themselves, at most the limit each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), parts.alias("parts")) \
        .select("sequence_id", "n_ids", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def vocabulary(name: str = TOKENIZER) -> str:
    """Path of a public tokenizer file, as installed on every machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def packed_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Documents tokenized and packed: one row a piece."""
    return pack(pieces(docs.select("doc_id", "text"), tokenizer or vocabulary())) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1(spark, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 4096 ids, packed into sequences."""
    return packed_documents(table(spark, sf_dir, "documents"))
