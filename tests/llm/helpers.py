"""Fixture tables and plain versions of the training-data operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: names that operators use inside, as extra columns of the input tables
CLASHES = ["fp", "n", "row", "h", "key", "id", "shard", "slot", "length", "offset", "sequence_id", "score", "lang_pred", "rejected",
           "component_id", "units", "print", "slice", "next", "d", "gone", "kept", "part", "first", "tree", "node"]


def save(spark, path, docs, benchmark=(), pages=(), conversations=(), clash=False, labels=(), embeddings=()):
    """A folder of tables; ``docs``: (doc_id, text, lang)."""
    from pyspark.sql import functions as F

    def put(df, name):
        if clash:
            df = df.withColumns({c: F.lit(7) for c in CLASHES if c not in df.columns})
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    rows = [(i, t, lang, "src", None if t is None else len(t)) for i, t, lang in docs]
    put(spark.createDataFrame(rows, DOCS), "documents")
    put(spark.createDataFrame(list(benchmark), "item_id bigint, text string"), "benchmark")
    put(spark.createDataFrame(list(pages), "page_id bigint, url string, html string"), "pages")
    put(spark.createDataFrame(list(conversations), "conv_id bigint, turn int, role string, text string"), "conversations")
    put(spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int"), "labels")
    put(spark.createDataFrame(list(embeddings), "vec_id bigint, embedding array<float>, label int"), "embeddings")
    return str(path)


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def corpus(seed=1, n=60):
    """Documents of two invented languages, exact and near copies, repeated lines, a leak, odd rows."""
    rng = random.Random(seed)
    one = ["the", "of", "and"] + ["".join(rng.choice(("ta", "lo", "ri", "men", "sk")) for _ in range(rng.randrange(2, 5))) for _ in range(300)]
    two = ["der", "und", "ist"] + ["".join(rng.choice(("ung", "ver", "zu", "ach", "keit")) for _ in range(rng.randrange(2, 5))) for _ in range(300)]
    docs = []
    for i in range(n):
        lang, vocabulary = (("xa", one), ("xb", two))[i % 2]
        docs.append((i, "\n".join(words(rng, rng.randrange(5, 30), vocabulary) for _ in range(rng.randrange(1, 6))), lang))
    item = words(rng, 30, one)
    line = words(rng, 12, two)
    docs[7] = (7, docs[7][1] + "\n" + item, "xa")
    for k in (11, 13, 21):
        docs[k] = (k, docs[k][1] + "\n" + line, "xb")
    docs[23] = (23, docs[23][1] + "\n" + line.replace("u", "o", 1), "xb")
    docs += [(n, docs[3][1], "xb"), (n + 1, docs[3][1] + " more", "xb"), (n + 2, words(rng, 20000, one), None),
             (n + 3, "", "xa"), (n + 4, None, "xa"), (n + 5, "a", None), (n + 6, "12 !!", "xb"), (n + 6, "12 !!", "xb"), (None, docs[5][1], "xb"),
             (None, None, None), (n + 7, "Ünï\u0301cøde \U0001F600 text\twith\u00a0odd <|endoftext|> spaces\r\n", "xa")]
    return docs, [(0, item), (1, words(rng, 25, two)), (2, None), (3, ""), (4, "ab")]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def connected(n, links):
    """Smallest member of each of 0 .. n-1's components."""
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
