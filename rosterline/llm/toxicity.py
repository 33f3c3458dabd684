"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts with a confirmed label 1, the unlabelled ones a sample of
all learning texts whatever their labels. Linear classifiers over hashed words
and word beginnings are trained in numpy, one a task, on the risk

    prior * E_P[loss(g, +)] + max(0, E_U[loss(g, -)] - prior * E_P[loss(g, -)])

with the logistic loss; where the bracket is negative, its own gradient is
climbed instead (the non-negative correction). The class prior is the share of
label 1 among the labelled learning texts. Their mean scores every whole text.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterline.llm import wordspans
from rosterline.llm.common import cut, table, written
from rosterline.llm.langid import held_out

POSITIVES = 4096        # distinct texts with label 1 that are learned from, about
UNLABELLED = 12288      # distinct texts of the unlabelled sample, about
CLASSIFIERS = 4         # each takes all positives and leaves out its share of the unlabelled texts
BITS = 18               # of a feature's number
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginnings that are features beside the word
SHARPNESS = 5.0         # standard errors by which a feature must be more frequent in the positives
LEAST = 3               # positives that hold a feature
PRIOR = 0.1             # used if only one kind of label is known
STEPS, RATE, MOMENTUM, DECAY = 150, 0.5, 0.9, 1e-4
SLACK = 0.0             # risk below minus this is climbed
THRESHOLD = 0.3
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True      # digits, letters and whatever isn't ASCII


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) for every word and its beginnings in a chunk of texts, repeats included."""
    low = LOWER[data]
    start, end, doc, _ = wordspans.spans(WORD[low], off)
    hashes = wordspans.Hashes(low)
    own, text = [wordspans.mixed(hashes.of(start, end) + np.uint64(1))], [doc]
    for n in BEGINNINGS:
        longer = end - start > n
        own.append(hashes.of(start[longer], start[longer] + n))
        text.append(doc[longer])
    return np.concatenate(text), (np.concatenate(own) >> np.uint64(64 - BITS)).astype(np.int64)


def present(texts: pa.Array):
    """The features of each text, each once, as a list array's chunks."""
    for first, last, data, off in wordspans.chunks(texts):
        doc, feature = features(data, off)
        pairs = np.unique((doc << BITS) | feature)
        sizes = np.bincount(pairs >> BITS, minlength=last - first)
        yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                       pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(positive: list, unlabelled: list, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of one classifier, from the features of each text.

    Features enter that are clearly more frequent in the positives than in the unlabelled texts.
    """
    size = 1 << BITS
    n_p, n_u = len(positive), len(unlabelled)
    bias = math.log(prior / (1 - prior))
    if not n_p or not n_u:
        return np.zeros(size), bias
    f_p, f_u = np.concatenate(positive), np.concatenate(unlabelled)
    d_p, d_u = np.bincount(f_p, minlength=size), np.bincount(f_u, minlength=size)
    both = (d_p + d_u) / (n_p + n_u)
    used = (d_p >= LEAST) & (d_p / n_p - d_u / n_u > SHARPNESS * np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u)))
    number = np.cumsum(used) - 1
    r_p, r_u = np.repeat(np.arange(n_p), [len(x) for x in positive]), np.repeat(np.arange(n_u), [len(x) for x in unlabelled])
    (f_p, r_p), (f_u, r_u) = ((number[f[used[f]]], r[used[f]]) for f, r in ((f_p, r_p), (f_u, r_u)))
    w, move, push = np.zeros(int(used.sum())), np.zeros(int(used.sum())), 0.0
    for _ in range(STEPS):
        g_p, g_u = bias + np.bincount(r_p, w[f_p], n_p), bias + np.bincount(r_u, w[f_u], n_u)
        s_p, s_u = _sigmoid(g_p), _sigmoid(g_u)
        rest = np.logaddexp(0, g_u).mean() - prior * np.logaddexp(0, g_p).mean()
        if rest >= -SLACK:
            c_p, c_u = -prior / n_p * np.ones(n_p), s_u / n_u            # of the whole risk: prior (s - 1) - prior s
        else:
            c_p, c_u = prior * s_p / n_p, -s_u / n_u
        slope = np.bincount(f_p, c_p[r_p], len(w)) + np.bincount(f_u, c_u[r_u], len(w)) + DECAY * w
        move = MOMENTUM * move - RATE * slope
        push = MOMENTUM * push - 0.1 * RATE * (c_p.sum() + c_u.sum())
        w, bias = w + move, bias + push
    out = np.zeros(size)
    out[used] = w
    return out, float(bias)


def _sampled(keys: DataFrame, most: int) -> DataFrame:
    """About ``most`` of the distinct ``keys(h)``, those below a bound of the hash; all if there are fewer."""
    n = keys.count()
    return keys.where(F.pmod(F.xxhash64("h"), F.lit(1 << 30)) < int(min(1.0, most / max(n, 1)) * (1 << 30)))


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None):
    """``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` to (weights, bias), or None without a positive.

    Texts count once however often they are copied; a text is a positive if any
    of its rows is labelled 1. Only hashes of texts are joined with the labels;
    the texts themselves are picked by the hashes of the two bounded samples.
    Memory of a training task grows with the sampled texts' distinct features.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    marks = labels.where("toxic in (0, 1)").select(F.col("doc_id").alias("l_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    known = cut(docs.select("doc_id", "h").join(marks, F.col("doc_id") == F.col("l_id")).groupBy("h").agg(F.max("toxic").alias("toxic")))
    if prior is None:
        share = known.agg(F.avg("toxic")).first()[0] or 0.0
        prior = share if 0 < share < 1 else PRIOR
    chosen = _sampled(known.where("toxic = 1").select("h"), positives).withColumn("positive", F.lit(True)) \
        .union(_sampled(cut(docs.select("h").distinct()), unlabelled).withColumn("positive", F.lit(False)))
    chosen = cut(chosen.groupBy("h").agg(F.max("positive").alias("p"), F.max(~F.col("positive")).alias("u")).withColumnRenamed("h", "k"))
    if not chosen.where("p").limit(1).count():
        return None

    def bags(batches):
        for batch in batches:
            at = 0
            for bag in present(batch.column("text")):
                part = batch.slice(at, len(bag))
                at += len(bag)
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("p"), part.column("u"), bag], names=["h", "p", "u", "bag"])
    # the samples' hashes: at most about POSITIVES + UNLABELLED rows
    picked = docs.join(F.broadcast(chosen), F.col("h") == F.col("k")).select("h", "p", "u", "text") \
        .mapInArrow(bags, "h bigint, p boolean, u boolean, bag array<int>")
    picked = written(picked.groupBy("h").agg(F.first("p").alias("p"), F.first("u").alias("u"), F.first("bag").alias("bag")), "toxic-sample")
    shares = picked.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(CLASSIFIERS - 1)))) \
        .withColumn("u", F.col("u") & (F.pmod(F.col("h"), F.lit(CLASSIFIERS)) != F.col("model"))).where("p or u")

    def fit(model: pa.Table) -> pa.Table:
        model = model.sort_by("h")
        bags_, p, u = (model.column(c).to_numpy(zero_copy_only=False) for c in ("bag", "p", "u"))
        w, bias = train([b for b, x in zip(bags_, p) if x], [b for b, x in zip(bags_, u) if x], prior)
        return pa.table({"weights": pa.array([w.astype("<f8").tobytes()], pa.binary()), "bias": [bias]})
    models = shares.select("model", "h", "p", "u", "bag").groupBy("model").applyInArrow(fit, "weights binary, bias double").collect()       # CLASSIFIERS rows of 2 MB
    return np.mean([np.frombuffer(m["weights"], "<f8") for m in models], 0), float(np.mean([m["bias"] for m in models]))


def score(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from THRESHOLD on, else 0), of each whole text.

    The score is the probability of the sum of the weights of the text's
    features, each once, so length and repetition don't matter. NULL texts are
    empty; without a model every score is 0. Columns of those names are replaced.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType
    docs = docs.drop("score", "predicted")
    if model is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)})
    own = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*own).withColumn("whole", F.coalesce(F.col(own[docs.columns.index("text")]), F.lit("")))
    kept = [c for c in own if c != own[docs.columns.index("text")]]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        weights, bias = shared.value
        used = weights != 0
        for batch in batches:
            sums = []
            for first, last, data, off in wordspans.chunks(batch.column("whole")):
                doc, feature = features(data, off)
                hit = used[feature]
                pairs = np.unique((doc[hit] << BITS) | feature[hit])
                sums.append(bias + np.bincount(pairs >> BITS, weights[pairs & ((1 << BITS) - 1)], last - first))
            s = _sigmoid(np.concatenate(sums)) if sums else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(s)], names=[*kept, "score"])
    names = [c for c in docs.columns if c != "text"]
    fields = {f.name: f for f in plain.schema.fields}
    rows = plain.mapInArrow(judge, StructType([*[fields[c] for c in kept], StructField("score", DoubleType())]))
    rows = rows.toDF(*names, "score")
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op12(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from three quarters of the documents and their labels.

    Documents without doc_id are scored; they have no label.
    """
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs.where(~held_out()).select("doc_id", "text"), labels.where(~held_out()).select("doc_id", "toxic"))
    return score(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "score", "predicted")
