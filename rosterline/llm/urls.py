"""URL filter: fixed rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones. The trees are fitted on a
bounded sample of them (about ``SAMPLE`` distinct URLs of both verdicts); suffix
statistics are counted over all labelled rows; every URL is judged.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterline.llm.common import bounded_sample, cut, table

#: (rule, verdict): host and path in one, a path begins at the first slash.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
SAMPLE = 20_000
TREES, DEPTH = 12, 4
PRIOR = 20.0        # rows of the overall rate mixed into each suffix's rate
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_chars", "host_chars", "path_chars", "depth", "labels", "digits", "entropy", "params", "query_chars",
            "marks", "hyphens", "secure", "fragment", "tld_rate", "domain_rate"]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for NULL and without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest fitting rule (ties: the longer host), or NULLs."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):
        at, start = text[:text.index("/")], text[text.index("/"):]
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the URL's text alone; every one is 0 for an empty text."""
    size = F.char_length(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    count = lambda c, p: F.regexp_count(c, F.lit(p)).cast("double")
    chars = F.array_distinct(F.split(url, ""))
    share = lambda x: (size - F.char_length(F.replace(url, x, F.lit("")))) / size
    bits = F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(0.0), lambda a, x: a - share(x) * F.log2(share(x)))
    return {"url_chars": size.cast("double"), "host_chars": F.char_length(host).cast("double"),
            "path_chars": F.char_length(path).cast("double"), "depth": count(path, "/[^/]"), "labels": count(host, r"\."),
            "digits": F.when(size > 0, count(url, "[0-9]") / size).otherwise(0.0),
            "entropy": F.when(size > 0, bits).otherwise(0.0),
            "params": F.when(query != "", count(query, "&") + 1).otherwise(0.0), "query_chars": F.char_length(query).cast("double"),
            "marks": count(url, r"[%_~@=,;!]"), "hyphens": count(host, "-"), "secure": F.startswith(url, F.lit("https")).cast("double"),
            "fragment": F.contains(url, F.lit("#")).cast("double")}


def _rates(known: DataFrame, suffix: str) -> DataFrame:
    """Share of blocked URLs by suffix over all labelled rows, drawn towards the overall share."""
    overall = known.agg(F.avg("blocked").alias("all")).first()["all"] or 0.0
    sums = known.groupBy(suffix).agg(F.count("*").alias("n"), F.sum("blocked").alias("b"))
    return cut(sums.select(F.col(suffix).alias("s_" + suffix),
                           ((F.col("b") + PRIOR * overall) / (F.col("n") + PRIOR)).alias(suffix + "_rate"))), overall


def judge(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages(page_id, url)`` to ``(page_id, host, path, rule, verdict, score)``, one row for each.

    ``rules`` are a short list (they become one expression). ``score`` is the
    trees' probability of ``block`` for every URL, whether a rule fits or not.
    Without labelled URLs the verdict is ``allow``, with labels of one kind
    that kind. Repeated rows and NULL page_ids are judged like any other.
    """
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "by_rule": verdict})
    rows = rows.withColumns(lexical(F.col("url"), F.col("host"), F.col("path")))
    rows = rows.withColumns({"tld": F.substring_index("host", ".", -1), "domain": F.substring_index("host", ".", -2)})
    known = rows.where("rule is not null").withColumn("blocked", (F.col("by_rule") == "block").cast("double"))
    (tlds, overall), (domains, _) = _rates(known, "tld"), _rates(known, "domain")

    def full(df):
        return df.join(tlds, df["tld"] == tlds["s_tld"], "left").join(domains, df["domain"] == domains["s_domain"], "left") \
            .fillna(overall, ["tld_rate", "domain_rate"])
    if not 0 < overall < 1:
        guess = F.lit("block" if overall == 1 else "allow")
        out = rows.withColumn("score", F.lit(float(overall)))
    else:
        guess = F.when(F.col("prediction") == 1, "block").otherwise("allow")
        # one row a URL, so that copies cannot fill the sample; rules give equal URLs equal labels
        keys = known.select(F.col("url").alias("key"), F.col("blocked").alias("label")).distinct()
        chosen = F.broadcast(bounded_sample(keys, sample).select("key"))              # 1.1 x sample rows at most
        fitted = full(known.join(chosen, F.col("url") == F.col("key"), "left_semi").dropDuplicates(["url"])).orderBy(F.xxhash64("url"), "url")
        gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
        model = GBTClassifier(labelCol="blocked", maxIter=TREES, maxDepth=DEPTH, seed=42).fit(gather.transform(fitted).select("features", "blocked"))
        from pyspark.ml.functions import vector_to_array
        out = model.transform(gather.transform(full(rows))).withColumn("score", vector_to_array("probability")[1])
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", guess).alias("verdict"), "score")


def op3(spark, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, else by the trees."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
