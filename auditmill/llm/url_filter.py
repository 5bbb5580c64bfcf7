"""URL filter: rules by host suffix and path, and boosted trees on lexical features for the URLs that no rule covers.

The labelled URLs that train the trees are, by default, those that a rule decides; every distinct one is used. What a URL's
suffix says is counted over all others of them, in training as in judging, and the trees' thresholds come from all of them
too. Judging covers all rows.

Defined results: a null URL, or one without `://`, has an empty host and path, fits no rule and is judged by the trees
from its features; of two rules that fit, the longer wins (block, if they are equally long); repeated rows are judged
alike and teach once; without labelled URLs of both kinds the verdict is the one kind that occurs, or allow; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import let, saved

#: (verdict, host, path), as the contract lists them.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ROUNDS, DEPTH, STEP, BINS = 12, 3, 0.3, 32
FEATURES = (
    "url_chars", "host_chars", "path_chars", "labels", "depth", "digit_ratio", "host_digit_ratio", "hyphens", "entropy",
    "parameters", "query_chars", "has_fragment", "is_https", "suffix_block_rate", "suffix_count",
)
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The winning rule as a struct (rule, verdict), or null."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = lambda h, p: ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in reversed(longest):
        out = F.when(fits(h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character."""

    def of_chars(chars: Column) -> Column:
        n = F.size(chars)
        share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
        parts = F.transform(F.array_distinct(chars), lambda c: let(share(c), lambda p: -p * F.log2(p)))
        return F.when(n == 0, F.lit(0.0)).otherwise(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))

    return let(F.filter(F.split(text, ""), lambda c: c != ""), of_chars)


def lexical(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, suffix, ...features but for the suffix statistics)."""
    base = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    size = lambda text: F.char_length(text).cast("double")
    ratio = lambda text: F.when(F.char_length(text) > 0, count(text, "[0-9]") / F.char_length(text)).otherwise(F.lit(0.0))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return base.select(
        "page_id", "url", "host", "path", F.substring_index(host, ".", -1).alias("suffix"),
        size(url).alias("url_chars"), size(host).alias("host_chars"), size(path).alias("path_chars"),
        (count(host, r"\.") + 1).alias("labels"), count(path, "/").alias("depth"),
        ratio(url).alias("digit_ratio"), ratio(host).alias("host_digit_ratio"), count(host, "-").alias("hyphens"),
        entropy(host).alias("entropy"), count(query, "[^&=]+=").alias("parameters"), size(query).alias("query_chars"),
        F.contains(url, F.lit("#")).cast("double").alias("has_fragment"),
        F.startswith(url, F.lit("https:")).cast("double").alias("is_https"),
    )


def taught_by(labelled: DataFrame) -> DataFrame:
    """The distinct rows (url, label), label 0 or 1 (block), with their features, in the same order in every run."""
    rows = labelled.select("url", "label").distinct().orderBy(F.xxhash64("url"), "url", "label")
    return lexical(rows.select(F.col("label").alias("page_id"), "url")).withColumnRenamed("page_id", "label")


def suffix_statistics(taught: DataFrame) -> DataFrame:
    """(suffix, blocked, known): per host suffix of the training URLs the blocked ones and all."""
    return taught.groupBy("suffix").agg(F.sum("label").alias("blocked"), F.count("*").cast("double").alias("known"))


def with_suffix_features(rows: DataFrame, known: DataFrame, prior: float, own: bool) -> DataFrame:
    """Block rate of the suffix, drawn to that of all training URLs, and its count. `own`: the rows are the training URLs
    themselves, and each leaves itself out."""
    joined = rows.join(known, "suffix", "left").fillna({"blocked": 0.0, "known": 0.0})
    blocked, others = (F.col("blocked") - F.col("label"), F.col("known") - 1) if own else (F.col("blocked"), F.col("known"))
    return joined.withColumns({"suffix_block_rate": (blocked + 5 * prior) / (others + 5), "suffix_count": F.log1p(others)})


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, block_score. `labelled` (url, label) replaces the rules' decisions as the training set."""
    rows = lexical(pages).withColumn("decided", rule_of(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = rows.where("decided IS NOT NULL").select("url", (F.col("decided.verdict") == "block").alias("label"))
    taught = taught_by(labelled.withColumn("label", F.col("label").cast("double")))
    taught = saved(taught, "url_training")
    prior = taught.agg(F.avg("label")).first()[0]
    if prior is None or prior in (0.0, 1.0):
        score = rows.withColumn("block_score", F.lit(prior or 0.0))
    else:
        score = _boosted(rows, taught, prior)
    return score.select(
        "page_id", "host", "path", F.col("decided.rule").alias("rule"),
        F.coalesce(F.col("decided.verdict"), F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        F.round("block_score", 6).alias("block_score"),
    )


def _boosted(rows: DataFrame, taught: DataFrame, prior: float) -> DataFrame:
    known = saved(suffix_statistics(taught), "url_suffixes")
    own = with_suffix_features(taught, known, prior, True).select("label", *FEATURES)
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    bins = max(BINS, isqrt(taught.count()) + 1)  # Spark proposes thresholds from bins^2 rows, here no fewer than all
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=STEP, maxBins=bins, seed=7
    ).fit(assembled.transform(own).select("label", "features"))
    judged = trees.transform(assembled.transform(with_suffix_features(rows, known, prior, False)))
    return judged.withColumn("block_score", F.get(vector_to_array("probability"), F.lit(1)))
