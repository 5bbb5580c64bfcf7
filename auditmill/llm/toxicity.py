"""Toxicity by class-conditional Kneser-Ney models.

Two word-bigram models, of toxic and of ordinary labelled documents, share their lowest order: Kneser-Ney continuation
counts over both classes. An expression seen after fewer than `MIN_CONTEXTS` different words is rare; both classes score
it with the shared counts alone, so it does not count for either. A pair seen `MIN_PAIR` times has both classes' own
counts, also when its second word is rare; that word's share of the back-off is then the shared one. A rarer pair counts
as its second word alone; what its first word says, the ratio of both classes' back-off weights, is a figure of its own.

A document's figures are its length-normalised log-likelihood ratio, the mean ratio of its `TOP` most toxic expressions,
and the mean ratio of the back-off weights before its rare pairs; a logistic curve, fitted on labelled rows that the
counts have not seen, turns them into a score and so decides what rare evidence is worth.

The classifier is fitted on bounded samples of labelled rows, chosen by a hash of the id: `COUNT_ROWS` for the counts,
`CURVE_ROWS` for the curve. Scoring covers all rows and whole texts.

Defined results: null and empty texts have no words, their figures are 0 and their score is the curve's value there;
labels that are null teach nothing, a document labelled both ways is toxic; a null id counts as the empty text in the
split; repeated rows score alike, and all of them count in the samples' statistics, but no more than `CURVE_ROWS` rows
fit the curve. Without labels of both classes every score is the share of toxic ones (0 if none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import fresh, remainder, saved, text_or_empty

COUNT_ROWS, CURVE_ROWS = 20_000, 10_000
MIN_CONTEXTS, MIN_PAIR = 5, 12
DISCOUNT = 0.75
TOP = 3
THRESHOLD = 0.7
FIGURES = ("mean", "top", "rare", "words")
#: Documents whose figures are computed together.
SLICE = 256
#: Joins two word hashes to a pair's key, with wrap-around.
PAIR_FACTOR = -7046029254386353131


def token_hashes(text: Column) -> Column:
    """64-bit hashes of the lower-case words; models know words by these."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.xxhash64(w))


@dataclass
class Model:
    """Log-likelihood ratios of known expressions by sorted key, and the logistic curve over the figures."""

    word_keys: np.ndarray
    word_ratio: np.ndarray
    pair_keys: np.ndarray
    pair_ratio: np.ndarray
    context_keys: np.ndarray
    context_ratio: np.ndarray
    curve: np.ndarray | None = None
    prior: float = 0.0

    def ratios(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Per token log P(token | previous, toxic) - log P(token | previous, ordinary)."""
        return self.evidence(words, starts)[0]

    def evidence(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ratios, and per token that of the back-off weights before it (0 where its pair is known)."""
        previous = np.concatenate([[0], words[:-1]]) if len(words) else words
        previous[starts[starts < len(words)]] = 0
        with np.errstate(over="ignore"):
            pairs = previous * np.int64(PAIR_FACTOR) + words
        out, known = _look(self.pair_keys, self.pair_ratio, pairs)
        alone, _ = _look(self.word_keys, self.word_ratio, words)
        before, _ = _look(self.context_keys, self.context_ratio, previous)
        return np.where(known, out, alone), np.where(known, 0.0, before)

    def score(self, figures: np.ndarray) -> np.ndarray:
        if self.curve is None:
            return np.full(len(figures), self.prior)
        return 1 / (1 + np.exp(-np.clip(_design(figures) @ self.curve, -30, 30)))


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0.0), known


def _design(figures: np.ndarray) -> np.ndarray:
    mean, top, rare, words = figures.T
    return np.column_stack([np.ones(len(figures)), np.clip(mean, -2, 2), np.clip(top, -2, 8), np.clip(rare, -2, 2), np.log1p(words)])


def figures_of(model: Model, hashes: pa.ListArray) -> np.ndarray:
    """Per document: mean ratio, mean of the TOP largest ratios (missing ones count 0), mean back-off ratio, number of words."""
    # A slice at a time, so that a batch's intermediate arrays stay small.
    parts = [_figures_of(model, hashes.slice(at, SLICE)) for at in range(0, len(hashes), SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FIGURES)))


def _figures_of(model: Model, hashes: pa.ListArray) -> np.ndarray:
    offsets = hashes.offsets.to_numpy()
    words = hashes.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    ratios, rare = model.evidence(words, offsets[:-1])
    out = np.zeros((len(hashes), len(FIGURES)))
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        if b > a:
            own = ratios[a:b]
            best = own if b - a <= TOP else np.partition(own, b - a - TOP)[-TOP:]
            out[i] = own.mean(), np.maximum(best, 0).sum() / TOP, rare[a:b].mean(), b - a
    return out


def _counted(docs: DataFrame) -> DataFrame:
    """Pair counts per class (h, w, c0, c1) of rows (toxic, hashes); h is 0 at a text's start."""
    pairs = F.explode(
        F.zip_with(F.concat(F.array(F.lit(0).cast("bigint")), F.slice("hashes", 1, F.greatest(F.size("hashes") - 1, F.lit(0)))),
                   "hashes", lambda h, w: F.struct(h.alias("h"), w.alias("w")))
    )
    one = lambda y: F.sum((F.col("toxic") == y).cast("bigint"))
    return (
        docs.where(F.size("hashes") > 0).select("toxic", pairs.alias("p")).groupBy("p.h", "p.w")
        .agg(one(0).alias("c0"), one(1).alias("c1"))
    )


def fit_counts(docs: DataFrame) -> Model:
    """Both classes' models from rows (toxic, hashes), as ratio tables of bounded size."""
    pairs = _counted(docs)
    blank = F.lit(None).cast("bigint")
    types = [F.sum((F.col(c) > 0).cast("bigint")).alias(t) for c, t in (("c0", "t0"), ("c1", "t1"))]
    sums = [F.sum("c0").alias("c0"), F.sum("c1").alias("c1")]
    # One job makes all three groupings from one shuffle of the pairs.
    stats = saved(
        pairs.where(F.col("c0") + F.col("c1") >= MIN_PAIR)
        .select("h", "w", "c0", "c1", blank.alias("t0"), blank.alias("t1"), blank.alias("contexts"))
        .unionByName(pairs.groupBy("h").agg(*sums, *types).withColumn("w", blank).withColumn("contexts", blank))
        .unionByName(
            pairs.groupBy("w").agg(*sums, F.count("*").alias("contexts"))
            .withColumn("h", blank).withColumn("t0", blank).withColumn("t1", blank)
        ),
        "toxic_counts",
    )
    words = stats.where("contexts IS NOT NULL").select("w", "c0", "c1", "contexts")
    before = stats.where("t0 IS NOT NULL").select("h", F.col("c0").alias("n0"), F.col("c1").alias("n1"), "t0", "t1")
    total = words.agg(
        F.sum("c0"), F.sum("c1"), F.sum((F.col("c0") > 0).cast("bigint")), F.sum((F.col("c1") > 0).cast("bigint")), F.sum("contexts")
    ).first()
    n0, n1, v0, v1, contexts = (float(x or 0) for x in total)
    if not n0 or not n1:
        empty = np.empty(0, np.int64), np.empty(0)
        return Model(*empty, *empty, *empty)
    shared = F.col("contexts") / contexts

    def alone(c: str, n: float, types: float) -> Column:
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / n + DISCOUNT * types / n * shared

    common = F.col("contexts") >= MIN_CONTEXTS
    known = words.select(
        "w", common.alias("common"),
        F.when(common, alone("c0", n0, v0)).otherwise(shared).alias("p0"),
        F.when(common, alone("c1", n1, v1)).otherwise(shared).alias("p1"),
    )

    def after(i: int) -> Column:
        own = F.greatest(F.col(f"c{i}") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"t{i}") * F.col(f"p{i}")
        return F.when(F.col(f"n{i}") > 0, own / F.col(f"n{i}")).otherwise(F.col(f"p{i}"))

    frequent = stats.where("h IS NOT NULL AND w IS NOT NULL").select("h", "w", "c0", "c1")
    joined = frequent.join(known.select("w", "p0", "p1"), "w").join(before, "h")
    pair = joined.select("h", "w", F.log(after(1) / after(0)).alias("ratio"))
    word = known.where("common").select("w", F.log(F.col("p1") / F.col("p0")).alias("ratio"))
    weight = lambda i: F.when(F.col(f"n{i}") > 0, DISCOUNT * F.col(f"t{i}") / F.col(f"n{i}")).otherwise(F.lit(1.0))
    context = before.select("h", F.log(weight(1) / weight(0)).alias("ratio")).where("ratio <> 0")
    # The samples bound all three.
    w, p, c = word.toArrow(), pair.toArrow(), context.toArrow()
    with np.errstate(over="ignore"):
        keys = p["h"].to_numpy() * np.int64(PAIR_FACTOR) + p["w"].to_numpy()
    tables = (w["w"].to_numpy(), w["ratio"]), (keys, p["ratio"]), (c["h"].to_numpy(), c["ratio"])
    return Model(*(column for keys, ratio in tables for column in _sorted(keys, ratio.to_numpy())))


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    return keys[order], values[order]


def fit_curve(figures: np.ndarray, toxic: np.ndarray) -> np.ndarray | None:
    """Logistic regression by Newton steps with a light ridge."""
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    x = _design(figures)
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _shared(rows: DataFrame, model: Model):
    return rows.sparkSession.sparkContext.broadcast(vars(model))  # the samples bound it


def _figures(rows: DataFrame, model: Model) -> Column:
    """The figures of the column `hashes`, as a struct; no other column reaches Python."""
    shared = _shared(rows, model)

    @F.arrow_udf(f"struct<{', '.join(f'{f}: double' for f in FIGURES)}>")
    def figures(hashes: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(list(map(pa.array, figures_of(Model(**shared.value), hashes).T)), FIGURES)

    return figures("hashes")


def score_of(rows: DataFrame, model: Model) -> Column:
    """The score of the documents' column `text`, null as empty."""
    shared = _shared(rows, model)

    @F.arrow_udf("double")
    def score(hashes: pa.Array) -> pa.Array:
        own = Model(**shared.value)
        return pa.array(own.score(figures_of(own, hashes)))

    return score(token_hashes(text_or_empty()))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model, learned from labelled rows outside the held-out third; nothing but text and label is used."""
    known = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(remainder(F.col("doc_id"), 3) != 1)
    order = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    # Two disjoint bounded samples; they are small enough for the join to send them to every reader of the texts.
    part = lambda which, rows: (
        known.where((F.pmod(F.xxhash64(F.lit("curve"), "doc_id"), F.lit(3)) == 0) == which).orderBy(order, "doc_id").limit(rows)
        .withColumn("curve", F.lit(which))
    )
    sample = F.broadcast(part(False, COUNT_ROWS).unionByName(part(True, CURVE_ROWS)))
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(sample, "doc_id")
    rows = rows.select("curve", "doc_id", F.col("toxic").cast("int").alias("toxic"), token_hashes(F.col("text")).alias("hashes"))
    model = fit_counts(rows.where("NOT curve").select("toxic", "hashes"))
    # A figure per sampled row; CURVE_ROWS bounds them but for repeated rows, so they are cut to it here.
    figured = rows.where("curve").select("doc_id", F.xxhash64("hashes").alias("same"), "toxic", _figures(rows, model).alias("f"))
    held = figured.orderBy("doc_id", "same").limit(CURVE_ROWS).select("toxic", "f.*").toArrow()
    toxic = held["toxic"].to_numpy().astype(float)
    figures = np.column_stack([held[c].to_numpy() for c in FIGURES]) if len(toxic) else np.zeros((0, len(FIGURES)))
    model.curve, model.prior = fit_curve(figures, toxic), float(toxic.mean()) if len(toxic) else 0.0
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), score_of(docs, fit(docs, labels)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with all columns of `docs`; only word hashes and scores pass through Python."""
    score = fresh(docs.columns, "score")
    rows = docs.select(*(F.col(f"`{c}`") for c in docs.columns), score_of(docs, fit(docs, labels)).alias(score))
    return rows.where(F.col(score) < THRESHOLD).drop(score)
