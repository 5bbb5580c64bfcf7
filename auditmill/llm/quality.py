"""Quality rules whose cutoffs are certified on labelled documents. DataFrame functions only.

A rule is a figure of a document with a ladder of cutoffs from strict to lax. For each stratum (language) and rule, the
labelled good documents say how many each cutoff would reject; a cutoff may be used only if the exact binomial test
rejects "its false rejection rate exceeds alpha" at the level delta / (rules x strata). The tests of one ladder are taken
from lax to strict and end at the first failure, which needs no further correction. The rates add up over the rules, so
with probability 1 - delta no stratum loses more than `alpha` of its good documents to the certified rules. A stratum
with too few labels to certify anything keeps its documents.

Defined results: null and blank texts have no words and fail the base rule; repeated rows are judged alike; a document
that carries several labels counts as good if one of them says so; null labels and unlabelled documents certify nothing;
languages outside `STRATA` (null too) share the stratum "other"; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import BLANKS, fresh, let, saved, text_or_empty, words_of

STRATA = ("en", "de", "fr", "es")
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rejections of good documents allowed per stratum over all rules, and the chance that the guarantee fails.
ALPHA, DELTA = 0.03, 0.05
#: Cutoffs from strict to lax: a document is above a cutoff when its figure is greater.
LADDERS = {
    "symbols_per_char": (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5),
    "dup_line_share": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.8),
    "repeat_word_share": (0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45),
    "chars_per_word": (6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0),
    "capital_share": (0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8),
    "shouts_per_word": (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 0.8, 1.0),
}


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, "")).cast("bigint")


def _upper(key: Column) -> Column:
    return F.shiftright(key, 32)


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text, the first occurrence included.

    Windows become longs (32 bits of hash, 32 of position), whose sorted neighbours give candidates; the candidates'
    words are then compared themselves, so that equal hashes of different windows do not count.
    """
    low = F.lit(0xFFFFFFFF).cast("bigint")

    def keys(w: Column) -> Column:
        window = lambda i: F.hash(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.shiftleft(window(i).cast("bigint"), 32).bitwiseOR(i.cast("bigint"))
        )

    def beside(array: Column, part, of=lambda x: x) -> Column:
        same = lambda x, j: F.coalesce(part(x) == part(F.get(array, j)), F.lit(False))
        return F.filter(array, lambda x, j: same(x, j - 1) | same(x, j + 1))

    def verified(w: Column, found: Column) -> Column:
        position = lambda x: x.bitwiseAND(low).cast("int")
        spelled = F.transform(
            found,
            lambda x: F.struct(
                F.concat_ws(" ", F.get(w, position(x)), F.get(w, position(x) + 1), F.get(w, position(x) + 2)).alias("s"),
                position(x).alias("p"),
            ),
        )
        return let(F.sort_array(spelled), lambda e: F.transform(beside(e, lambda x: x["s"]), lambda x: x["p"]))

    def covered(positions: Column) -> Column:
        step = lambda p, j: F.least(F.lit(3), F.coalesce(F.get(positions, j + 1) - p, F.lit(3)))
        return F.aggregate(F.transform(positions, step), F.lit(0).cast("bigint"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        candidates = let(F.sort_array(keys(w)), lambda k: beside(k, _upper))
        return let(
            candidates,
            lambda found: F.when(F.size(found) == 0, F.lit(0).cast("bigint")).otherwise(
                let(F.sort_array(verified(w, found)), covered)
            ),
        )

    return F.when(F.size(words) < 4, F.lit(0).cast("bigint")).otherwise(count(words))


def measured(df: DataFrame, name: str) -> DataFrame:
    """Adds the struct column `name` with the figures of each text."""
    words, body = fresh(df.columns, "_words"), fresh(df.columns, "_body")
    text, w = F.col(body), F.col(words)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    figures = F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        _without(text, BLANKS).alias("word_chars"),
        (F.char_length(text) - _without(text, SYMBOLS)).alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
        let(lines, lambda x: F.size(x).cast("bigint")).alias("n_lines"),
        repeated_words(w).alias("n_repeat_words"),
        (F.char_length(text) - _without(text, CAPITALS)).alias("n_capitals"),
        (F.char_length(text) - _without(text, "!")).alias("n_shouts"),
    )
    return df.withColumn(body, text_or_empty()).withColumn(words, words_of(text)).withColumn(name, figures).drop(body, words)


def base_failed(q: Column) -> Column:
    return (q["n_words"] < 50) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def rungs(q: Column) -> Column:
    """Per rule, how many of its cutoffs the document is above."""
    per = lambda a, b: F.when(q[b] > 0, q[a] / q[b]).otherwise(F.lit(0.0))
    figures = {
        "symbols_per_char": per("n_symbols", "word_chars"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_word_share": per("n_repeat_words", "n_words"),
        "chars_per_word": per("word_chars", "n_words"),
        "capital_share": per("n_capitals", "word_chars"),
        "shouts_per_word": per("n_shouts", "n_words"),
    }
    above = lambda value, cuts: sum((value > c).cast("int") for c in cuts)
    return F.array(*(above(figures[rule], cuts) for rule, cuts in LADDERS.items()))


def stratum(lang: Column) -> Column:
    return F.when(lang.isin(*STRATA), lang).otherwise(F.lit("other"))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial(n, rate), exactly, summed in logarithms; 1 when k is not below the mean."""
    odds = F.lit(rate / (1 - rate))
    first = n * F.log1p(F.lit(-rate))
    start = F.struct(first.alias("term"), first.alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i * odds)
        return let(
            term,
            lambda t: F.struct(
                t.alias("term"),
                (F.greatest(acc["total"], t) + F.log1p(F.exp(-F.abs(acc["total"] - t)))).alias("total"),
            ),
        )

    counted = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.exp(F.aggregate(counted, start, step, lambda acc: acc["total"]))
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(tail)


def certified(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """From good labelled rows (stratum, rungs): per stratum the rung of each rule from which a document is rejected.

    At most one row per stratum, whatever the size of the input; rules without a certified cutoff have a null rung.
    """
    rules, tests = len(LADDERS), len(LADDERS) * (len(STRATA) + 1)
    steps = max(map(len, LADDERS.values()))
    each = F.posexplode("rungs").alias("rule", "rung")
    at = F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("cutoff")
    counts = good.select("stratum", each).groupBy("stratum", "rule", "rung").agg(F.count("*").alias("n"))
    # Rejected by a cutoff: the documents on its rung or above. The counts are few, whatever the input.
    rejected = (
        counts.select("stratum", "rule", "rung", "n", at)
        .groupBy("stratum", "rule", "cutoff")
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("rung") >= F.col("cutoff"), F.col("n")).otherwise(0)).alias("k"))
    )
    ladder_length = F.element_at(F.array(*(F.lit(len(c)) for c in LADDERS.values())), F.col("rule") + 1)
    passed = rejected.where(F.col("cutoff") <= ladder_length).where(
        binomial_tail(F.col("k"), F.col("n"), alpha / rules) <= delta / tests
    )
    # k falls with the cutoff, so the laxest cutoffs pass first and the smallest that passes ends the sequence.
    chosen = passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judged(docs: DataFrame, labels: DataFrame, carry: list[str], alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The `carry` columns and (doc_id, lang, text)'s figures, base_failed, kept; figures are computed and stored once."""
    q = fresh(docs.columns, "_figures")
    inner = F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row") if carry else F.lit(None).alias("row")
    source = measured(docs.select("doc_id", "lang", "text", inner), q).select(
        "row", "doc_id", stratum(F.col("lang")).alias("stratum"), q
    )
    rows = saved(source.select("row", "doc_id", "stratum", F.col(q).alias("q")), "quality")
    rows = rows.withColumns({"base_failed": base_failed(F.col("q")), "rungs": rungs(F.col("q"))})
    good_ids = labels.where("quality = 1").select("doc_id").distinct()
    good = rows.select("doc_id", "stratum", "rungs").join(good_ids, "doc_id", "left_semi")
    cutoffs = F.broadcast(certified(good, alpha, delta))  # at most a row per stratum
    over = F.exists(
        F.transform("rungs", lambda rung, i: rung >= F.element_at("cutoffs", i)), lambda x: F.coalesce(x, F.lit(False))
    )
    verdict = ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))
    return rows.join(cutoffs, "stratum", "left").select("row", "doc_id", "stratum", "q.*", "base_failed", verdict.alias("kept"))


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels, []).drop("row", "n_lines", "n_capitals", "n_shouts")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all columns of `docs`."""
    return judged(docs, labels, docs.columns).where("kept").select("row.*")
