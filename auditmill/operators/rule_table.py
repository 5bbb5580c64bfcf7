"""Line scan by a table of rules: thousands of patterns as rows, met through the literal text that their matches must hold.

Every pattern is taken apart once: from its literals comes a small set of q-grams of which any match holds at least one.
They are as long as the literals allow (`SIZES`), so that rules which differ in a number or name only do not share them.
Lines meet rules by an equi-join on q-grams, and the pattern itself decides. Only the q-grams of a line that begin and
measure like one of the index take part. Rules whose patterns hold no literal of `Q` characters are scanned as constants,
as the built-in catalogs are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate
from math import log2
from re import _constants as op
from re import _parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.functions.text import constant, explode_lines, java_pattern, strip
from auditmill.operators.findings import as_findings, union_findings
from auditmill.operators.regex_scan import scan_lines
from auditmill.plans.storage import write_once
from auditmill.rules import Rule, Ruleset, ruleset
from auditmill.sources.artifacts import code_artifacts

#: Lengths of q-grams; of a literal the longest that fits counts.
SIZES = (3, 5, 8, 16)
Q = SIZES[0]
#: Rules without a usable literal are compiled into the plan; more of them than this are an error.
MAX_CONSTANT_RULES = 200
#: Alternative texts that one stretch of a pattern is spelled out to.
MAX_TEXTS = 64
#: Characters that ignoring case equates with an ASCII letter, and that letter.
FOLDED_FROM, FOLDED_TO = "ſKİı", "skii"
#: Letters from frequent to rare, to choose the q-gram that few lines hold.
FREQUENT = " etaoinsrhldcumfpgwybvkxjqz"
#: Below this share of lines, fewer q-grams count for more than rarer ones.
RARE = 1e-9
#: Thousandths of bits that a character adds: whole numbers, so that sums of equal characters are equal.
_RARITY, _RAREST = {c: round(1000 * log2(2 + i)) for i, c in enumerate(FREQUENT)}, round(1000 * log2(40))

RULE_TABLE = (
    "rule_ord int, rule_id string, finding_type string, severity string, description string, remediation_guidance string, "
    "cwe_mapping string, pattern string"
)
_TEXTS = ("rule_id", "finding_type", "severity", "description", "remediation_guidance", "cwe_mapping")
_INDEX_SQL = "rule_ord int, gram string, earlier array<string>, java string, error string"
_INDEX = pa.schema([
    ("rule_ord", pa.int32()), ("gram", pa.string()), ("earlier", pa.list_(pa.string())), ("java", pa.string()), ("error", pa.string()),
])


# --- What a match must hold -------------------------------------------------------------------------------------------


def required_grams(pattern: str) -> tuple[str, ...] | None:
    """Folded q-grams of which every line with a match holds one; None if the pattern has no such set."""
    best = min(_covers(list(_parser.parse(pattern))), key=_weight, default=None)
    return tuple(sorted(best)) if best else None


def _covers(items: list) -> Iterator[frozenset[str]]:
    """Sets that each have to be hit by any match of the sequence: of every stretch that is one of a few known texts, a
    q-gram of each; of what repeats or branches otherwise, the sets of its parts."""
    stretch = [""]
    for item in [*items, None]:
        texts = item and _texts_of(item)
        if texts and len(stretch) * len(texts) <= MAX_TEXTS:
            stretch = [a + b for a in stretch for b in texts]
            continue
        if all(len(text) >= Q for text in stretch):
            yield frozenset(map(_rarest, stretch))
        stretch = texts or [""]
        if item is None or texts:
            continue
        kind, value = item
        if kind is op.SUBPATTERN:
            yield from _covers(list(value[-1]))
        elif kind is op.ATOMIC_GROUP:
            yield from _covers(list(value))
        elif _repeats(kind) and value[0] > 0:
            yield from _covers(list(value[2]) * min(value[0], SIZES[-1]))
        elif kind is op.BRANCH:
            parts = [min(_covers(list(part)), key=_weight, default=None) for part in value[1]]
            if all(parts):
                yield frozenset().union(*parts)


def _repeats(kind) -> bool:
    return kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)


def _texts_of(item: tuple) -> list[str] | None:
    """All folded texts that one part of a pattern can match, if they are known and few."""
    kind, value = item
    if kind is op.LITERAL:
        return [chr(value).lower()] if value < 128 else None
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):  # they take no characters, so what stands around them stays together
        return [""]
    if kind is op.IN:
        if all(k is op.LITERAL and v < 128 for k, v in value) and len(value) <= 4:
            return sorted({chr(v).lower() for _, v in value})
        return None
    if kind is op.BRANCH:
        parts = [_texts_of_all(list(part)) for part in value[1]]
        return _few({text for part in parts for text in part}) if all(parts) else None
    if kind is op.SUBPATTERN:
        return _texts_of_all(list(value[-1]))
    if kind is op.ATOMIC_GROUP:
        return _texts_of_all(list(value))
    if _repeats(kind) and value[0] == value[1] <= MAX_TEXTS:
        return _texts_of_all(list(value[2]) * value[0])
    return None


def _texts_of_all(items: list) -> list[str] | None:
    out = [""]
    for item in items:
        texts = _texts_of(item)
        out = texts and _few({a + b for a in out for b in texts})
        if not out:
            return None
    return out


def _few(texts: set[str]) -> list[str] | None:
    return sorted(texts) if len(texts) <= MAX_TEXTS else None


def _rarest(text: str) -> str:
    q = max(size for size in SIZES if size <= len(text))
    sums = [0, *accumulate(_rarity(text))]
    at = max(range(len(text) - q + 1), key=lambda i: sums[i + q] - sums[i])  # the first of equals
    return text[at : at + q]


def _rarity(text: str) -> Iterator[int]:
    return (_RARITY.get(c, _RAREST) for c in text)


def _weight(cover: frozenset[str]) -> float:
    """An estimate of the share of lines that hold one of the q-grams."""
    return sum(max(2 ** (-sum(_rarity(gram)) / 1000), RARE) for gram in cover)


def folded(line: Column) -> Column:
    """The line as the index spells it: small letters, and the few others that ignoring case equates with them."""
    return F.lower(F.translate(line, FOLDED_FROM, FOLDED_TO))


# --- Rules ------------------------------------------------------------------------------------------------------------


def rule_table(spark: SparkSession, rules: str | Ruleset = "core") -> DataFrame:
    """The line rules of a catalog as a rule table."""
    rows = [(i, *(getattr(r.emits[0], t) for t in _TEXTS), r.pattern) for i, r in ruleset(rules).line_rules]
    return spark.createDataFrame(rows, RULE_TABLE)


def index_rules(rules: DataFrame) -> DataFrame:
    """Rows (rule_ord, gram, earlier, java, error): one per rule and q-gram of its set, with the q-grams before it; without a
    gram where the pattern has none; with an error where it is no pattern."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for ordinal, pattern in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    if pattern is None or "(?<" in pattern:
                        re.compile(pattern)  # parsing alone does not reject them: no text, look-behind of varying width
                    grams, java = required_grams(pattern), java_pattern(pattern, checked=True)
                except (re.error, TypeError, KeyError, ValueError) as e:
                    rows.append((ordinal, None, None, None, f"{type(e).__name__}: {e}"))
                    continue
                rows += [(ordinal, g, list(grams[:i]), java, None) for i, g in enumerate(grams or [])]
                if not grams:
                    rows.append((ordinal, None, None, java, None))
            columns = zip(*rows) if rows else [()] * len(_INDEX)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _INDEX)], schema=_INDEX)

    # Taking a pattern apart costs far more than moving it.
    return rules.select("rule_ord", "pattern").repartition("rule_ord").mapInArrow(work, _INDEX_SQL)


def split_rules(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rules, rejected ones with their error): patterns are required to be valid, types and severities present."""
    checked = rules.join(index_rules(rules).groupBy("rule_ord").agg(F.max("error").alias("error")), "rule_ord", "left")
    missing = F.col("severity").isNull() | F.col("finding_type").isNull()
    error = F.coalesce("error", F.when(missing, "a rule needs a severity and a finding type"))
    told = checked.withColumn("error", error)
    return told.where("error IS NULL").drop("error"), told.where("error IS NOT NULL").select("rule_ord", "rule_id", "error")


def constant_rules(rules: DataFrame, index: DataFrame) -> tuple[Ruleset, list[int]] | None:
    """The rules that no q-gram finds, as a catalog and their ordinals; there are few, or the table cannot be used."""
    bare = index.where("gram IS NULL AND error IS NULL").select("rule_ord").limit(MAX_CONSTANT_RULES + 1)
    rows = rules.join(F.broadcast(bare), "rule_ord").limit(MAX_CONSTANT_RULES + 1).collect()
    if len(rows) > MAX_CONSTANT_RULES:
        raise ValueError(f"more than {MAX_CONSTANT_RULES} rules hold no literal of {Q} characters that a match must have")
    if not rows:
        return None
    rows.sort(key=lambda r: r.rule_ord)
    made = [
        Rule(r.rule_id, "REGEX", r.severity, r.description, r.remediation_guidance, r.cwe_mapping, r.pattern, finding_type=r.finding_type)
        for r in rows
    ]
    return Ruleset("table", tuple(made)), [r.rule_ord for r in rows]


def _begun(grams: DataFrame) -> DataFrame:
    return grams.withColumns({"start": F.substring("gram", 1, Q), "size": F.char_length("gram")})


# --- Scan -------------------------------------------------------------------------------------------------------------

_KEEP = ("artifact_id", "artifact_seq", "filename", "source")


def scan_lines_by_table(artifacts: DataFrame, rules: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Findings of the rules in a table (`RULE_TABLE`, rule_ord unique) over code artifacts: the rows that the same rules give
    as a catalog. Invalid rules find nothing here; `split_rules` lists them.

    `index` is a stored `index_rules`, worth keeping for tables that change seldom. It is no larger than the rules, so
    Spark sends it to the lines while its measured size allows, and otherwise both sides meet by q-gram.
    """
    index = write_once(index_rules(rules), "rule_index") if index is None else index
    held = index.where("gram IS NOT NULL")
    lines = explode_lines(code_artifacts(artifacts), _KEEP).withColumn("folded", folded(F.col("line")))
    # A look-ahead finds overlapping q-grams in one pass over the line.
    by_size = [F.array_distinct(F.regexp_extract_all("folded", F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1))) for q in SIZES]
    probes = lines.select("*", F.explode(F.concat(*by_size)).alias("gram")).drop("folded")
    # At most the triples of ASCII characters times `SIZES`, whatever the number of rules.
    probes = _begun(probes).join(F.broadcast(_begun(held).select("start", "size").distinct()), ["start", "size"], "left_semi")
    met = probes.drop("start", "size").join(held.select("rule_ord", "gram", "earlier", "java"), "gram")
    # A line that holds several of a rule's q-grams meets the rule by the first of them only.
    first = ~F.exists("earlier", lambda g: F.contains(folded(F.col("line")), g))
    hits = met.where(first).where(F.rlike("line", F.col("java")))
    texts = rules.select(F.col("rule_ord").alias("ord"), *_TEXTS)
    rows = hits.join(texts, F.col("rule_ord") == F.col("ord")).withColumn("evidence_snippet", strip(F.col("line"))).selectExpr(
        "artifact_id", "artifact_seq", "filename AS artifact_filename", "source AS artifact_source", "line_no",
        "concat('line ', line_no) AS location", "evidence_snippet", "rule_ord", "1 AS phase", "line_no AS position", "0 AS dup", *_TEXTS,
    )
    found = as_findings(rows)
    rest = constant_rules(rules, index)
    if rest is None:
        return found
    catalog, ordinals = rest
    given = F.get(constant(ordinals, "array<int>"), F.col("rule_ord"))
    numbered = scan_lines(artifacts, catalog, prefilter=False).drop("finding_id").withColumn("rule_ord", given)
    return union_findings(found, as_findings(numbered))
