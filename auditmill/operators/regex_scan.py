"""Line scan: every line against every line rule, one finding per (line, rule)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.functions.text import any_match, check_patterns, constant, context_free, explode_lines, java_pattern, strip
from auditmill.operators.findings import as_findings, emission_texts
from auditmill.rules import Ruleset, ruleset
from auditmill.sources.artifacts import code_artifacts

_KEEP = ("artifact_id", "artifact_seq", "filename", "source")


def scan_lines(
    artifacts: DataFrame, rules: str | Ruleset = "core", *, prefilter: bool = True, extra: Sequence[str] = ()
) -> DataFrame:
    """Findings of the line rules over code artifacts. Narrow from scan to output: no shuffle, no Python.
    `extra` artifact columns (an event time, a project) travel along behind the finding columns.

    `prefilter` tests the rules' hints on whole contents before they are split into lines, then on lines. The test on
    contents applies only when every hint is free of anchors and look-around, where the result is provably the same.
    """
    catalog = ruleset(rules)
    code = artifacts.where(F.col("language") == "python") if catalog.python_only else artifacts
    code = code_artifacts(code)
    numbered = catalog.line_rules
    patterns = [java_pattern(r.pattern) for _, r in numbered]
    first_look = [r.hint.pattern if r.hint else r.pattern for _, r in numbered]
    check_patterns(artifacts.sparkSession, [*patterns, *map(java_pattern, first_look)])
    opens = "".join(r.hint.opens for _, r in numbered) if all(r.hint for _, r in numbered) else None

    def promising(column: str) -> Column:
        return any_match(F.col(column), [java_pattern(p) for p in first_look], opens)

    if prefilter and all(map(context_free, first_look)):
        code = code.where(promising("content"))
    lines = explode_lines(code, (*_KEEP, *extra))
    if prefilter:
        lines = lines.where(promising("line"))
    hits = F.array(*[F.when(F.col("line").rlike(p), F.lit(n)) for n, p in enumerate(patterns)]).cast("array<int>")
    texts = emission_texts(r.emits[0] for _, r in numbered)
    ordinals = constant([i for i, _ in numbered], "array<int>")
    # One slot per rule, empty ones dropped behind the generator: array functions would leave generated code.
    rows = lines.select(*_KEEP, *extra, "line_no", "line", F.explode(hits).alias("hit")).where("hit IS NOT NULL")
    rows = rows.withColumns({
        "text": F.get(texts, F.col("hit")), "rule_ord": F.get(ordinals, F.col("hit")),
        "evidence_snippet": strip(F.col("line")),
    }).selectExpr(
        "artifact_id", "artifact_seq", "filename AS artifact_filename", "source AS artifact_source", "line_no",
        f"concat('{catalog.location_label} ', line_no) AS location", "evidence_snippet", "rule_ord",
        "1 AS phase", "line_no AS position", "0 AS dup", "text.*", *extra,
    )
    return as_findings(rows, extra)
