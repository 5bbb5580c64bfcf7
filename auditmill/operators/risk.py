"""Scores, breakdowns, flags and dashboard metrics, all from one partial aggregate over the input tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.functions.scoring import DEPENDENCY_STATUSES, FINDING_TYPES, SEVERITIES, severity_weight

def risk_facts(
    findings: DataFrame,
    dependencies: DataFrame | None = None,
    artifacts: DataFrame | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Counts, score and flags in one row, or in one row per group of `keys`.

    The tables are stacked and aggregated once: no join between the inputs, and a hot group shrinks in the map-side
    half of the aggregate. Without keys the row is there even when every input is empty.
    """

    return _stacked(findings, dependencies, artifacts, keys).groupBy(*keys).agg(*_measures())


def risk_rollup(
    findings: DataFrame, dependencies: DataFrame, artifacts: DataFrame, levels: Mapping[str, Sequence[str]]
) -> DataFrame:
    """The facts of several groupings from one aggregate: a column `level` with the grouping's name, its key columns (null
    where a level does not group by them), and the facts. Every input has all key columns."""
    keys = list(dict.fromkeys(k for own in levels.values() for k in own))
    rows = _stacked(findings, dependencies, artifacts, keys)
    sets = [[F.col(k) for k in own] for own in levels.values()]
    grouped = rows.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.grouping_id(*keys).alias("grouped"), *_measures())
    # The bits of a grouping id tell, first key highest, which keys the level leaves out.
    ids = {name: sum((k not in own) << (len(keys) - 1 - i) for i, k in enumerate(keys)) for name, own in levels.items()}
    level = reduce(lambda chain, item: chain.when(F.col("grouped") == item[1], item[0]), ids.items(), F)
    return grouped.select(level.alias("level"), *[c for c in grouped.columns if c != "grouped"])


def _stacked(findings: DataFrame, dependencies: DataFrame | None, artifacts: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """All inputs as rows (keys, kind, severity, finding_type, status)."""

    def measured(df: DataFrame, kind: str, have: Sequence[str]) -> DataFrame:
        facts = [c if c in have else f"CAST(NULL AS STRING) AS {c}" for c in ("severity", "finding_type", "status")]
        return df.selectExpr(*keys, f"'{kind}' AS kind", *facts)

    rows = measured(findings, "finding", ("severity", "finding_type"))
    if dependencies is not None:
        rows = rows.unionByName(measured(dependencies, "dependency", ("status",)))
    if artifacts is not None:
        rows = rows.unionByName(measured(artifacts, "artifact", ()))
    return rows


def _measures() -> list[Column]:
    def tally(column: str, values: Sequence[str], prefix: str = "") -> list[Column]:
        return [F.expr(f"count_if({column} = '{v}') AS `{prefix}{v}`") for v in values]

    return [
        F.expr("count_if(kind = 'artifact') AS artifacts"),
        F.expr("count_if(kind = 'finding') AS findings"),
        F.expr("count_if(kind = 'dependency') AS dependencies"),
        F.coalesce(F.sum(severity_weight(F.col("severity"))), F.lit(0)).cast("bigint").alias("total_risk_score"),
        *tally("severity", SEVERITIES),
        *tally("finding_type", (*FINDING_TYPES, "HARDCODED_SECRET")),
        *tally("status", (*DEPENDENCY_STATUSES, "HALLUCINATED"), "dep_"),
    ]


def merge_facts(facts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Facts of a whole from the facts of its parts (batches, partitions, days): every measure adds up."""
    measures = [c for c in facts.columns if c not in keys]
    return facts.groupBy(*keys).agg(*[F.expr(f"CAST(coalesce(sum(`{c}`), 0) AS BIGINT) AS `{c}`") for c in measures])


def high_or_critical() -> Column:
    return (F.col("CRITICAL") + F.col("HIGH")) > 0


def risky_dependencies() -> Column:
    return F.col("dep_DENY") + F.col("dep_UNKNOWN")


def total_risk_score(findings: DataFrame) -> DataFrame:
    return findings.agg(
        F.coalesce(F.sum(severity_weight(F.col("severity"))), F.lit(0)).cast("bigint").alias("total_risk_score")
    )


def artifact_risk_score(artifacts: DataFrame, findings: DataFrame) -> DataFrame:
    """Score per artifact, zero where nothing was found. Findings shrink to one row per artifact before the join."""
    scores = findings.groupBy("artifact_id").agg(
        F.sum(severity_weight(F.col("severity"))).alias("score"), F.count("*").alias("n")
    )
    owners = artifacts.select("artifact_id", "artifact_seq", "filename", "source")
    return owners.join(scores, "artifact_id", "left").select(
        "artifact_id", "artifact_seq", "filename", "source",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("finding_count"),
        F.coalesce("score", F.lit(0)).cast("bigint").alias("risk_score"),
    )


def gate_flags(findings: DataFrame, dependencies: DataFrame) -> DataFrame:
    facts = risk_facts(findings, dependencies)
    return facts.select(
        high_or_critical().alias("has_high_critical_findings"),
        (F.col("SECRET") > 0).alias("has_secret_findings"),
        (risky_dependencies() > 0).alias("has_risky_dependencies"),
        "total_risk_score",
    )


def _counts_as_rows(facts: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias(label), F.col(c).alias("finding_count")) for c in columns])
    return facts.select(F.explode(pairs).alias("r")).select("r.*")


def severity_breakdown(findings: DataFrame) -> DataFrame:
    """All four severities, zeros included."""
    return _counts_as_rows(risk_facts(findings), SEVERITIES, "severity")


def finding_type_breakdown(findings: DataFrame) -> DataFrame:
    return _counts_as_rows(
        risk_facts(findings), ("SECRET", "INSECURE_DEPENDENCY", "HALLUCINATED_PACKAGE"), "finding_type"
    )


def dashboard_metrics(findings: DataFrame, dependencies: DataFrame, artifacts: DataFrame) -> DataFrame:
    return risk_facts(findings, dependencies, artifacts).select(
        "artifacts",
        F.col("findings").alias("total_findings"),
        F.col("CRITICAL").alias("critical_findings"),
        F.col("HIGH").alias("high_findings"),
        "dependencies",
        risky_dependencies().alias("risky_dependencies"),
    )


def rule_hits(catalog_rows: DataFrame, findings: DataFrame) -> DataFrame:
    """Rule catalog with its number of findings, zeros included; findings shrink to one row per rule first."""
    hits = findings.groupBy("rule_id").agg(F.count("*").alias("finding_count"))
    return catalog_rows.join(hits, "rule_id", "left").fillna(0, ["finding_count"])
