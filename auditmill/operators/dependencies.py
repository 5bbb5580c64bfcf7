"""Manifest parsing, package classification, dependency findings and dependency queries."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.functions.text import explode_lines, java_pattern, strip
from auditmill.operators.findings import as_findings, emission_texts
from auditmill.policy import Policy, policy
from auditmill.rules import Emission
from auditmill.schemas import DEPENDENCY, declared
from auditmill.sources.artifacts import manifest_artifacts

_KEEP = ("artifact_id", "artifact_seq", "filename", "source")


def _any(tests) -> Column:
    return reduce(Column.__or__, list(tests), F.lit(False))


def parse_manifests(artifacts: DataFrame, rules: str | Policy = "core") -> DataFrame:
    """One row per package entry, in the dialect the filename picks. Narrow: no shuffle.

    Files of other kinds, and files without their dialect's marker, are dropped before lines are made.
    """
    chosen = policy(rules)
    suffixed = {d: F.col("filename").endswith(d.suffix) for d in chosen.dialects}
    eligible = _any(
        suffixed[d] & (F.col("content").contains(d.marker) if d.marker else F.lit(True)) for d in chosen.dialects
    )
    lines = explode_lines(manifest_artifacts(artifacts).where(eligible), _KEEP)
    entries = lines.withColumn("entry", strip("line")).where((F.col("entry") != "") & ~F.col("entry").startswith("#"))
    name = version = F.lit("")
    for d in reversed(chosen.dialects):
        pattern = java_pattern(f"^(?:{d.pattern})")
        name = F.when(suffixed[d], F.regexp_extract("entry", pattern, 1)).otherwise(name)
        version = F.when(suffixed[d], F.regexp_extract("entry", pattern, d.version_group)).otherwise(version)
    if chosen.null_version:
        version = F.nullif(version, F.lit(""))
    if not chosen.keep_name_case:
        name = F.lower(name)
    # Parsed values come out of a generator, so filters on them later cannot pull copies of the regexes down.
    parsed = F.explode(F.array(F.struct(name.alias("name"), version.alias("version_spec"))))
    return (
        entries.select("*", parsed.alias("parsed"))
        .where("parsed.name != ''")
        .selectExpr("artifact_id", "artifact_seq", "filename AS source_file", "source AS artifact_source",
                    "line_no", "entry", "parsed.*")
    )


def listed_status(name: Column, chosen: Policy) -> Column:
    """Status by list membership alone; the lists are literals, so there is no join."""
    key = F.lower(name) if chosen.fold_case else name

    def listed(entries):
        return key.isin(*[e.lower() if chosen.fold_case else e for e in entries]) if entries else F.lit(False)

    deny, allow = (listed(chosen.denylist), "DENY"), (listed(chosen.allowlist), "ALLOW")
    first, second = (allow, deny) if chosen.allow_first else (deny, allow)
    return F.when(first[0], first[1]).when(second[0], second[1]).otherwise("UNKNOWN")


def suspicious_name(name: Column, chosen: Policy) -> Column:
    """Naming heuristic as one alternation: any listed suffix, or a listed prefix followed by a dash."""
    if chosen.suspicious_pattern:
        return F.lower(name).rlike(java_pattern(chosen.suspicious_pattern))
    tests = []
    if chosen.suffixes:
        tests.append("(?:" + "|".join(map(re.escape, chosen.suffixes)) + r")\z")
    if chosen.prefixes:
        tests.append("^(?:" + "|".join(map(re.escape, chosen.prefixes)) + ")-")
    return name.rlike("|".join(tests)) if tests else F.lit(False)


def classify(entries: DataFrame, rules: str | Policy = "core", *, policy_table: DataFrame | None = None) -> DataFrame:
    """Add `status`, `suspicious` and `risk_notes`.

    `policy_table(name, status)` replaces the literal lists when an organisation keeps its lists as a table. It is
    reduced to one row per name (DENY wins) and left-joined without a broadcast hint: Spark broadcasts it only while
    its measured size allows, and beyond that splits hot names as skewed partitions of the entries side.
    """
    chosen = policy(rules)
    if policy_table is None:
        rows = entries.withColumn("status", listed_status(F.col("name"), chosen))
    else:
        winner = F.min if chosen.allow_first else F.max
        listed = policy_table.where(F.col("status").isin("ALLOW", "DENY")).groupBy("name").agg(
            winner("status").alias("listed")
        )
        rows = entries.join(listed, "name", "left").withColumn("status", F.coalesce("listed", F.lit("UNKNOWN")))
    flagged = (F.col("status") == "UNKNOWN") & suspicious_name(F.col("name"), chosen)
    rows = rows.withColumn("suspicious", flagged)
    rows = rows.withColumn("status", F.when(F.col("suspicious"), chosen.suspicious_status).otherwise(F.col("status")))

    # Note texts.
    notes = F.expr("""
        CASE WHEN status = 'DENY' THEN concat("Package '", name, "' is on the denylist.")
             WHEN suspicious THEN concat("Package '", name, "' flagged as potential hallucination risk (suspicious naming).")
             WHEN status = 'UNKNOWN' THEN concat("Package '", name, "' is not in the allowlist or denylist.")
        END""")
    rows = rows.withColumn("risk_notes", notes)
    return rows.selectExpr(*declared(DEPENDENCY))


def analyze_dependencies(artifacts: DataFrame, rules: str | Policy = "core", *, policy_table=None) -> DataFrame:
    return classify(parse_manifests(artifacts, rules), rules, policy_table=policy_table)


# Finding texts, by the reason for the finding.
_DENIED = Emission(
    "DEP_DENYLISTED", "INSECURE_DEPENDENCY", "HIGH", "Denylisted package '{name}' found.",
    "Remove denylisted package. Consult internal security policies.", "CWE-937",
)
_SUSPICIOUS = Emission(
    "DEP_HALLUCINATION_RISK", "HALLUCINATED_PACKAGE", "MEDIUM", "Potential hallucinated package '{name}' detected.",
    "Verify package existence and authenticity. Avoid unknown/hallucinated packages.", "CWE-506",
)
_SUSPICIOUS_DOC = Emission(
    "DEP_H01", "HALLUCINATED_PACKAGE", "HIGH", "Potential hallucinated package '{name}' detected.",
    "Verify if this package truly exists and is legitimate. Avoid installing unverified packages.", None,
)


def dependency_findings(dependencies: DataFrame, rules: str | Policy = "core") -> DataFrame:
    """Findings for denied and for suspiciously named packages; other unknown packages give none."""
    doc = policy(rules).name == "doc"
    wanted = "suspicious" if doc else "status = 'DENY' OR suspicious"
    texts = emission_texts([_SUSPICIOUS_DOC] if doc else [_DENIED, _SUSPICIOUS])
    ordinal = F.lit(0) if doc else F.expr("IF(status = 'DENY', 0, 1)")
    rows = dependencies.where(wanted).withColumn("rule_ord", ordinal).withColumn("text", F.get(texts, F.col("rule_ord")))
    rows = rows.selectExpr(
        "artifact_id", "artifact_seq", "line_no", "artifact_source", "source_file AS artifact_filename", "name",
        "concat('File: ', source_file) AS location", f"{'name' if doc else 'entry'} AS evidence_snippet", "rule_ord",
        "3 AS phase", "line_no AS position", "0 AS dup", "text.*",
    )
    return as_findings(rows.withColumn("description", F.expr("replace(description, '{name}', name)")))


def hallucinated_packages(findings: DataFrame) -> DataFrame:
    """Distinct package names quoted in the descriptions of hallucination findings."""
    quoted = F.split("description", "'")
    return (
        findings.where((F.col("finding_type") == "HALLUCINATED_PACKAGE") & F.col("description").contains("'"))
        .select(F.lower(F.get(quoted, F.lit(1))).alias("package_name"))
        .distinct()
    )


def dependencies_view(
    dependencies: DataFrame, findings: DataFrame, statuses=None, *, only_hallucinated: bool = False
) -> DataFrame:
    """Display table with `hallucination_risk` Yes/No by existence of the name among hallucination findings.

    The name set is distinct before the join and carries no broadcast hint, so its measured size decides the join.
    """
    rows = dependencies if statuses is None else dependencies.where(F.col("status").isin(*statuses))
    names = hallucinated_packages(findings)
    how = "inner" if only_hallucinated else "left"
    joined = rows.join(names, F.lower(rows["name"]) == names["package_name"], how)
    return joined.select(
        "name", F.col("version_spec").alias("version"), "status", "source_file",
        F.when(F.col("package_name").isNotNull(), "Yes").otherwise("No").alias("hallucination_risk"),
    )


def dependency_risk_summary(dependencies: DataFrame, findings: DataFrame, statuses=None) -> DataFrame:
    """Denied and unknown rows among the selected statuses, distinct hallucinated names over all findings."""
    rows = dependencies if statuses is None else dependencies.where(F.col("status").isin(*statuses))
    measures = rows.select((F.col("status") == "DENY").alias("deny"), (F.col("status") == "UNKNOWN").alias("unknown"),
                           F.lit(False).alias("named"))
    names = hallucinated_packages(findings).select(
        F.lit(False).alias("deny"), F.lit(False).alias("unknown"), F.lit(True).alias("named")
    )
    totals = measures.unionByName(names).agg(
        F.count_if("deny").alias("denylisted"), F.count_if("unknown").alias("unknown"),
        F.count_if("named").alias("potential_hallucinations"),
    )
    clear = (F.col("denylisted") == 0) & (F.col("unknown") == 0) & (F.col("potential_hallucinations") == 0)
    return totals.withColumn("all_allowed", clear)
