"""Severity weights, severity order and the rule-id to finding-type mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Domains and risk weights.
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
SEVERITY_WEIGHTS = {"CRITICAL": 100, "HIGH": 50, "MEDIUM": 10, "LOW": 1}
FINDING_TYPES = (
    "SECRET",
    "INJECTION_SINK",
    "UNSAFE_CRYPTO",
    "UNSAFE_DESERIALIZATION",
    "DANGEROUS_EXEC",
    "INSECURE_DEPENDENCY",
    "HALLUCINATED_PACKAGE",
    "LICENSE_RISK",
)
DOC_SEVERITIES = (*SEVERITIES, "INFO")
DOC_FINDING_TYPES = (
    "HARDCODED_SECRET",
    "INSECURE_DESERIALIZATION",
    "SQL_INJECTION",
    "DANGEROUS_EXECUTION",
    "WEAK_CRYPTO",
    "OUTDATED_DEPENDENCY",
    "DENYLISTED_DEPENDENCY",
    "HALLUCINATED_PACKAGE",
    "OTHER_VULNERABILITY",
)
DEPENDENCY_STATUSES = ("ALLOW", "DENY", "UNKNOWN")
SOURCE_TAGS = ("COPILOT", "CLAUDE", "AGENT", "UNKNOWN")


def severity_weight(severity: Column) -> Column:
    return _lookup(severity, SEVERITY_WEIGHTS).cast("bigint")


def severity_rank(severity: Column) -> Column:
    """4 for CRITICAL down to 1 for LOW, 0 for anything else."""
    return _lookup(severity, {name: step for step, name in enumerate(reversed(SEVERITIES), start=1)})


def _lookup(key: Column, values: dict[str, int]) -> Column:
    found = F
    for name, value in values.items():
        found = found.when(key == name, F.lit(value))
    return found.otherwise(0)


def finding_type_of(rule_id: str) -> str:
    """Finding type implied by a rule id; a rule id outside the domain is rejected before any job starts."""
    for prefix in ("UNSAFE_CRYPTO", "UNSAFE_DESERIALIZATION"):
        if rule_id == prefix or rule_id.startswith(prefix + "_"):
            return prefix
    token = rule_id.partition("_")[0]
    token = {"INJECTION": "INJECTION_SINK"}.get(token, token)
    if token not in FINDING_TYPES:
        raise ValueError(f"rule id {rule_id!r} implies no known finding type")
    return token


def finding_type_column(rule_id: Column) -> Column:
    """The same mapping for rule tables; null marks a rule id outside the domain."""
    tokens = F.split(rule_id, "_")
    first, second = tokens[0], F.try_element_at(tokens, F.lit(2))
    return (
        F.when(first == "INJECTION", "INJECTION_SINK")
        .when((first == "UNSAFE") & second.isin("CRYPTO", "DESERIALIZATION"), F.concat_ws("_", first, second))
        .when(first.isin(*FINDING_TYPES), first)
    )
