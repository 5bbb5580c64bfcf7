"""CI/CD gate plans: the core five-gate plan (global or per group) and the three-gate documentation variant."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.functions.text import FIELD_SEP, constant
from auditmill.operators.risk import high_or_critical, risk_facts, risk_rollup, risky_dependencies

# Gate texts.
DEFAULT_OWNER = "DevSecOps Team"
FINDINGS_REPORT = "code_gen_risk_findings.json"
DEPENDENCY_REPORT = "dependency_risk_report.json"
WARN_SCORE = 20


def _texts(*values: str) -> Column:
    return constant(values, "array<string>")


def _block_if(condition: Column, otherwise: str = "WARN") -> Column:
    return F.when(condition, "BLOCK").otherwise(otherwise)


def gate_plan(
    findings: DataFrame, dependencies: DataFrame, *, artifacts: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Five gates in plan order. With `keys` (columns of every input) there is one plan per group, and `artifacts`
    brings in groups without any finding."""
    return plan_from_facts(risk_facts(findings, dependencies, artifacts, keys), keys)


#: Groupings of `gate_plan_rollup`: their names and key columns.
LEVELS = {"total": (), "source": ("source",), "language": ("language",), "artifact": ("artifact_id",)}


def gate_plan_rollup(
    findings: DataFrame, dependencies: DataFrame, artifacts: DataFrame, levels: Mapping[str, Sequence[str]] = LEVELS
) -> DataFrame:
    """The five gates for every group of every level, from one aggregate over the stacked inputs. Columns: `level`, the key
    columns of all levels (null where a level has no such key), and the gate's. Without artifacts there are no rows."""
    keys = dict.fromkeys(k for own in levels.values() for k in own)
    return plan_from_facts(risk_rollup(findings, dependencies, artifacts, levels), ["level", *keys])


def plan_from_facts(facts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The five gates of each facts row."""
    secrets = F.col("SECRET") > 0
    gates = [
        ("CI_SECURITY", _texts("SAST Scanner", "Dependency Scanner"),
         _texts("No HIGH/CRITICAL Vulnerabilities", "Dependency Allowlist Compliance"),
         _block_if(high_or_critical() | (risky_dependencies() > 0)), DEFAULT_OWNER,
         _texts(FINDINGS_REPORT, DEPENDENCY_REPORT)),
        ("PRE_COMMIT", F.when(secrets, _texts("Secret Scanner")).otherwise(_texts("Secret Scanner", "Linter")),
         F.when(secrets, _texts("No Hardcoded Secrets")).otherwise(_texts("No Hardcoded Secrets", "Code Formatting")),
         _block_if(secrets), DEFAULT_OWNER, _texts(FINDINGS_REPORT)),
        ("CI_BUILD", _texts("Build Tool", "Linter"), _texts("Successful Build", "Code Linting"),
         F.lit("BLOCK"), "Development Team", _texts()),
        ("CI_TEST", _texts("Test Runner"), _texts("All Unit Tests Pass"), F.lit("BLOCK"), "QA Team", _texts()),
        ("PRE_DEPLOY", _texts("Manual Review", "Audit Artifact Check"),
         _texts("Security Audit Approval", "Artifact Integrity Check"),
         _block_if(F.col("total_risk_score") > 0), "Release Manager", _texts()),
    ]
    rows = F.array(*[
        F.struct(
            F.lit(n).alias("gate_ord"), F.lit(kind).alias("gate_type"), tools.alias("tools"),
            checks.alias("required_checks"), action.alias("failure_action"), F.lit(owner).alias("owner_role"),
            evidence.alias("evidence_required"),
        )
        for n, (kind, tools, checks, action, owner, evidence) in enumerate(gates, start=1)
    ])
    return facts.select(*keys, F.explode(rows).alias("g")).select(*keys, "g.*")


def gate_plan_doc(findings: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Three gates with action, reason and a details map of counts; the ids and names behind the counts are rows of
    `gate_details_doc`, so no list grows with the data."""
    return doc_plan_from_facts(risk_facts(findings, dependencies))


def doc_plan_from_facts(facts: DataFrame) -> DataFrame:
    """The three gates of a facts row."""
    secrets, severe = F.col("HARDCODED_SECRET") > 0, high_or_critical()
    notable = F.col("total_risk_score") > WARN_SCORE
    unsafe = (F.col("dep_DENY") + F.col("dep_HALLUCINATED")) > 0

    def details(*pairs: tuple[str, Column]) -> Column:
        return F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))])

    score = ("risk_score", F.col("total_risk_score"))
    gates = [
        ("PRE_COMMIT", _block_if(secrets, "PASS"),
         F.when(secrets, "Hardcoded secrets detected.").otherwise("No hardcoded secrets detected."),
         F.when(secrets, details(("findings", F.col("HARDCODED_SECRET"))))),
        ("CI_SECURITY", F.when(severe, "BLOCK").when(notable, "WARN").otherwise("PASS"),
         F.when(severe, "Critical or High severity security findings detected.")
          .when(notable, "Medium severity security findings detected.")
          .otherwise("No critical/high findings or significant risk score."),
         F.when(severe, details(("findings", F.col("CRITICAL") + F.col("HIGH")), score)).when(notable, details(score))),
        ("CI_BUILD", _block_if(unsafe, "PASS"),
         F.when(unsafe, "Denylisted or potentially hallucinated dependencies detected.")
          .otherwise("All dependencies appear safe."),
         F.when(unsafe, details(("denylisted", F.col("dep_DENY")), ("hallucinated", F.col("dep_HALLUCINATED"))))),
    ]
    rows = F.array(*[
        F.struct(F.lit(n).alias("gate_ord"), F.lit(kind).alias("gate_type"), action.alias("action"),
                 reason.alias("reason"), info.alias("details"))
        for n, (kind, action, reason, info) in enumerate(gates, start=1)
    ])
    return facts.select(F.explode(rows).alias("g")).select("g.*")


def gate_details_doc(findings: DataFrame, dependencies: DataFrame) -> DataFrame:
    """What each blocking gate refers to, one row per finding id or dependency name: (gate_type, detail, value)."""
    secrets = findings.where(F.col("finding_type") == "HARDCODED_SECRET").select(
        F.lit("PRE_COMMIT").alias("gate_type"), F.lit("finding_id").alias("detail"), F.col("finding_id").alias("value")
    )
    severe = findings.where(F.col("severity").isin("CRITICAL", "HIGH")).select(
        F.lit("CI_SECURITY").alias("gate_type"), F.lit("finding_id").alias("detail"), F.col("finding_id").alias("value")
    )
    unsafe = dependencies.where(F.col("status").isin("DENY", "HALLUCINATED")).select(
        F.lit("CI_BUILD").alias("gate_type"),
        F.when(F.col("status") == "DENY", "denylisted").otherwise("hallucinated").alias("detail"),
        F.col("name").alias("value"),
    )
    return secrets.unionByName(severe).unionByName(unsafe)


def details_text() -> Column:
    """The details map as `key=value,...`, sorted; null where a gate has none."""
    return F.array_join(F.sort_array(F.transform(F.map_entries("details"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")


def gate_status_doc(plan: DataFrame) -> DataFrame:
    """Identity, overall status and summary text of a documentation-variant plan (three rows in, one row out). The id is
    a digest of the gates, so equal plans have equal ids."""
    action = F.col("action")
    # Summary messages.
    message = (
        F.when((F.col("gate_type") == "PRE_COMMIT") & (action == "BLOCK"),
               "Pre-commit gate blocking due to hardcoded secrets.")
        .when((F.col("gate_type") == "CI_SECURITY") & (action == "BLOCK"),
              "CI Security gate blocking due to Critical/High findings.")
        .when((F.col("gate_type") == "CI_SECURITY") & (action == "WARN"),
              "CI Security gate warning due to Medium findings.")
        .when((F.col("gate_type") == "CI_BUILD") & (action == "BLOCK"),
              "CI Build gate blocking due to insecure/hallucinated dependencies.")
    )
    told = F.concat_ws(FIELD_SEP, "gate_type", "action", "reason", F.coalesce(details_text(), F.lit("")))
    totals = plan.agg(
        F.array_sort(F.collect_list(F.struct("gate_ord", told.alias("text")))).alias("gates"),
        F.max(F.when(action == "BLOCK", 2).when(action == "WARN", 1).otherwise(0)).alias("worst"),
        F.array_sort(F.collect_list(F.when(message.isNotNull(), F.struct("gate_ord", message.alias("m"))))).alias("ms"),
    )
    text = F.array_join(F.transform("ms", lambda s: s["m"]), " ")
    gates = F.array_join(F.transform("gates", lambda g: g["text"]), FIELD_SEP)
    return totals.select(
        F.sha2(gates, 256).alias("plan_id"),
        F.current_timestamp().alias("created_at"),
        F.when(F.col("worst") == 2, "BLOCK").when(F.col("worst") == 1, "WARN").otherwise("PASS").alias("overall_status"),
        F.when(F.size("ms") > 0, F.concat(F.lit("Analysis completed. "), text))
         .otherwise("Analysis completed. No significant risks found to block the pipeline.").alias("summary"),
    )
