"""Risk themes and the executive summary as long-form rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.functions.scoring import SEVERITIES
from auditmill.operators.findings import top_findings
from auditmill.operators.risk import risk_facts

# Theme texts.
THEME_SECRETS = "Hard-coded Secrets & Credential Leaks"
THEME_EXECUTION = "Insecure Input Handling & Dynamic Execution"
THEME_PACKAGES = "Dependency / Package Hallucinations & Risky Libraries"
THEME_NONE = "No major risk themes identified - excellent!"
NO_FINDINGS = "No major findings. Excellent work!"


def _themes() -> Column:
    found = F.array_compact(F.array(
        F.when(F.col("SECRET") > 0, THEME_SECRETS),
        F.when(F.col("INJECTION_SINK") + F.col("DANGEROUS_EXEC") + F.col("UNSAFE_DESERIALIZATION") > 0, THEME_EXECUTION),
        F.when(F.col("INSECURE_DEPENDENCY") + F.col("HALLUCINATED_PACKAGE") > 0, THEME_PACKAGES),
    ))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(THEME_NONE)))


def risk_themes(findings: DataFrame) -> DataFrame:
    return risk_facts(findings).select(F.posexplode(_themes()).alias("p", "theme")).select(
        (F.col("p") + 1).alias("theme_ord"), "theme"
    )


def executive_summary(
    findings: DataFrame, dependencies: DataFrame, artifacts: DataFrame, facts: DataFrame | None = None
) -> DataFrame:
    """Rows (section, ord, key, value): overview counts, themes, severity counts, top five findings.

    `findings` is read twice (counts, top five): pass a stored table when it is costly to compute, or the `facts` of all
    three tables where they are known.
    """
    facts = risk_facts(findings, dependencies, artifacts) if facts is None else facts

    def line(section: str, n, key: Column, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(n).cast("int").alias("ord"), key.alias("key"),
                        value.cast("string").alias("value"))

    fixed = [
        line("overview", 1, F.lit("code_artifacts"), F.col("artifacts")),
        line("overview", 2, F.lit("dependencies"), F.col("dependencies")),
        *[line("severity", n, F.lit(s), F.col(s)) for n, s in enumerate(SEVERITIES, start=1)],
    ]
    none = F.when(F.col("findings") == 0, F.array(line("top_findings", 1, F.lit("none"), F.lit(NO_FINDINGS))))
    themes = F.transform(
        _themes(), lambda t, i: F.struct(F.lit("risk_themes").alias("section"), (i + 1).alias("ord"),
                                         F.lit("theme").alias("key"), t.alias("value"))
    )
    empty = F.array().cast("array<struct<section:string,ord:int,key:string,value:string>>")
    rows = F.concat(F.array(*fixed), themes, F.coalesce(none, empty))
    counted = facts.select(F.explode(rows).alias("r")).select("r.*")
    text = F.format_string("[%s] %s in %s at %s. Remediation: %s", "severity", "description", "artifact_filename",
                           "location", "remediation_guidance")
    best = top_findings(findings).select(
        F.lit("top_findings").alias("section"), F.col("rank").alias("ord"), F.col("rule_id").alias("key"),
        text.alias("value"),
    )
    return counted.unionByName(best)
