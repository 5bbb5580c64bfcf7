"""A full run over the six sample files has the documented counts, lines, scores, gates and order."""

import hashlib

import pytest
from pyspark.sql import functions as F

from auditmill.operators import findings as fd
from auditmill.operators import risk
from auditmill.plans.audit import run_audit
from auditmill.schemas import FINDING_FIELDS
from auditmill.sources.artifacts import sample_source_tag
from tests.samples import FILES


@pytest.fixture(scope="module")
def audit(spark):
    from auditmill.sources.artifacts import artifacts_from

    rows = [(n, name, content) for n, (name, content, _) in enumerate(FILES)]
    df = spark.createDataFrame(rows, "artifact_seq bigint, filename string, content string")
    return run_audit(artifacts_from(df.withColumn("source", sample_source_tag(F.col("filename")))))


def test_source_tags(audit):
    assert {r.filename: r.source for r in audit.artifacts.collect()} == {name: tag for name, _, tag in FILES}


def test_findings_in_report_order(audit):
    rows = audit.findings.orderBy(*fd.ordered_columns()).collect()
    assert [(r.artifact_filename, r.rule_id, r.line_no) for r in rows] == [
        ("app_with_secrets.py", "SECRET_API_KEY", 5),
        ("app_with_secrets.py", "SECRET_API_KEY", 6),
        ("app_with_secrets.py", "SECRET_AWS_KEY", 6),
        ("data_processor.py", "INJECTION_SQL_FSTRING", 9),
        ("data_processor.py", "UNSAFE_CRYPTO_MD5", 15),
        # breadth first: the call at line 24 is nearer to the root than the one at line 13
        ("app_with_secrets.py", "AST_PICKLE_LOADS", 24),
        ("app_with_secrets.py", "AST_DANGEROUS_EVAL_EXEC", 13),
        ("app_with_secrets.py", "AST_DANGEROUS_EVAL_EXEC", 13),
        ("data_processor.py", "AST_SUBPROCESS_SHELL_TRUE", 21),
        ("data_processor.py", "AST_SUBPROCESS_SHELL_TRUE", 21),
        ("requirements.txt", "DEP_HALLUCINATION_RISK", 3),
        ("requirements.txt", "DEP_DENYLISTED", 4),
        ("pyproject.toml", "DEP_HALLUCINATION_RISK", 7),
    ]
    assert [r.location for r in rows[:3]] == ["line 5", "line 6", "line 6"]
    assert rows[6].evidence_snippet == "eval(body['expr'])"
    assert rows[10].evidence_snippet == "flask-billing-pro==0.3.1 # suggested by an assistant"
    assert rows[11].location == "File: requirements.txt"
    assert len({r.finding_id for r in rows}) == 13


def test_public_fields_come_first(audit):
    assert tuple(audit.findings.columns[:10]) == FINDING_FIELDS


def test_scores(audit):
    rows = risk.artifact_risk_score(audit.artifacts, audit.findings).collect()
    assert {r.filename: r.risk_score for r in rows} == {
        "app_with_secrets.py": 500, "data_processor.py": 160, "simple_script.py": 0,
        "requirements.txt": 60, "pyproject.toml": 10, "package.json": 0,
    }
    assert risk.total_risk_score(audit.findings).first()[0] == 730
    assert [tuple(r) for r in risk.severity_breakdown(audit.findings).collect()] == [
        ("CRITICAL", 4), ("HIGH", 6), ("MEDIUM", 3), ("LOW", 0),
    ]


def test_dependencies(audit):
    rows = audit.dependencies.orderBy("artifact_seq", "line_no").collect()
    assert [(r.name, r.version_spec, r.status) for r in rows] == [
        ("requests", "2.31", "ALLOW"),
        ("flask-billing-pro", "0.3.1 # suggested by an assistant", "UNKNOWN"),
        ("pyyaml", "6.0 # loader", "DENY"),
        ("numpy", "1.26.0", "ALLOW"),
        ("fastapi", "0.110", "ALLOW"),
        ("shoplib-enterprise", "0.1", "UNKNOWN"),
        ("sqlalchemy", "2.0.1", "ALLOW"),
        ("name", "shop-front", "UNKNOWN"),
        ("version", "3.1.0", "UNKNOWN"),
        ("express", "^4.18.0", "UNKNOWN"),
        ("lodash.get", "^4.4.2", "UNKNOWN"),
        ("tiny-widget", "0.9.0", "UNKNOWN"),
    ]
    notes = {r.name: r.risk_notes for r in rows}
    assert notes["requests"] is None
    assert notes["pyyaml"] == "Package 'pyyaml' is on the denylist."
    assert notes["express"] == "Package 'express' is not in the allowlist or denylist."
    assert notes["shoplib-enterprise"].endswith("flagged as potential hallucination risk (suspicious naming).")


def test_gates_all_block(audit):
    rows = audit.gate_plan.orderBy("gate_ord").collect()
    assert [r.gate_type for r in rows] == ["CI_SECURITY", "PRE_COMMIT", "CI_BUILD", "CI_TEST", "PRE_DEPLOY"]
    assert {r.failure_action for r in rows} == {"BLOCK"}
    assert rows[1].tools == ["Secret Scanner"] and rows[2].evidence_required == []
    assert [r.owner_role for r in rows] == [
        "DevSecOps Team", "DevSecOps Team", "Development Team", "QA Team", "Release Manager"]


def test_top_five(audit):
    top = fd.top_findings(audit.findings).orderBy("rank").collect()
    assert [(r["rank"], r.rule_id, r.artifact_filename) for r in top] == [
        (1, "UNSAFE_CRYPTO_MD5", "data_processor.py"),
        (2, "DEP_HALLUCINATION_RISK", "requirements.txt"),
        (3, "DEP_HALLUCINATION_RISK", "pyproject.toml"),
        (4, "DEP_DENYLISTED", "requirements.txt"),
        (5, "INJECTION_SQL_FSTRING", "data_processor.py"),
    ]
    ranked = fd.top_findings(audit.findings, rank_by="severity_rank").orderBy("rank").collect()
    assert [r.severity for r in ranked] == ["CRITICAL"] * 4 + ["HIGH"]


def test_summary(audit):
    rows = {(r.section, r.ord): (r.key, r.value) for r in audit.executive_summary.collect()}
    assert rows["overview", 1] == ("code_artifacts", "6") and rows["overview", 2] == ("dependencies", "12")
    assert [rows["risk_themes", n][1] for n in (1, 2, 3)] == [
        "Hard-coded Secrets & Credential Leaks",
        "Insecure Input Handling & Dynamic Execution",
        "Dependency / Package Hallucinations & Risky Libraries",
    ]
    assert rows["top_findings", 5][1] == (
        "[HIGH] Potential SQL injection due to f-string formatting in query. in data_processor.py at line 9. "
        "Remediation: Use parameterized queries instead of f-strings or string concatenation for SQL.")
    assert len(rows) == 2 + 4 + 3 + 5


def test_hashes(audit):
    hashes = sorted(hashlib.sha256(content.encode()).hexdigest() for _, content, _ in FILES)
    assert audit.inputs_hash.first()[0] == hashlib.sha256("".join(hashes).encode()).hexdigest()
    assert audit.outputs_hash.first()[0] == audit.outputs_hash.first()[0]
    assert audit.scan_errors.count() == 0


def test_filename_lookup(audit):
    partial = audit.artifacts.where("filename LIKE '%.py'")
    names = {r.artifact_filename for r in fd.with_filename(audit.findings, partial).collect()}
    assert names == {"app_with_secrets.py", "data_processor.py", "N/A"}


def test_detail_and_filters(audit):
    assert fd.finding_detail(audit.findings, 3).first().label == "HIGH - INJECTION_SQL_FSTRING (data_processor.py)"
    assert fd.finding_detail(audit.findings, 13).count() == 0
    only = fd.filter_findings(audit.findings, ["CRITICAL"], ["SECRET"])
    assert {(r.severity, r.finding_type) for r in only.collect()} == {("CRITICAL", "SECRET")} and only.count() == 3
    assert fd.filter_findings(audit.findings).count() == 13
    assert fd.findings_view(audit.findings).columns == [
        "severity", "finding_type", "rule_id", "artifact_filename", "location", "description"]
    assert fd.dependency_related(audit.findings).count() == 3
    assert fd.drop_repeated(audit.findings).count() == 11
    assert {r.phase_name: r.new_findings for r in fd.findings_by_phase(audit.findings).collect()} == {
        "regex": 5, "ast": 5, "dependency": 3}


def test_out_of_domain_rows_are_quarantined(audit):
    odd = audit.findings.withColumn("severity", F.expr("IF(rule_id = 'SECRET_AWS_KEY', 'SEVERE', IF(rule_id = 'DEP_DENYLISTED', NULL, severity))"))
    good, bad = fd.split_by_domain(odd)
    assert good.count() == 11 and sorted(r.message for r in bad.collect()) == ["INSECURE_DEPENDENCY", "SEVERE/SECRET"]
