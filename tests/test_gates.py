"""Gate decisions for every branch, empty inputs and groups."""

import pytest

from auditmill.operators import risk, summary
from auditmill.operators.dependencies import analyze_dependencies
from auditmill.operators.findings import facets
from auditmill.operators.gates import gate_details_doc, gate_plan, gate_plan_doc, gate_status_doc, plan_from_facts
from auditmill.plans.audit import all_findings

CASES = {
    "nothing": ({}, dict(CI_SECURITY="WARN", PRE_COMMIT="WARN", PRE_DEPLOY="WARN")),
    "allowed package": ({"requirements.txt": "numpy"}, dict(CI_SECURITY="WARN", PRE_COMMIT="WARN", PRE_DEPLOY="WARN")),
    "unknown package": ({"requirements.txt": "left-pad"}, dict(CI_SECURITY="BLOCK", PRE_COMMIT="WARN", PRE_DEPLOY="WARN")),
    "medium only": ({"a.py": "hashlib.md5(x)"}, dict(CI_SECURITY="WARN", PRE_COMMIT="WARN", PRE_DEPLOY="BLOCK")),
    "high": ({"a.py": "eval(x)"}, dict(CI_SECURITY="BLOCK", PRE_COMMIT="WARN", PRE_DEPLOY="BLOCK")),
    "secret": ({"a.py": "pwd = '12345678'"}, dict(CI_SECURITY="BLOCK", PRE_COMMIT="BLOCK", PRE_DEPLOY="BLOCK")),
}


def tables(make, files, variant="core"):
    artifacts = make(files or {"x.py": ""}, variant=variant)
    return artifacts, all_findings(artifacts, variant, variant), analyze_dependencies(artifacts, variant)


@pytest.mark.parametrize("case", list(CASES))
def test_core_plan(make, case):
    files, expected = CASES[case]
    _, found, deps = tables(make, files)
    rows = gate_plan(found, deps).orderBy("gate_ord").collect()
    assert [r.gate_type for r in rows] == ["CI_SECURITY", "PRE_COMMIT", "CI_BUILD", "CI_TEST", "PRE_DEPLOY"]
    assert {r.gate_type: r.failure_action for r in rows} == {**expected, "CI_BUILD": "BLOCK", "CI_TEST": "BLOCK"}
    assert rows[1].tools == (["Secret Scanner"] if expected["PRE_COMMIT"] == "BLOCK" else ["Secret Scanner", "Linter"])


DOC_CASES = {
    "nothing": ({}, ("PASS", "PASS", "PASS"), "PASS", "Analysis completed. No significant risks found to block the pipeline."),
    "few medium": ({"a.py": "hashlib.md5(x)\n" * 2}, ("PASS", "PASS", "PASS"), "PASS",
                   "Analysis completed. No significant risks found to block the pipeline."),
    "more medium": ({"a.py": "hashlib.md5(x)\n" * 3}, ("PASS", "WARN", "PASS"), "WARN",
                    "Analysis completed. CI Security gate warning due to Medium findings."),
    "denied package": ({"requirements.txt": "pyyaml"}, ("PASS", "PASS", "BLOCK"), "BLOCK",
                       "Analysis completed. CI Build gate blocking due to insecure/hallucinated dependencies."),
    "secret": ({"a.py": "token = 'abcdefghijklmnop'"}, ("BLOCK", "BLOCK", "PASS"), "BLOCK",
               "Analysis completed. Pre-commit gate blocking due to hardcoded secrets. "
               "CI Security gate blocking due to Critical/High findings."),
}


@pytest.mark.parametrize("case", list(DOC_CASES))
def test_doc_plan(make, case):
    files, actions, overall, text = DOC_CASES[case]
    _, found, deps = tables(make, files, "doc")
    plan = gate_plan_doc(found, deps)
    rows = plan.orderBy("gate_ord").collect()
    assert [r.gate_type for r in rows] == ["PRE_COMMIT", "CI_SECURITY", "CI_BUILD"]
    assert tuple(r.action for r in rows) == actions
    assert all((r.details is None) == (r.action == "PASS") for r in rows)
    status = gate_status_doc(plan)
    assert tuple(status.select("overall_status", "summary").first()) == (overall, text)
    assert len(status.first().plan_id) == 64 and status.first().plan_id == gate_status_doc(plan).first().plan_id


def test_doc_details_are_rows(make):
    files = {"a.py": "token = 'abcdefghijklmnop'\neval(x)", "requirements.txt": "pyyaml\nx-pro"}
    _, found, deps = tables(make, files, "doc")
    rows = gate_details_doc(found, deps).collect()
    assert sorted((r.gate_type, r.detail) for r in rows) == [
        ("CI_BUILD", "denylisted"), ("CI_BUILD", "hallucinated"), ("CI_SECURITY", "finding_id"), ("CI_SECURITY", "finding_id"),
        ("CI_SECURITY", "finding_id"), ("PRE_COMMIT", "finding_id")]


def test_plan_per_group(make):
    artifacts, found, deps = tables(make, [("a.py", "eval(x)", "CLAUDE"), ("b.py", "x", "AGENT"), ("requirements.txt", "what", "COPILOT")])
    plan = gate_plan(*[t.withColumnRenamed("artifact_source", "source") for t in (found, deps)], artifacts=artifacts, keys=["source"])
    actions = {(r.source, r.gate_type): r.failure_action for r in plan.collect()}
    assert len(actions) == 15
    assert [actions[s, "CI_SECURITY"] for s in ("CLAUDE", "AGENT", "COPILOT")] == ["BLOCK", "WARN", "BLOCK"]
    assert [actions[s, "PRE_DEPLOY"] for s in ("CLAUDE", "AGENT", "COPILOT")] == ["BLOCK", "WARN", "WARN"]


def test_facts_add_up(make):
    artifacts, found, deps = tables(make, {"a.py": "eval(x)\nhashlib.md5(y)", "b.py": "pickle.loads(z)", "requirements.txt": "q\npyyaml"})
    whole = risk.risk_facts(found, deps, artifacts)
    parts = [risk.risk_facts(found.where(c), deps.where(c), artifacts.where(c)) for c in ("artifact_seq = 0", "artifact_seq > 0")]
    merged = risk.merge_facts(parts[0].unionByName(parts[1]))
    assert merged.collect() == whole.collect()
    assert plan_from_facts(merged).collect() == gate_plan(found, deps).collect()


def test_empty_inputs_give_zero_rows_filled(make):
    artifacts, found, deps = (t.where("false") for t in tables(make, {"a.py": "eval(x)"}))
    assert risk.total_risk_score(found).first()[0] == 0
    assert tuple(risk.gate_flags(found, deps).first()) == (False, False, False, 0)
    assert [r.finding_count for r in risk.severity_breakdown(found).collect()] == [0] * 4
    assert [r.finding_count for r in risk.finding_type_breakdown(found).collect()] == [0] * 3
    assert tuple(risk.dashboard_metrics(found, deps, artifacts).first()) == (0,) * 6
    assert [r.theme for r in summary.risk_themes(found).collect()] == ["No major risk themes identified - excellent!"]
    rows = summary.executive_summary(found, deps, artifacts).collect()
    assert ("top_findings", 1, "none", "No major findings. Excellent work!") in [tuple(r) for r in rows] and len(rows) == 8
    assert facets(found, ["severity", "finding_type"]).count() == 0
    assert risk.artifact_risk_score(artifacts, found).count() == 0
