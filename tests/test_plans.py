"""Whole runs, the audit package, stored tables, and the shape of physical plans."""

import re
import zipfile

import pytest
from pyspark.sql import functions as F

from auditmill.operators import evidence, risk
from auditmill.operators.ast_scan import scan_errors, scan_tree_findings
from auditmill.operators.dependencies import analyze_dependencies
from auditmill.operators.regex_scan import scan_lines
from auditmill.plans.audit import all_findings, audit_uploads, run_audit, write_manifest, write_package
from auditmill.plans.queries import QUERIES
from auditmill.rules import CORE, Rule
from auditmill.schemas import DEPENDENCY_FIELDS, FINDING_FIELDS, FINDING_ORDER
from auditmill.sources.artifacts import store_artifacts
from tests.samples import FILES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_package(spark, make, tmp_path):
    audit = run_audit(make(FILES))
    target = write_package(audit, str(tmp_path / "package"), team="team x")
    findings = spark.read.json(f"{target}/findings")
    assert findings.count() == 13 and set(FINDING_FIELDS) <= set(findings.columns)
    assert spark.read.json(f"{target}/dependencies").select(*DEPENDENCY_FIELDS).count() == 12
    gates = spark.read.json(f"{target}/gate_plan").orderBy("gate_ord").collect()
    assert [g.failure_action for g in gates] == ["BLOCK"] * 5 and gates[0].tools == ["SAST Scanner", "Dependency Scanner"]
    header = spark.read.json(f"{target}/_manifest/header").first()
    whole = evidence.manifest_header(evidence.inputs_hash_tree(audit.artifacts), audit.outputs_hash).first()
    assert header.team_or_user == "team x" and header.run_id == whole.run_id
    assert header.inputs_hash_tree == whole.inputs_hash_tree and header.outputs_hash == whole.outputs_hash
    write_manifest(audit, str(tmp_path / "again"))
    assert spark.read.json(str(tmp_path / "again" / "_manifest" / "header")).first().run_id == header.run_id
    assert spark.read.json(f"{target}/_manifest/artifacts").count() == 6
    bodies = {r.filename: (r.content, r.source) for r in spark.read.parquet(f"{target}/artifacts").collect()}
    assert bodies == {name: (content, source) for name, content, source in FILES}


@pytest.mark.parametrize("variant", ["core", "doc"])
def test_uploads_to_package(spark, tmp_path, variant):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    with zipfile.ZipFile(inbox / "project.zip", "w") as archive:
        for name, content, _ in FILES[:3]:
            archive.writestr(f"src/{name}", content)
        archive.writestr("src/__init__.py", "def broken(:")
    for name, content, _ in FILES[3:]:
        (inbox / name).write_text(content)
    (inbox / "latin.py").write_bytes(b"# \xe9")
    audit = audit_uploads(spark, str(inbox), out, source="AGENT", rules=variant)
    # doc: one eval, one MD5, one shell call, one pickle, one suspicious package in requirements.txt
    assert audit.findings.count() == {"core": 13, "doc": 5}[variant]
    assert spark.read.json(f"{out}/gate_plan").count() == {"core": 5, "doc": 3}[variant]
    if variant == "doc":
        assert spark.read.json(f"{out}/gate_status").first().overall_status == "BLOCK"
        assert spark.read.json(f"{out}/gate_details").count() == 4 + 2
    assert {r.source for r in audit.artifacts.collect()} == {"AGENT"} and audit.artifacts.count() == 7
    assert spark.read.json(f"{out}/quarantine").count() == 1 and spark.read.json(f"{out}/scan_errors").count() == 1
    assert spark.read.json(f"{out}/findings").count() == audit.findings.count()
    assert spark.read.json(f"{out}/_manifest/artifacts").count() == 7


def test_uploads_and_pastes_in_one_run(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.py").write_text("eval(x)")
    pastes = spark.createDataFrame([(t,) for t in ("eval(x)", "eval(x)", "shodan==1", "", None)], "content string")
    audit = audit_uploads(spark, str(inbox), out, pastes=pastes)
    assert sorted(r.filename for r in audit.artifacts.collect()) == ["a.py", "requirements.txt", "snippet.py", "snippet.py"]
    assert audit.artifacts.select("artifact_id").distinct().count() == 4 and audit.dependencies.count() == 1
    assert audit.findings.where("rule_id LIKE 'AST%'").count() == 3 * 2
    assert [r.error_class for r in spark.read.json(f"{out}/quarantine").collect()] == ["NullContent"]


def test_uploads_are_read_once(spark, tmp_path):
    from auditmill.sources.files import SPREAD_LEVELS, read_rows

    with zipfile.ZipFile(tmp_path / "big.zip", "w") as archive:
        for n in range(400):
            archive.writestr(f"m{n}.py", f"x = {n}")
    rows = read_rows(spark, str(tmp_path))
    assert plan_of(rows).count("MapInArrow") // plan_of(rows).count("AdaptiveSparkPlan") == SPREAD_LEVELS + 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows.select(F.spark_partition_id()).distinct().count() > 4  # members of one archive in several tasks
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_findings_out_of_domain_leave_the_run(make):
    rules = CORE.with_rules(Rule("SECRET_X", "REGEX", "SEVERE", "d", "r", pattern="zzz"))
    audit = run_audit(make({"a.py": "zzz = eval(x)"}), rules)
    assert [r.message for r in audit.out_of_domain.collect()] == ["SEVERE/SECRET"] and audit.findings.count() == 2


def test_variants_do_not_mix(make):
    files = {"a.py": "eval('x')", "b.cfg": "eval('x')", "requirements.txt": "flask-secure-pro==1\n"}
    one, two = run_audit(make(files), "doc"), run_audit(make(files, variant="doc"), "doc", "doc")
    assert sorted(one.findings.collect()) == sorted(two.findings.collect()) and one.doc_gates
    assert sorted(one.dependencies.collect()) == sorted(two.dependencies.collect())
    with pytest.raises(ValueError, match="variants"):
        run_audit(make(files), "doc", "core")


def test_ordered_report(spark, make, tmp_path):
    from auditmill.plans.audit import write_reports

    audit = run_audit(make(FILES), store=False)
    write_reports(audit, str(tmp_path / "r"), ordered=True, fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "r" / "findings")).count() == 13
    files = list((tmp_path / "r" / "findings").glob("severity=*/*.parquet"))
    for file in files:
        rows = spark.read.parquet(str(file)).select(*FINDING_ORDER).toPandas().values.tolist()
        assert rows == sorted(rows)
    assert any(len(spark.read.parquet(str(f)).collect()) > 2 for f in files)


def test_errors_that_were_left_out_cannot_be_read(make):
    with pytest.raises(ValueError, match="parse errors"):
        run_audit(make(FILES), store=False, report_errors=False).scan_errors


def test_run_without_store_is_the_same(make):
    artifacts = make(FILES)
    one, two = run_audit(artifacts), run_audit(artifacts, store=False, once_per_content=True)
    key = ["finding_id", "rule_id", "evidence_snippet"]
    assert sorted(one.findings.select(key).collect()) == sorted(two.findings.select(key).collect())
    assert one.gate_plan_by_source.count() == 4 * 5


def test_stored_artifacts(make, tmp_path):
    artifacts = make(FILES)
    kept = store_artifacts(artifacts, str(tmp_path / "artifacts"))
    for scan in (scan_lines, scan_tree_findings, analyze_dependencies, all_findings):
        assert sorted(map(str, scan(kept).drop("created_at").collect())) == sorted(map(str, scan(artifacts).collect()))
    assert "route=dependency_scan" in str(kept.inputFiles()) and "PartitionFilters: [isnotnull(route" in plan_of(analyze_dependencies(kept))
    # The owners' side of the tree scan, scores and inventory read no content.
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(scan_tree_findings(kept, once_per_content=True)))
    # Contents are read once; beside them ids and hashes, and the stored ids of copies that are left out.
    assert sorted("content:" in s for s in schemas) == [False, False, True] and "artifact_id:string" in schemas
    scores = plan_of(risk.artifact_risk_score(kept, run_audit(kept).findings))
    assert "content:" not in "".join(re.findall(r"ReadSchema: struct<([^>]*)>", scores))


def test_narrow_scans_have_no_exchange(make, tmp_path):
    kept = store_artifacts(make(FILES), str(tmp_path / "artifacts"))
    for df in (scan_lines(kept), analyze_dependencies(kept), scan_tree_findings(kept), scan_errors(kept)):
        assert "Exchange" not in plan_of(df)


STORED = ("audit_scan_errors", "executive_summary", "evidence_manifest", "outputs_hash", "stream_secret_findings")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STORED])
def test_no_cross_joins_or_row_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan
