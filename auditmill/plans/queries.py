"""Registered queries: each reads whole benchmark tables, or corpora Spark derives from them, and returns one plan."""

from __future__ import annotations

import ast
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.functions.scoring import finding_type_column
from auditmill.functions.text import explode_lines
from auditmill.operators import evidence, risk, summary
from auditmill.operators import findings as fd
from auditmill.operators.ast_scan import scan_errors, scan_tree_findings
from auditmill.operators.dependencies import (
    analyze_dependencies,
    classify,
    dependencies_view,
    dependency_findings,
    dependency_risk_summary,
    hallucinated_packages,
    parse_manifests,
)
from auditmill.operators.gates import LEVELS, gate_details_doc, gate_plan, gate_plan_doc, gate_plan_rollup, gate_status_doc
from auditmill.operators.proofs import artifact_proofs, proven_root
from auditmill.operators.regex_scan import scan_lines
from auditmill.operators.rule_table import scan_lines_by_table
from auditmill.operators.rule_table import rule_table as line_rule_table
from auditmill.operators.scan_store import ScanStore
from auditmill.plans.audit import all_findings, joined_gate_plan, package_outputs_hash, package_size, run_audit, write_package, write_reports
from auditmill.plans.package import STAGES, verify_package
from auditmill.plans.storage import new_path, stored
from auditmill.rules import CORE, Rule, ruleset
from auditmill.sources import corpora
from auditmill.sources.artifacts import (
    artifacts_from,
    inventory,
    language_by_extension,
    pasted_snippets,
    route,
    split_invalid,
)
from auditmill.sources.upload_source import read_source, write_files
from auditmill.streaming.arrivals import drained
from auditmill.streaming.replacement import KEY, current_scores, score_changes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

FINDING_TEXT = (
    "finding_type", "severity", "rule_id", "description", "location", "evidence_snippet", "remediation_guidance",
    "cwe_mapping",
)
FINDING_COLUMNS = ("artifact_id", "artifact_filename", "artifact_source", *FINDING_TEXT, "phase", "line_no", "rule_ord", "dup")


def query(name: str | None = None):
    """Register a query under its own name, or under `name` where an operator has taken it."""

    def register(fn):
        QUERIES[name or fn.__name__] = fn
        return fn

    return register


def _findings(spark, sf):
    return all_findings(corpora.audit_corpus(spark, sf))


def _tables(spark, sf):
    """(corpus, findings, dependencies), manifests parsed in one place."""
    corpus, dependencies = corpora.audit_corpus(spark, sf), _dependencies(spark, sf)
    return corpus, all_findings(corpus, dependencies=dependencies), dependencies


def _audit(spark, sf):
    """A stored run for the outputs that read findings several times; they need no parse errors."""
    return run_audit(stored(corpora.audit_corpus(spark, sf), "corpus"), report_errors=False)


def _dependencies(spark, sf, packages="core"):
    return analyze_dependencies(corpora.dep_corpus(spark, sf), packages)


def _doc_corpus(spark, sf):
    """The audit corpus with languages by extension."""
    return corpora.audit_corpus(spark, sf).withColumn("language", language_by_extension(F.col("filename")))


def _doc_tables(spark, sf):
    corpus = _doc_corpus(spark, sf)
    dependencies = analyze_dependencies(corpus, "doc")
    return all_findings(corpus, "doc", "doc", dependencies), dependencies


# --- Sources and routing --------------------------------------------------------------------------------------------


@query()
def artifact_inventory(spark, sf):
    preview = F.concat(F.substring("content_hash", 1, 16), F.lit("..."))
    return corpora.document_artifacts(spark, sf).select(
        "artifact_id", "artifact_seq", "filename", "source", "language", "content_hash", preview.alias("hash_preview")
    )


@query()
def code_artifact_inventory(spark, sf):
    return inventory(corpora.code_corpus(spark, sf))


@query()
def code_artifact_inventory_legacy(spark, sf):
    return inventory(corpora.code_corpus(spark, sf), legacy=True)


@query()
def artifact_language(spark, sf):
    return _doc_corpus(spark, sf).select("artifact_seq", "filename", "language")


@query()
def artifact_routing(spark, sf):
    return corpora.audit_corpus(spark, sf).select("artifact_seq", "filename", route().alias("route"))


@query()
def sniffed_filename(spark, sf):
    turns = corpora.conversation_snippets(spark, sf).select(
        F.concat_ws("/", F.lit("turn"), "conv_id", "turn").alias("snippet_id"), "content"
    )
    files = corpora.audit_corpus(spark, sf).select(
        F.concat_ws("/", F.lit("file"), "filename").alias("snippet_id"), "content"
    )
    pasted = pasted_snippets(turns.unionByName(files))
    return pasted.select("snippet_id", "filename", F.sha2("content", 256).alias("content_hash"))


@query()
def artifact_lines(spark, sf):
    return explode_lines(corpora.document_artifacts(spark, sf), ["artifact_seq"])


def _uploaded(spark, sf, **how):
    """Every document as an uploaded text, written by tasks and read back through the registered source."""
    path = new_path(spark, "uploads")
    texts = corpora.table(spark, sf, "documents").where("text IS NOT NULL").selectExpr("concat('d', doc_id, '.txt') AS filename", "text AS content")
    write_files(texts, path, **how)
    return read_source(spark, path).select(
        "filename", F.sha2("content", 256).alias("content_hash"), F.octet_length("content").alias("n_bytes"), "error_class"
    )


@query()
def upload_round_trip(spark, sf):
    return _uploaded(spark, sf)


@query()
def archive_round_trip(spark, sf):
    return _uploaded(spark, sf, archives=True)


# --- Scans ----------------------------------------------------------------------------------------------------------


@query()
def secret_findings_documents(spark, sf):
    return scan_lines(corpora.document_artifacts(spark, sf)).select("finding_id", *FINDING_COLUMNS)


@query()
def regex_findings(spark, sf):
    return scan_lines(corpora.code_corpus(spark, sf)).select("finding_id", *FINDING_COLUMNS)


@query()
def regex_findings_notebook(spark, sf):
    return scan_lines(corpora.code_corpus(spark, sf), "notebook").select(*FINDING_COLUMNS)


@query()
def regex_findings_doc(spark, sf):
    return scan_lines(_doc_corpus(spark, sf), "doc").select(*FINDING_COLUMNS)


@query()
def ast_findings(spark, sf):
    return scan_tree_findings(corpora.code_corpus(spark, sf), once_per_content=True).select(*FINDING_COLUMNS)


@query()
def ast_findings_in_place(spark, sf):
    return scan_tree_findings(corpora.code_corpus(spark, sf)).select(*FINDING_COLUMNS)


@query()
def ast_findings_incremental(spark, sf):
    """Two runs over one result store: first every other file, then all files, of which only the rest is parsed."""
    corpus = stored(corpora.code_corpus(spark, sf), "corpus")
    store = ScanStore(spark, new_path(spark, "scan_store"))
    store.add(corpus.where("artifact_seq % 2 = 0"), report_errors=False)
    return store.findings(corpus).select(*FINDING_COLUMNS)


@query()
def ast_findings_dedup(spark, sf):
    return fd.drop_repeated(scan_tree_findings(corpora.code_corpus(spark, sf))).select(*FINDING_COLUMNS)


@query()
def ast_findings_doc(spark, sf):
    return scan_tree_findings(_doc_corpus(spark, sf), "doc").select(*FINDING_COLUMNS)


@query()
def ast_findings_nested(spark, sf):
    """Tree findings in nested code, with the ids and the tree positions that order them."""
    return scan_tree_findings(corpora.nested_corpus(spark, sf)).select("finding_id", "position", *FINDING_COLUMNS)


@query("scan_errors")
def scan_error_rows(spark, sf):
    return scan_errors(corpora.code_corpus(spark, sf)).select("artifact_id", "stage", "error_class")


@query()
def audit_scan_errors(spark, sf):
    """Parse errors as a whole stored run keeps them."""
    audit = run_audit(stored(corpora.audit_corpus(spark, sf), "corpus"))
    return audit.scan_errors.select("artifact_id", "stage", "error_class")


def _aliased_shell(node: ast.AST) -> bool:
    """Any `<name>.run(..., shell=True)` other than subprocess.run."""
    match node:
        case ast.Call(func=ast.Attribute(value=ast.Name(id=owner), attr="run")) if owner != "subprocess":
            return any(k.arg == "shell" and getattr(k.value, "value", None) is True for k in node.keywords)
    return False


CUSTOM_RULES = (
    Rule("INJECTION_JSON_LOADS", "REGEX", "LOW", "JSON is loaded.", "Validate the input.", "CWE-20",
         r"\b(?P<json_module>json)\.loads\("),
    Rule("DANGEROUS_EXEC_ALIASED_SHELL", "AST", "HIGH", "Shell call through an alias.", "Avoid shell=True.", "CWE-78",
         check=_aliased_shell, node_types=(ast.Call,), finding_type="DANGEROUS_EXEC"),
)


@query()
def custom_rule_findings(spark, sf):
    rules = CORE.with_rules(*CUSTOM_RULES)
    corpus = corpora.code_corpus(spark, sf)
    found = fd.union_findings(scan_lines(corpus, rules), scan_tree_findings(corpus, rules))
    return found.where(F.col("rule_id").isin(*[r.rule_id for r in CUSTOM_RULES])).select(*FINDING_COLUMNS)


def rule_table(spark: SparkSession, name: str = "core") -> DataFrame:
    """A rule catalog as a table, finding types derived from the rule ids."""
    rows = [(r.rule_id, r.method, r.severity, e.rule_id, e.finding_type, r.cwe_mapping)
            for r in ruleset(name).rules for e in r.emits if e.rule_id == r.rule_id]
    table = spark.createDataFrame(
        rows, "rule_id string, detection_method string, severity string, emitted string, emitted_type string, cwe_mapping string"
    )
    by_id = F.coalesce(finding_type_column(F.col("emitted")), F.col("emitted_type"))
    return table.select("rule_id", "detection_method", "severity", by_id.alias("finding_type"), "cwe_mapping")


@query()
def rule_catalog(spark, sf):
    corpus = corpora.code_corpus(spark, sf)
    found = fd.union_findings(scan_lines(corpus), scan_tree_findings(corpus))
    return risk.rule_hits(rule_table(spark), found)


def order_rules(spark: SparkSession, sf: str) -> DataFrame:
    """A rule table of the core line rules and one rule per order: of four shapes, two of which the code corpus can match."""
    key = F.col("o_orderkey").cast("string")
    shapes = F.array(
        F.concat(F.lit(r'hashlib\.md5\(b"'), key, F.lit(r'"\)')),
        F.concat(F.lit("^x"), key, F.lit(r"\s*=\s*"), key, F.lit("$")),
        F.concat(F.lit("deprecated_module_"), key, F.lit(r"\.(?:load|dump)\(")),
        F.concat(F.lit(r'(?:sha1\(b"'), key, F.lit(r'"\)|md5\(b"'), key, F.lit(r'"\))')),
    )
    own = corpora.table(spark, sf, "orders").select(
        (F.col("o_orderkey") + 100).cast("int").alias("rule_ord"),
        F.concat(F.lit("ORDER_"), key).alias("rule_id"),
        F.lit("UNSAFE_CRYPTO").alias("finding_type"), F.lit("LOW").alias("severity"),
        F.concat(F.lit("Mark of order "), key, F.lit(".")).alias("description"),
        F.lit("Remove the mark.").alias("remediation_guidance"), F.lit("CWE-1").alias("cwe_mapping"),
        F.get(shapes, (F.col("o_orderkey") % 4).cast("int")).alias("pattern"),
    )
    return line_rule_table(spark).unionByName(own)


@query()
def rule_table_findings(spark, sf):
    """The line scan with all rules in a table: more than ten thousand at scale factor 0.01."""
    rules = stored(order_rules(spark, sf), "rules")
    return scan_lines_by_table(corpora.code_corpus(spark, sf), rules).select("finding_id", *FINDING_COLUMNS)


@query()
def stream_secret_findings(spark, sf):
    """The line scan over documents arriving as a stream; the sink's table equals the batch result."""
    schema = corpora.table(spark, sf, "documents").schema
    # A glob takes the table as one file or as a folder of files.
    arrivals = spark.readStream.schema(schema).parquet(f"{sf}/documents.parque[t]")
    found = scan_lines(corpora.documents_as_artifacts(arrivals))
    return drained(found, "stream_secret_findings").select("finding_id", *FINDING_COLUMNS)


@query()
def stream_latest_scores(spark, sf):
    """Four documents as versions of one artifact, arriving in files that deal the versions out of order."""
    rows = corpora.table(spark, sf, "documents").where("text IS NOT NULL").selectExpr(
        "concat('a', doc_id DIV 4) AS artifact_key", "doc_id % 4 AS version", "doc_id AS artifact_seq",
        "concat('a', doc_id DIV 4, '.md') AS filename", "source", "text AS content",
    )
    path = new_path(spark, "arrivals")
    # Two rounds of arrivals at every size; the files grow in number with the table, not in size.
    files = 4 * rows.rdd.getNumPartitions()
    rows.repartition(files, F.xxhash64("artifact_seq")).write.parquet(path)
    arrivals = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files // 2).parquet(path)
    return current_scores(drained(score_changes(artifacts_from(arrivals, extra=KEY)), "changes"))


# --- Dependencies ---------------------------------------------------------------------------------------------------


def _parsed(spark, sf, suffix):
    rows = parse_manifests(corpora.dep_corpus(spark, sf)).where(F.col("source_file").endswith(suffix))
    return rows.select("artifact_id", "source_file", "line_no", "name", "version_spec")


@query()
def dep_parse_requirements(spark, sf):
    return _parsed(spark, sf, "requirements.txt")


@query()
def dep_parse_pyproject(spark, sf):
    return _parsed(spark, sf, "pyproject.toml")


@query()
def dep_parse_package_json(spark, sf):
    return _parsed(spark, sf, "package.json")


def _classified(spark, sf, packages):
    return _dependencies(spark, sf, packages).select(
        "artifact_id", "source_file", "line_no", "name", "version_spec", "status", "suspicious"
    )


@query()
def dep_classification(spark, sf):
    return _classified(spark, sf, "core")


@query()
def dep_classification_notebook(spark, sf):
    return _classified(spark, sf, "notebook")


@query()
def dep_classification_doc(spark, sf):
    return _classified(spark, sf, "doc")


@query()
def dep_classification_policy_table(spark, sf):
    """Lists kept as a table with repeated rows, derived from the parts: the join form of the classification."""
    policy_table = corpora.table(spark, sf, "part").selectExpr(
        "element_at(array('requests', 'numpy', 'pandas', 'left-pad', 'shodan', 'boto3'), CAST(p_partkey % 6 AS INT) + 1) AS name",
        "IF(p_partkey % 6 < 4, 'ALLOW', IF(p_size > 25, 'DENY', 'ALLOW')) AS status",
    )
    rows = classify(parse_manifests(corpora.dep_corpus(spark, sf)), policy_table=policy_table)
    return rows.select("artifact_id", "source_file", "line_no", "name", "version_spec", "status", "suspicious")


@query()
def dependency_report(spark, sf):
    return _dependencies(spark, sf).select(
        "artifact_id", "line_no", "name", "version_spec", "source_file", "status", "risk_notes"
    )


@query("dependency_findings")
def dependency_finding_rows(spark, sf):
    return fd.dependency_related(dependency_findings(_dependencies(spark, sf))).select("finding_id", *FINDING_COLUMNS)


@query()
def dependency_findings_doc(spark, sf):
    return dependency_findings(_dependencies(spark, sf, "doc"), "doc").select(*FINDING_COLUMNS)


@query("hallucinated_packages")
def hallucinated_package_names(spark, sf):
    return hallucinated_packages(dependency_findings(_dependencies(spark, sf)))


@query()
def dependencies_filtered(spark, sf):
    deps = _dependencies(spark, sf)
    return dependencies_view(deps, dependency_findings(deps), ["UNKNOWN", "DENY"])


@query()
def dependencies_hallucinated(spark, sf):
    deps = _dependencies(spark, sf)
    return dependencies_view(deps, dependency_findings(deps), only_hallucinated=True)


@query()
def dependency_facets(spark, sf):
    return fd.facets(_dependencies(spark, sf), ["status"])


@query("dependency_risk_summary")
def dependency_risk_totals(spark, sf):
    deps = _dependencies(spark, sf)
    return dependency_risk_summary(deps, dependency_findings(deps), ["UNKNOWN"])


# --- Findings -------------------------------------------------------------------------------------------------------


@query("all_findings")
def all_finding_rows(spark, sf):
    return _findings(spark, sf).select(*FINDING_COLUMNS)


@query()
def finding_artifact_lookup(spark, sf):
    """Filenames looked up in an inventory that lacks the manifests: their findings show N/A."""
    looked_up = fd.with_filename(_findings(spark, sf), corpora.code_corpus(spark, sf))
    return looked_up.select("artifact_id", "artifact_filename", "rule_id", "line_no", "dup")


@query()
def findings_by_phase(spark, sf):
    return fd.findings_by_phase(_findings(spark, sf))


@query()
def findings_filtered(spark, sf):
    chosen = fd.filter_findings(_findings(spark, sf), ["CRITICAL", "MEDIUM"], ["SECRET", "UNSAFE_CRYPTO", "HALLUCINATED_PACKAGE"])
    return fd.findings_view(chosen)


@query()
def findings_wide(spark, sf):
    return fd.findings_view(_findings(spark, sf), wide=True)


@query()
def finding_detail(spark, sf):
    return fd.finding_detail(fd.filter_findings(_findings(spark, sf), ["HIGH"]), 7)


@query("finding_positions")
def finding_position_rows(spark, sf):
    """Every finding with its 1-based place in the report."""
    rows = fd.finding_positions(stored(_findings(spark, sf), "findings"))
    return rows.select("report_position", *FINDING_COLUMNS)


@query()
def finding_detail_deep(spark, sf):
    """A finding far behind the first page of the report."""
    return fd.finding_detail(stored(_findings(spark, sf), "findings"), 1500)


@query()
def finding_facets(spark, sf):
    return fd.facets(_findings(spark, sf), ["severity", "finding_type"])


@query()
def finding_type_breakdown(spark, sf):
    return risk.finding_type_breakdown(_findings(spark, sf))


@query()
def severity_breakdown(spark, sf):
    return risk.severity_breakdown(_findings(spark, sf))


@query()
def severity_breakdown_documents(spark, sf):
    return risk.severity_breakdown(scan_lines(corpora.document_artifacts(spark, sf)))


_TOP = ("rank", "severity", "finding_type", "rule_id", "description", "artifact_filename", "location", "remediation_guidance")


@query()
def top_findings(spark, sf):
    return fd.top_findings(_findings(spark, sf)).select(*_TOP)


@query()
def top_findings_ranked(spark, sf):
    return fd.top_findings(_findings(spark, sf), rank_by="severity_rank").select(*_TOP)


# --- Risk, gates, summary -------------------------------------------------------------------------------------------


@query()
def total_risk_score(spark, sf):
    return risk.total_risk_score(_findings(spark, sf))


@query()
def artifact_risk_score(spark, sf):
    corpus = corpora.audit_corpus(spark, sf)
    return risk.artifact_risk_score(corpus, all_findings(corpus))


@query()
def artifact_risk_score_copies(spark, sf):
    """Every document as a paste that nothing but its text identifies: equal pastes stay separate artifacts."""
    pastes, _ = split_invalid(corpora.table(spark, sf, "documents").select("source", F.col("text").alias("content")))
    artifacts = artifacts_from(pastes)
    return risk.artifact_risk_score(artifacts, scan_lines(artifacts))


@query()
def gate_flags(spark, sf):
    return risk.gate_flags(*_tables(spark, sf)[1:])


@query("gate_plan")
def gate_plan_rows(spark, sf):
    return joined_gate_plan(gate_plan(*_tables(spark, sf)[1:]))


@query()
def gate_plan_by_source(spark, sf):
    corpus, *tables = _tables(spark, sf)
    by_source = [t.withColumnRenamed("artifact_source", "source") for t in tables]
    return joined_gate_plan(gate_plan(*by_source, artifacts=corpus, keys=["source"]))


@query()
def gate_plan_by_artifact(spark, sf):
    corpus, found, dependencies = _tables(spark, sf)
    plan = gate_plan(found, dependencies, artifacts=corpus, keys=["artifact_id"])
    return plan.select("artifact_id", "gate_ord", "gate_type", "failure_action")


@query("gate_plan_rollup")
def gate_plan_rollup_rows(spark, sf):
    """The gates of the whole, of every source, language and artifact, from one aggregate."""
    corpus, found, dependencies = _tables(spark, sf)
    keyed = [
        df.withColumns({"source": F.col(source), "language": language_by_extension(F.col(name))})
        for df, source, name in (
            (found, "artifact_source", "artifact_filename"), (dependencies, "artifact_source", "source_file"), (corpus, "source", "filename"))
    ]
    keys = dict.fromkeys(k for own in LEVELS.values() for k in own)
    return gate_plan_rollup(*keyed).select("level", *keys, "gate_ord", "gate_type", "failure_action", "owner_role")


@query("gate_plan_doc")
def gate_plan_doc_rows(spark, sf):
    return joined_gate_plan(gate_plan_doc(*_doc_tables(spark, sf)))


@query("gate_details_doc")
def gate_details_doc_rows(spark, sf):
    """The finding ids and package names that each gate of the documentation variant blocks on."""
    return gate_details_doc(*_doc_tables(spark, sf))


@query("gate_status_doc")
def gate_status_doc_row(spark, sf):
    return gate_status_doc(gate_plan_doc(*_doc_tables(spark, sf))).drop("created_at")


@query()
def risk_themes(spark, sf):
    return summary.risk_themes(_findings(spark, sf))


@query()
def executive_summary(spark, sf):
    return _audit(spark, sf).executive_summary


@query()
def dashboard_metrics(spark, sf):
    corpus, found, dependencies = _tables(spark, sf)
    return risk.dashboard_metrics(found, dependencies, corpus)


# --- Evidence -------------------------------------------------------------------------------------------------------


@query()
def inputs_hash(spark, sf):
    return evidence.inputs_hash(corpora.document_artifacts(spark, sf))


@query()
def inputs_hash_tree(spark, sf):
    return evidence.inputs_hash_tree(corpora.document_artifacts(spark, sf))


@query()
def outputs_hash(spark, sf):
    return _audit(spark, sf).outputs_hash


@query()
def evidence_manifest(spark, sf):
    audit = _audit(spark, sf)
    header = evidence.manifest_header(evidence.inputs_hash_tree(audit.artifacts), audit.outputs_hash)
    return header.select("run_id", "team_or_user", "app_version", "inputs_hash_tree", "outputs_hash")


@query()
def evidence_manifest_artifacts(spark, sf):
    return evidence.manifest_artifacts_table(corpora.audit_corpus(spark, sf))


@query("package_size")
def package_size_text(spark, sf):
    return package_size(corpora.audit_corpus(spark, sf).unionByName(corpora.document_artifacts(spark, sf)))


@query("artifact_proofs")
def artifact_proof_rows(spark, sf):
    """A proof for every document that its hash is among the inputs, checked against the root, and with another hash."""
    proofs = artifact_proofs(corpora.document_artifacts(spark, sf))
    other = F.sha2(F.col("content_hash"), 256)
    return proofs.select(
        "artifact_id", "content_hash", "copies", "root",
        F.aggregate("steps", F.lit(0), lambda n, s: n + s["siblings"]).cast("bigint").alias("n_siblings"),
        (proven_root(F.col("content_hash"), F.col("copies"), F.col("steps")) == F.col("root")).alias("proven"),
        (proven_root(other, F.col("copies"), F.col("steps")) == F.col("root")).alias("other_proven"),
    )


@query()
def package_round_trip(spark, sf):
    """A package that is written, half written again, and written again: what its files then hold, digests checked."""
    corpus = stored(corpora.audit_corpus(spark, sf), "corpus")
    target = write_package(run_audit(corpus))
    write_reports(run_audit(corpus.where("artifact_seq % 2 = 0")), f"{target}/{STAGES}/interrupted")
    write_package(run_audit(corpus), target)
    outputs = package_outputs_hash(spark, target).first()[0]
    return verify_package(spark, target).select("dataset", "n_rows", "valid", F.lit(outputs).alias("outputs_hash"))
