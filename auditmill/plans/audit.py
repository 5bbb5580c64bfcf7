"""One audit run: artifacts in; findings, dependencies, errors, gates, summary and evidence out."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.functions.text import size_text
from auditmill.operators import evidence, gates, summary
from auditmill.operators.ast_scan import scan_tree_findings, scan_trees, tree_errors, tree_findings
from auditmill.operators.dependencies import analyze_dependencies, dependency_findings
from auditmill.operators.findings import finding_id, split_by_domain, union_findings
from auditmill.operators.regex_scan import scan_lines
from auditmill.operators.risk import risk_facts
from auditmill.plans.package import MANIFEST, Dataset, datasets_of, staged, write_dataset
from auditmill.plans.storage import new_path, stored, write_once
from auditmill.policy import POLICIES, Policy, policy
from auditmill.rules import Ruleset, ruleset
from auditmill.schemas import DEPENDENCY_FIELDS, FINDING_FIELDS, FINDING_ORDER
from auditmill.sources.artifacts import (
    UNUSABLE,
    artifacts_from,
    language_by_extension,
    sniffed_name,
    split_ingest,
    store_ingest,
    stored_ingest,
)
from auditmill.sources.files import read_rows

GATE_COLUMNS = ("gate_ord", "gate_type", "tools", "required_checks", "failure_action", "owner_role", "evidence_required")
DOC_GATE_COLUMNS = ("gate_ord", "gate_type", "action", "reason", "details")
SUMMARY_COLUMNS = ("section", "ord", "key", "value")


@dataclass(frozen=True)
class Audit:
    """Tables of one run. `artifacts` keeps the contents; everything downstream reads only the narrow columns."""

    artifacts: DataFrame
    findings: DataFrame
    dependencies: DataFrame
    errors: DataFrame | None  # None: the run did not look for parse errors
    out_of_domain: DataFrame  # findings of custom rules whose type or severity the variant does not know
    doc_gates: bool = False  # gates of the documentation variant

    @property
    def scan_errors(self) -> DataFrame:
        if self.errors is None:
            raise ValueError("this run left parse errors out (report_errors=False)")
        return self.errors

    @cached_property
    def facts(self) -> DataFrame:
        """One stored row of counts, scores and flags: gates and summary follow from it without reading findings again."""
        return write_once(risk_facts(self.findings, self.dependencies, self.artifacts), "facts")

    @property
    def gate_plan(self) -> DataFrame:
        return gates.doc_plan_from_facts(self.facts) if self.doc_gates else gates.plan_from_facts(self.facts)

    @property
    def gate_plan_by_source(self) -> DataFrame:
        return gates.gate_plan(
            self.findings.withColumnRenamed("artifact_source", "source"),
            self.dependencies.withColumnRenamed("artifact_source", "source"),
            artifacts=self.artifacts, keys=["source"],
        )

    @property
    def executive_summary(self) -> DataFrame:
        return summary.executive_summary(self.findings, self.dependencies, self.artifacts, self.facts)

    @property
    def inputs_hash(self) -> DataFrame:
        return evidence.inputs_hash(self.artifacts)

    @property
    def outputs_hash(self) -> DataFrame:
        return _outputs_hash(self.findings, self.dependencies, self.gate_plan, self.executive_summary)


def _outputs_hash(findings: DataFrame, dependencies: DataFrame, plan: DataFrame, summary_rows: DataFrame) -> DataFrame:
    return evidence.outputs_hash([
        (findings, FINDING_FIELDS[1:]),  # the id restates the order key
        (dependencies, DEPENDENCY_FIELDS),
        (joined_gate_plan(plan), DOC_GATE_COLUMNS if "details" in plan.columns else GATE_COLUMNS),
        (summary_rows, SUMMARY_COLUMNS),
    ])


def joined_gate_plan(plan: DataFrame, sep: str = "|") -> DataFrame:
    """Gate rows with list and map columns joined to text."""
    if "details" in plan.columns:
        return plan.withColumn("details", gates.details_text())
    lists = ("tools", "required_checks", "evidence_required")
    return plan.withColumns({c: F.array_join(c, sep) for c in lists})


def all_findings(
    artifacts: DataFrame,
    rules: str | Ruleset = "core",
    packages: str | Policy = "core",
    dependencies: DataFrame | None = None,
) -> DataFrame:
    """Line, tree and dependency findings of an artifact table, as one lazy plan. Hand in `dependencies` where the
    analyzed dependencies are used beside the findings."""
    if dependencies is None:
        dependencies = analyze_dependencies(artifacts, packages)
    return union_findings(
        scan_lines(artifacts, rules),
        scan_tree_findings(artifacts, rules),
        dependency_findings(dependencies, packages),
    )


def run_audit(
    artifacts: DataFrame,
    rules: str | Ruleset = "core",
    packages: str | Policy | None = None,
    *,
    store: bool = True,
    once_per_content: bool = False,
    report_errors: bool = True,
) -> Audit:
    """Scan everything once. With `store`, scan results are written to the shared folder, since every later output
    reads them again; one tree pass then serves both findings and parse errors. Several passes read `artifacts`, so
    hand in a stored table (`store_artifacts`) when it is costly to derive.

    Without `report_errors`, only contents that may hold a sink are parsed: same findings, and asking for
    the run's `scan_errors` raises. Without `packages`, the policy is the rule set's own; rules of the documentation
    variant take languages by extension, whatever variant the artifacts were made with.
    """
    catalog = ruleset(rules)
    own = catalog.name.removesuffix("+custom")
    packages = policy(packages or (own if own in POLICIES else "doc" if catalog.python_only else "core"))
    if packages.name in (("core", "notebook") if catalog.python_only else ("doc",)):
        raise ValueError(f"rules {catalog.name} and packages {packages.name} belong to different variants")
    if catalog.python_only:
        artifacts = artifacts.withColumn("language", language_by_extension(F.col("filename")))
    keep = stored if store else (lambda df, label, *near: df)
    trees = scan_trees(artifacts, rules, once_per_content=once_per_content, report_errors=report_errors)
    if report_errors:
        trees = keep(trees, "tree_scan", "artifact_id")
    dependencies = keep(analyze_dependencies(artifacts, packages), "dependencies", "artifact_id")
    found = union_findings(
        scan_lines(artifacts, rules), tree_findings(trees, rules), dependency_findings(dependencies, packages)
    )
    # The id follows from columns that are stored, and its digits cannot be packed: it is made again on reading.
    findings = keep(found.drop("finding_id"), "findings", "artifact_id").select(finding_id().alias("finding_id"), "*")
    findings, out_of_domain = split_by_domain(findings, doc=catalog.python_only)
    errors = tree_errors(trees) if report_errors else None
    return Audit(artifacts, findings, dependencies, errors, out_of_domain, catalog.python_only)


def write_reports(audit: Audit, out_dir: str, *, ordered: bool = False, fmt: str = "json") -> list[Dataset]:
    """The report datasets, gate plan as plain strings. `ordered` range-sorts findings into report order; otherwise
    the order columns travel along."""
    findings = audit.findings
    if ordered:
        # The writer needs rows of one severity together; sorted like this it does not sort again by severity alone.
        findings = findings.repartitionByRange(*FINDING_ORDER).sortWithinPartitions("severity", *FINDING_ORDER)
    columns = [c for c in (*FINDING_FIELDS, *FINDING_ORDER, "artifact_filename") if c != "severity"]
    tables = {
        "findings": findings.select(*dict.fromkeys(columns), "severity"),
        "dependencies": audit.dependencies.select(*DEPENDENCY_FIELDS, "artifact_id", "line_no"),
        # At most a few dozen rows each, one output file.
        "gate_plan": audit.gate_plan.coalesce(1),
        "executive_summary": audit.executive_summary.coalesce(1),
        "scan_errors": audit.scan_errors,
        "out_of_domain": audit.out_of_domain,
    }
    if audit.doc_gates:
        tables["gate_status"] = gates.gate_status_doc(audit.gate_plan).coalesce(1)
        tables["gate_details"] = gates.gate_details_doc(audit.findings, audit.dependencies)
    return [
        write_dataset(df, out_dir, name, fmt, ["severity"] if name == "findings" else ()) for name, df in tables.items()
    ]


def write_manifest(audit: Audit, out_dir: str, *, fmt: str = "json", **identity: str) -> list[Dataset]:
    """Header row and artifact list. The inputs are covered by the tree digest, at every size."""
    header = evidence.manifest_header(evidence.inputs_hash_tree(audit.artifacts), audit.outputs_hash, **identity)
    return [
        write_dataset(header.coalesce(1), out_dir, f"{MANIFEST}/header", fmt),
        write_dataset(evidence.manifest_artifacts_table(audit.artifacts), out_dir, f"{MANIFEST}/artifacts", fmt),
    ]


def write_package(audit: Audit, out_dir: str | None = None, *, bodies: bool = True, **identity: str) -> str:
    """The whole audit package as one directory: artifact bodies by source, reports, manifest.

    It is written aside and then takes the place of what is there (`plans.package`): a reader finds the old package or
    the new one, and a write that was interrupted leaves no trace or is carried to its end by the next one.
    """
    spark = audit.artifacts.sparkSession
    target = out_dir or new_path(spark, "package")
    with staged(spark, target) as stage:
        written = [write_dataset(audit.artifacts, stage.path, "artifacts", "parquet", ["source"])] if bodies else []
        stage.datasets += [*written, *write_reports(audit, stage.path), *write_manifest(audit, stage.path, **identity)]
    return target


def package_outputs_hash(spark: SparkSession, target: str) -> DataFrame:
    """The digest of a written package's reports, from its files alone: that of the run that wrote them."""
    tables = {d.name: d.read(spark, target) for d in datasets_of(spark, target)}
    return _outputs_hash(tables["findings"], tables["dependencies"], tables["gate_plan"], tables["executive_summary"])


def audit_uploads(
    spark: SparkSession,
    location: str,
    out_dir: str,
    *,
    pastes: DataFrame | None = None,
    source: str = "UNKNOWN",
    rules: str | Ruleset = "core",
    packages: str | Policy | None = None,
    **identity: str,
) -> Audit:
    """Files and archives under `location`, and a table of `pastes` (`content`, optionally `artifact_seq`), to a complete
    package under `out_dir`; one source tag for the run.

    Inputs are read once: artifact bodies are stored by route, and every scan reads that table; unusable inputs land
    in `quarantine`. Pastes are named by sniffing, and empty ones make no artifact.
    """
    variant = "doc" if ruleset(rules).python_only else "core"
    inputs = artifacts_from(read_rows(spark, location), source=source, variant=variant, extra=UNUSABLE)
    if pastes is not None:
        seq = [c for c in ("artifact_seq",) if c in pastes.columns]
        missing = F.col("content").isNull()
        named = pastes.where(missing | (F.col("content") != "")).select(
            *seq, "content", sniffed_name(F.col("content")).alias("filename"), F.lit(None).cast("string").alias("path"),
            F.when(missing, "NullContent").alias("error_class"), F.when(missing, "content is required").alias("message"),
        )
        inputs = inputs.unionByName(artifacts_from(named, source=source, variant=variant, extra=UNUSABLE))
    with staged(spark, out_dir) as stage:
        artifacts, unusable = store_ingest(inputs, f"{stage.path}/artifacts")
        stage.datasets.append(Dataset("artifacts", "parquet", stored_ingest(spark, f"{stage.path}/artifacts").schema.json()))
        stage.datasets.append(write_dataset(unusable, stage.path, "quarantine", "json"))
        audit = run_audit(artifacts, rules, packages)
        stage.datasets += [*write_reports(audit, stage.path), *write_manifest(audit, stage.path, **identity)]
    # The bodies have moved with the package.
    artifacts, _ = split_ingest(stored_ingest(spark, f"{out_dir}/artifacts"))
    if audit.doc_gates:
        artifacts = artifacts.withColumn("language", language_by_extension(F.col("filename")))
    return replace(audit, artifacts=artifacts)


def package_size(artifacts: DataFrame) -> DataFrame:
    """Artifact bytes with their display text."""
    total = artifacts.agg(F.coalesce(F.sum(F.octet_length("content").cast("bigint")), F.lit(0)).cast("bigint").alias("total_bytes"))
    return total.select("total_bytes", size_text(F.col("total_bytes")).alias("size_text"))
