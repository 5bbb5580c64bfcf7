"""Results of the syntax-tree scan kept across runs: a content that any earlier run has parsed is not parsed again.

The store is one bucketed table, `content_hash` deciding the bucket. It holds the raw hits of every content and one row
that says the content has been parsed, under the fingerprint of the rules; other rules find their own contents unparsed.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.operators.ast_scan import HIT_SCHEMA, OWNER, may_hit, one_per_content, tree_findings, tree_worker
from auditmill.plans.storage import write_once
from auditmill.rules import Ruleset, ruleset
from auditmill.sources.artifacts import code_artifacts

BUCKETS = 64
PARSED = "parsed"


def fingerprint(rules: str | Ruleset) -> str:
    """Identity of what a scan would report: rules, texts, the code of their checks, and the parser's version."""
    catalog = ruleset(rules)
    parts = [sys.version_info[:2], catalog.source_segment, catalog.python_only, catalog.tokens]
    for ordinal, rule in catalog.tree_rules:
        code = getattr(rule.check, "__code__", None)
        parts += [ordinal, rule.rule_id, rule.emits, [t.__name__ for t in rule.node_types], getattr(rule.check, "__qualname__", ""),
                  code and (code.co_code.hex(), [c for c in code.co_consts if not hasattr(c, "co_code")], code.co_names)]
    return hashlib.sha256(repr(parts).encode()).hexdigest()


class ScanStore:
    """A folder of results. One run writes to it at a time; readers see whole runs only, since Spark commits each write at once."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "scan_store_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        schema = f"rules STRING, content_hash STRING, state STRING, {HIT_SCHEMA}"
        # A session that has not seen the folder yet only has to be told how its files are bucketed.
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({schema}) USING parquet "
            f"CLUSTERED BY (content_hash) SORTED BY (content_hash) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def results(self, rules: str | Ruleset = "core") -> DataFrame:
        return self.spark.table(self.table).where(F.col("rules") == fingerprint(rules))

    def pending(self, artifacts: DataFrame, rules: str | Ruleset = "core", *, report_errors: bool = True) -> DataFrame:
        """One artifact (artifact_id, content_hash) for each content that no run has parsed under these rules."""
        code = _scanned(artifacts, ruleset(rules), report_errors)
        known = self.results(rules).where(F.col("state") == PARSED).select("content_hash")
        return one_per_content(code).join(known, "content_hash", "left_anti")

    def add(self, artifacts: DataFrame, rules: str | Ruleset = "core", *, report_errors: bool = True) -> None:
        """Parse what is pending and append its results, errors included. Without `report_errors`, contents that cannot hold a
        sink are left for a run that wants errors."""
        catalog = ruleset(rules)
        # Stored, so that its measured size decides how the contents are picked: few new ones move no content.
        chosen = write_once(self.pending(artifacts, rules, report_errors=report_errors).select("artifact_id"), "pending_contents")
        contents = _scanned(artifacts, catalog, report_errors).join(chosen, "artifact_id", "left_semi").select("content_hash", "content")
        hits = contents.mapInArrow(_with_marks(tree_worker(catalog, True, 1)), f"content_hash string, state string, {HIT_SCHEMA}")
        # An artifact that is listed twice has been parsed twice.
        rows = hits.distinct().select(F.lit(fingerprint(catalog)).alias("rules"), *hits.columns).repartition(self.buckets, "content_hash")
        rows.write.bucketBy(self.buckets, "content_hash").sortBy("content_hash").format("parquet").mode("append").saveAsTable(self.table)

    def scan(self, artifacts: DataFrame, rules: str | Ruleset = "core", *, report_errors: bool = True) -> DataFrame:
        """Raw scan rows of all artifacts, as `scan_trees` gives them, after parsing what is new.

        The artifacts come to the store's buckets by their hash, ids and names only; the store itself is not shuffled.
        """
        self.add(artifacts, rules, report_errors=report_errors)
        code = _scanned(artifacts, ruleset(rules), report_errors)
        hits = self.results(rules).where("state IS NULL").drop("rules", "state")
        if not report_errors:
            hits = hits.where("error_class IS NULL")
        return code.select("content_hash", *OWNER).join(hits, "content_hash").drop("content_hash")

    def findings(self, artifacts: DataFrame, rules: str | Ruleset = "core") -> DataFrame:
        return tree_findings(self.scan(artifacts, rules), rules)


def _scanned(artifacts: DataFrame, catalog: Ruleset, report_errors: bool) -> DataFrame:
    code = artifacts.where(F.col("language") == "python") if catalog.python_only else artifacts
    code = code_artifacts(code)
    return code.where("content IS NOT NULL" if report_errors else may_hit(F.col("content"), catalog))


def _with_marks(worker):
    """The tree worker's rows, and one row per content that says it has been parsed."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            for found in worker(iter([batch])):
                yield _batch(found.column(0), pa.nulls(found.num_rows, pa.string()), found.columns[1:])
            yield _batch(batch.column(0), pa.array([PARSED] * size, pa.string()), [pa.nulls(size, t) for _, t in _HIT])

    return marked


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
_HIT = [(name, _TYPES[kind]) for name, kind in (field.split() for field in HIT_SCHEMA.split(", "))]


def _batch(hashes: pa.Array, states: pa.Array, columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([hashes, states, *columns], ["content_hash", "state", *[name for name, _ in _HIT]])
