"""Structured Streaming entry: arriving artifacts, stateless scans, windowed counts, gate refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from auditmill.operators.ast_scan import scan_trees, tree_errors, tree_findings
from auditmill.operators.dependencies import analyze_dependencies, dependency_findings
from auditmill.operators.findings import union_findings
from auditmill.operators.gates import plan_from_facts
from auditmill.operators.regex_scan import scan_lines
from auditmill.operators.risk import merge_facts, risk_facts
from auditmill.plans.storage import new_path
from auditmill.schemas import ARTIFACT
from auditmill.sources.artifacts import split_invalid


def arriving_artifacts(spark: SparkSession, path: str, *, files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Stream of artifact rows from files that land under `path`."""
    reader = spark.readStream.format(fmt).schema(ARTIFACT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def new_contents(artifacts: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop contents already seen within `delay`; the watermark bounds the state."""
    return artifacts.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(["content_hash"])


def severity_counts(artifacts: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Line findings per tumbling window of artifact creation time and severity. Works on batch and stream input."""
    timed = artifacts.withWatermark("created_at", delay)
    counts = scan_lines(timed, extra=["created_at"]).groupBy(F.window("created_at", window).alias("w"), "severity").count()
    return counts.select(F.col("w.start").alias("window_start"), "severity", F.col("count").alias("finding_count"))


def audit_arrivals(artifacts: DataFrame, out_dir: str, checkpoint: str, *, available_now: bool = False) -> StreamingQuery:
    """Scan every micro-batch with the batch operators and keep findings, dependencies, facts, parse errors and
    unusable rows (`quarantine`) per batch.

    A retried batch overwrites its own folder, so results are exactly once.
    """

    def scan_batch(batch: DataFrame, batch_id: int) -> None:
        def kept(df: DataFrame, name: str) -> DataFrame:
            path = f"{out_dir}/{name}/batch_id={batch_id}"
            df.write.mode("overwrite").parquet(path)
            return df.sparkSession.read.schema(df.schema).parquet(path)

        usable, unusable = split_invalid(batch)
        kept(unusable, "quarantine")
        trees = kept(scan_trees(usable), "tree_scan")
        kept(tree_errors(trees), "scan_errors")
        dependencies = kept(analyze_dependencies(usable), "dependencies")
        findings = kept(
            union_findings(scan_lines(usable), tree_findings(trees), dependency_findings(dependencies)), "findings"
        )
        # Facts come from the written tables, not from a second scan.
        kept(risk_facts(findings, dependencies), "facts")

    writer = artifacts.writeStream.foreachBatch(scan_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_gate_plan(spark: SparkSession, out_dir: str) -> DataFrame:
    """Gate plan over everything that has arrived, from one facts row per batch."""
    return plan_from_facts(merge_facts(spark.read.parquet(f"{out_dir}/facts").drop("batch_id")))


def drained(stream: DataFrame, label: str) -> DataFrame:
    """Run a stateless stream over what is available now into a Parquet sink in the shared folder, and read that."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    query = (
        stream.writeStream.format("parquet").option("path", f"{path}/table")
        .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")
