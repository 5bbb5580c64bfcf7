"""Arriving artifacts give the batch result."""

import datetime

from auditmill.operators.ast_scan import scan_errors
from auditmill.operators.gates import gate_plan
from auditmill.operators.dependencies import analyze_dependencies
from auditmill.plans.audit import all_findings
from auditmill.sources.artifacts import artifacts_from
from auditmill.streaming.arrivals import arriving_artifacts, audit_arrivals, current_gate_plan, drained, new_contents, severity_counts
from tests.samples import FILES


def land(spark, path, more=()):
    rows = [(n, name, content, source, datetime.datetime(2024, 1, 1, n // 3, min(10 * n, 59))) for n, (name, content, source) in enumerate([*FILES, *more])]
    df = artifacts_from(spark.createDataFrame(
        rows, "artifact_seq bigint, filename string, content string, source string, created_at timestamp"))
    for n in range(2):
        df.where(f"artifact_seq % 2 = {n}").coalesce(1).write.mode("append").parquet(path)
    return df


def test_micro_batches_equal_batch(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    artifacts = land(spark, inbox, [("broken.py", "def broken(:", "AGENT"), ("gone.py", None, "AGENT")])
    stream = arriving_artifacts(spark, inbox, files_per_trigger=1)
    audit_arrivals(stream, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    found = spark.read.parquet(f"{out}/findings")
    assert found.select("batch_id").distinct().count() == 2
    errors = spark.read.parquet(f"{out}/scan_errors").drop("batch_id")
    assert sorted(errors.collect()) == sorted(scan_errors(artifacts.where("content IS NOT NULL")).collect())
    assert errors.count() == 1
    assert [r.path for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["gone.py"]
    batch = all_findings(artifacts)
    assert sorted(found.select("finding_id").collect()) == sorted(batch.select("finding_id").collect())
    assert current_gate_plan(spark, out).collect() == gate_plan(batch, analyze_dependencies(artifacts)).collect()


def test_windowed_counts(spark, tmp_path):
    inbox = str(tmp_path / "in")
    artifacts = land(spark, inbox)
    expected = sorted(map(tuple, severity_counts(artifacts).collect()))
    assert [(r[0].hour, r[1], r[2]) for r in expected] == [(0, "CRITICAL", 3), (0, "HIGH", 1), (0, "MEDIUM", 1)]
    query = (severity_counts(arriving_artifacts(spark, inbox)).writeStream.format("memory").queryName("counts")
             .outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("counts").collect())) == expected


def test_repeated_contents_are_dropped(spark, tmp_path):
    inbox = str(tmp_path / "in")
    land(spark, inbox)
    land(spark, inbox)
    assert drained(new_contents(arriving_artifacts(spark, inbox)), "once").count() == 6
