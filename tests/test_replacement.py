"""Newer versions of artifacts replace older ones, however they arrive."""

import random

import pytest
from pyspark.sql import functions as F

from auditmill.operators.risk import artifact_risk_score
from auditmill.operators.regex_scan import scan_lines
from auditmill.plans.storage import new_path
from auditmill.sources.artifacts import artifacts_from
from auditmill.streaming.arrivals import drained
from auditmill.streaming.replacement import KEY, current_scores, latest_versions, score_changes

LINES = ['token = "abcdefghij0123456789"', "hashlib.md5(x)", "x = 1", "pwd = 'abcdefgh1'"]
ROWS = "artifact_key string, version bigint, artifact_seq bigint, filename string, source string, content string"


def versions():
    pick = random.Random(7)
    rows = []
    for key in range(12):
        for version in pick.sample(range(10), pick.randrange(1, 6)):
            content = "\n".join(pick.choice(LINES) for _ in range(pick.randrange(4)))
            rows.append((f"k{key}", version, 10 * key + version, f"k{key}.py", "AGENT", content))
    return rows + [(None, 1, 900, "n.py", "AGENT", LINES[0]), ("k0", None, 901, "n.py", "AGENT", LINES[0])]


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_any_batching_equals_the_batch_over_the_latest(spark, batches):
    rows = versions()
    batch = artifacts_from(spark.createDataFrame(rows, ROWS), extra=KEY)
    latest = latest_versions(batch)
    names = {r.artifact_id: (r.artifact_key, r.version) for r in latest.collect()}
    expected = sorted((*names[r.artifact_id], r.finding_count, r.risk_score) for r in artifact_risk_score(latest, scan_lines(latest)).collect())
    path = new_path(spark, "arrivals")
    random.Random(batches).shuffle(rows)
    repeated = rows + rows[:5]  # some arrive twice
    for n in range(batches):
        spark.createDataFrame(repeated[n::batches], ROWS).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)
    changes = drained(score_changes(artifacts_from(stream, extra=KEY)), "changes")
    assert sorted(map(tuple, current_scores(changes).collect())) == expected and len(expected) == 12
    assert changes.agg(F.sum("artifacts")).first()[0] == 12
    if batches > 1:
        assert changes.where("artifacts = -1").count() > 0  # something was taken back


def test_arriving_files_grow_in_number(spark, tmp_path, monkeypatch):
    """Else one task would read a fixed share of the table."""
    from auditmill.plans import queries

    rows = spark.range(400).selectExpr("id AS doc_id", "concat('line ', id) AS text", "'AGENT' AS source")
    rows.repartition(24).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "new_path", lambda spark, label: str(tmp_path / label))
    assert queries.QUERIES["stream_latest_scores"](spark, str(tmp_path)).where("version = 3").count() == 100
    partitions = spark.read.parquet(str(tmp_path / "documents.parquet")).rdd.getNumPartitions()
    files = list((tmp_path / "arrivals").glob("*.parquet"))
    assert partitions > 1 and 4 < len(files) <= 4 * partitions
