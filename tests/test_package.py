"""Packages that are sealed: repeated, interrupted and damaged ones."""

import shutil

import pytest
from pyspark.sql import functions as F

from auditmill.plans import package
from auditmill.plans.audit import audit_uploads, package_outputs_hash, run_audit, write_package
from tests.samples import FILES


def state(spark, target):
    rows = package.verify_package(spark, target).collect()
    return {r.dataset: (r.n_rows, r.valid) for r in rows}


def small(spark, target, n, *, fail=False, more=False):
    """A package of two or three tiny datasets."""
    with package.staged(spark, target) as stage:
        rows = spark.range(n).select("id", (F.col("id") % 2).cast("string").alias("kind"), F.lit(None).cast("string").alias("note"))
        stage.datasets.append(package.write_dataset(rows, stage.path, "rows", "json", ["kind"]))
        stage.datasets.append(package.write_dataset(rows.limit(1).coalesce(1), stage.path, "_manifest/header", "json"))
        if more:
            stage.datasets.append(package.write_dataset(rows, stage.path, "more", "parquet"))
        if fail:
            raise RuntimeError("lost")
    return target


def test_an_audit_package(spark, tmp_path, make):
    audit = run_audit(make(FILES))
    target = write_package(audit, str(tmp_path / "p"))
    first = state(spark, target)
    assert first["findings"] == (13, True) and first["artifacts"] == (6, True) and all(valid for _, valid in first.values())
    assert set(first) == {"artifacts", "findings", "dependencies", "gate_plan", "executive_summary", "scan_errors", "out_of_domain",
                          "_manifest/header", "_manifest/artifacts"}
    assert package_outputs_hash(spark, target).first() == audit.outputs_hash.first()


def test_a_package_can_be_written_again(spark, tmp_path):
    target = small(spark, str(tmp_path / "p"), 10, more=True)
    (tmp_path / "p" / "of the user").mkdir()
    assert state(spark, target) == {"rows": (10, True), "more": (10, True), "_manifest/header": (1, True)}
    small(spark, target, 4)
    assert state(spark, target) == {"rows": (4, True), "_manifest/header": (1, True)}
    assert sorted(p.name for p in (tmp_path / "p").iterdir()) == ["_manifest", "of the user", "rows"]
    small(spark, target, 0)
    assert state(spark, target) == {"rows": (0, True), "_manifest/header": (0, True)}


def test_an_error_while_writing_keeps_the_old_package(spark, tmp_path):
    target = small(spark, str(tmp_path / "p"), 10)
    with pytest.raises(RuntimeError):
        small(spark, target, 4, fail=True)
    assert state(spark, target)["rows"] == (10, True)


@pytest.mark.parametrize(("sealed", "moved"), [(False, 0), (True, 0), (True, 1)])
def test_the_next_write_settles_an_interrupted_one(spark, tmp_path, monkeypatch, sealed, moved):
    """A driver that dies leaves a stage: unsealed it is dropped, sealed it is put in place from wherever the moves stopped."""
    target = small(spark, str(tmp_path / "p"), 10)
    count, move = [0], package._Files.move

    def stopping(self, *paths):
        if count[0] == moved:
            raise KeyboardInterrupt
        count[0] += 1
        move(self, *paths)

    if sealed:
        monkeypatch.setattr(package._Files, "move", stopping)
        with pytest.raises(KeyboardInterrupt):
            small(spark, target, 4)
        monkeypatch.undo()
    else:
        package.write_dataset(spark.range(3), f"{target}/{package.STAGES}/lost", "rows", "json")
    package.settle(spark, target)
    assert state(spark, target)["rows"] == ((4, True) if sealed else (10, True))
    assert package._Files(spark, target).children(f"{target}/{package.STAGES}") == []


def test_damage_is_found(spark, tmp_path):
    target = small(spark, str(tmp_path / "p"), 10, more=True)
    spark.read.parquet(f"{target}/more").limit(1).write.mode("append").parquet(f"{target}/more")
    shutil.rmtree(f"{target}/rows/kind=1")
    assert state(spark, target) == {"rows": (10, False), "more": (10, False), "_manifest/header": (1, True)}
    shutil.rmtree(f"{target}/{package.RECORD}")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        package.verify_package(spark, target).collect()


def test_uploads_can_be_audited_again(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.py").write_text("eval(x)")
    audit_uploads(spark, str(inbox), out)
    (inbox / "b.py").write_text("exec(y)")
    (inbox / "c.py").write_bytes(b"\xff")
    audit = audit_uploads(spark, str(inbox), out)
    found = state(spark, out)
    assert all(valid for _, valid in found.values()) and found["quarantine"][0] == 1 and found["artifacts"][0] == 3
    assert sorted(r.filename for r in audit.artifacts.collect()) == ["a.py", "b.py"] and audit.findings.count() == 4
    assert spark.read.json(f"{out}/findings").agg(F.count("*")).first()[0] == 4


def test_large_text_datasets_are_compressed_in_bounded_files(spark, tmp_path, make, monkeypatch):
    monkeypatch.setattr(package, "FILE_ROWS", 5)
    artifacts = make(FILES)
    audit = run_audit(artifacts)
    target = write_package(audit, str(tmp_path / "p"))
    files = [p for p in (tmp_path / "p" / "findings").rglob("part-*")]
    assert len(files) > 2 and all(p.name.endswith(".json.gz") for p in files)
    assert all(valid for _, valid in state(spark, target).values())
    # The id is not stored with the findings, and is what the scans give.
    kept = {r.finding_id for r in run_audit(artifacts, store=False).findings.collect()}
    assert kept == {r.finding_id for r in spark.read.json(f"{target}/findings").collect()} and len(kept) == 13
    stored = audit.findings.inputFiles()
    assert stored and "finding_id" not in spark.read.parquet(*stored).columns
