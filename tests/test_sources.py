"""Files, archives, pasted snippets, defaults, ids and quarantine."""

import hashlib
import io
import re
import zipfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from auditmill.operators.ast_scan import scan_tree_findings
from auditmill.operators.risk import artifact_risk_score
from auditmill.sources.artifacts import artifacts_from, inventory, pasted_snippets, split_invalid
from auditmill.sources.files import read_any, read_archives, read_uploads


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in members:
            archive.writestr(name, body)
    return buffer.getvalue()


def test_uploads_are_strict_utf8(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.py").write_bytes("x = 'é'\r\n".encode())
    (tmp_path / "sub" / "requirements.txt").write_bytes(b"numpy\n")
    (tmp_path / "sub" / "empty.toml").write_bytes(b"")
    (tmp_path / "sub" / "_private dir").mkdir()
    (tmp_path / "sub" / "_private dir" / "__init__.py").write_bytes(b"y")
    (tmp_path / ".hidden #1.py").write_bytes(b"z")
    (tmp_path / "bad.json").write_bytes(b"\xff\xfe{}")
    (tmp_path / "note.md").write_bytes(b"ignored")
    rows, bad = read_uploads(spark, str(tmp_path))
    expected = {"a.py": "x = 'é'\r\n", "requirements.txt": "numpy\n", "empty.toml": "", "__init__.py": "y", ".hidden #1.py": "z"}
    assert {r.filename: r.content for r in rows.collect()} == expected
    assert {r.filename for r in read_uploads(spark, tmp_path.as_uri())[0].collect()} == set(expected)
    assert [(r.path.rsplit("/", 1)[1], r.error_class) for r in bad.collect()] == [("bad.json", "UnicodeDecodeError")]


def test_archives(spark, tmp_path):
    members = [
        ("top.py", "eval(1)\r\nx\ry"), ("pkg/sub/mod.py", b"a\xffb\xc3\xa9"), ("data.bin", b"\x00\x01"), ("empty/", ""),
        ("../up.py", "up"), ("/abs.py", "abs"), ("dup.py", "first"), ("dup.py", "second"), ("docs/requirements.txt", "numpy"), ("none.py", ""),
    ]
    (tmp_path / "one.zip").write_bytes(zipped(members))
    (tmp_path / "two.zip").write_bytes(zipped([(f"f{n}.py", f"n = {n}") for n in range(150)]))
    (tmp_path / "broken.zip").write_bytes(b"PK not a zip")
    rows, bad = read_archives(spark, str(tmp_path))
    got = {r.filename: r.content for r in rows.collect()}
    assert {k: v for k, v in got.items() if not k.startswith("f")} == {
        "top.py": "eval(1)\nx\ny", "pkg/sub/mod.py": "abé", "data.bin": "\x00\x01", "up.py": "up", "abs.py": "abs",
        "dup.py": "second", "docs/requirements.txt": "numpy", "none.py": ""}
    assert sum(k.startswith("f") for k in got) == 150
    assert [r.error_class for r in bad.collect()] == ["BadZipFile"]
    (tmp_path / "solo.py").write_text("pass")
    everything, errors = read_any(spark, str(tmp_path))
    assert everything.count() == 159 and errors.count() == 1


def test_equal_files_stay_apart(spark, tmp_path):
    from auditmill.operators.risk import artifact_risk_score
    from auditmill.plans.audit import all_findings

    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "__init__.py").write_text("eval(x)")
    (tmp_path / "c.zip").write_bytes(zipped([("a/__init__.py", "eval(x)"), ("b/__init__.py", "eval(x)")]))
    artifacts = artifacts_from(read_any(spark, str(tmp_path))[0])
    scores = artifact_risk_score(artifacts, all_findings(artifacts)).collect()
    assert [r.risk_score for r in scores] == [100] * 4 and len({r.artifact_id for r in scores}) == 4


def test_defaults_and_ids(spark):
    df = spark.createDataFrame([("a",), ("é\n",)], "content string")
    rows = artifacts_from(df, source="AGENT").collect()
    assert {(r.filename, r.source, r.language) for r in rows} == {("snippet.py", "AGENT", "python")}
    assert {r.content_hash for r in rows} == {hashlib.sha256(t.encode()).hexdigest() for t in ("a", "é\n")}
    again = artifacts_from(df.repartition(3), source="AGENT").collect()
    assert {r.artifact_id for r in rows} == {r.artifact_id for r in again} and len({r.artifact_id for r in rows}) == 2
    assert artifacts_from(df).first().source == "UNKNOWN"


def test_equal_rows_are_separate_artifacts(spark, monkeypatch):
    monkeypatch.setattr("auditmill.sources.artifacts.COPIES_PER_BLOCK", 10)
    texts = ["eval('x')"] * 57 + ["a"] * 10 + ["b"]
    df = spark.createDataFrame([(t, "2024-01-01" if n < 30 else None) for n, t in enumerate(texts)], "content string, created_at string")
    for rows in (df.select("content"), df.repartition(7).select("content")):
        made = artifacts_from(rows).collect()
        assert sorted(r.content for r in made) == sorted(texts) and len({r.artifact_id for r in made}) == len(texts)
        assert sorted(r.artifact_seq for r in made if r.content == "a") == list(range(10))
    timed = artifacts_from(df).collect()
    assert len({r.artifact_id for r in timed}) == len(texts)
    assert sum(r.created_at.year == 2024 for r in timed) == 30
    artifacts = artifacts_from(df.limit(2))
    scores = artifact_risk_score(artifacts, scan_tree_findings(artifacts)).collect()
    assert [r.risk_score for r in scores] == [100, 100]  # two findings each
    assert artifacts_from(df.where("false")).count() == 0


def test_streams_must_identify_rows(spark, tmp_path):
    spark.range(1).selectExpr("'x' AS content").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("content string").parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="artifact_seq"):
        artifacts_from(stream)


def test_languages(spark):
    names = ["a.py", "b.txt", "requirements.txt", "c.toml", "d.json", "Makefile"]
    df = spark.createDataFrame([(n, "") for n in names], "filename string, content string")
    assert {r.filename: r.language for r in artifacts_from(df, variant="doc").collect()} == dict(
        zip(names, ["python", "text", "text", "toml", "unknown", "unknown"]))
    assert {r.language for r in artifacts_from(df).collect()} == {"python"}


def test_null_content_is_quarantined(spark):
    df = spark.createDataFrame([("a.py", "x"), ("b.py", None)], "filename string, content string")
    rows, bad = split_invalid(df)
    assert rows.count() == 1 and [(r.path, r.error_class) for r in bad.collect()] == [("b.py", "NullContent")]


SNIFFED = {
    "requests==1\nnumpy>=2\nprint(x)": "requirements.txt",
    "requests==1\nprint(x)": "snippet.py",  # exactly half
    "# only\n\n": "snippet.py",
    "x = 1\ny = 2": "requirements.txt",  # assignments look alike
    "\n\n  requests ~= 1\r\n# c\n": "requirements.txt",
    "flask": "snippet.py",
    "   ": "snippet.py",
    "def f(): pass": "snippet.py",
    "a ==1": "requirements.txt",
}


def test_sniffer(spark):
    df = spark.createDataFrame([(t,) for t in [*SNIFFED, ""]], "content string")
    assert {r.content: r.filename for r in pasted_snippets(df).collect()} == SNIFFED


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(["a==1", "b >= 2", "# c", "", "  ", "x = 1", "print(x)", "\u00a0d~=3", "\x0c", "-r x"]), max_size=6),
                min_size=5, max_size=40))
def test_sniffer_equals_brute_force(spark, texts):
    texts = [t for t in {"\n".join(lines) for lines in texts} if t] or ["a==1"]

    def name(text):
        lines = [x.strip() for x in text.strip().splitlines()]
        lines = [x for x in lines if x and x[0] != "#"]
        hits = [x for x in lines if re.match(r"[a-zA-Z0-9_\-\.]+\s*[<>=!~]+", x)]
        return "requirements.txt" if lines and len(hits) / len(lines) > 0.5 else "snippet.py"

    df = spark.createDataFrame([(t,) for t in texts], "content string")
    assert {r.content: r.filename for r in pasted_snippets(df).collect()} == {t: name(t) for t in texts}


def test_inventory(spark):
    df = spark.createDataFrame([("a.py", "x", "CLAUDE")], "filename string, content string, source string")
    df = artifacts_from(df.withColumn("created_at", F.lit("2024-03-05 06:07:08").cast("timestamp")))
    digest = hashlib.sha256(b"x").hexdigest()
    assert tuple(inventory(df).first()) == ("a.py", "CLAUDE", "python", digest[:16] + "...", "2024-03-05 06:07")
    assert tuple(inventory(df, legacy=True).first()) == ("a.py", "CLAUDE", digest[:10] + "...", "2024-03-05 06:07")
