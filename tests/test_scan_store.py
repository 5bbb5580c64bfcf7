"""Scan results kept across runs."""

import ast

from pyspark.sql import functions as F

from auditmill.operators.ast_scan import copies_of_contents, one_per_content, scan_errors, scan_tree_findings, tree_errors
from auditmill.operators.scan_store import PARSED, ScanStore, fingerprint
from auditmill.plans.storage import new_path
from auditmill.rules import CORE, DOC, Rule

KEY = ("artifact_id", "rule_id", "line_no", "evidence_snippet", "dup", "finding_id")
FILES = [
    ("a.py", "eval('1')", "X"), ("b.py", "eval('1')", "X"), ("c.py", "x = 1", "X"), ("d.py", "def broken(:", "X"),
    ("e.py", "pickle.loads(b)\nexec('2')", "X"), ("requirements.txt", "numpy", "X"), ("f.py", "", "X"),
]


def rows_of(df, columns=KEY):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_second_run_parses_nothing(spark, make):
    artifacts, store = make(FILES), ScanStore(spark, new_path(spark, "store"), buckets=4)
    assert store.pending(artifacts).count() == 5  # two files share a content, the manifest is no code
    for _ in range(2):
        assert rows_of(store.findings(artifacts)) == rows_of(scan_tree_findings(artifacts))
        assert store.pending(artifacts).count() == 0
        marks = store.results().where(F.col("state") == PARSED)
        assert marks.count() == marks.select("content_hash").distinct().count() == 5
    assert rows_of(tree_errors(store.scan(artifacts)), ("artifact_id", "error_class")) == rows_of(scan_errors(artifacts), ("artifact_id", "error_class"))


def test_only_new_contents_are_parsed(spark, make):
    store = ScanStore(spark, new_path(spark, "store"), buckets=4)
    store.add(make(FILES[:3]), report_errors=False)  # only contents that may hold a sink
    grown = make([*FILES, ("g.py", "eval('3')", "X")])
    assert store.pending(grown, report_errors=False).count() == 2
    assert store.pending(grown).count() == 5
    assert rows_of(store.findings(grown)) == rows_of(scan_tree_findings(grown))


def test_a_new_session_and_other_rules(spark, make):
    path, artifacts = new_path(spark, "store"), make(FILES)
    ScanStore(spark, path, buckets=4).add(artifacts)
    spark.catalog.clearCache()
    spark.sql(f"DROP TABLE {ScanStore(spark, path, buckets=4).table}")  # as a session that knows nothing of it
    again = ScanStore(spark, path, buckets=4)
    assert again.pending(artifacts).count() == 0
    rule = Rule("SECRET_X", "AST", "LOW", "d", "r", check=lambda node: isinstance(node, ast.Assign))
    wider = CORE.with_rules(rule)
    assert again.pending(artifacts, wider).count() == 5 and again.pending(artifacts, DOC).count() == 5
    assert rows_of(again.findings(artifacts, wider)) == rows_of(scan_tree_findings(artifacts, wider))
    other = Rule("SECRET_X", "AST", "LOW", "d", "r", check=lambda node: isinstance(node, ast.Name))
    assert len({fingerprint(r) for r in (CORE, wider, CORE.with_rules(other), DOC)}) == 4


def test_the_store_is_not_shuffled(spark, make):
    artifacts, store = make(FILES), ScanStore(spark, new_path(spark, "store"), buckets=4)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        found = store.scan(artifacts)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert found.count() > 0 and "SortMergeJoin" in plan
        executed = found._jdf.queryExecution().executedPlan().toString()
        assert executed.count("Exchange hashpartitioning(content_hash") == 1  # that of the artifacts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_artifacts_listed_twice(spark, make):
    artifacts = make(FILES)
    twice = artifacts.unionByName(artifacts)
    expected = rows_of(scan_tree_findings(twice))
    assert rows_of(scan_tree_findings(twice, once_per_content=True)) == expected
    assert rows_of(ScanStore(spark, new_path(spark, "store"), buckets=2).findings(twice)) == expected


def test_one_artifact_stands_for_each_content(make):
    code = make(FILES[:6])
    kept = {r.artifact_id for r in one_per_content(code).collect()}
    left = {r.artifact_id for r in copies_of_contents(code).collect()}
    assert len(kept) == 5 and len(left) == 1 and not kept & left
