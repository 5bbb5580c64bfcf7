"""Counts of the derived corpora, computed beforehand from the line and name templates."""

import types

import pytest

from auditmill.operators.ast_scan import scan_errors
from auditmill.operators.dependencies import analyze_dependencies
from auditmill.plans.audit import all_findings
from auditmill.plans.storage import shared_dir
from auditmill.sources import corpora

CODE = {
    "0.001": (15, 1, 83, 42, 124, 83, 42, 394, 78, 38),
    "0.01": (150, 9, 833, 417, 1249, 833, 417, 3918, 784, 393),
}
RULES = ("SECRET_API_KEY", "SECRET_AWS_KEY", "SECRET_GENERIC_PASSWORD", "INJECTION_SQL_FSTRING", "UNSAFE_CRYPTO_MD5",
         "AST_DANGEROUS_EVAL_EXEC", "AST_SUBPROCESS_SHELL_TRUE", "AST_PICKLE_LOADS")
DEPS = {"0.001": (70, 200, 65, 38, 97, 48), "0.01": (75, 2000, 625, 375, 1000, 500)}


@pytest.mark.parametrize("sf", list(CODE))
def test_code_corpus(spark, sf):
    corpus = corpora.code_corpus(spark, f"/root/testdata/sf{sf}")
    hits = {r.rule_id: r["count"] for r in all_findings(corpus).groupBy("rule_id").count().collect()}
    assert (corpus.count(), scan_errors(corpus).count(), *[hits[r] for r in RULES]) == CODE[sf]


@pytest.mark.parametrize("sf", list(DEPS))
def test_dep_corpus(spark, sf):
    corpus = corpora.dep_corpus(spark, f"/root/testdata/sf{sf}")
    rows = analyze_dependencies(corpus)
    status = {r.status: r["count"] for r in rows.groupBy("status").count().collect()}
    assert (corpus.count(), rows.count(), status["ALLOW"], status["DENY"], status["UNKNOWN"],
            rows.where("suspicious").count()) == DEPS[sf]


def test_hot_key_becomes_bounded_files(spark, monkeypatch):
    monkeypatch.setattr(corpora, "LINES_PER_FILE", 100)
    corpus = corpora.code_corpus(spark, "/root/testdata/sf0.001")
    sizes = corpus.selectExpr("size(split(content, '\\n')) AS n", "filename", "artifact_seq")
    assert sizes.where("n > 101").count() == 0
    assert sizes.select("artifact_seq").distinct().count() == sizes.select("filename").distinct().count() == sizes.count() > 100


def test_shared_folder_is_required_on_a_cluster():
    def session(master, checkpoint=None):
        context = types.SimpleNamespace(
            master=master, getConf=lambda: {"spark.checkpoint.dir": checkpoint}, getCheckpointDir=lambda: None)
        return types.SimpleNamespace(sparkContext=context)

    assert shared_dir(session("yarn", "hdfs:///cp")) == "hdfs:///cp"
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn"))
