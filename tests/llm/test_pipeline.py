"""Each stage of the pipeline against its operator's own verdict on that stage's input."""

import public_tokenizers
import pytest

import corpus_pipeline
from auditmill.llm import common, exact_dedup, jaccard_join, quality, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = common.table(spark, SF, "documents"), []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = common.saved(stage(spark, docs, SF), f"test_{number}")
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r[0] for r in df.select("doc_id").collect())


def test_order_and_columns(stages):
    assert [name for name, *_ in stages] == ["quality rules", "toxicity", "exact dedup", "n-gram Jaccard join", "packing"]
    for _, before, after in stages[:-1]:
        assert after.schema == before.schema
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_decisions_take_effect(spark, stages):
    labels = common.table(spark, SF, "labels")
    (_, d0, d1), (_, _, d2), (_, _, d3), (_, _, d4), (_, _, packed) = stages
    assert ids(d1) == ids(quality.quality_verdicts(d0, labels).where("kept"))
    assert ids(d2) == ids(toxicity.toxicity_scores(d1, labels).where("predicted = 0"))
    assert ids(d3) == ids(exact_dedup.exact_groups(d2).where("kept"))
    assert ids(d4) == sorted(r[0] for r in jaccard_join.similarity_classes(d3).select("class_id").distinct().collect())
    assert sorted({r[0] for r in packed.select("doc_id").collect()}) == ids(d4)


def test_keep_one_carries_rows_whole(spark):
    """Null and empty texts stay as they are, and columns named like the operator's own are carried, in their order."""
    schema = "key string, text string, row int, doc_id int, tokens string"
    rows = [("k", "a b c d e f", 1, 3, "t"), (None, " a b c d e  f", 2, 2, None), ("n", None, 3, 5, "u"), ("m", "", 4, 6, "v"), ("o", "z", 5, None, "w")]
    kept = jaccard_join.keep_one(spark.createDataFrame(rows, schema))
    assert kept.columns == ["key", "text", "row", "doc_id", "tokens"]
    assert dict(kept.dtypes)["doc_id"] == "int"
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[2]) == [rows[1], rows[2], rows[4]]
