"""Digests equal their definitions, whatever the partitioning."""

import hashlib
from collections import Counter

import pytest

from auditmill.operators import evidence

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def flat(hashes):
    return sha("".join(sorted(hashes)))


def tree(digests):
    level = sorted(f"{d}:{n}" for d, n in Counter(digests).items())
    for prefix in (5, 2):
        groups = {}
        for entry in level:
            groups.setdefault(entry[:prefix], []).append(entry)
        level = sorted(f"{p}:{sha(''.join(members))}" for p, members in groups.items())
    return sha("".join(level))


@pytest.mark.parametrize("hashes", [
    [], [sha("a")], [sha("a")] * 3, [sha(str(n)) for n in range(1000)], [sha("hot")] * 20000 + [sha(str(n)) for n in range(9000)],
], ids=["empty", "one", "copies", "many", "hot"])
def test_input_hashes(spark, monkeypatch, hashes):
    df = spark.createDataFrame([(h,) for h in hashes], "content_hash string").repartition(7)
    assert [r[0] for r in evidence.inputs_hash(df).collect()] == [flat(hashes)]
    assert [r[0] for r in evidence.inputs_hash_tree(df).collect()] == [tree(hashes)]


def test_dataset_digest_ignores_partitioning_not_content(spark):
    rows = [(n, None if n % 3 else str(n)) for n in range(500)]
    df = spark.createDataFrame(rows, "a int, b string")
    digests = {evidence.dataset_digest(df.repartition(k), ["a", "b"]).first()[0] for k in (1, 3, 8)}
    assert digests == {tree([sha("\u0001".join(["" if c is None else str(c) for c in r])) for r in rows])}
    assert evidence.dataset_digest(df.where("a > 0"), ["a", "b"]).first()[0] not in digests
    assert evidence.dataset_digest(df.union(df.limit(1)), ["a", "b"]).first()[0] not in digests


def test_outputs_hash_is_the_hash_of_digests_in_order(spark):
    one, two = spark.range(3), spark.range(5)
    parts = [evidence.dataset_digest(d, ["id"]).first()[0] for d in (one, two)]
    assert evidence.outputs_hash([(one, ["id"]), (two, ["id"])]).first()[0] == sha("".join(parts))
    assert evidence.outputs_hash([(one, ["id"]), (one.where("false"), ["id"])]).first()[0] == sha(parts[0] + sha(""))
    assert evidence.outputs_hash([(two, ["id"]), (one, ["id"])]).first()[0] == sha("".join(reversed(parts)))


def test_manifest_header(spark, make):
    artifacts = make({"a.py": "x"})
    header = evidence.manifest_header(evidence.inputs_hash_tree(artifacts), evidence.outputs_hash([(artifacts, ["filename"])]))
    row = header.first()
    assert header.count() == 1 and row.run_id == sha(row.inputs_hash_tree + row.outputs_hash)
    assert row.team_or_user and row.app_version and row.parser_version.startswith("3.")
    assert evidence.manifest_artifacts_table(artifacts).columns == ["artifact_id", "filename", "content_hash"]


def test_digests_are_shuffled_once_as_bytes(spark):
    hashes = [sha(str(n % 700)) for n in range(2000)] + [None] * 3
    df = spark.createDataFrame([(n % 2, h) for n, h in enumerate(hashes)], "part int, digest string").repartition(5)
    out = evidence.digest_tree(df, "root", ["part"])

    def want(part):
        own = Counter(hashes[part::2])
        entries = sorted(":".join([*([d] if d else []), str(n)]) for d, n in own.items())
        for prefix in (5, 2):
            groups = {}
            for entry in entries:
                groups.setdefault(entry[:prefix], []).append(entry)
            entries = sorted(f"{p}:{sha(''.join(members))}" for p, members in groups.items())
        return sha("".join(entries))

    assert {r.part: r.root for r in out.collect()} == {0: want(0), 1: want(1)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    # Rows to leaves, leaves to branches, branches to the root: digests take no shuffle of their own for their counts.
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning(part") == 3
