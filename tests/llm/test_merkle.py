"""The manifest tree against a direct computation, and the defined results of odd inputs."""

import hashlib
import random
import zlib

import pytest

from auditmill.llm import merkle

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, position int, node string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(told, (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """(root, per leaf its siblings by level) of one tree."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            start = at[i] - at[i] % 3
            run = nodes[start : start + 3]
            p.append((run[: at[i] - start], run[at[i] - start + 1 :]))
            at[i] //= 3
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def expected(rows):
    rows = [r[:5] for r in rows]
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = own, climb([leaf(*r) for r in own])
    root, upper = climb([trees[s][1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        own, (subroot, paths) = trees[s]
        for r, path in zip(own, paths):
            whole = path + upper[n]
            touched = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0 and r[4] is not None
            cur = leaf(*r[:4], r[4].replace("\n", "")) if touched else leaf(*r)
            for left, right in whole:
                cur = h(*left, cur, *right)
            proof = h(*[x for left, right in whole for x in (*left, *right)])
            out.append((r[0], leaf(*r), subroot, root, proof, cur, cur == root))
    return sorted(out, key=repr)


def actual(df):
    proofs = merkle.document_proofs(df)
    return sorted(map(tuple, proofs.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def rows_of(n, hot=0.5, seed=3):
    pick = random.Random(seed)
    sources = ["hot", "a", "B", "é", "", None]
    rows = [
        (i, sources[0] if pick.random() < hot else pick.choice(sources), pick.choice(["en", None]), pick.choice([i, None]),
         pick.choice(["one\ntwo", "plain", "", None, "é\n" * 40]), "k", 7, "n")
        for i in range(n)
    ]
    return rows + [(None, "a", None, None, "x\ny", "k", 1, "n")] * 2 + [(5, "solo", "en", 3, "\n", "k", 1, "n")] * 3 + [rows[0]] * 4


def test_manifest_equals_a_direct_computation(spark):
    rows = rows_of(300)
    assert actual(spark.createDataFrame(rows, DOCS).repartition(5)) == expected(rows)


def test_several_rounds_of_blocks(spark, monkeypatch):
    """Blocks of nine leaves: the hot source takes three rounds, the sources' tree two."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = rows_of(200) + [(1000 + i, f"s{i:02}", "en", 1, "a\nb", "k", 1, "n") for i in range(14)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    tree = merkle.manifest(df)
    assert len(tree.sources.rounds) == 3 and len(tree.above.rounds) == 2
    assert max(r["n"] for b in tree.sources.rounds for r in b.selectExpr("size(members) AS n").collect()) <= 9
    assert actual(df) == expected(rows)
    assert tree.sources.nodes().where("level = 0").count() == len(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_small_trees(spark, n):
    rows = [(i, "s", "en", 1, "a\nb", "k", 1, "n") for i in range(n)]
    assert actual(spark.createDataFrame(rows, DOCS)) == expected(rows)


def test_versions_copy_only_the_path(spark):
    """A version has one new node per level; with the shared siblings it gives its own root."""
    rows = [(i, "s", "en", 1, "a\nb", "k", 1, "n") for i in range(81)] + [(100, "t", "en", 1, "a", "k", 1, "n")]
    versions = merkle.manifest(spark.createDataFrame(rows, DOCS)).versions(spark).collect()
    for v in versions:
        if v["changed"] is None:
            assert len(v["copied"]) == 0
        elif v["doc_id"] < 100:
            assert len(v["copied"]) == 6 and v["copied"][0] == v["changed"] and v["copied"][-1] == v["folded_root"]


def test_empty_table(spark):
    proofs = merkle.document_proofs(spark.createDataFrame([], DOCS))
    assert proofs.count() == 0 and proofs.columns[:4] == ["doc_id", "leaf", "subroot", "root"]
