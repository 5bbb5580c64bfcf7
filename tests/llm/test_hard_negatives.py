"""Hard negatives against brute force, and the defined results of odd inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from auditmill.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, block int, members string"


def wrapped(n):
    return (n + (1 << 63)) % (1 << 64) - (1 << 63)


def brute(rows):
    """Rows (vec_id, label, vector) of integers, one per id; anchors are multiples of 10."""
    dot = lambda a, b: wrapped(sum(x * y for x, y in zip(a, b)))
    out = []
    for a, label, v in rows:
        if a % 10:
            continue
        scored = [(-dot(v, w), b, other) for b, other, w in rows if b != a]
        for s, p, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fits = sorted((n, b) for n, b, other in scored if other != label and 80 * -s <= 100 * -n <= 100 * -s)
            out += [(a, p, r, b, -s, -n) for r, (n, b) in enumerate(fits[:5], 1)]
    return sorted(out)


def mined(df):
    found = hn.hard_negatives(hn.integer_vectors(df), F.col("vec_id") % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def quantised(rows):
    return [(i, label, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, label, *_ in rows]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, "m") for r in rows], SCHEMA).repartition(3)


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in (("BLOCK_ROWS", 32), ("SLAB_BLOCKS", 3), ("LEAF", 4), ("FANOUT", 3), ("CHUNK", 4)):
        monkeypatch.setattr(hn, name, value)


def test_equals_brute_force_with_a_hot_label_and_ties(spark, small_blocks):
    pick = random.Random(1)
    rows = [(i, [pick.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(5)], 1 if i % 3 else pick.randrange(4)) for i in range(400)]
    expected = brute(quantised(rows))
    assert mined(frame(spark, rows)) == expected and len(expected) > 300
    assert any(r[4] == r[5] for r in expected)


def test_odd_rows(spark, small_blocks):
    good = [(i, [1.0, float(i % 7), 0.5], i % 2) for i in range(60)]
    short = [(70, [2.0], 0), (71, [], 1), (80, [], 0)]
    bad = [(90, None, 1), (100, [1.0, None], 1), (110, [float("nan")], 0), (120, [float("inf")], 0), (130, [1.0, 1.0, 1.0], None), (None, [9.0, 9.0, 9.0], 0)]
    copies = [good[10]] * 3 + [(20, [1.0, 6.0, 0.5], 5)]  # a larger label under an id that is there already
    expected = brute(quantised(good + short))
    assert mined(frame(spark, good + short + bad + copies)) == expected


def test_scores_beyond_exact_doubles_wrap_like_spark(spark, small_blocks):
    pick = random.Random(2)
    rows = [(i, [pick.choice([1e8, -3e7, 5e6, 1e30]) for _ in range(3)], i % 3) for i in range(80)]
    as_long = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    expected = brute([(i, label, [as_long(x) for x in v]) for i, label, v in quantised(rows)])
    assert mined(frame(spark, rows)) == expected


def test_no_anchor_no_positive_and_empty_tables(spark):
    assert mined(frame(spark, [(i, [1.0], 0) for i in range(1, 9)])) == []
    assert mined(frame(spark, [(0, [1.0], 0), (1, [1.0], 1), (10, [1.0], 2)])) == []
    assert mined(frame(spark, [])) == []


def test_boxes_bound_their_rows_and_prune(monkeypatch):
    """Every score lies in its box's interval, and on clustered vectors the search opens few leaves."""
    pick = np.random.default_rng(3)
    centres = pick.integers(-400, 400, (20, 8))
    vectors = np.repeat(centres, 60, axis=0) + pick.integers(-6, 6, (1200, 8))
    ids, labels = pick.permutation(1200), np.arange(1200) % 2
    tree = hn.Tree(ids, labels, vectors)
    assert sorted(tree.ids.tolist()) == list(range(1200)) and max(b - a for a, b in tree.parts) <= hn.LEAF
    anchors = vectors[:50]
    lower, upper, scores_of = tree.scorer(anchors)
    opened = []
    for i, q in enumerate(anchors):
        seen = []
        for node, (a, b) in enumerate(tree.parts):
            scores = scores_of(i, a, b)
            assert (lower[i, node] <= scores).all() and (scores <= upper[i, node]).all()
        goal = hn.Goal(-np.inf, np.inf, [])
        hn.search(tree, i, -1, 0, True, [goal], lower, upper, lambda i, a, b: seen.append(a) or scores_of(i, a, b))
        same = [(int(v @ q), -int(n)) for v, n, label in zip(tree.vectors, tree.ids, tree.labels) if label == 0]
        assert sorted(goal.best) == sorted(same, reverse=True)[:5][::-1]
        opened.append(len(seen))
    assert np.mean(opened) < len(tree.parts) / 3
