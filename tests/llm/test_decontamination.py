"""Benchmark passages against brute force, and the defined results of odd inputs."""

import hashlib
import random
import re

import pytest

from auditmill.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, row string, spans int, items string"
ITEMS = "item_id bigint, text string, window string"


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def brute(docs, items):
    windows = {}
    for item, text, *_ in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    widths = sorted({len(w) for w in windows})
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for k in widths:
            for i in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[i : i + k]))) is not None:
                    hit |= set(range(i, i + k))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables():
    pick = random.Random(5)
    pool = ["alpha", "BETA", "gamma", "Straße", "été", "x1", "ÉTÉ", "delta"]
    text = lambda n: pick.choice([" ", "\n", ", ", "--"]).join(pick.choice(pool) for _ in range(n))
    items = [(i, text(pick.choice([3, 9, 10, 11, 25])), "w") for i in range(40)]
    items += [(7, text(12), "w"), (50, None, "w"), (51, "", "w"), (52, "?!", "w"), (None, text(14), "w"), (53, items[0][1], "w")]
    docs = []
    for i in range(150):
        parts = [text(pick.randrange(1, 40))]
        if i % 2:
            parts += [pick.choice(items)[1] or "", text(5)]
        docs.append((i, " ".join(parts), "r", 1, "i"))
    docs += [(200, None, "r", 1, "i"), (201, "", "r", 1, "i"), (202, "...", "r", 1, "i"), (None, items[4][1], "r", 1, "i"), docs[3], docs[3]]
    docs.append((203, text(30_000) + " " + items[4][1].upper(), "r", 1, "i"))
    return docs, items


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_brute_force(spark, tables):
    docs, items = tables
    got = dc.contamination(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = brute(docs, items)
    assert rows_of(got) == expected and any(r[5] for r in expected) and not all(r[5] for r in expected)


def test_parts_of_a_large_benchmark_give_the_same(spark, tables, monkeypatch):
    docs, items = tables
    docs, items = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    whole = sorted((r.doc_id or -1, r.n_words, r.items, [tuple(s) for s in r.spans]) for r in dc.leaked_passages(docs, items).collect())
    monkeypatch.setattr(dc, "PART_WINDOWS", 60)
    parts = sorted((r.doc_id or -1, r.n_words, r.items, [tuple(s) for s in r.spans]) for r in dc.leaked_passages(docs, items).collect())
    assert parts == whole


def test_passages_lie_where_they_are_in_the_original(spark):
    item = "One two three FOUR five six seven eight nine ten"
    text = "Ünïcode 😀, before: one,two;three\nfour five-six seven EIGHT nine ten! after"
    row = dc.leaked_passages(spark.createDataFrame([(1, text)], "doc_id int, text string"), spark.createDataFrame([(9, item)], "item_id int, text string")).first()
    (span,) = row["spans"]
    assert text[span["start"] : span["end"]] == "one,two;three\nfour five-six seven EIGHT nine ten"
    assert words(text)[span["first"] : span["first"] + span["words"]] == words(item) and row["items"] == ["9"]


def test_clean_words_and_empty_tables(spark, tables):
    docs, items = tables
    none = dc.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS))
    assert rows_of(none) == brute(docs, [])
    assert dc.contamination(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    nine = "a b c d e f g h i"  # nine words of a ten-word item are no window
    got = dc.contamination(spark.createDataFrame([(1, nine)], "doc_id int, text string"), spark.createDataFrame([(1, nine + " j")], "item_id int, text string"))
    assert got.first()["contaminated"] is False
