"""Benchmark decontamination by an Aho-Corasick automaton over normalised questions and answers.

Texts are lower-cased (A to Z) and read as words of digits, letters a to z and everything beyond ASCII. A window is
`WINDOW` consecutive words of an item, or the whole of an item with fewer. The windows are patterns over numbered words in
one automaton; every document is scanned once, word by word, whatever the number of items. The words that occurrences
cover are merged to passages, and passages are mapped back to character offsets of the original text.

The automaton is built on the driver and sent to the tasks while the benchmark has at most `PART_WINDOWS` pairs of a
window and an item, counted first. A larger benchmark is dealt by a hash of the pair into parts of about that size: each
has an automaton of its own, documents are scanned once per part, and the parts' passages and items are merged per document.

Defined results: null and empty texts, and texts without words, have no words and no passages; items without words have
no windows; an item listed twice is one item, whose windows are those of both texts; an item without id is named by the
empty text; repeated documents are judged alike; without items nothing is contaminated; an empty table gives no rows;
columns beyond id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import saved

WINDOW = 10
#: Pairs of a window and an item in one automaton; about 1 kB each.
PART_WINDOWS = 100_000
#: Bytes that separate words, once capitals are small letters.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_CAPITALS, _SMALL, _SPACE = range(0x41, 0x5B), range(0x61, 0x7B), 0x20
NORMAL = bytes(_SMALL[b - 0x41] if b in _CAPITALS else _SPACE if b in SEPARATORS else b for b in range(256))

_SPAN = pa.struct([("first", pa.int64()), ("words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_FOUND = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string())),
])
_FOUND_SQL = (
    "row bigint, doc_id bigint, n_words bigint, spans array<struct<first:bigint,words:bigint,start:bigint,end:bigint>>, items array<string>"
)
_PAIR = pa.schema([("window", pa.binary()), ("item", pa.string())])


def words_of(text: bytes) -> list[bytes]:
    """The normalised words of a UTF-8 text: bytes of one length, so that places in it stay places in the original."""
    return text.translate(NORMAL).split()


def windows_of(text: bytes, window: int) -> Iterator[bytes]:
    words = words_of(text)
    width = min(window, len(words))
    for i in range(len(words) - width + 1 if words else 0):
        yield b" ".join(words[i : i + width])


def window_pairs(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (window, item) of items (item_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for name, text in zip(names, texts):
                found = list(dict.fromkeys(windows_of(text, window)))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([name] * len(found), pa.string())], schema=_PAIR)

    rows = items.where("text IS NOT NULL").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")
    return rows.mapInArrow(work, "window binary, item string").distinct()


class Windows:
    """The automaton over word numbers, the word list, and per window its width and its items."""

    def __init__(self, pairs: Iterable[tuple[bytes, str]]):
        owners: dict[bytes, list[str]] = {}
        for window, item in pairs:
            owners.setdefault(window, []).append(item)
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        self.widths, self.items = [], []
        for n, (window, items) in enumerate(owners.items()):
            # Number 0 is for words that no window has.
            key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in window.split(b" "))
            self.automaton.add_word(key, n)
            self.widths.append(len(key))
            self.items.append(items)
        if owners:
            self.automaton.make_automaton()

    def occurrences(self, words: list[bytes]) -> Iterable[tuple[int, int]]:
        """(place of the last word, window) of every occurrence."""
        if not self.widths or not words:
            return ()
        return self.automaton.iter(tuple(map(self.numbers.get, words, repeat(0))))


def merged(n_words: int, parts: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts (first word, behind the last) of a text as maximal passages; touching ones are one passage."""
    edges = np.zeros(n_words + 2, np.int64)
    parts = np.array(list(parts), np.int64).reshape(-1, 2)
    np.add.at(edges, parts[:, 0] + 1, 1)
    np.add.at(edges, parts[:, 1] + 1, -1)
    inside = np.cumsum(edges) > 0
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def placed(text: bytes, passages: list[tuple[int, int]]) -> list[dict]:
    """Passages with their code points [start, end) in the original text."""
    normal = np.frombuffer(text.translate(NORMAL), np.uint8)
    in_word = np.concatenate([[False], normal != _SPACE, [False]])
    starts, ends = np.flatnonzero(in_word[1:] & ~in_word[:-1]), np.flatnonzero(~in_word[1:] & in_word[:-1])
    # Code points before each byte: bytes that continue one do not count.
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return [
        {"first": a, "words": b - a, "start": int(points[starts[a]]), "end": int(points[ends[b - 1]])} for a, b in passages
    ]


def _scanner(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = shared.value
        for batch in batches:
            rows = []
            for row, doc_id, text in zip(batch.column(0), batch.column(1), batch.column(2).cast(pa.binary())):
                text = text.as_py() or b""
                words = words_of(text)
                parts, kinds = set(), set()
                for last, kind in windows.occurrences(words):
                    parts.add((last + 1 - windows.widths[kind], last + 1))
                    kinds.add(kind)
                spans = placed(text, merged(len(words), parts)) if parts else []
                items = sorted({item for kind in kinds for item in windows.items[kind]})
                rows.append((row.as_py(), doc_id.as_py(), len(words), spans, items))
            yield _found(rows)

    return work


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from its rows of several parts (row, doc_id, n_words, lists of spans, lists of items)."""
    for batch in batches:
        rows = []
        for row, doc_id, n_words, spans, items in zip(*(c.to_pylist() for c in batch.columns)):
            begin = {s["first"]: s["start"] for part in spans for s in part}
            finish = {s["first"] + s["words"]: s["end"] for part in spans for s in part}
            passages = merged(n_words, [(s["first"], s["first"] + s["words"]) for part in spans for s in part])
            whole = [{"first": a, "words": b - a, "start": begin[a], "end": finish[b]} for a, b in passages]
            rows.append((row, doc_id, n_words, whole, sorted({i for part in items for i in part})))
        yield _found(rows)


def leaked_passages(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: row, doc_id, n_words, spans (first word, number of words, code points start and end) and items whose
    windows occur, sorted as strings."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    pairs = saved(window_pairs(items, window), "benchmark_windows")
    parts = max(1, -(-pairs.count() // PART_WINDOWS))
    if parts > 1:
        rows = saved(rows, "numbered_documents")  # so that a row has one number in every part
    found = None
    for part in range(parts):
        own = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(parts)) == part).toArrow()  # about PART_WINDOWS rows
        shared = spark.sparkContext.broadcast(Windows(zip(own["window"].to_pylist(), own["item"].to_pylist())))
        scanned = rows.mapInArrow(_scanner(shared), _FOUND_SQL)
        found = scanned if found is None else found.unionByName(scanned)
    if parts == 1:
        return found
    grouped = found.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"),
    )  # fmt: skip  # a row per part
    return grouped.mapInArrow(_together, _FOUND_SQL)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["words"])
    return leaked_passages(docs, items, window).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )
