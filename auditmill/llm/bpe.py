"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by joining binary pieces.

The rank map goes to every task (a vocabulary, so its size does not depend on the data). A task splits whole texts into
words, folds the merges once per distinct word that it meets, and puts the documents together from the folded words; at
most `CACHED_WORDS` of them are held at a time. Nothing is shuffled. A fold with Spark's higher-order functions gave the
same ids and took about five times the allowed time; README has the figures.

Defined results: null and empty texts have no ids (the digest of the empty string); repeated rows are encoded alike; an
empty table gives no rows; other columns are not looked at. A word that is itself a token has that id, even if merges
would not reach it. Long words are merged with a heap, in n log n steps for n bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from auditmill.llm.common import small_batches, text_or_empty

CACHED_WORDS = 300_000
LONG_WORD = 100


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: again and again, the leftmost pair of the smallest rank becomes one part."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _fold_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    none = len(ranks) + 256
    after = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while after and (least := min(after)) < none:
        i = after.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del after[i]
        if i:
            after[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(after):
            after[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges, with the pairs in a heap and the parts in a linked list."""
    n = len(word)
    end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    pairs: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = right[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(pairs, (rank, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    while pairs:
        _, i, middle, stop = heapq.heappop(pairs)
        j = right[i]
        if end[i] != middle or j >= n or end[j] != stop:  # one of the parts has changed since
            continue
        end[i], right[i], end[j] = stop, right[j], -1
        if right[i] < n:
            left[right[i]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = right[i]
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


class _Folded(dict):
    """Ids of words, folded at the first use."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> list[int]:
        ids = self[word] = fold(word.encode(), self.ranks)
        return ids


class Codec:
    """Encodes texts with the folded words at hand; decodes ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.pieces = {rank: token for token, rank in ranks.items()}
        self.words = _Folded(ranks)

    def encode(self, text: str) -> list[int]:
        ids = list(chain.from_iterable(map(self.words.__getitem__, self.split(text))))
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def _worker(ranks, pattern: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(ranks.value, pattern)
        names = list(map(str, range(max(codec.pieces) + 1)))
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = codec.encode(text)
                joined = ",".join(map(names.__getitem__, ids)).encode()
                rows.append((len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
            columns = zip(*rows) if rows else [[], [], []]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(_SCHEMA)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=_SCHEMA)

    return work


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    rows = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(_worker(ranks, pattern), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
