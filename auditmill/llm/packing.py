"""Packing of tokenized documents into training sequences by sum-of-squares online placement.

A document of any length first fills whole windows. What remains goes to the open window whose fill level makes the sum
of squared counts of partially filled windows smallest; a level array holds the counts, so a placement costs one vector
operation over the levels. The windows that are still open at the end of a partition are emptied into full ones, and the
last remainder is cut into lengths that are powers of two and need no padding.

Defined results: a null or empty text is the end id alone; repeated rows are packed each for itself; an empty table
gives no rows; other columns are not looked at. Sequence ids are unique, not consecutive.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import small_batches, text_or_empty

WINDOW = 2048
END_ID = 1
#: The tokenizer's special token: the only text for which ranks and tokenizer differ.
SPECIAL = "<|endoftext|>"

_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
     ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
_SQL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
#: Pieces of one document that a worker holds until it knows where they go: (document, start, length).
Piece = tuple[int, int, int]


class Packer:
    """Places remainders below a window; yields closed windows as lists of pieces."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)  # open windows by fill level; levels 0 and `window` stay 0
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]

    def add(self, document: int, tokens: int) -> Iterator[list[Piece]]:
        full = tokens - tokens % self.window
        for start in range(0, full, self.window):
            yield [(document, start, self.window)]
        size = tokens - full
        if size:
            yield from self._place((document, full, size))

    def _place(self, piece: Piece) -> Iterator[list[Piece]]:
        size = piece[2]
        level = self._best(size)
        if level:
            self.counts[level] -= 1
            pieces = self.open[level].pop()
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            yield pieces
        else:
            self.counts[level + size] += 1
            self.open[level + size].append(pieces)

    def _best(self, size: int) -> int:
        """The level, 0 for a new window, with the smallest sum of squares after the placement; the fullest of equals."""
        counts, last = self.counts, self.window - size
        # Moving a window from level a to b changes the sum by 2 (counts[b] - counts[a]) + 2; a filled window leaves it.
        change = 2 * (counts[size:] - counts[: last + 1]) + 2
        change[last] = 1 - 2 * counts[last]
        change[0] = 2 * counts[size] + 1
        change[1:][counts[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def finish(self) -> Iterator[list[Piece]]:
        """Empties the open windows: full ones as far as the pieces go, then powers of two."""
        rest = [piece for level in reversed(self.open) for pieces in level for piece in pieces]
        left = sum(p[2] for p in rest)
        room, pieces = 0, []
        for document, start, length in rest:
            while length:
                if not room:
                    room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
                taken = min(room, length)
                pieces.append((document, start, taken))
                start, length, room, left = start + taken, length - taken, room - taken, left - taken
                if not room:
                    yield pieces
                    pieces = []
        self.__init__(self.window)


def _encoder(tokenizer_json: str):
    """ids of a text. The tokenizer's merges run in the faster of two libraries; a text with the special token needs the other."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_str(tokenizer_json)
    to_byte = {c: b for b, c in _byte_letters().items()}
    vocabulary = json.loads(tokenizer_json)["model"]["vocab"]
    ranks = {bytes(to_byte[c] for c in piece): i for piece, i in vocabulary.items() if piece != SPECIAL}
    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        ids = slow.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)
        ids.append(END_ID)
        return np.array(ids, "<u4")

    return encode


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _pack_worker(tokenizer):
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = _encoder(tokenizer.value), Packer()
        base, sequence, number = TaskContext.get().partitionId() << 40, 0, 0
        held: dict[int, list] = {}  # per document with open pieces: id, ids, ids not yet placed
        rows: list[tuple] = []

        def place(windows: Iterable[list[Piece]]) -> None:
            nonlocal sequence
            for pieces in windows:
                offset = 0
                for document, start, length in pieces:
                    entry = held[document]
                    doc_id, first, ids, total = entry[:4]
                    crc = zlib.crc32(ids[start - first : start - first + length].tobytes())
                    rows.append((doc_id, start, length, crc, total, base + sequence, offset))
                    offset += length
                    entry[4] -= length
                    if not entry[4]:
                        del held[document]
                sequence += 1

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = encode(text)
                held[number] = [doc_id, 0, ids, len(ids), len(ids)]
                place(packer.add(number, len(ids)))
                if (entry := held.get(number)) and entry[4] < len(ids):  # only the remainder is kept
                    entry[1], entry[2] = len(ids) - entry[4], ids[-entry[4] :].copy()
                number += 1
            yield from _piece_rows(rows)
            rows.clear()
        place(packer.finish())
        yield from _piece_rows(rows)

    return work


def _piece_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 50_000):
        columns = zip(*rows[at : at + 50_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def packed(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Narrow: every scan task packs its own rows.

    A worker holds the remainders (each below a window) of its open windows; sum-of-squares placement keeps these few.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = spark.sparkContext.broadcast(file.read())  # a vocabulary: its size does not depend on the data
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_pack_worker(tokenizer), _SQL)
