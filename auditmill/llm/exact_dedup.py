"""Exact deduplication with a cuckoo-filter index over live digests.

Two texts are equal when they agree after deleting every blank. Defined results: a null text counts as empty; of equal
texts the one with the most code points stays, then the smallest doc_id (nulls last), then the first row read, so
repeated rows leave one row; an empty table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import BLANKS, fresh, saved, small_batches, text_or_empty

SLOTS = 4
MAX_KICKS = 200


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four slots, each at one of two places; supports deletion."""

    def __init__(self, buckets: int):
        self.mask = buckets - 1
        self.slots = np.zeros((buckets, SLOTS), np.uint16)

    def _places(self, key: int) -> tuple[int, int, int]:
        print_ = (key >> 48) or 1
        first = key & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, place: int, print_: int) -> int:
        return (place ^ (print_ * 0x5BD1E995)) & self.mask

    def contains(self, key: int) -> bool:
        print_, a, b = self._places(key)
        return print_ in self.slots[a].tolist() or print_ in self.slots[b].tolist()

    def insert(self, key: int) -> bool:
        """False on overflow: a fingerprint has lost its place, and the filter has to be rebuilt."""
        print_, a, b = self._places(key)
        for place in (a, b):
            if self._put(place, print_):
                return True
        place = b
        for kick in range(MAX_KICKS):
            row, slot = self.slots[place], kick % SLOTS
            print_, row[slot] = int(row[slot]), print_
            place = self._other(place, print_)
            if self._put(place, print_):
                return True
        return False

    def delete(self, key: int) -> bool:
        print_, a, b = self._places(key)
        for place in (a, b):
            row = self.slots[place].tolist()
            if print_ in row:
                self.slots[place, row.index(print_)] = 0
                return True
        return False

    def _put(self, place: int, print_: int) -> bool:
        row = self.slots[place].tolist()
        if 0 in row:
            self.slots[place, row.index(0)] = print_
            return True
        return False


class LiveIndex:
    """Live digests with the figures of their rows: a filter in front of content kept in buckets.

    Most digests are new; for those the filter alone answers. A hit is verified against the full digests of its
    content bucket, so a false hit of the filter never merges two texts. When the filter overflows, it is rebuilt at
    twice the size from the stored keys.
    """

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.content: list[dict[bytes, tuple]] = [{} for _ in range(1024)]
        self.resizes = 0

    @staticmethod
    def _key(digest: bytes) -> int:
        return int.from_bytes(digest[:8], "little")

    def _bucket(self, digest: bytes) -> dict[bytes, tuple]:
        return self.content[int.from_bytes(digest[8:10], "little") % len(self.content)]

    def find(self, digest: bytes) -> tuple | None:
        return self._bucket(digest).get(digest) if self.filter.contains(self._key(digest)) else None

    def add(self, digest: bytes, count: int, rank: tuple) -> None:
        """Adds `count` rows of a digest, the best of which has `rank` (smaller is better)."""
        known = self.find(digest)
        if known is not None:
            # A digest whose best is unknown stays so: the new row need not be better than those that remain.
            self._bucket(digest)[digest] = (known[0] + count, known[1] and min(known[1], rank))
            return
        self._bucket(digest)[digest] = (count, rank)
        if not self.filter.insert(self._key(digest)):
            self._resize()

    def remove(self, digest: bytes, rank: tuple | None = None, count: int = 1) -> bool:
        """Takes rows of a live digest away; with the last one the digest leaves filter and content. Where `rank` is that of the
        best row, or is not given, the best of those that remain is unknown (None) until `renew`."""
        known = self.find(digest)
        if known is None:
            return False
        if known[0] > count:
            best = known[1] if rank is not None and known[1] is not None and known[1] < rank else None
            self._bucket(digest)[digest] = (known[0] - count, best)
        else:
            del self._bucket(digest)[digest]
            self.filter.delete(self._key(digest))
        return True

    def renew(self, digest: bytes, rank: tuple) -> None:
        """Gives a live digest the rank of its best row, found among the rows that remain."""
        known = self.find(digest)
        if known is not None:
            self._bucket(digest)[digest] = (known[0], rank)

    def _resize(self) -> None:
        buckets = 2 * (self.filter.mask + 1)
        while True:
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(self._key(d)) for bucket in self.content for d in bucket):
                break
            buckets *= 2
        self.resizes += 1

    def __len__(self) -> int:
        return sum(map(len, self.content))

    def items(self) -> Iterator[tuple[bytes, int, tuple]]:
        for bucket in self.content:
            for digest, (count, rank) in bucket.items():
                yield digest, count, rank


_GROUP = pa.schema([("digest", pa.binary()), ("n", pa.int64()), ("chars", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64())])
_GROUP_SQL = "digest binary, n bigint, chars bigint, doc_id bigint, row bigint"
#: Digests that a worker holds before it passes its counts on; the merge sees them again.
LOCAL_DIGESTS = 100_000
#: Digests expected in one task of the merge.
TASK_DIGESTS = 250_000


def _groups(batches: Iterable[pa.RecordBatch], limit: int | None) -> Iterator[pa.RecordBatch]:
    index, held = LiveIndex(), 0
    for batch in batches:
        for digest, n, chars, doc_id, row in zip(*(c.to_pylist() for c in batch.columns)):
            index.add(digest, n, (-chars, doc_id is None, doc_id or 0, row))
        held += batch.num_rows
        if limit and held >= limit:
            yield from _group_rows(index)
            index, held = LiveIndex(), 0
    yield from _group_rows(index)


def _group_rows(index: LiveIndex) -> Iterator[pa.RecordBatch]:
    rows = [(d, n, -r[0], None if r[1] else r[2], r[3]) if r else (d, n, None, None, None) for d, n, r in index.items()]
    for start in range(0, len(rows), 20_000):
        columns = zip(*rows[start : start + 20_000])
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _GROUP)], schema=_GROUP)


def keyed(df: DataFrame, *carry: str) -> DataFrame:
    """Stored rows (row, doc_id, digest, chars, *carry); the row number is an identity from here on."""
    text = text_or_empty()
    return saved(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.unhex(F.sha2(F.translate(text, BLANKS, ""), 256)).alias("digest"),
            F.char_length(text).cast("bigint").alias("chars"),
            *carry,
        ),
        "exact_rows",
    )


def digest_groups(rows: DataFrame) -> DataFrame:
    """One row per digest: n, and the row that stays.

    Each scan task folds its rows in an index of its own first, so a digest that a third of all rows share reaches the
    merge as a row per task or so.
    """
    spark = rows.sparkSession
    small_batches(spark, 4096)
    local = rows.select("digest", F.lit(1).cast("bigint").alias("n"), "chars", "doc_id", "row").mapInArrow(
        lambda batches: _groups(batches, LOCAL_DIGESTS), _GROUP_SQL
    )
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // TASK_DIGESTS)
    return local.repartition(tasks, "digest").mapInArrow(lambda batches: _groups(batches, None), _GROUP_SQL)


def _live_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups, then deletions of single rows (a last column tells them): what is live, without a row where the best has gone."""
    index = LiveIndex()
    for batch in batches:
        for digest, n, chars, doc_id, row, gone in zip(*(c.to_pylist() for c in batch.columns)):
            rank = (-chars, doc_id is None, doc_id or 0, row)
            if gone:
                index.remove(digest, rank)
            else:
                index.add(digest, n, rank)
    yield from _group_rows(index)


def groups_after_deletion(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """`digest_groups` of stored rows without those that `gone` (row) names: inserted, deleted again by their digests, and
    looked up anew only for digests whose best row has gone."""
    live = F.lit(False).alias("gone")
    deleted = rows.join(gone.distinct(), "row", "left_semi").select(
        "digest", F.lit(1).cast("bigint").alias("n"), "chars", "doc_id", "row", F.lit(True).alias("gone")
    )
    inserted = digest_groups(rows).select("digest", "n", "chars", "doc_id", "row", live)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // TASK_DIGESTS)
    met = inserted.unionByName(deleted).repartition(tasks, "digest").sortWithinPartitions("gone")
    left = saved(met.mapInArrow(_live_groups, _GROUP_SQL), "live_digests")
    stale = rows.join(left.where("row IS NULL").select("digest"), "digest", "left_semi").join(gone, "row", "left_anti")
    return left.where("row IS NOT NULL").unionByName(digest_groups(stale))


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = keyed(docs)
    return _decided(rows).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _decided(rows: DataFrame) -> DataFrame:
    copies = digest_groups(rows).where("n > 1").select(
        "digest", F.col("n").alias("group_size"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row")
    )
    # Only digests with copies are joined; adaptive execution splits a hot one on the side of the rows.
    joined = rows.select("row", "doc_id", "digest").join(copies, "digest", "left")
    alone = F.col("keep_row").isNull()
    return joined.select(
        "row", "doc_id", "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("keep_row") == F.col("row"))).alias("kept"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all columns of `docs`."""
    carried = fresh(("row", "doc_id", "digest", "chars"), "columns_of_docs")
    rows = keyed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(carried))
    # Stored, so that its measured size decides how it is joined: a small set of row numbers moves no text.
    dropped = saved(_decided(rows).where("NOT kept").select("row"), "equal_rows")
    return rows.select("row", carried).join(dropped, "row", "left_anti").select(f"{carried}.*")
