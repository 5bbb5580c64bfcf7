"""Jaccard self-join of documents on five-word shingles by chosen paths.

Documents with equal word sequences share a representative. A representative's shingle set is embedded as `TOKENS`
minhash tokens, of which two sets share a Jaccard share. In each of `RUNS` runs a set follows every token whose hash,
salted by the path so far, falls below `BRANCH / TOKENS`: sets that share tokens meet in the same buckets. Buckets up to
`BUCKET` members are compared by brute force; larger ones split again, down to `DEPTH` levels, and what is still large
is compared in blocks. There are as many runs as bring the chance to miss a pair of exactly the threshold below
1 - `RECALL` in buckets that need no split (7e-5); where every bucket splits once or twice it is about 5e-4 or 1e-3.

Brute force on tokens keeps pairs well below the threshold too (five standard deviations), which gives candidate
clusters; inside these, all pairs are compared exactly on whole shingle sets, large clusters in pairs of blocks. A task
returns link counts and a spanning forest, never pairs, so output is linear in a group's size.

Defined results: a document of one to four words has one shingle of all its words; null and blank texts have none and
equal only each other; equal word sequences count as linked; repeated rows are documents of their own; a class's id is
its smallest doc_id (null if all are null); an empty table gives no rows; other columns are carried or not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import discard, fresh, saved, small_batches, text_or_empty, words_of

SHINGLE = 5
#: The threshold as a fraction, for exact comparisons.
SIMILAR = (4, 5)
TOKENS, BRANCH, DEPTH = 128, 2.0, 3
RECALL = 0.9999
RUNS = math.ceil(math.log(1 - RECALL) / (-BRANCH * SIMILAR[0] / SIMILAR[1]))
BUCKET, BLOCK, CLUSTER_BLOCK = 256, 1024, 512
#: Shared tokens from which two sets may reach the threshold: its mean less five standard deviations.
ENOUGH = int(TOKENS * 0.8 - 5 * math.sqrt(TOKENS * 0.8 * 0.2))

_SEEDS = np.random.default_rng(5).integers(1, 2**63, (2, TOKENS), dtype=np.uint64) | np.uint64(1)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _ODD[0]
        return x ^ (x >> np.uint64(29))


def shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (repeats included) of documents given as word hashes, and their offsets."""
    words = words.view(np.uint64)
    sizes = np.diff(offsets)
    with np.errstate(over="ignore"):
        padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
        rolled = sum((padded[i : i + len(words)] * _ODD[i] for i in range(SHINGLE)), np.zeros(len(words), np.uint64))
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    position = np.arange(bounds[-1]) - np.repeat(bounds[:-1] - offsets[:-1], counts)
    out = rolled[position]
    with np.errstate(over="ignore"):
        for i in np.flatnonzero((sizes > 0) & (sizes < SHINGLE)):  # a short text is one shingle of its own words
            own = words[offsets[i] : offsets[i + 1]]
            out[bounds[i]] = (own * _ODD[: len(own)]).sum() + np.uint64(sizes[i])
    return _mix(out), bounds


def _arrays(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, key, hashes) to (row, key, tokens); texts without words have no tokens."""
    schema = pa.schema([("row", pa.int64()), ("key", pa.string()), ("tokens", pa.binary())])
    for batch in batches:
        hashes, bounds = shingles(*_arrays(batch.column(2)))
        some = np.flatnonzero(np.diff(bounds))
        starts = bounds[:-1][some]
        tokens = np.empty((len(some), TOKENS), np.uint32)
        if len(some):
            with np.errstate(over="ignore"):
                for k in range(TOKENS):
                    mixed = (hashes ^ _SEEDS[0, k]) * _SEEDS[1, k]
                    tokens[:, k] = np.minimum.reduceat(mixed, starts) >> np.uint64(32)
        found: list[bytes | None] = [None] * batch.num_rows
        for at, own in zip(some.tolist(), tokens):
            found[at] = own.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], schema=schema)


def _tokens(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, TOKENS)


def _branches(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, child path) for every token that a member follows."""
    with np.errstate(over="ignore"):
        place = np.arange(1, TOKENS + 1, dtype=np.uint64) * _ODD[1]
        children = _mix(_mix(tokens.astype(np.uint64) * _ODD[2] + place) + paths.view(np.uint64)[:, None] * _ODD[3])
    followed = (children >> np.uint64(11)).astype(np.float64) < BRANCH / TOKENS * 2.0**53
    member, at = np.nonzero(followed)
    return member, _mix(children[member, at] + _ODD[4]).view(np.int64)


_PATHS = pa.schema([("path", pa.int64()), ("row", pa.int64())])


def _first_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, tokens = batch.column(0).to_numpy(), _tokens(batch.column(1))
        for run in range(RUNS):
            member, child = _branches(_mix(np.full(len(rows), run + 1, np.uint64)).view(np.int64), tokens)
            yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(rows[member])], schema=_PATHS)


def _next_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, tokens = batch.column(1).to_numpy(), _tokens(batch.column(2))
        member, child = _branches(batch.column(0).to_numpy(), tokens)
        yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(rows[member])], schema=_PATHS)


def _forest(linked: np.ndarray) -> np.ndarray:
    """Per member the smallest member that links reach; `linked` is a symmetric matrix."""
    root = np.arange(len(linked))
    while True:
        best = np.minimum(root, np.where(linked, root[None, :], len(root)).min(1, initial=len(root)))
        best = best[best]
        if (best == root).all():
            return root
        root = best


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Slices of equal leading key columns from sorted batches; a group may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        changed = np.any([c[1:] != c[:-1] for c in columns], 0)
        bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            part = batch.slice(a, b - a)
            if held and a == 0 and all(held[-1].column(k)[-1] == part.column(k)[0] for k in range(keys)):
                held.append(part)
            else:
                if held:
                    yield _one(held)
                held = [part]
    if held:
        yield _one(held)


def _one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _candidate_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (path, a, b, row, tokens) to a forest (row, smaller row) of the sets that share enough tokens."""
    out: list[np.ndarray] = []
    for group in _groups(batches, 3):
        rows = group.column(3).to_numpy()
        if len(rows) < 2:
            continue
        order = np.argsort(rows)
        rows, tokens = rows[order], _tokens(group.column(4))[order]
        linked = np.empty((len(rows), len(rows)), bool)
        for i in range(len(rows)):
            linked[i] = (tokens == tokens[i]).sum(1) >= ENOUGH
        root = _forest(linked)
        child = np.flatnonzero(root != np.arange(len(rows)))
        if len(child):
            out.append(np.stack([rows[child], rows[root[child]]]))
        if sum(x.shape[1] for x in out) > 50_000:
            yield _edge_batch(out)
            out = []
    yield _edge_batch(out)


def _edge_batch(out: list[np.ndarray]) -> pa.RecordBatch:
    both = np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], schema=_EDGES)


_LINKS = pa.schema([("row", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _exact_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cluster, a, b, row, block, copies, hashes) to each member's links, counted in copies, and its forest root."""
    top, bottom = SIMILAR
    for group in _groups(batches, 3):
        rows, block, copies = (group.column(k).to_numpy() for k in (3, 4, 5))
        hashes, bounds = shingles(*_arrays(group.column(6)))
        sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(ids) + 1, np.int32)
        crossed = group.column(1)[0].as_py() != group.column(2)[0].as_py()
        order = np.argsort(rows)
        linked = np.zeros((len(rows), len(rows)), bool)
        for i in range(len(rows)):
            own = ids[starts[i] : starts[i] + sizes[i]]
            mark[own] = 1
            common = np.add.reduceat(mark[ids], starts)
            mark[own] = 0
            linked[i] = bottom * common >= top * (sizes + sizes[i] - common)
        np.fill_diagonal(linked, False)
        if crossed:
            linked &= block[:, None] != block[None, :]
        links = linked @ copies
        root = _forest(linked[np.ix_(order, order)])
        some = np.flatnonzero(links[order])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[order][some]), pa.array(links[order][some].astype(np.int64)), pa.array(rows[order][root[some]])], schema=_LINKS
        )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of undirected edges (u, v): large and small stars in turn until nothing changes."""

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    def canonical(e: DataFrame) -> DataFrame:
        return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    current = saved(canonical(edges), "edges")
    before = None
    while (now := state(current)) != before:
        before = now
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = canonical(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        last, current = current, saved(canonical(moved), "edges")
        discard(last)
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _blocked(rows: DataFrame, blocks) -> DataFrame:
    """A row for each pair of blocks (a <= b) that the row's own block is in."""
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks).withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))))
        .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))
    )


def _candidates(tokens: DataFrame) -> list[DataFrame]:
    """Stored forest edges over (row, tokens), per level, that connect all sets that may be similar."""
    found, paths = [], saved(tokens.mapInArrow(_first_paths, "path bigint, row bigint"), "paths")
    for depth in range(1, DEPTH + 1):
        sizes = paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        members = saved(paths.join(sizes, "path").join(tokens, "row").select("path", "row", "tokens", "n"), "members")
        last = depth == DEPTH
        small = _blocked(members if last else members.where(F.col("n") <= BUCKET),
                         F.when(F.col("n") <= BUCKET, F.lit(1)).otherwise(F.ceil(F.col("n") / BLOCK)))
        sorted_ = small.select("path", "a", "b", "row", "tokens").repartition("path", "a", "b").sortWithinPartitions("path", "a", "b")
        found.append(saved(sorted_.mapInArrow(_candidate_edges, "u bigint, v bigint").distinct(), "candidates"))
        done = [paths, members]
        if not last:
            large = members.where(F.col("n") > BUCKET).select("path", "row", "tokens")
            paths = saved(large.mapInArrow(_next_paths, "path bigint, row bigint"), "paths")
        discard(*done)
    return found


def similarity_rows(docs: DataFrame, *carry) -> DataFrame:
    """Stored rows (row, doc_id, key, text, *carry); key stands for the word sequence."""
    words = words_of(text_or_empty())
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text", *carry)
    return saved(base.withColumn("key", F.sha2(F.array_join(words, " "), 256)), "similarity_rows")


def _hashes():
    return F.transform(words_of(text_or_empty()), lambda w: F.xxhash64(w)).alias("hashes")


def classes(rows: DataFrame) -> DataFrame:
    """(row, doc_id, root, n_links) of stored rows; root is a row number that stands for the class."""
    spark = rows.sparkSession
    small_batches(spark)
    # Tokens are far smaller than texts, so they are made before copies meet: no text is shuffled for the candidates.
    signed = rows.select("row", "key", _hashes()).mapInArrow(_signatures, "row bigint, key string, tokens binary")
    groups = saved(signed.groupBy("key").agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.first("tokens").alias("tokens")), "sequences")
    edges = _candidates(groups.where("tokens is not null").select("row", "tokens"))
    clusters = components(reduce(DataFrame.unionByName, edges))
    discard(*edges)
    # Exact comparison of all pairs inside a candidate cluster; every text travels to the pairs of its own block only.
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    members = clusters.join(sizes, "root").select(F.col("node").alias("row"), "root", "n").join(groups.select("row", "copies"), "row")
    texts = members.join(rows.select("row", "text"), "row")
    blocked = _blocked(texts, F.ceil(F.col("n") / CLUSTER_BLOCK))
    dealt = blocked.select("root", "a", "b", "row", "block", "copies", "text").repartition("root", "a", "b").sortWithinPartitions("root", "a", "b")
    worker: Callable = _exact_links
    links = saved(
        dealt.select("root", "a", "b", "row", "block", "copies", _hashes()).mapInArrow(worker, "row bigint, links bigint, root bigint"), "links"
    )
    linked = links.groupBy("row").agg(F.sum("links").alias("links"))
    joined = components(links.select(F.col("row").alias("u"), F.col("root").alias("v")))
    known = (
        groups.join(linked, "row", "left").join(joined.withColumnRenamed("node", "row"), "row", "left")
        .select("key", F.coalesce("root", "row").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    # Links and roots are at most a row per document, numbers only.
    found = saved(rows.select("row", "doc_id", "key").join(known, "key").select("row", "doc_id", "root", "n_links"), "classes")
    discard(groups, links)
    return found


def similarity_classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id, class_size, n_links (documents of Jaccard similarity 0.8 or more to it)."""
    rows = similarity_rows(docs)
    found = classes(rows)
    discard(rows)
    ids = found.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return found.join(ids, "root").select("doc_id", "class_id", "class_size", "n_links")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest doc_id (nulls last), with all columns of `docs`."""
    carried = fresh(("row", "doc_id", "text", "key"), "columns_of_docs")
    others = [c for c in docs.columns if c.lower() != "text"]
    rows = similarity_rows(docs, F.struct(*(F.col(f"`{c}`") for c in others)).alias(carried))
    found = classes(rows)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    kept = found.groupBy("root").agg(first.alias("first")).select("first.row")
    # Stored, so that its measured size decides how it is joined: a small set of row numbers moves no text.
    dropped = saved(found.select("row").join(kept, "row", "left_anti"), "similar_rows")
    discard(found)
    columns = [F.col("text").alias(c) if c.lower() == "text" else F.col(f"{carried}.`{c}`") for c in docs.columns]
    return rows.select("row", "text", carried).join(dropped, "row", "left_anti").select(*columns)
