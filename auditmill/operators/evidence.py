"""Evidence digests and the manifest."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditmill import __version__
from auditmill.functions.text import row_digest

HASHES_PER_BLOCK = 8192
LEAF_PREFIX, BRANCH_PREFIX = 5, 2
TEAM = "InnovateTech DevSecOps"  # fixed value: default team of the manifest
APP_VERSION = "1.0.0-alpha"  # fixed value: default application version of the manifest


def manifest_artifacts_table(artifacts: DataFrame) -> DataFrame:
    return artifacts.select("artifact_id", "filename", "content_hash")


def inputs_hash(artifacts: DataFrame) -> DataFrame:
    """SHA-256 over the concatenation of all sorted content hashes, copies included.

    Copies are counted before the shuffle; hashes are range-sorted in parallel and packed into blocks. A plain SHA-256
    is sequential by definition, so its last step streams the packed blocks through one running digest, in constant
    memory. Use it to compare with manifests that hold this value; `inputs_hash_tree` has no sequential step and is
    the digest for very large runs.
    """
    counts = artifacts.groupBy("content_hash").agg(F.count("*").alias("copies"))
    packed = (
        counts.repartitionByRange("content_hash")
        .sortWithinPartitions("content_hash")
        .mapInArrow(_pack, "first string, block binary, copies bigint")
    )
    # One empty block, so that an empty input has the digest of empty text.
    start = artifacts.sparkSession.range(1).selectExpr("'' AS first", "CAST('' AS BINARY) AS block", "1L AS copies")
    return start.unionByName(packed).repartition(1).sortWithinPartitions("first").mapInArrow(_fold, "inputs_hash string")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of consecutive hashes; a hash with many copies stays one entry with its count."""
    names = ["first", "block", "copies"]
    for batch in batches:
        hashes, copies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        blocks, run = [], []
        for h, n in zip(hashes, copies):
            if n > HASHES_PER_BLOCK:
                if run:
                    blocks.append((run[0], "".join(run).encode(), 1))
                blocks.append((h, h.encode(), n))
                run = []
                continue
            run += [h] * n
            if len(run) >= HASHES_PER_BLOCK:
                blocks.append((run[0], "".join(run).encode(), 1))
                run = []
        if run:
            blocks.append((run[0], "".join(run).encode(), 1))
        if blocks:
            columns = list(zip(*blocks))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())], names
            )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = hashlib.sha256()
    for batch in batches:
        for block, copies in zip(batch.column(1), batch.column(2)):
            text, left = block.as_py(), copies.as_py()
            while left > 0:
                step = min(left, HASHES_PER_BLOCK)
                digest.update(text * step)
                left -= step
    yield pa.RecordBatch.from_arrays([pa.array([digest.hexdigest()], pa.string())], ["inputs_hash"])


def digest_tree(digests: DataFrame, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Root of a three-level tree over a column of row digests named `digest` (lower-case hex), as a multiset; one row,
    or one row per group of `keys`.

    Equal digests of a batch collapse to one row with their count before the shuffle. Digests travel once, as bytes, to
    the leaf that their prefix names; counts and leaves are made there. The prefix fan-outs are fixed (16^5 leaves, 16^2
    branches, one root), so no group grows beyond N / 16^5 distinct digests.
    """
    joined = F.sha2(F.array_join(F.sort_array(F.collect_list("entry")), ""), 256)

    def level(df: DataFrame, prefix: int | None, out: str) -> DataFrame:
        parts = [] if prefix is None else [F.substring("entry", 1, prefix).alias("prefix")]
        return df.groupBy(*keys, *parts).agg(joined.alias(out))

    def entries(df: DataFrame, left: str, right: str) -> DataFrame:
        return df.select(*keys, F.concat_ws(":", left, F.col(right).cast("string")).alias("entry"))

    packed = digests.select(*keys, F.unhex("digest").alias("digest"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in packed.schema)
    text = F.lower(F.hex("digest"))
    collapsed = packed.mapInArrow(_collapsed, f"{schema}, n bigint").withColumn("leaf", F.substring(text, 1, LEAF_PREFIX))
    # Dealt by leaf, the rows need no further shuffle for the counts of their digests.
    counted = collapsed.repartition(*keys, "leaf").groupBy(*keys, "leaf", "digest").agg(F.sum("n").cast("string").alias("n"))
    entry = counted.select(*keys, "leaf", F.concat_ws(":", text, "n").alias("entry"))
    prefix = F.coalesce("leaf", F.substring(F.min("entry"), 1, LEAF_PREFIX))  # null digests have one entry, their count
    leaves = entry.groupBy(*keys, "leaf").agg(prefix.alias("prefix"), joined.alias("digests"))
    leaves = leaves.select(*keys, "prefix", F.col("digests").alias("leaf"))
    branches = level(entries(leaves, "prefix", "leaf"), BRANCH_PREFIX, "branch")
    return level(entries(branches, "prefix", "branch"), None, name)


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's different rows, with their count behind them."""
    for batch in batches:
        names = batch.schema.names
        counts = pa.Table.from_batches([batch]).group_by(names).aggregate([([], "count_all")]).select([*names, "count_all"])
        yield from counts.rename_columns([*names, "n"]).to_batches()


def digest_entries(digests: DataFrame) -> DataFrame:
    """The lowest entries of a digest tree: `digest:count`, one per distinct digest."""
    counted = digests.groupBy("digest").agg(F.count("*").cast("string").alias("n"))
    return counted.select(F.concat_ws(":", "digest", "n").alias("entry"))


def inputs_hash_tree(artifacts: DataFrame) -> DataFrame:
    """Parallel digest of the content hashes as a multiset; a different value from `inputs_hash` by construction."""
    return digest_tree(artifacts.select(F.col("content_hash").alias("digest")), "inputs_hash_tree")


def dataset_digest(df: DataFrame, columns: Sequence[str], name: str = "dataset_hash") -> DataFrame:
    return digest_tree(df.select(row_digest(columns).alias("digest")), name)


def outputs_hash(reports: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Hash of the report digests in the given order (findings, dependencies, gate plan, summary); one tree pass
    serves all reports."""
    rows = None
    for n, (df, columns) in enumerate(reports):
        part = df.select(F.lit(n).alias("report"), row_digest(columns).alias("digest"))
        rows = part if rows is None else rows.unionByName(part)
    roots = digest_tree(rows, "root", ["report"])
    empty = F.sha2(F.lit("").cast("binary"), 256)
    chain = [F.coalesce(F.max(F.when(F.col("report") == n, F.col("root"))), empty) for n in range(len(reports))]
    return roots.agg(F.sha2(F.concat(*chain), 256).alias("outputs_hash"))


def manifest_header(*digests: DataFrame, team: str = TEAM, app_version: str = APP_VERSION) -> DataFrame:
    """One manifest row over one-row digest tables (`inputs_hash_tree`, `outputs_hash`; a missing one is null). The
    plain `inputs_hash` is no part of it, since one task would have to read every hash. The run id follows from the digests, so a rerun over equal data names the same run.

    `parser_version` records the Python grammar the syntax-tree scan used.
    """
    names = ("inputs_hash_tree", "outputs_hash")
    rows = None
    for digest in digests:
        row = digest.selectExpr(*[c if c in digest.columns else f"CAST(NULL AS STRING) AS {c}" for c in names])
        rows = row if rows is None else rows.unionByName(row)
    merged = rows.agg(*[F.max(c).alias(c) for c in names])
    return merged.select(
        F.sha2(F.concat_ws("", *names), 256).alias("run_id"),
        F.current_timestamp().alias("generated_at"),
        F.lit(team).alias("team_or_user"),
        F.lit(app_version).alias("app_version"),
        *names,
        F.lit(f"{sys.version_info.major}.{sys.version_info.minor}").alias("parser_version"),
        F.lit(__version__).alias("engine_version"),
    )
