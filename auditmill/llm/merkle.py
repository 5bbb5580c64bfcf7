"""Merkle manifest of documents: a persistent ternary tree whose versions copy only the path to a tampered leaf.

Every document is a leaf: a digest of its columns. The leaves of a source, by ascending doc_id, form a tree in which runs
of three nodes become their digest; the sources' roots form one tree above them. Trees are cut into aligned blocks of
`BLOCK` leaves, `BLOCK_LEVELS` levels high. A block is one row, built in one task; the roots of a tree's blocks are the
nodes of the next round, until each tree has one node, and the trees' roots go through the same rounds. A source with
most of the documents is therefore many rows, and rounds grow with the logarithm of the leaves.

A tampered leaf starts a version: the nodes above it inside its block are copied, with the change; all others are shared
with the first version. Above the block the version goes on along the upper path, which the downward rounds hand to each
block. Proofs are the runs' other nodes along that whole path.

Defined results: nulls in any column count as `-` in the leaf; a null doc_id sorts first and is drawn as the empty text;
rows with equal doc_id are ordered by their leaves, and equal rows are leaves of their own; a null source is a source of
its own, before the others; a null or empty text, or one without a line feed, stays as it is when tampered with; an empty
table has no rows and no root; columns beyond those of the leaf are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.llm.common import remainder, saved
from auditmill.operators.positions import with_positions

#: The columns that make a leaf, in their order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
RUN, BLOCK_LEVELS = 3, 7
BLOCK = RUN**BLOCK_LEVELS
DIGEST = 32
ROWS_PER_BATCH = 1024

_NODE_SQL = "key string, position bigint, total bigint, node binary"
_PATH_SQL = "key string, position bigint, path binary, subroot binary"
_NODE = pa.schema([("key", pa.string()), ("position", pa.int64()), ("total", pa.int64()), ("node", pa.binary())])
_PATH = pa.schema([("key", pa.string()), ("position", pa.int64()), ("path", pa.binary()), ("subroot", pa.binary())])


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Hex SHA-256 over the columns of `LEAF`; `columns` replaces some of them."""

    def told(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*(told(columns.get(c, F.col(c))) for c in LEAF)), 256)


def parent(nodes: bytes) -> bytes:
    """The digest of a run of nodes, which it takes as hex text."""
    return hashlib.sha256(nodes.hex().encode()).digest()


class Block:
    """Some nodes of a tree and everything above them inside the block. Versions share it."""

    def __init__(self, nodes: list[bytes], whole_tree: bool):
        """A block that is not the whole tree has all its levels, however few nodes it holds."""
        self.levels = [nodes]
        while len(self.levels[-1]) > 1 if whole_tree else len(self.levels) <= BLOCK_LEVELS:
            below = self.levels[-1]
            self.levels.append([parent(b"".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> list[tuple[bytes, bytes]]:
        """Per level the nodes left and right of the i-th leaf's ancestor in its run."""
        out = []
        for level in self.levels[:-1]:
            start = i - i % RUN
            out.append((b"".join(level[start:i]), b"".join(level[i + 1 : start + RUN])))
            i //= RUN
        return out

    def copied(self, i: int, node: bytes) -> list[bytes]:
        """The nodes of a version that differs in the i-th leaf: that leaf and copies of its ancestors, up to the root."""
        out = [node]
        for left, right in self.path(i):
            out.append(parent(left + out[-1] + right))
        return out


def encoded(path: list[tuple[bytes, bytes]]) -> bytes:
    """Per level a byte each for the number of nodes left and right, then the nodes."""
    return b"".join(bytes((len(a) // DIGEST, len(b) // DIGEST)) + a + b for a, b in path)


def decoded(path: bytes) -> list[tuple[bytes, bytes]]:
    out, at = [], 0
    while at < len(path):
        middle = at + 2 + path[at] * DIGEST
        end = middle + path[at + 1] * DIGEST
        out.append((path[at + 2 : middle], path[middle:end]))
        at = end
    return out


def folded(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        node = parent(left + node + right)
    return node


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for key, block, total, nodes in zip(*batch.columns):
            total = total.as_py()
            root = Block(nodes.as_py(), total <= BLOCK).root
            rows.append((key.as_py(), block.as_py(), -(-total // BLOCK), root))
        yield _batch(rows, _NODE)


def _paths_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node's path to the root, from its block's."""
    for batch in batches:
        for key, block, total, nodes, path, subroot in zip(*batch.columns):
            key, first, path, subroot = key.as_py(), block.as_py() * BLOCK, path.as_py(), subroot.as_py()
            own = Block(nodes.as_py(), total.as_py() <= BLOCK)
            rows = [(key, first + i, encoded(own.path(i)) + path, subroot) for i in range(len(own.levels[0]))]
            for at in range(0, len(rows), ROWS_PER_BATCH):
                yield _batch(rows[at : at + ROWS_PER_BATCH], _PATH)


_VERSION_SQL = "doc_id bigint, leaf binary, changed binary, subroot binary, siblings binary, copied array<binary>, folded_root binary"
_VERSION = pa.schema([
    ("doc_id", pa.int64()), ("leaf", pa.binary()), ("changed", pa.binary()), ("subroot", pa.binary()), ("siblings", pa.binary()),
    ("copied", pa.list_(pa.binary())), ("folded_root", pa.binary()),
])


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each leaf's proof and the version that its change starts; an unchanged leaf is checked against the first version."""
    for batch in batches:
        for members, total, path, subroot in zip(*batch.columns):
            members, subroot, above = members.as_py(), subroot.as_py(), decoded(path.as_py())
            block = Block([m["node"] for m in members], total.as_py() <= BLOCK)
            upper = b"".join(a + b for a, b in above)
            top, rows = folded(block.root, above), []
            for i, m in enumerate(members):
                inner = block.path(i)
                siblings = b"".join(a + b for a, b in inner) + upper
                if m["changed"] is None:
                    root, copied = folded(m["node"], inner), []
                    end = top if root == block.root else folded(root, above)
                else:
                    copied = block.copied(i, m["changed"])
                    for left, right in above:
                        copied.append(parent(left + copied[-1] + right))
                    end = copied[-1]
                rows.append((m["doc_id"], m["node"], m["changed"], subroot, siblings, copied, end))
                if len(rows) == ROWS_PER_BATCH:
                    yield _batch(rows, _VERSION)
                    rows = []
            yield _batch(rows, _VERSION)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _blocks(nodes: DataFrame, *carry: str) -> DataFrame:
    """Stored rows (key, block, total, members) of nodes (key, position, total, node): at most `BLOCK` members, in order."""
    block = F.floor(F.col("position") / BLOCK).cast("bigint")
    members = F.array_sort(F.collect_list(F.struct("position", "node", *carry)))
    grouped = nodes.groupBy("key", block.alias("block")).agg(F.max("total").alias("total"), members.alias("members"))
    return saved(grouped, "merkle_blocks")


def _nodes_of(blocks: DataFrame) -> DataFrame:
    return blocks.select("key", "block", "total", F.transform("members", lambda m: m["node"]).alias("nodes"))


@dataclass
class Forest:
    """Trees by key: their blocks, round by round, and their roots (key, node)."""

    rounds: list[DataFrame]
    roots: DataFrame

    def paths(self, tops: DataFrame) -> DataFrame:
        """(key, position, path, subroot) for every block of the first round; `tops` (key, path, subroot) has what lies
        above each tree's root."""
        paths = tops.withColumn("position", F.lit(0).cast("bigint"))
        for blocks in reversed(self.rounds[1:]):
            paths = saved(_below(_nodes_of(blocks), paths).mapInArrow(_paths_down, _PATH_SQL), "merkle_paths")
        return paths

    def nodes(self) -> DataFrame:
        """Every block's lowest nodes: (key, level, position, node). The others follow from them."""
        parts = [
            b.select("key", F.lit(n * BLOCK_LEVELS).alias("level"), F.explode("members").alias("m")).select("key", "level", "m.position", "m.node")
            for n, b in enumerate(self.rounds)
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out


def _below(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with their own path and subroot behind their columns."""
    above = paths.select(F.col("key").alias("key_above"), "position", "path", "subroot")
    same = (F.col("key") == F.col("key_above")) & (F.col("block") == F.col("position"))
    return blocks.join(above, same).drop("key_above", "position")


def forest(nodes: DataFrame, *carry: str) -> Forest | None:
    """Builds the trees of nodes (key, position, total, node, *carry); None if there are none."""
    rounds = [_blocks(nodes, *carry)]
    most = rounds[0].agg(F.max("total")).first()[0]
    if most is None:
        return None
    while True:
        roots = _nodes_of(rounds[-1]).mapInArrow(_block_roots, _NODE_SQL)
        if most <= BLOCK:
            return Forest(rounds, saved(roots.select("key", "node"), "merkle_roots"))
        most = -(-most // BLOCK)
        rounds.append(_blocks(roots))


def leaves_of(docs: DataFrame) -> DataFrame:
    """Stored leaves (key, doc_id, node, changed): `key` orders like the source, null first, and is never null; `changed`
    is the leaf after tampering, null where nothing changes."""
    bare = leaf_digest({"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    touched = (remainder(F.col("doc_id"), 2) == 0) & F.contains(F.col("text"), F.lit("\n"))
    return saved(
        docs.select(
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.unhex(leaf_digest({})).alias("node"),
            F.when(touched, F.unhex(bare)).alias("changed"),
        ),
        "merkle_leaves",
    )


@dataclass
class Manifest:
    """The first version: the documents' trees by source, the tree above them, and its root (None without documents)."""

    sources: Forest | None
    above: Forest | None
    root: bytes | None

    def versions(self, spark) -> DataFrame:
        """Per document: doc_id, leaf, changed, subroot, siblings (all nodes of the proof, lowest first), copied (the nodes
        of the version that the tampered leaf starts, up to its root; none without a change) and folded_root."""
        if self.sources is None:
            return spark.createDataFrame([], _VERSION_SQL)
        blank = F.lit(b"")
        first = spark.range(1).select(F.lit("").alias("key"), blank.alias("path"), blank.alias("subroot"))
        # Each source's path comes from the block of sources that holds it; its own number names it.
        whole = _below(_nodes_of(self.above.rounds[0]), self.above.paths(first)).mapInArrow(_paths_down, _PATH_SQL)
        named = self.above.rounds[0].select(F.explode("members").alias("m")).select("m.position", "m.tree", F.col("m.node").alias("own"))
        tops = whole.select("position", "path").join(named, "position").select(F.col("tree").alias("key"), "path", F.col("own").alias("subroot"))
        paths = self.sources.paths(saved(tops, "merkle_tops"))
        blocks = _below(self.sources.rounds[0], paths).select("members", "total", "path", "subroot")
        return blocks.mapInArrow(_versions, _VERSION_SQL)


def manifest(docs: DataFrame) -> Manifest:
    leaves = with_positions(leaves_of(docs), ["doc_id", "node"], ["key"], total="total")
    sources = forest(leaves, "doc_id", "changed")
    if sources is None:
        return Manifest(None, None, None)
    subroots = with_positions(sources.roots, ["key"], total="total")
    above = forest(subroots.select(F.lit("").alias("key"), "position", "total", "node", F.col("key").alias("tree")), "tree")
    return Manifest(sources, above, above.roots.first()["node"])


def document_proofs(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, copied_nodes; digests as hex text."""
    tree = manifest(docs)
    text = lambda column: F.lower(F.hex(column))
    root = F.lit(tree.root).cast("binary")
    return tree.versions(docs.sparkSession).select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), text(root).alias("root"),
        F.sha2(text("siblings").cast("binary"), 256).alias("proof_sha256"), text("folded_root").alias("folded_root"),
        (F.col("folded_root") == root).alias("verified"), F.size("copied").alias("copied_nodes"),
    )
