"""Hard-negative mining over an R-tree packed by sort-tile-recursive order (STR).

Vectors are packed into blocks: ranges of (label, first coordinate), each cut again by the second coordinate, both by
exact distributed row numbers. A block is one row; its task packs it further, coordinate by coordinate, into leaves of
`LEAF` vectors and the boxes above them. A box bounds every coordinate, so each coordinate's product with an anchor lies
in an interval, and the sum of these bounds every score inside the box. A search takes boxes from a queue, best upper
bound first, and leaves out boxes that lie outside the score window, hold only labels that cannot count, or end strictly
below the k-th score found so far; equal scores are looked at, since the smaller id wins.

Anchors are searched in chunks of `CHUNK`, each against the blocks it can need; a task holds one block and one batch of
chunks at a time, and passes on at most k rows per anchor (or positive) and block. Ranks are taken per anchor from there.
First the positives are found, the k best of the anchor's own label; their scores are the windows of the negatives.

Scores are exact integers: sums that may leave the range in which doubles count exactly are taken in 64-bit integers, as
Spark's own, and there no box is left out.

Defined results: rows with a null id, label or vector, or any null or non-finite component take no part; of rows with an
equal id the one with the smallest label, then vector, takes part; a shorter vector counts as if zeros followed; empty
vectors score 0; ties go to the smaller id; an anchor without another row of its label has no positives and no rows, a
positive without negatives in its window has none; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditmill.llm.common import saved
from auditmill.operators.positions import with_positions

BEST = 5
#: The window of the negatives, in hundredths of the positive's score.
LOW, HIGH = 80, 100
BLOCK_ROWS, SLAB_BLOCKS = 4096, 16
LEAF, FANOUT, CHUNK = 64, 8, 256
#: Doubles are exact integers up to here.
EXACT = 1 << 53


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """Usable rows as (vec_id, label, vector), each component x as floor(scale * x)."""
    x = F.col("embedding")
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    usable = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, finite))
    vector = F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))
    return usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), vector.alias("vector"))


# --- One block's tree -------------------------------------------------------------------------------------------------


class Tree:
    """The packed boxes of one block. Arrays of boxes run from the leaves to the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        spread = np.argsort(-np.ptp(vectors.astype(float), axis=0), kind="stable") if len(ids) else np.empty(0, int)
        leaves = tiles(vectors, np.arange(len(ids)), list(spread))
        order = np.concatenate(leaves)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        ends = np.cumsum([len(x) for x in leaves])
        self.parts = list(zip((ends - [len(x) for x in leaves]).tolist(), ends.tolist()))
        self.children: list[range] = [range(0)] * len(leaves)
        boxes = [(self.vectors[a:b].min(0), self.vectors[a:b].max(0), self.labels[a:b].min(), self.labels[a:b].max()) for a, b in self.parts]
        level = range(len(boxes))
        while len(level) > 1:
            above = len(boxes)
            for at in range(level.start, level.stop, FANOUT):
                own = range(at, min(at + FANOUT, level.stop))
                low, high, least, most = zip(*(boxes[i] for i in own))
                boxes.append((np.min(low, axis=0), np.max(high, axis=0), min(least), max(most)))
                self.children.append(own)
            level = range(above, len(boxes))
        self.low, self.high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])
        self.least, self.most = [int(b[2]) for b in boxes], [int(b[3]) for b in boxes]
        self.largest = max(abs(int(self.low.min(initial=0))), abs(int(self.high.max(initial=0))))
        self.floats = None

    def scorer(self, anchors: np.ndarray):
        """(intervals of all boxes per anchor, function from anchor and leaf to scores), in exact arithmetic."""
        dimension = min(anchors.shape[1], self.vectors.shape[1])
        q = np.zeros((len(anchors), self.vectors.shape[1]), np.int64)
        q[:, :dimension] = anchors[:, :dimension]
        most = max((abs(int(q.min(initial=0))), abs(int(q.max(initial=0)))))
        if most * self.largest * max(1, q.shape[1]) >= EXACT:
            bounds = np.full((len(q), len(self.low)), -np.inf), np.full((len(q), len(self.low)), np.inf)
            with np.errstate(over="ignore"):
                return *bounds, lambda i, a, b: (self.vectors[a:b] * q[i]).sum(1)
        if self.floats is None:
            self.floats = self.vectors.astype(float), self.low.astype(float), self.high.astype(float)
        vectors, low, high = self.floats
        q = q.astype(float)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T, lambda i, a, b: vectors[a:b] @ q[i]


def tiles(vectors: np.ndarray, rows: np.ndarray, coordinates: list[int]) -> list[np.ndarray]:
    """Sort-tile-recursive leaves of at most `LEAF` rows: slabs by the first coordinate, each tiled by the others."""
    leaves = -(-len(rows) // LEAF)
    if leaves <= 1 or not coordinates:
        return [rows[a : a + LEAF] for a in range(0, len(rows), LEAF)] or [rows]
    # No more coordinates than cut anything: with more, a slab would be everything.
    left = min(len(coordinates), max(1, (leaves - 1).bit_length()))
    slabs = max(2, int(np.ceil(leaves ** (1 / left) - 1e-9))) if left > 1 else leaves
    size = LEAF * -(-leaves // slabs)
    rows = rows[np.argsort(vectors[rows, coordinates[0]], kind="stable")]
    return [leaf for a in range(0, len(rows), size) for leaf in tiles(vectors, rows[a : a + size], coordinates[1:left])]


@dataclass
class Goal:
    """What one search looks for: the best scores within [low, high] among rows of the anchor's label, or of all others."""

    low: float
    high: float
    best: list  # heap of (score, -id), the worst first

    def wants(self, lower: float, upper: float) -> bool:
        return upper >= self.low and lower <= self.high and (len(self.best) < BEST or upper >= self.best[0][0])

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.low) & (scores <= self.high)
        if len(self.best) >= BEST:
            fits &= scores >= self.best[0][0]
        if not fits.any():
            return
        scores, ids = scores[fits], ids[fits]
        if len(scores) > BEST:
            first = np.lexsort((ids, -scores))[:BEST]
            scores, ids = scores[first], ids[first]
        for found in zip(scores.tolist(), (-ids).tolist()):
            if len(self.best) < BEST:
                heapq.heappush(self.best, found)
            else:
                heapq.heappushpop(self.best, found)


def search(tree: Tree, i: int, own_id: int, label: int, same: bool, goals: list[Goal], lower, upper, scores_of) -> None:
    """Best-first search of one block for the i-th anchor of the scorer; all goals share the queue."""

    def counts(node: int) -> bool:
        least, most = tree.least[node], tree.most[node]
        return least <= label <= most if same else not least == label == most

    lower, upper = lower[i], upper[i]
    root = len(upper) - 1
    queue = [(-upper[root], root)] if counts(root) else []
    while queue:
        bound, node = heapq.heappop(queue)
        if not any(g.wants(lower[node], -bound) for g in goals):
            continue
        children = tree.children[node]
        if children:
            for child in children:
                if counts(child) and any(g.wants(lower[child], upper[child]) for g in goals):
                    heapq.heappush(queue, (-upper[child], child))
            continue
        a, b = tree.parts[node]
        labels = tree.labels[a:b]
        takes = (labels == label) & (tree.ids[a:b] != own_id) if same else labels != label
        scores, ids = scores_of(i, a, b)[takes], tree.ids[a:b][takes]
        for goal in goals:
            goal.offer(scores, ids)


# --- Arrow ------------------------------------------------------------------------------------------------------------


def _members(value) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(ids, labels, matrix, positives) of one list of members; shorter vectors are filled up with zeros."""
    members = value.values
    ids, labels = (members.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "label"))
    vectors = members.field("vector")
    offsets = vectors.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = vectors.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return ids, labels, flat.reshape(len(sizes), width), members.field("positives")
    matrix = np.zeros((len(sizes), width), np.int64)
    at = np.repeat(np.arange(len(sizes)), sizes)
    matrix[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return ids, labels, matrix, members.field("positives")


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])
_POSITIVE_SQL = "anchor_id bigint, positive_id bigint, score bigint"
_NEGATIVE = pa.schema([
    ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64()),
])
_NEGATIVE_SQL = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def _searcher(same: bool):
    """Rows (block, chunk, members) sorted by block, each block's own row (no chunk) before its chunks of anchors."""
    schema = _POSITIVE if same else _NEGATIVE

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for chunk, value in zip(batch.column(1), batch.column(2)):
                ids, labels, vectors, positives = _members(value)
                if not chunk.is_valid:
                    tree = Tree(ids, labels, vectors)
                    continue
                bounds, rows = tree.scorer(vectors), []
                for i, (anchor, label) in enumerate(zip(ids.tolist(), labels.tolist())):
                    if same:
                        goal = Goal(-np.inf, np.inf, [])
                        search(tree, i, anchor, label, True, [goal], *bounds)
                        rows += [(anchor, -n, int(s)) for s, n in goal.best]
                        continue
                    wanted = [(p["vec_id"], p["score"]) for p in positives[i].as_py()]
                    goals = [Goal(-(-LOW * s // 100), HIGH * s // 100, []) for _, s in wanted]
                    search(tree, i, anchor, label, False, goals, *bounds)
                    rows += [(anchor, p, s, -n, int(found)) for (p, s), g in zip(wanted, goals) for found, n in g.best]
                columns = zip(*rows) if rows else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return work


def _member(positives: Column) -> Column:
    return F.struct("vec_id", "label", "vector", positives.alias("positives"))


def _no_positives() -> Column:
    return F.lit(None).cast("array<struct<vec_id: bigint, score: bigint>>")


def _searched(blocks: DataFrame, chunks: DataFrame, routes: DataFrame, same: bool, n_blocks: int) -> DataFrame:
    """Each chunk against the blocks that `routes` (chunk, block) names."""
    sent = routes.join(chunks, "chunk").select("block", "chunk", "members")
    own = blocks.select("block", F.lit(None).cast("bigint").alias("chunk"), "members")
    met = own.unionByName(sent).repartition(n_blocks, "block").sortWithinPartitions("block", "chunk")  # null first
    return met.mapInArrow(_searcher(same), _POSITIVE_SQL if same else _NEGATIVE_SQL)


def _chunked(anchors: DataFrame, positives: Column) -> DataFrame:
    """Anchors by label in chunks of at most `CHUNK`: (chunk, members)."""
    chunk = F.floor(F.col("position") / CHUNK).cast("bigint").alias("chunk")
    placed = with_positions(anchors, ["label", "vec_id"])
    return saved(placed.groupBy(chunk).agg(F.collect_list(_member(positives)).alias("members")), "anchor_chunks")


def _packed_blocks(vectors: DataFrame) -> DataFrame:
    """Stored blocks (block, members): at most `BLOCK_ROWS` vectors each, tiled by (label, first coordinate), then by the second."""
    first, second = F.get("vector", F.lit(0)), F.get("vector", F.lit(1))
    by_label = with_positions(vectors.withColumns({"x": first, "y": second}), ["label", "x", "vec_id"], name="along")
    slab = saved(by_label.withColumn("slab", F.floor(F.col("along") / (BLOCK_ROWS * SLAB_BLOCKS)).cast("bigint")), "slabs")
    tiled = with_positions(slab, ["y", "vec_id"], ["slab"], name="across")
    block = F.col("slab") * SLAB_BLOCKS + F.floor(F.col("across") / BLOCK_ROWS).cast("bigint")
    return saved(tiled.groupBy(block.alias("block")).agg(F.collect_list(_member(_no_positives())).alias("members")), "blocks")


def hard_negatives(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """For rows (vec_id, label, vector of integers): per anchor, positive and rank the negatives in the positive's window.

    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    one = F.min(F.struct("label", "vector")).alias("row")
    rows = saved(vectors.groupBy("vec_id").agg(one).select("vec_id", "row.label", "row.vector"), "vectors")
    blocks = _packed_blocks(rows)
    n_blocks = max(1, blocks.count())
    anchors = rows.where(is_anchor)
    # Positives: only blocks that share a label with the chunk.
    chunks = _chunked(anchors, _no_positives())
    labels = lambda df, key: df.select(key, F.explode(F.array_distinct(F.transform("members", lambda m: m["label"]))).alias("label"))
    routes = labels(chunks, "chunk").join(labels(blocks, "block"), "label").select("chunk", "block").distinct()
    found = _searched(blocks, chunks, routes, True, n_blocks)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    positives = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BEST)
    windows = positives.groupBy("anchor_id").agg(
        F.collect_list(F.struct(F.col("positive_id").alias("vec_id"), "score")).alias("positives")
    )
    known = saved(anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"), "anchors")
    # Negatives: the stated anchors against all blocks.
    chunks = _chunked(known, F.col("positives"))
    everywhere = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))).alias("block")
    found = _searched(blocks, chunks, chunks.select("chunk", everywhere), False, n_blocks)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= BEST)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
