"""Membership proofs: that an artifact's content hash is one of a run's inputs, from the siblings on its path to the root.

The tree is `evidence.digest_tree` with sixteen-fold levels, so a proof holds a few kilobytes at any number of artifacts:
one step per level, each with the entries before and behind the artifact's own. Its root is a digest of all inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.operators.evidence import digest_entries
from auditmill.plans.storage import write_once

#: Hex digits that the entries of one group have in common, level by level; the root's group has none.
PREFIXES = (6, 5, 4, 3, 2, 1, 0)
#: Levels of at most so many digits have few groups at any number of artifacts (five megabytes in all), and are sent to the
#: hashes.
SENT = 3
STEP = "struct<before: string, after: string, siblings: int>"


@dataclass(frozen=True)
class InputTree:
    """Groups (prefix, entries) of every level, lowest first, stored; and the root (one row, none without artifacts)."""

    levels: tuple[DataFrame, ...]

    @property
    def root(self) -> DataFrame:
        return self.levels[-1].select(_node(F.col("entries")).alias("root"))


def input_tree(artifacts: DataFrame) -> InputTree:
    entries, levels = digest_entries(artifacts.select(F.col("content_hash").alias("digest"))), []
    for prefix in PREFIXES:
        groups = entries.groupBy(F.substring("entry", 1, prefix).alias("prefix")).agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        levels.append(write_once(groups, f"input_tree_{prefix}"))
        entries = levels[-1].select(F.concat_ws(":", "prefix", _node(F.col("entries"))).alias("entry"))
    return InputTree(tuple(levels))


def _node(entries: Column) -> Column:
    return F.sha2(F.array_join(entries, ""), 256)


def input_proofs(tree: InputTree) -> DataFrame:
    """(content_hash, copies, steps): a proof per distinct content hash, steps from the leaf's group to the root's."""
    entries = tree.levels[0].select(F.explode("entries").alias("entry"))
    return _proven(entries.select(F.substring_index("entry", ":", 1).alias("content_hash")), tree)


def _proven(rows: DataFrame, tree: InputTree) -> DataFrame:
    """The rows with `copies` and `steps`. Rows are joined with the groups on their path and make their steps at the end, so
    a row moves once and no step ever does. The lower groups come in one piece: sixteen leaves at most and the two groups
    above them, of which there are 16^5 at most."""
    path = F.col("content_hash")
    named = [g.select(F.col("prefix").alias(f"prefix_{n}"), F.col("entries").alias(f"entries_{n}")) for n, g in enumerate(tree.levels)]
    lowest = tree.levels[0].groupBy(F.substring("prefix", 1, PREFIXES[1]).alias("prefix_1"))
    groups = lowest.agg(F.collect_list(F.struct("prefix", "entries")).alias("leaves")).join(named[1], "prefix_1")
    for n in range(2, len(PREFIXES)):
        if PREFIXES[n] > SENT:
            groups = groups.join(named[n], F.substring("prefix_1", 1, PREFIXES[n]) == F.col(f"prefix_{n}"))
    rows = rows.join(groups, F.substring(path, 1, PREFIXES[1]) == F.col("prefix_1"))
    for n in range(2, len(PREFIXES)):
        if PREFIXES[n] <= SENT:
            rows = rows.join(F.broadcast(named[n]), F.substring(path, 1, PREFIXES[n]) == F.col(f"prefix_{n}"))
    leaf = F.filter("leaves", lambda g: g["prefix"] == F.substring(path, 1, PREFIXES[0]))
    rows = rows.withColumn("entries_0", F.get(leaf, F.lit(0))["entries"])
    # An entry stands behind all that are less than its label, a hash or the prefix of the group below.
    labels = [path, *(F.substring(path, 1, length) for length in PREFIXES[:-1])]
    before = lambda n: F.filter(f"entries_{n}", lambda e: e < labels[n])
    rows = rows.withColumns({f"at_{n}": F.size(before(n)) for n in range(len(PREFIXES))})
    steps = F.array(*(_step(F.col(f"entries_{n}"), F.col(f"at_{n}")) for n in range(len(PREFIXES))))
    copies = F.substring_index(F.get("entries_0", F.col("at_0")), ":", -1).cast("bigint")
    return rows.withColumns({"copies": copies, "steps": steps}).drop(
        "leaves", *(f"{c}_{n}" for c in ("prefix", "entries", "at") for n in range(len(PREFIXES)))
    )


def _step(entries: Column, at: Column) -> Column:
    return F.struct(
        F.array_join(F.slice(entries, F.lit(1), at), "").alias("before"),
        F.array_join(F.slice(entries, at + 2, F.size(entries)), "").alias("after"),
        (F.size(entries) - 1).alias("siblings"),
    )


def proven_root(content_hash: Column, copies: Column, steps: Column) -> Column:
    """The root that a proof leads to from a hash and its number of copies."""
    lengths = F.array(*map(F.lit, PREFIXES))

    def labelled(step: Column, i: Column) -> Column:
        length = F.get(lengths, i)
        label = F.when(length > 0, F.concat(F.substring(content_hash, F.lit(1), length), F.lit(":"))).otherwise("")
        return F.struct(step["before"].alias("before"), step["after"].alias("after"), label.alias("label"))

    def climb(entry: Column, step: Column) -> Column:
        return F.concat(step["label"], F.sha2(F.concat(step["before"], entry, step["after"]), 256))

    return F.aggregate(F.transform(steps, labelled), F.concat(content_hash, F.lit(":"), copies.cast("string")), climb)


def artifact_proofs(artifacts: DataFrame) -> DataFrame:
    """(artifact_id, content_hash, copies, steps, root): a proof for every artifact, beside the root it has to lead to."""
    tree = input_tree(artifacts)
    owners = artifacts.select("artifact_id", "content_hash")
    root = tree.root.first()  # one row, none without artifacts
    return _proven(owners, tree).withColumn("root", F.lit(root and root[0]).cast("string"))
