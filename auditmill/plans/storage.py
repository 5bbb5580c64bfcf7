"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder `spark.checkpoint.dir` names; only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if found:
        return found
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="auditmill-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/auditmill/{uuid.uuid4().hex}/{label}"


def stored(df: DataFrame, label: str, *near: str) -> DataFrame:
    """Write once, read many: cuts the lineage, survives executor loss, and lets later reads prune columns.

    Scan output is small against the contents it comes from; the rebalance packs it into files of the advisory size
    (and splits hot partitions) instead of one tiny file per scan task. Rows that are equal in the columns `near` stay
    together, so that what they share is packed once.
    """
    return write_once(df.hint("rebalance", *near), label)


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Like `stored`, with the partitions as they are."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
