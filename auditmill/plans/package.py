"""A package of datasets that is written aside, sealed by a record of its digests, and put in place as one.

The record is the last dataset of a stage and the last to arrive at the target. Without it there is no package; with it,
every dataset can be read and checked from the files alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditmill.functions.text import FIELD_SEP
from auditmill.operators.evidence import digest_tree

STAGES, MANIFEST, RECORD = "_staged", "_manifest", "_manifest/datasets"
#: Rows of a file at most: a compressed text file is read by one task.
FILE_ROWS = 1_000_000
_RECORD_SCHEMA = "dataset string, format string, columns string, n_rows bigint, digest string"


@dataclass(frozen=True)
class Dataset:
    """Where a dataset lies below a package, and what its files hold."""

    name: str
    fmt: str
    schema_json: str

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schema_json))
        return spark.read.schema(schema).format(self.fmt).load(f"{root}/{self.name}")


@dataclass
class Stage:
    path: str
    datasets: list[Dataset] = field(default_factory=list)


def write_dataset(df: DataFrame, root: str, name: str, fmt: str, partition_by: Sequence[str] = ()) -> Dataset:
    """Text formats repeat names and wording in every row, so their files are compressed."""
    options = {"compression": "gzip", "maxRecordsPerFile": FILE_ROWS} if fmt in ("json", "csv") else {}
    df.write.partitionBy(*partition_by).format(fmt).options(**options).save(f"{root}/{name}")
    return Dataset(name, fmt, df.schema.json())


@contextmanager
def staged(spark: SparkSession, target: str) -> Iterator[Stage]:
    """A folder to write datasets to. On leaving, their digests are taken from the files, the record is written, and the
    package takes its place; an error leaves what was there before."""
    settle(spark, target)
    stage = Stage(f"{target}/{STAGES}/{uuid.uuid4().hex}")
    try:
        yield stage
        _seal(spark, stage)
    except BaseException:
        _Files(spark, target).delete(stage.path)
        raise
    _put_in_place(spark, stage.path, target)


def settle(spark: SparkSession, target: str) -> None:
    """Finishes what interrupted writes have left: a sealed stage is put in place, any other is deleted."""
    files = _Files(spark, target)
    for stage in files.children(f"{target}/{STAGES}"):
        if files.exists(f"{target}/{STAGES}/{stage}/{RECORD}/_SUCCESS"):
            _put_in_place(spark, f"{target}/{STAGES}/{stage}", target)
        else:
            files.delete(f"{target}/{STAGES}/{stage}")


def datasets_of(spark: SparkSession, root: str) -> list[Dataset]:
    """What the record of a package names: about ten datasets."""
    rows = spark.read.schema(_RECORD_SCHEMA).json(f"{root}/{RECORD}").collect()
    return [Dataset(r.dataset, r.format, r.columns) for r in sorted(rows, key=lambda r: r.dataset)]


def verify_package(spark: SparkSession, target: str) -> DataFrame:
    """(dataset, n_rows, digest, valid): what the record says, and whether the files still say the same. No record, no package:
    then reading it raises."""
    recorded = spark.read.schema(_RECORD_SCHEMA).json(f"{target}/{RECORD}")
    found = _digests(spark, target, datasets_of(spark, target)).withColumnsRenamed({"n_rows": "n_found", "digest": "found"})
    same = (F.col("n_rows") == F.col("n_found")) & (F.col("digest") == F.col("found"))
    return recorded.join(found, "dataset", "left").select("dataset", "n_rows", "digest", F.coalesce(same, F.lit(False)).alias("valid"))


def _digests(spark: SparkSession, root: str, datasets: Sequence[Dataset]) -> DataFrame:
    """(dataset, n_rows, digest) from the files; one tree pass serves all datasets."""
    names = spark.createDataFrame([(d.name,) for d in datasets], "dataset string")
    rows = reduce(DataFrame.unionByName, [_row_digests(d, d.read(spark, root)) for d in datasets])
    counts = rows.groupBy("dataset").agg(F.count("*").alias("n_rows"))
    joined = names.join(counts, "dataset", "left").join(digest_tree(rows, "digest", ["dataset"]), "dataset", "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return joined.select("dataset", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"), F.coalesce("digest", empty).alias("digest"))


def _row_digests(dataset: Dataset, df: DataFrame) -> DataFrame:
    """Nulls differ from empty text here, and times do not depend on the session's zone."""

    def told(f: T.StructField) -> Column:
        value = F.unix_micros(F.col(f.name)) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        if isinstance(f.dataType, T.MapType):
            value = F.array_sort(F.map_entries(value))
        return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))

    return df.select(
        F.lit(dataset.name).alias("dataset"), F.sha2(F.concat_ws(FIELD_SEP, *map(told, df.schema.fields)), 256).alias("digest")
    )


def _seal(spark: SparkSession, stage: Stage) -> None:
    columns = spark.createDataFrame([(d.name, d.fmt, d.schema_json) for d in stage.datasets], "dataset string, format string, columns string")
    record = columns.join(_digests(spark, stage.path, stage.datasets), "dataset")
    record.coalesce(1).write.json(f"{stage.path}/{RECORD}")


def _put_in_place(spark: SparkSession, stage: str, target: str) -> None:
    """Moves a sealed stage's datasets over the target's, the record last. It can be repeated from any point."""
    files = _Files(spark, target)
    names = [d.name.partition("/")[0] for d in datasets_of(spark, stage)]
    old = []
    if files.exists(f"{target}/{RECORD}/_SUCCESS"):
        old = [d.name.partition("/")[0] for d in datasets_of(spark, target)]
        files.delete(f"{target}/{MANIFEST}")
    for name in {*old} - {*names}:
        files.delete(f"{target}/{name}")
    for name in files.children(stage):
        if name != MANIFEST:
            files.move(f"{stage}/{name}", f"{target}/{name}")
    files.move(f"{stage}/{MANIFEST}", f"{target}/{MANIFEST}")
    files.delete(f"{target}/{STAGES}")


class _Files:
    """Folders of the file system that holds a path, through the driver."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._system.listStatus(self._path(path))] if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        self.delete(target)
        if not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")
