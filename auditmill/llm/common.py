"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.plans.storage import new_path

#: The white space of every contract here: space, and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: A word, as a Java and Python pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Written to the cluster's shared folder and read again: later jobs neither recompute it nor depend on executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by `saved` that every reader has already turned into stored tables of their own."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._saved_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bounds what one Arrow batch of whole texts takes in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def fresh(columns: Iterable[str], base: str) -> str:
    """`base`, or `base` with underscores until no column (names compare without case) has that name."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
