"""Artifacts from any DataFrame of `(filename, content)`: hashing, defaults, tags, manifest sniffing, routing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from auditmill.functions.text import FIELD_SEP, java_pattern, split_lines, strip
from auditmill.schemas import ARTIFACT

# Fixed values.
SNIPPET_NAME = "snippet.py"
MANIFEST_NAME = "requirements.txt"
MANIFEST_LINE = r"^[a-zA-Z0-9_\-\.]+\s*[<>=!~]+"
MANIFEST_SUFFIXES = (".txt", ".toml", ".json")
SAMPLE_TAGS = (("app_with_secrets.py", "COPILOT"), ("data_processor.py", "CLAUDE"))
MANIFEST_TAG = "UNKNOWN_DEPENDENCY_FILE"

COPY_SALTS = 64
COPIES_PER_BLOCK = 4096


def has_suffix(filename: Column, suffixes=MANIFEST_SUFFIXES) -> Column:
    return reduce(Column.__or__, [filename.endswith(s) for s in suffixes])


def language_by_extension(filename: Column) -> Column:
    return (
        F.when(filename.endswith(".py"), "python")
        .when(filename.endswith(".txt"), "text")
        .when(filename.endswith(".toml"), "toml")
        .otherwise("unknown")
    )


def sample_source_tag(filename: Column) -> Column:
    tag = F.when(has_suffix(filename), MANIFEST_TAG)
    for part, name in SAMPLE_TAGS:
        tag = tag.when(filename.contains(part), name)
    return tag.otherwise("UNKNOWN")


def artifacts_from(
    rows: DataFrame, *, source: str | None = None, variant: str = "core", extra: Sequence[str] = ()
) -> DataFrame:
    """Artifact table from rows with `content` and, optionally, filename, source, language, artifact_seq and created_at.

    Ids are digests, so a retried task yields the same ids. `artifact_seq` tells equal rows apart (the file sources set
    it, and it keeps the table narrow). Without it equal rows are counted and numbered, which shuffles each distinct
    content; a stream has to bring it. Rows with null content violate the model; route them with `split_invalid` first.
    `source` tags every row of the run. `extra` columns of the rows travel along behind the artifact's.
    """
    have = set(rows.columns)

    def given(name: str, kind: str, default: str) -> str:
        return f"{f'coalesce(CAST({name} AS {kind}), {default})' if name in have else default} AS {name}"

    if source is not None:
        rows, have = rows.withColumn("source", F.lit(source)), have | {"source"}
    columns = [
        given("filename", "STRING", f"'{SNIPPET_NAME}'"),
        given("source", "STRING", "'UNKNOWN'"),
        given("created_at", "TIMESTAMP", "current_timestamp()"),
        given("language", "STRING", "'python'"),
        "content",
        # Declared non-null, so that joins and groupings on digests add no null test that would hash contents again.
        "coalesce(sha2(content, 256), '') AS content_hash",
        *extra,
    ]
    identity = ["filename", "source", "content_hash", "artifact_seq"]
    if "artifact_seq" in have:
        base = rows.selectExpr(given("artifact_seq", "BIGINT", "0L"), *columns)
    elif rows.isStreaming:
        raise ValueError("a stream of artifacts needs artifact_seq: equal rows cannot be counted over all of it")
    else:
        # Rows that differ in a given time or language only are no copies of each other.
        told = {"created_at": "CAST(unix_micros(CAST(created_at AS TIMESTAMP)) AS STRING)", "language": "language"}
        marks = [f"coalesce({told[c]}, '') AS _{c}" for c in told if c in have]
        base = _numbered(rows.selectExpr(*columns, *marks))
        identity += [f"_{c}" for c in told if c in have]
    if variant == "doc":
        base = base.withColumn("language", language_by_extension(F.col("filename")))
    digest = F.coalesce(F.sha2(F.concat_ws(FIELD_SEP, *identity), 256), F.lit(""))
    return base.withColumn("artifact_id", digest).select(*ARTIFACT.fieldNames(), *extra)


def _numbered(rows: DataFrame) -> DataFrame:
    """Equal rows numbered from 0 by `artifact_seq`; equal rows are interchangeable, so any order gives the same table.

    Copies travel as counts, first per salt, so a hot row meets as at most `COPY_SALTS` rows in one task. Its copies
    are written out again in blocks that spread over tasks.
    """
    keys = rows.columns
    salted = rows.withColumn("salt", F.spark_partition_id() % COPY_SALTS).groupBy(*keys, "salt").agg(F.count("*").alias("n"))
    copies = salted.groupBy(*keys).agg(F.sum("n").alias("n"))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES_PER_BLOCK).cast("bigint")))
    blocks = copies.select(*keys, "n", starts.alias("start")).repartition("content_hash", "start")
    last = F.least(F.col("n"), F.col("start") + COPIES_PER_BLOCK) - 1
    return blocks.select(*keys, F.explode(F.sequence("start", last)).alias("artifact_seq"))


def split_invalid(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantine rows): content is mandatory."""
    name = F.col("filename") if "filename" in rows.columns else F.lit(None).cast("string")
    bad = rows.where(F.col("content").isNull()).select(
        name.alias("path"), F.lit("ingest").alias("stage"), F.lit("NullContent").alias("error_class"),
        F.lit("content is required").alias("message"),
    )
    return rows.where(F.col("content").isNotNull()), bad


def looks_like_manifest(content: Column) -> Column:
    """More than half of the stripped lines, blanks and comments aside, open with `name operator`.

    One pass over the lines: an entry votes for, another line against; a positive sum is a majority. Stripping every
    line makes stripping the whole text first needless.
    """

    def vote(line: Column) -> Column:
        text = strip(line)
        return (
            F.when((text == "") | text.startswith("#"), 0).when(text.rlike(java_pattern(MANIFEST_LINE)), 1).otherwise(-1)
        )

    return F.aggregate(split_lines(content), F.lit(0), lambda total, line: total + vote(line)) > 0


def sniffed_name(content: Column) -> Column:
    return F.when(looks_like_manifest(content), MANIFEST_NAME).otherwise(SNIPPET_NAME)


def pasted_snippets(rows: DataFrame) -> DataFrame:
    """Pasted text gets a filename by sniffing; the content stays as pasted. Empty text makes no artifact."""
    return rows.where(F.col("content") != "").withColumn("filename", sniffed_name(F.col("content")))


CODE_ROUTE, MANIFEST_ROUTE, NO_ROUTE, QUARANTINE = "code_scan", "dependency_scan", "none", "quarantine"
UNUSABLE = ("path", "error_class", "message")


def route() -> Column:
    """Which scan an artifact goes to: manifests by suffix, then everything whose language is python."""
    return (
        F.when(has_suffix(F.col("filename")), MANIFEST_ROUTE)
        .when(F.col("language") == "python", CODE_ROUTE)
        .otherwise(NO_ROUTE)
    )


def code_artifacts(artifacts: DataFrame) -> DataFrame:
    if "route" in artifacts.columns:
        return artifacts.where(F.col("route") == CODE_ROUTE)
    return artifacts.where((F.col("language") == "python") & ~has_suffix(F.col("filename")))


def manifest_artifacts(artifacts: DataFrame) -> DataFrame:
    if "route" in artifacts.columns:
        return artifacts.where(F.col("route") == MANIFEST_ROUTE)
    return artifacts.where(has_suffix(F.col("filename")))


def store_artifacts(artifacts: DataFrame, path: str) -> DataFrame:
    """Write the artifact table partitioned by route and read it back.

    Scans then open only their own route's files, and everything that needs ids or hashes but no content (joins by
    content hash, inventory, manifest, scores) reads only those columns.
    """
    artifacts.withColumn("route", route()).write.partitionBy("route").parquet(path)
    return read_artifacts(artifacts.sparkSession, path)


def read_artifacts(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*ARTIFACT.fields, T.StructField("route", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def store_ingest(rows: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(artifacts, quarantine) from artifact rows with the `UNUSABLE` columns, written in one pass: a row with an
    `error_class` goes to a route of its own, which no scan opens."""
    routes = F.when(F.col("error_class").isNotNull(), QUARANTINE).otherwise(route())
    rows.withColumn("route", routes).write.partitionBy("route").parquet(path)
    return split_ingest(stored_ingest(rows.sparkSession, path))


def stored_ingest(spark: SparkSession, path: str) -> DataFrame:
    """The table that `store_ingest` has written, unusable rows included."""
    kept = [*ARTIFACT.fields, *[T.StructField(c, T.StringType()) for c in (*UNUSABLE, "route")]]
    return spark.read.schema(T.StructType(kept)).parquet(path)


def split_ingest(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(artifacts, quarantine) of a stored ingest."""
    bad = table.where(F.col("route") == QUARANTINE).select("path", F.lit("ingest").alias("stage"), "error_class", "message")
    return table.where(F.col("route") != QUARANTINE).drop(*UNUSABLE), bad


def inventory(artifacts: DataFrame, *, legacy: bool = False) -> DataFrame:
    """Display table; the legacy form shows a shorter hash and no language."""
    preview = F.concat(F.substring("content_hash", 1, 10 if legacy else 16), F.lit("..."))
    columns = [F.col("filename"), F.col("source")] + ([] if legacy else [F.col("language")])
    return artifacts.select(
        *columns, preview.alias("hash_preview"), F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created")
    )
