"""Uploaded files and zip archives as distributed sources.

Spark's own file listing leaves out empty files and names that begin with `_` or `.`, so `__init__.py` would be missing
from an audit. Listing and reading therefore run as Spark jobs over Arrow filesystems (local, HDFS, S3, GCS, ABFS).
"""

from __future__ import annotations

import re
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.sources.artifacts import has_suffix

# Accepted upload extensions.
UPLOAD_SUFFIXES = (".py", ".txt", ".toml", ".json")
ARCHIVE_SUFFIX = ".zip"
SPREAD_LEVELS = 2
ROWS_PER_BATCH = 1024
BYTES_PER_BATCH = 16 << 20
MAX_BYTES = (1 << 30) - 1  # Spark holds a string in one array
_TOO_LARGE = f"larger than {MAX_BYTES} bytes"

_LISTED = "path string, folder boolean"
_PARTS = "path string, member string, error_class string, message string"
_CONTENTS = "path string, member string, filename string, content string, error_class string, message string"


def list_files(spark: SparkSession, location: str) -> DataFrame:
    """Paths of all files under `location`. The first levels are listed folder by folder and spread over tasks, the
    folders found by then recursively."""
    uri = re.sub("^s3a:", "s3:", location)

    def lister(recursive: bool):
        def contents(path: str, folder: bool) -> Iterator[tuple]:
            if not folder:
                yield path, False
                return
            system, base = fs.FileSystem.from_uri(uri)
            for info in system.get_file_info(fs.FileSelector(path or base, recursive=recursive)):
                is_folder = info.type == fs.FileType.Directory
                if not (recursive and is_folder):
                    yield info.path, is_folder

        return _rows(contents, _LISTED)

    found = spark.createDataFrame([("", True)], _LISTED)
    for _ in range(SPREAD_LEVELS):
        found = found.mapInArrow(lister(False), _LISTED).repartition("path")
    return found.mapInArrow(lister(True), _LISTED).select("path")


def read_rows(spark: SparkSession, location: str, suffixes: tuple[str, ...] = (*UPLOAD_SUFFIXES, ARCHIVE_SUFFIX)) -> DataFrame:
    """`artifact_seq, filename, content, path, error_class, message` of every file and archive member, in one pass.

    One listing and one read: rows that could not be read have an `error_class` and no content. Archives are first
    opened for their directory only; then members are spread over tasks, and each task reads its own members through
    a seekable handle, so a big archive is neither one task nor one record. Files are strict UTF-8; the filename is
    the base name, or the member's path. `artifact_seq` is a digest of the full path, which keeps equal files apart.
    """
    uri = re.sub("^s3a:", "s3:", location)
    wanted = list_files(spark, location).where(has_suffix(F.col("path"), suffixes))
    # (path, member) is unique, so the copies and members of one archive spread out as well.
    parts = wanted.repartition("path").mapInArrow(_rows(_parts(uri), _PARTS), _PARTS).repartition("path", "member")
    rows = parts.sortWithinPartitions("path").mapInArrow(_rows(contents_of(uri), _CONTENTS), _CONTENTS)
    seq = F.when(F.col("member").isNull(), F.xxhash64("path")).otherwise(F.xxhash64("path", "filename"))
    place = F.concat_ws("!", "path", "member")
    return rows.select(seq.alias("artifact_seq"), "filename", "content", place.alias("path"), "error_class", "message")


def split_read(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows `artifact_seq, filename, content`, quarantine) of `read_rows`; store its rows first where both are used."""
    bad = rows.where("error_class IS NOT NULL").select("path", F.lit("ingest").alias("stage"), "error_class", "message")
    return rows.where("error_class IS NULL").select("artifact_seq", "filename", "content"), bad


def read_uploads(spark: SparkSession, location: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of the single files."""
    return split_read(read_rows(spark, location, UPLOAD_SUFFIXES))


def read_archives(spark: SparkSession, location: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) over every member of every zip archive."""
    return split_read(read_rows(spark, location, (ARCHIVE_SUFFIX,)))


def read_any(spark: SparkSession, location: str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of single files and archive members together."""
    return split_read(read_rows(spark, location))


def safe_name(name: str) -> str:
    """Member path as extraction would place it: no drive, no leading slash, no `.` or `..` steps."""
    return "/".join(step for step in re.sub(r"^[A-Za-z]:", "", name).split("/") if step not in ("", ".", ".."))


def _member_text(raw: bytes) -> str:
    """Text-mode reading: undecodable bytes are skipped, line ends become newlines."""
    return raw.decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n")


def member_names(system: fs.FileSystem, path: str) -> list[tuple[str, int]]:
    """(name, compressed size) of an archive's members, sorted; of members with one name the last, as it overwrites the others."""
    with system.open_input_file(path) as handle, zipfile.ZipFile(handle) as archive:
        return sorted({safe_name(m.filename): m.compress_size for m in archive.infolist() if not m.is_dir()}.items())


def _parts(uri: str):
    """One row per file, or per member of an archive: the last of each name, as a later one overwrites it."""

    def parts(path: str) -> Iterator[tuple]:
        if not path.endswith(ARCHIVE_SUFFIX):
            yield path, None, None, None
            return
        system, _ = fs.FileSystem.from_uri(uri)
        try:
            names = [name for name, _ in member_names(system, path)]
        except (zipfile.BadZipFile, pa.ArrowInvalid) as e:  # Arrow: a seek before the start of a very short file
            yield path, None, "BadZipFile", str(e)
        else:
            for name in names:
                yield path, name, None, None

    return parts


def contents_of(uri: str):
    """The text of each part. Parts come sorted by path, so the members of one archive share one open handle."""
    held = {}

    def members(system: fs.FileSystem, path: str) -> tuple[zipfile.ZipFile, dict]:
        if held.get("path") != path:
            for old in held.pop("open", ()):
                old.close()
            handle = system.open_input_file(path)
            archive = zipfile.ZipFile(handle)
            latest = {safe_name(m.filename): m for m in archive.infolist() if not m.is_dir()}
            held.update(path=path, open=(archive, handle), latest=latest)
        return held["open"][0], held["latest"]

    def contents(path: str, member: str | None, error_class: str | None, message: str | None) -> Iterator[tuple]:
        name, text = member or path.rsplit("/", 1)[-1], None
        if error_class is None:
            system, _ = fs.FileSystem.from_uri(uri)
            try:
                if member is not None:
                    archive, latest = members(system, path)
                    if latest[member].file_size > MAX_BYTES:
                        raise OverflowError(_TOO_LARGE)
                    text = _member_text(archive.read(latest[member]))
                else:
                    with system.open_input_file(path) as handle:
                        if handle.size() > MAX_BYTES:
                            raise OverflowError(_TOO_LARGE)
                        text = handle.read().decode()
            except UnicodeDecodeError as e:
                error_class, message = type(e).__name__, "file is not valid UTF-8"
            except OverflowError as e:
                error_class, message = "FileTooLarge", str(e)
            except (RuntimeError, NotImplementedError, zipfile.BadZipFile, EOFError, zlib.error, pa.ArrowInvalid) as e:
                error_class, message = type(e).__name__, str(e)
        yield path, member, name, text, error_class, message

    return contents


_ARROW_TYPES = {"string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def batches_of(rows: Iterable[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded size."""
    fields = pa.schema([(name, _ARROW_TYPES[kind]) for name, kind in (f.split() for f in schema.split(", "))])
    held, size = [], 0

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), fields)], schema=fields)

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
        if len(held) >= ROWS_PER_BATCH or size >= BYTES_PER_BATCH:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _rows(expand: Callable[..., Iterable[tuple]], schema: str):
    """Arrow worker that replaces each input row by the rows `expand(*row)` yields."""

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for values in zip(*batch.columns) for row in expand(*[v.as_py() for v in values]))
        yield from batches_of(rows, schema)

    return worker
