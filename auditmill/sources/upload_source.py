"""Uploads as a registered data source: `spark.read.format("auditmill_uploads")`, its stream of arrivals, and its writer.

Reading: a partition is a share of the single files, or a slice of the members of one archive, so a big archive is many
partitions. Planning lists names and sizes only, in one process, as Spark does for its own files; `files.read_rows` lists
by a Spark job and suits folders of very many files. Streaming: offsets count the entries of a log, each of which names
the files that were new; a replayed batch reads the files its entry names. Writing: tasks write below a staging folder
beside the target, and what they report is moved into place at the end, so a lost task or a failed job leaves nothing.
"""

from __future__ import annotations

import json
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from auditmill.sources.files import ARCHIVE_SUFFIX, UPLOAD_SUFFIXES, batches_of, contents_of, member_names, safe_name

FORMAT = "auditmill_uploads"
SCHEMA = "path string, member string, filename string, content string, error_class string, message string"
#: Bytes and files that one partition reads, and bytes of text that one written archive holds.
PART_BYTES, PART_FILES = 64 << 20, 1000


def register(spark: SparkSession) -> None:
    spark.dataSource.register(UploadSource)


def read_source(spark: SparkSession, location: str, **options: str) -> DataFrame:
    """The rows of `files.read_rows`, through the registered source."""
    register(spark)
    return with_artifact_seq(spark.read.format(FORMAT).options(**options).load(location))


def with_artifact_seq(rows: DataFrame) -> DataFrame:
    """Source rows, batch or stream, as `read_rows` names them: a digest of the full path keeps equal files apart."""
    seq = F.when(F.col("member").isNull(), F.xxhash64("path")).otherwise(F.xxhash64("path", "filename"))
    place = F.concat_ws("!", "path", "member")
    return rows.select(seq.alias("artifact_seq"), "filename", "content", place.alias("path"), "error_class", "message")


def write_files(rows: DataFrame, location: str, *, archives: bool = False, mode: str = "append") -> None:
    """Rows (filename, content) as single files, or as members of zip archives of about `PART_BYTES` of text. Filenames are
    relative paths and have to be unique."""
    register(rows.sparkSession)
    chosen = rows.select("filename", F.col("content").cast("string").alias("content"))
    chosen.write.format(FORMAT).option("archives", str(archives).lower()).mode(mode).save(location)


class UploadSource(DataSource):
    """Options: `path`; `suffixes` (comma-separated); `part_bytes`; for streams `log`, a folder of their own; for writing
    `archives`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return UploadReader(self._places())

    def streamReader(self, schema) -> DataSourceStreamReader:
        if "log" not in self.options:
            raise ValueError("a stream of uploads needs the option log: a folder that keeps the names of what has arrived")
        return ArrivalReader(self._places(), _uri(self.options["log"]))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if set(schema.fieldNames()) != {"filename", "content"}:
            raise ValueError("uploads are written from the columns filename and content")
        return UploadWriter(_uri(self._path()), self.options.get("archives", "false") == "true", overwrite)

    def _path(self) -> str:
        if "path" not in self.options:
            raise ValueError("uploads need a path")
        return self.options["path"]

    def _places(self) -> Places:
        suffixes = self.options.get("suffixes")
        wanted = tuple(s.strip() for s in suffixes.split(",")) if suffixes else (*UPLOAD_SUFFIXES, ARCHIVE_SUFFIX)
        return Places(_uri(self._path()), wanted, int(self.options.get("part_bytes", PART_BYTES)))


def _uri(path: str) -> str:
    return re.sub("^s3a:", "s3:", path)


@dataclass
class Files(InputPartition):
    """Single files."""

    paths: tuple[str, ...]


@dataclass
class Slice(InputPartition):
    """The `at`-th of `of` slices of an archive's members, by their place among its compressed bytes."""

    path: str
    at: int
    of: int


@dataclass
class Places:
    """Where uploads lie and how they are dealt to partitions."""

    uri: str
    suffixes: tuple[str, ...]
    part_bytes: int

    def listed(self) -> list[tuple[str, int]]:
        """(path, size) of the files, in the order of their paths."""
        system, base = fs.FileSystem.from_uri(self.uri)
        infos = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        return sorted((i.path, i.size) for i in infos if i.type == fs.FileType.File and i.path.endswith(self.suffixes))

    def dealt(self, files: Sequence[tuple[str, int]]) -> list[InputPartition]:
        parts, held, size = [], [], 0
        for path, n_bytes in files:
            if path.endswith(ARCHIVE_SUFFIX):
                slices = max(1, -(-n_bytes // self.part_bytes))
                parts += [Slice(path, i, slices) for i in range(slices)]
                continue
            held.append(path)
            size += n_bytes
            if size >= self.part_bytes or len(held) >= PART_FILES:
                parts.append(Files(tuple(held)))
                held, size = [], 0
        return [*parts, Files(tuple(held))] if held else parts

    def rows(self, part: InputPartition) -> Iterator[tuple]:
        contents = contents_of(self.uri)
        if isinstance(part, Files):
            for path in part.paths:
                yield from contents(path, None, None, None)
            return
        system, _ = fs.FileSystem.from_uri(self.uri)
        try:
            members = member_names(system, part.path)
        except (zipfile.BadZipFile, pa.ArrowInvalid) as e:
            if part.at == 0:
                yield part.path, None, part.path.rsplit("/", 1)[-1], None, "BadZipFile", str(e)
            return
        total, before = sum(size for _, size in members) or 1, 0
        for name, size in members:
            if before * part.of // total == part.at:
                yield from contents(part.path, name, None, None)
            before += size

    def batches(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        yield from batches_of(self.rows(part), SCHEMA)


class UploadReader(DataSourceReader):
    def __init__(self, places: Places):
        self.places = places

    def partitions(self) -> list[InputPartition]:
        return self.places.dealt(self.places.listed()) or [Files(())]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.places.batches(partition)


class ArrivalReader(DataSourceStreamReader):
    """Offset n: the first n entries of the log. Files have to be moved into place whole, and are read once."""

    def __init__(self, places: Places, log: str):
        self.places, self.log = places, log
        self.seen: set[str] | None = None
        self.entries = 0

    def _load(self) -> None:
        if self.seen is None:
            self.seen = set()
            while (entry := self._entry(self.entries + 1)) is not None:
                self.seen.update(path for path, _ in entry)
                self.entries += 1

    def _entry(self, n: int) -> list[tuple[str, int]] | None:
        system, base = fs.FileSystem.from_uri(self.log)
        try:
            with system.open_input_file(f"{base}/{n}.json") as handle:
                return [tuple(x) for x in json.loads(handle.read())]
        except FileNotFoundError:
            return None

    def _note(self, files: list[tuple[str, int]]) -> None:
        """The entry appears whole or not at all: it is written under another name and moved."""
        system, base = fs.FileSystem.from_uri(self.log)
        system.create_dir(base, recursive=True)
        draft = f"{base}/{uuid.uuid4().hex}.draft"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(files).encode())
        system.move(draft, f"{base}/{self.entries + 1}.json")
        self.entries += 1
        self.seen.update(path for path, _ in files)

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        self._load()
        new = [(path, size) for path, size in self.places.listed() if path not in self.seen]
        if new:
            self._note(new)
        return {"entries": self.entries}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files = [f for n in range(start["entries"] + 1, end["entries"] + 1) for f in self._entry(n) or ()]
        return self.places.dealt(files) or [Files(())]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        return self.places.batches(partition)

    def commit(self, end: dict) -> None:
        """Nothing to give up: the log is what tells files that have been read."""


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class UploadWriter(DataSourceArrowWriter):
    def __init__(self, target: str, archives: bool, overwrite: bool):
        self.target, self.archives, self.overwrite = target.rstrip("/"), archives, overwrite
        self.stage = f"{self.target}.staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = fs.FileSystem.from_uri(self.stage)
        rows = self._named(iterator)
        return Written(tuple(self._zipped(system, base, rows) if self.archives else self._single(system, base, rows)))

    @staticmethod
    def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            for name, content in zip(batch.column("filename"), batch.column("content").cast(pa.binary())):
                if not name.is_valid or not content.is_valid:
                    raise ValueError("filename and content are required")
                yield safe_name(name.as_py()), content.as_py()

    @staticmethod
    def _single(system: fs.FileSystem, base: str, rows: Iterator[tuple[str, bytes]]) -> Iterator[str]:
        made = set()
        for name, content in rows:
            path = f"{base}/{name}"
            folder = path.rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            with system.open_output_stream(path) as out:
                out.write(content)
            yield name

    @staticmethod
    def _zipped(system: fs.FileSystem, base: str, rows: Iterator[tuple[str, bytes]]) -> Iterator[str]:
        """Archives under names of this attempt's own, so that a second attempt never meets a half-written one."""
        system.create_dir(base, recursive=True)
        row = next(rows, None)
        while row is not None:
            name, size = f"{uuid.uuid4().hex}{ARCHIVE_SUFFIX}", 0
            with system.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                while row is not None and size < PART_BYTES:
                    archive.writestr(*row)
                    size += len(row[1])
                    row = next(rows, None)
            yield name

    def commit(self, messages: list[Written | None]) -> None:
        system, base = fs.FileSystem.from_uri(self.stage)
        _, target = fs.FileSystem.from_uri(self.target)
        names = {name for m in messages if m for name in m.names}
        listed = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        for info in listed:  # of attempts that did not count
            if info.type == fs.FileType.File and info.path[len(base) + 1 :] not in names:
                system.delete_file(info.path)
        there = system.get_file_info(target).type != fs.FileType.NotFound
        if there and self.overwrite:
            system.delete_dir(target)
            there = False
        if not there and names:
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            system.move(base, target)
            return
        system.create_dir(target, recursive=True)
        for name in sorted(names):
            system.create_dir(f"{target}/{name}".rsplit("/", 1)[0], recursive=True)
            system.move(f"{base}/{name}", f"{target}/{name}")
        self.abort(messages)

    def abort(self, messages) -> None:
        system, base = fs.FileSystem.from_uri(self.stage)
        if system.get_file_info(base).type != fs.FileType.NotFound:
            system.delete_dir(base)
