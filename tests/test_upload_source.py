"""The registered source of uploads: partitions, errors, streams and writing."""

import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from auditmill.sources import upload_source as us
from auditmill.sources.files import read_any, read_rows


def put(path, body):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(body)


def zipped(members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, body in members:
            archive.writestr(name, body)
    return buffer.getvalue()


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def inbox(tmp_path):
    put(tmp_path / "in" / "a.py", "x = 'é'\r\n".encode())
    put(tmp_path / "in" / "sub" / "_private" / "__init__.py", b"")
    put(tmp_path / "in" / "bad.json", b"\xff")
    put(tmp_path / "in" / "note.md", b"ignored")
    put(tmp_path / "in" / "broken.zip", b"PK nothing")
    put(tmp_path / "in" / "many.zip", zipped([(f"d{n % 3}/f{n}.py", f"n = {n}\r\n" * (n + 1)) for n in range(60)]))
    return tmp_path / "in"


def test_equals_the_other_reader(spark, inbox):
    assert rows_of(us.read_source(spark, str(inbox))) == rows_of(read_rows(spark, str(inbox)))
    assert us.read_source(spark, str(inbox), suffixes=".md").count() == 1


def test_an_archive_is_many_partitions(spark, inbox):
    whole = us.read_source(spark, str(inbox))
    sliced = us.read_source(spark, str(inbox), part_bytes="400")
    assert rows_of(sliced) == rows_of(whole)
    assert sliced.rdd.getNumPartitions() > 8 > whole.rdd.getNumPartitions()
    sizes = [r.n for r in sliced.where("path LIKE '%many.zip!%'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 60 and max(sizes) < 30


def test_files_and_archives_round_trip(spark, tmp_path):
    texts = [(f"p{n % 4}/f{n}.py", f"text {n} é\n" * n) for n in range(40)] + [("../up.txt", "up"), ("/abs.py", "")]
    df = spark.createDataFrame(texts, "filename string, content string").repartition(5)
    us.write_files(df, str(tmp_path / "files"))
    us.write_files(df, str(tmp_path / "zips"), archives=True)
    bases = {name.rsplit("/", 1)[-1]: body for name, body in texts}
    safe = {name.removeprefix("../").removeprefix("/"): body for name, body in texts}
    assert {r.filename: r.content for r in us.read_source(spark, str(tmp_path / "files")).collect()} == bases
    assert {r.filename: r.content for r in us.read_source(spark, str(tmp_path / "zips")).collect()} == safe
    assert {p.suffix for p in (tmp_path / "zips").iterdir()} == {".zip"} and len(list((tmp_path / "zips").iterdir())) == 5
    assert {r.filename: r.content for r in read_any(spark, str(tmp_path / "zips"))[0].collect()} == safe
    us.write_files(df.limit(3), str(tmp_path / "zips"), archives=True, mode="overwrite")
    assert us.read_source(spark, str(tmp_path / "zips")).count() == 3
    us.write_files(spark.createDataFrame([("late.py", "x")], "filename string, content string"), str(tmp_path / "files"))
    assert us.read_source(spark, str(tmp_path / "files")).count() == len(bases) + 1
    assert not [p for p in tmp_path.iterdir() if "staging" in p.name]


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows = [(f"f{n}.py", None if n == 150 else "x") for n in range(200)]
    df = spark.createDataFrame(rows, "filename string, content string").repartition(4)
    with pytest.raises(Exception, match="required"):
        us.write_files(df, str(tmp_path / "files"))
    assert list(tmp_path.iterdir()) == []
    with pytest.raises(Exception, match="filename and content"):
        df.withColumn("more", F.lit(1)).write.format(us.FORMAT).mode("append").save(str(tmp_path / "files"))


def test_a_stream_reads_every_arrival_once(spark, tmp_path):
    inbox, log, out, checkpoint = (str(tmp_path / n) for n in ("in", "log", "out", "checkpoint"))
    us.register(spark)

    def drain():
        arriving = us.with_artifact_seq(spark.readStream.format(us.FORMAT).option("log", log).load(inbox))
        arriving.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.filename for r in spark.read.parquet(out).collect())

    put(tmp_path / "in" / "a.py", b"1")
    put(tmp_path / "in" / "one.zip", zipped([("m/x.py", "2"), ("m/y.py", "3")]))
    assert drain() == ["a.py", "m/x.py", "m/y.py"]
    assert drain() == ["a.py", "m/x.py", "m/y.py"]
    put(tmp_path / "in" / "two.zip", zipped([("z.py", "4")]))
    put(tmp_path / "in" / "b.py", b"\xff")
    assert drain() == ["a.py", "b.py", "m/x.py", "m/y.py", "z.py"]
    assert sorted(p.name for p in (tmp_path / "log").iterdir()) == ["1.json", "2.json"]
    seen = {hashlib.sha256((r.content or "").encode()).hexdigest() for r in spark.read.parquet(out).collect()}
    assert len(seen) == 5


def test_options_are_checked(spark, tmp_path):
    us.register(spark)
    with pytest.raises(Exception, match="log"):
        spark.readStream.format(us.FORMAT).load(str(tmp_path)).writeStream.format("noop").option(
            "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert us.read_source(spark, str(tmp_path / "missing")).count() == 0
