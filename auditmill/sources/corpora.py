"""Artifact corpora derived by Spark from the benchmark tables (documents, events, part, conversations)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditmill.functions.scoring import SOURCE_TAGS
from auditmill.functions.text import constant
from auditmill.sources.artifacts import artifacts_from

# One derived file holds the lines of one key within one block of ids, so its size has a bound at any scale.
LINES_PER_FILE = 131072
BLOCK_STRIDE = 1 << 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_as_artifacts(documents: DataFrame) -> DataFrame:
    rows = documents.select(
        F.col("doc_id").alias("artifact_seq"),
        F.concat(F.lit("documents/"), F.col("doc_id").cast("string"), F.lit(".md")).alias("filename"),
        "source",
        F.col("text").alias("content"),
    )
    return artifacts_from(rows)


def document_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, whole text, as one artifact."""
    return documents_as_artifacts(table(spark, sf_dir, "documents"))


# The 24 line templates, by event_id modulo 24 (m = MD5 of the event id as text).
CODE_LINE = """
CASE event_id % 24
  WHEN 0 THEN concat('x', event_id, ' = ', event_id)
  WHEN 1 THEN concat('api_key = "', m, '"')
  WHEN 2 THEN concat('ACCESS = "AKIA', upper(left(m, 16)), '"')
  WHEN 3 THEN concat('password = "p@', left(m, 10), '"')
  WHEN 4 THEN 'query = f"SELECT * FROM t WHERE id = {x}"'
  WHEN 5 THEN concat('h = hashlib.md5(b"', event_id, '").hexdigest()')
  WHEN 6 THEN 'eval("x")'
  WHEN 7 THEN 'model.eval()'
  WHEN 8 THEN 'subprocess.run("ls", shell=True)'
  WHEN 9 THEN 'obj = pickle.loads(blob)'
  WHEN 10 THEN 'exec("y = 1")'
  WHEN 11 THEN 'subprocess.run(["ls"], shell=False)'
  WHEN 12 THEN 'sp.run("ls", shell=True)'
  WHEN 13 THEN 'obj = json.loads(blob)'
  WHEN 14 THEN '# eval("x") in a comment'
  WHEN 15 THEN 'password = "short"'
  WHEN 16 THEN 'token = "abc"'
  WHEN 17 THEN 'hashlib.sha256(b"x")'
  WHEN 18 THEN 'query = f"select name from t where id = {x}"'
  WHEN 19 THEN 'query = "SELECT * FROM t WHERE id = %s"'
  WHEN 20 THEN concat('pwd = "', m, '"')
  WHEN 21 THEN concat('password = "', m, '"')
  WHEN 22 THEN 'f = eval'
  WHEN 23 THEN 'g = builtins.eval'
END
"""


def _joined_lines(position: str) -> Column:
    """Lines of one bounded group, ordered, as one text."""
    ordered = F.sort_array(F.collect_list(F.struct(position, "line")))
    return F.array_join(F.transform(ordered, lambda s: s["line"]), "\n")


def code_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Python file per user and id block, one line per event; every 17th user's files do not parse."""
    files = (
        table(spark, sf_dir, "events")
        .withColumn("m", F.md5(F.col("event_id").cast("string")))
        .selectExpr("user_id", "event_id", "ts", f"event_id DIV {LINES_PER_FILE} AS block", f"{CODE_LINE} AS line")
        .groupBy("user_id", "block")
        .agg(_joined_lines("event_id").alias("body"), F.min("ts").alias("created_at"))
    )
    user = F.col("user_id").cast("string")
    suffix = F.when(F.col("block") == 0, "").otherwise(F.concat(F.lit("_"), F.col("block").cast("string")))
    tags = constant(list(SOURCE_TAGS), "array<string>")
    rows = files.select(
        (F.col("block") * BLOCK_STRIDE + F.col("user_id")).alias("artifact_seq"),
        F.concat(F.lit("u"), user, suffix, F.lit(".py")).alias("filename"),
        F.get(tags, (F.col("user_id") % 4).cast("int")).alias("source"),
        "created_at",
        F.when(F.col("user_id") % 17 == 0, F.concat("body", F.lit("\ndef broken(:"))).otherwise(F.col("body")).alias("content"),
    )
    return artifacts_from(rows)


# Whole files by o_orderkey modulo 4, with nested blocks, calls over several lines and two sinks on one line.
NESTED_FILES = (
    """import pickle

class Job:
    def run(self, blob):
        if blob:
            return pickle.loads(blob)
        return eval(
            "1 + 1"
        )
""",
    """x = eval("1"); y = exec("2")
""",
    """def go():
    for i in range(3):
        subprocess.run(
            ["ls"],
            shell=True,
        )
    return lambda: builtins.eval(exec("z"))
""",
    """def ok():
    return json.loads("{}")
""",
)


def nested_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Python file per order; a closing comment makes every content its own."""
    key = F.col("o_orderkey").cast("string")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("artifact_seq"),
        F.concat(F.lit("o"), key, F.lit(".py")).alias("filename"),
        F.get(constant(list(SOURCE_TAGS), "array<string>"), (F.col("o_orderkey") % 4).cast("int")).alias("source"),
        F.concat(
            F.get(constant(list(NESTED_FILES), "array<string>"), (F.col("o_orderkey") % 4).cast("int")), F.lit("# order "), key
        ).alias("content"),
    )
    return artifacts_from(rows)


# Package names by p_partkey modulo 16, manifest names by p_size modulo 3.
PACKAGES = (
    "requests", "numpy", "pandas", "fastapi", "SQLAlchemy", "Flask", "pyyaml", "shodan", "MD5",
    "flask-secure-pro", "django-utils-advanced", "scikit-learn", "boto3", "left-pad", "requests-ai", "pickle",
)
MANIFESTS = ("requirements.txt", "pyproject.toml", "package.json")


def dep_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per brand, dialect and id block; one entry per part."""
    name = F.get(constant(PACKAGES, "array<string>"), (F.col("p_partkey") % 16).cast("int"))
    version = F.concat(F.col("p_size").cast("string"), F.lit(".0.0"))
    entry = (
        F.when(F.col("kind") == 0, F.when(F.col("p_partkey") % 5 == 0, F.concat(name, F.lit(">="), version, F.lit(" # note")))
               .otherwise(F.concat(name, F.lit("=="), version)))
        .when(F.col("kind") == 1, F.concat(F.lit('    "'), name, F.lit(">="), version, F.lit('",')))
        .otherwise(F.concat(F.lit('    "'), name, F.lit('": "^'), version, F.lit('",')))
    )
    files = (
        table(spark, sf_dir, "part")
        .select("p_brand", "p_partkey", "p_size", (F.col("p_size") % 3).alias("kind"),
                F.expr(f"p_partkey DIV {LINES_PER_FILE}").alias("block"))
        .withColumn("line", entry)
        .groupBy("p_brand", "kind", "block")
        .agg(_joined_lines("p_partkey").alias("body"))
    )
    heads = constant(["# comment\n\n", "dependencies = [\n", '"dependencies": {\n'], "array<string>")
    tails = constant(["", "\n]", "\n}"], "array<string>")
    folder = F.when(F.col("block") == 0, F.col("p_brand")).otherwise(
        F.concat_ws("/", "p_brand", F.col("block").cast("string")))
    brand_no = F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint")
    kind = F.col("kind").cast("int")
    rows = files.select(
        (F.col("block") * BLOCK_STRIDE + brand_no * 3 + kind).alias("artifact_seq"),
        F.concat_ws("/", folder, F.get(constant(MANIFESTS, "array<string>"), kind)).alias("filename"),
        F.lit("UNKNOWN_DEPENDENCY_FILE").alias("source"),
        F.concat(F.get(heads, kind), "body", F.get(tails, kind)).alias("content"),
    )
    return artifacts_from(rows)


def audit_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code files and manifests together: the usual input of one audit run."""
    return code_corpus(spark, sf_dir).unionByName(dep_corpus(spark, sf_dir))


def conversation_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a pasted snippet."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("content"))
