import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("auditmill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Artifacts from `{filename: content}` or `[(filename, content, source)]`, in the given order."""
    from auditmill.sources.artifacts import artifacts_from

    def build(files, variant="core", partitions=4):
        if isinstance(files, dict):
            files = [(name, content, "UNKNOWN") for name, content in files.items()]
        rows = [(n, name, content, source) for n, (name, content, source) in enumerate(files)]
        df = spark.createDataFrame(rows, "artifact_seq bigint, filename string, content string, source string")
        return artifacts_from(df.repartition(partitions), variant=variant)

    return build
