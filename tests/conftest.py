import gzip
import json
import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("wardlake-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


@pytest.fixture()
def write_gz():
    """Write a gzip NDJSON file; items that are not text are dumped as JSON."""

    def write(path, items):
        lines = [i if isinstance(i, str) else json.dumps(i) for i in items]
        with gzip.open(path, "wt", encoding="utf-8") as out:
            out.write("".join(line + "\n" for line in lines))

    return write


@pytest.fixture()
def evaluate(spark):
    """Parse one JSON text with a schema as ``r`` and return one expression."""

    def run(resource, schema, expression):
        text = resource if isinstance(resource, str) else json.dumps(resource)
        frame = spark.range(1).select(F.from_json(F.lit(text), schema).alias("r"))
        value = frame.select(expression(F.col("r")).alias("v")).first()["v"]
        return tuple(value) if hasattr(value, "asDict") else value

    return run


@pytest.fixture()
def bronze_frame(spark):
    """Bronze rows of literal resources."""
    from wardlake.sources.bronze import bronze_rows

    def build(resources, family="MimicThing"):
        lines = spark.createDataFrame(
            [(f"{family}.ndjson.gz", json.dumps(r)) for r in resources],
            "source_file string, value string",
        )
        return bronze_rows(lines, "demo", "1.0", "2024-01-01T00:00:00+00:00")

    return build
