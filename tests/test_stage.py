"""What a query has the stage build: the layer tables its result depends on."""

import os
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.harness.queries import QUERIES
from wardlake.harness.stage import Lake
from wardlake.sources.tables import write_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize(
    ("name", "tables"),
    [
        ("slc_2_ingredient_parents", {"medication_ingredient", "medication"}),
        ("slc_5_dispense_requests", {"medication_dispense", "medication_request", "medication"}),
    ],
)
def test_a_check_of_keys_builds_only_its_tables(spark, monkeypatch, name, tables):
    place = Lake(spark, SF)
    monkeypatch.setattr("wardlake.harness.queries.lake", lambda *_: place)
    assert QUERIES[name](spark, SF).count() == 1
    built = {label.removeprefix("silver.") for label in place._done if label.startswith("silver.")}
    assert built == tables


def _shuffles(spark):
    """Numbers of the shuffles that have files in this session."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(re.findall(r"shuffle_(\d+)_", files.getAllFiles().mkString(" ")))


def test_shuffle_files_go_with_the_table_they_were_for(spark):
    before = _shuffles(spark)
    Lake(spark, SF).gold("condition_summary")
    for _ in range(100):
        left = _shuffles(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_texts_of_a_table_are_compressed_in_large_pages(spark, folder):
    """Texts that come again after more than a page of the default size."""
    parts = F.transform(F.sequence(F.lit(1), F.lit(300)), lambda n: F.md5(F.concat("kind", n)))
    kind = (F.col("id") % 120).cast("string").alias("kind")
    texts = spark.range(0, 600, 1, 1).select("id", kind)
    rows = texts.select(F.concat(F.array_join(parts, " "), "id").alias("value"))
    write_table(rows, f"{folder}/own", T.StructType().add("value", "string"))
    rows.write.option("compression", "zstd").parquet(f"{folder}/default")

    def size(name):
        return sum(part.stat().st_size for part in Path(folder, name).glob("*.parquet"))

    assert 2 * size("own") < size("default")
