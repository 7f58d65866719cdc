"""Source files the harness lands: order of lines, and the landing without dangling links."""

import gzip
import os
import re
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from wardlake.harness import testbed
from wardlake.harness.stage import RESOURCE_TYPES, Lake, write_landing
from wardlake.sources.tables import run_together

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def small_sorts(spark):
    """Sorts spill after so few rows that files are merged from several runs."""
    conf = spark.sparkContext._jsc.sc().conf()
    name = "spark.shuffle.spill.numElementsForceSpillThreshold"
    before = conf.get(name, str((1 << 31) - 1))
    conf.set(name, "500")
    yield
    conf.set(name, before)


def test_lines_keep_their_order_when_sorts_spill(spark, folder, small_sorts):
    key = F.col("id")
    family = F.when(key % 3 == 0, F.lit("MimicA")).otherwise(F.lit("MimicB"))
    lines = spark.range(0, 20_000, 1, 7).select(
        F.concat(family, F.lit(".ndjson.gz")).alias("source_file"),
        F.format_string("%06d", key).alias("value"),
        key.alias("key"),
    )
    write_landing(spark, [lines.orderBy(F.rand(3))], f"{folder}/landing", "key")
    for name, rest in (("MimicA", {0}), ("MimicB", {1, 2})):
        with gzip.open(f"{folder}/landing/{name}.ndjson.gz", "rt") as found:
            keys = [int(line) for line in found]
        assert keys == [k for k in range(20_000) if k % 3 in rest]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_long_chains_of_ingredients_leave_no_dangling_link(spark, folder):
    for name in os.listdir(SF):
        if name != "part.parquet":
            shutil.copy(f"{SF}/{name}", folder)
    # Medications 40 to 61 each name the next one, and 61 one that does not exist.
    part = spark.read.parquet(f"{SF}/part.parquet")
    size = F.when(F.col("p_partkey").between(40, 61), F.lit(5)).otherwise(F.lit(1))
    part.withColumn("p_size", size.cast("int")).write.parquet(f"{folder}/part.parquet")
    lines = Lake(spark, folder)._resolving_lines().collect()
    values = [row["value"] for row in lines]
    ids = {re.search(r'"id":"([^"]*)"', value).group(1) for value in values}
    tails = {
        tail
        for value in values
        for tail in re.findall(r'"[^"]*(?:Patient|Encounter|Medication|MedicationRequest)/([^"/]*)"', value)
    }
    assert tails <= ids
    assert "m-62" in ids and not ids & {f"m-{k}" for k in range(40, 62)}


def test_tables_are_built_side_by_side(spark):
    """The build of one table does not wait for that of another."""
    lake, both = Lake(spark, SF), threading.Barrier(2, timeout=20)
    run_together({name: lambda name=name: lake._once(name, both.wait) for name in "ab"})
    lake._once("a", both.wait)  # built already: nothing waits


def test_parts_of_a_family_from_several_tables_are_all_landed(spark, folder):
    lines = [
        spark.range(n, n + 50, 1, 2).select(
            F.lit("MimicA.ndjson.gz").alias("source_file"), F.col("id").cast("string").alias("value")
        )
        for n in (0, 50)
    ]
    write_landing(spark, lines, f"{folder}/landing")
    assert len(os.listdir(f"{folder}/landing")) >= 4
    found = spark.read.option("pathGlobFilter", "*.ndjson.gz").text(f"{folder}/landing")
    assert sorted(int(r[0]) for r in found.collect()) == list(range(100))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("kind", RESOURCE_TYPES)
def test_rendering_stays_compilable(spark, kind):
    """The JVM interprets methods above 8000 bytes of code: keep below."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (testbed.bronze_of(spark, SF, kind), testbed.source_lines(spark, SF, kind)):
            execution = df.select("*")._jdf.queryExecution()
            text = spark._jvm.PythonSQLUtils.explainString(execution, "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
