"""The plans are the ones wanted: pruned scans, balanced joins, no Python."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from wardlake.operators import gold, privacy, profiling, relationships, silver
from wardlake.operators.lookups import left_lookup
from wardlake.plans.registry import GOLD_TABLES, SILVER
from wardlake.sources import bronze, ndjson, tables


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Empty but written Silver tables, so that scans show up in plans."""
    root = str(tmp_path_factory.mktemp("silver"))
    for name, table in SILVER.items():
        tables.write_silver(spark.createDataFrame([], table.schema), root, name)
    return {name: tables.read_silver(spark, root, name) for name in SILVER}


@contextlib.contextmanager
def settings(spark, **values):
    for name, value in values.items():
        spark.conf.set(name.replace("__", "."), value)
    try:
        yield
    finally:
        for name in values:
            spark.conf.unset(name.replace("__", "."))


def plan(df, part="executedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


def large(spark):
    """As if no table were small enough to broadcast."""
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1")


FORBIDDEN = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.mark.parametrize("name", [t.name for t in GOLD_TABLES])
def test_gold_plans(spark, written, name):
    with large(spark):
        text = plan(gold.build_gold(name, written))
    assert not [word for word in FORBIDDEN if word in text]
    assert "Window" not in text
    # No global sort and no single-partition step.
    assert "rangepartitioning" not in text and "SinglePartition" not in text


def test_lookup_joins_run_between_two_exchanges(spark, written):
    with large(spark):
        text = plan(gold.build_gold("medication_order_fulfillment", written))
    assert text.count("SortMergeJoin") == 1
    assert len(re.findall(r"hashpartitioning\(_join_key", text)) == 2


def test_encounter_summary_reads_each_table_once_and_two_columns(spark, written):
    text = plan(gold.build_gold("encounter_summary", written))
    scans = re.findall(r"ReadSchema: (struct<[^\n]*)", text)
    assert len(scans) == 8
    observation = [s for s in scans if s.startswith("struct<encounter_id:string>")]
    assert observation, scans


def test_daily_filters_reach_the_scan(spark, written):
    text = plan(gold.build_gold("vitals_daily", written))
    assert "PushedFilters: [In(display" in text
    assert "raw_json" not in text and "issued_datetime" not in text


def test_audit_reads_each_table_once(spark, written):
    text = plan(relationships.completeness_metrics(written))
    assert text.count("FileScan") == 11
    with large(spark):
        text = plan(relationships.orphan_metrics(spark, written))
    # Nine tables with references, four target tables.
    assert text.count("FileScan") == 9 - 1 + 4
    assert "LeftAnti" in text
    assert not [word for word in FORBIDDEN if word in text]


def test_samples_are_limited_before_the_exchange(spark, written):
    text = plan(privacy.pattern_samples(written))
    assert "WindowGroupLimit" in text


def test_silver_prunes_partitions_and_parses_once(spark, folder):
    rows = spark.createDataFrame(
        [("Observation", "1", "f", "F", None, "d", "1", "t", '{"id":"1"}')],
        bronze.BRONZE_SCHEMA,
    )
    rows.write.partitionBy("resource_type").parquet(f"{folder}/b")
    source = bronze.read_bronze(spark, f"{folder}/b")
    for name in ("observation", "medication_request", "medication_dispense"):
        built = silver.build_silver(name, source)
        text = plan(built)
        assert re.search(r"PartitionFilters: \[[^\]]*resource_type", text)
        assert not [word for word in FORBIDDEN if word in text]
        optimized = plan(built, "optimizedPlan")
        whole = [p for p in optimized.split("from_json(") if "raw_json#" in p.split(")")[-2]]
        assert len(whole) <= 2, optimized


def test_generated_code_stays_compilable(spark, written, folder):
    """The JVM interprets methods above 8000 bytes of code: keep below."""
    rows = spark.createDataFrame([], bronze.BRONZE_SCHEMA)
    rows.write.partitionBy("resource_type").mode("overwrite").parquet(f"{folder}/b")
    source = bronze.read_bronze(spark, f"{folder}/b")
    built = [gold.build_gold(t.name, written) for t in GOLD_TABLES]
    built += [silver.build_silver(n, source, written["medication"]) for n in SILVER]
    with settings(spark, spark__sql__adaptive__enabled="false"):
        for df in built:
            execution = df.select("*")._jdf.queryExecution()
            text = spark._jvm.PythonSQLUtils.explainString(execution, "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert max(sizes, default=0) < 8000


def test_first_dates_read_few_columns(spark, written):
    """The second look at the measurements reads no encounter, unit or issue time."""
    with large(spark):
        for name in ("vitals_daily", "labs_daily"):
            text = plan(gold.build_gold(name, written))
            scans = re.findall(r"ReadSchema: (struct<[^\n]*effective_datetime[^\n]*)", text)
            assert len(scans) == 2
            assert [s for s in scans if "encounter_id" not in s and "unit" not in s]


def test_references_are_exchanged_once_for_fold_and_anti_join(spark, written):
    with large(spark):
        lost = relationships.reference_keys(written).join(
            relationships.target_keys(written), ["target", "key"], "left_anti"
        )
        text = plan(lost)
    # One exchange of the references and one of the targets.
    assert text.count("Exchange hashpartitioning(target") == 2


def test_profile_folds_shapes_by_numbers(spark, folder, write_gz):
    """Rows are folded to shapes in a hash aggregate, which files and keys share."""
    write_gz(f"{folder}/A.ndjson.gz", [{"id": "1"}])
    resources = ndjson.scan_resources(ndjson.scan_lines(spark, folder))
    text = plan(profiling.file_profiles(resources))
    assert "Window" not in text
    lowest = [n for n in re.findall(r"(\w*Aggregate)\(keys.*partial_min\(line_id", text)]
    lowest += re.findall(r"\(\d+\) (\w*Aggregate)[^(]*\n(?:[^\n]+\n)*[^\n]*partial_min\(line_id", text)
    assert lowest and set(lowest) == {"HashAggregate"}


def test_numbering_can_be_split(spark, folder, write_gz):
    """Lines and starts are exchanged for the join alone, so a large file splits."""
    write_gz(f"{folder}/A.ndjson.gz", [{"id": "1"}])
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(ndjson.numbered_resources(spark, folder))
    assert "Broadcast" not in text
    assert text.count("Exchange hashpartitioning(_file") == 2


def test_skewed_lookup_is_split_at_run_time(spark):
    """A hot key and the null keys end up in several tasks of the join."""
    facts = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.col("id").cast("string"))
        .alias("k"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    )
    keys = spark.range(0, 400_000, 1, 8).select(F.col("id").cast("string").alias("k"))
    dimension = keys.union(spark.sql("select 'hot' as k")).withColumn("d", F.lit(1))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB",
    ):
        joined = left_lookup(facts, dimension, "k")
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.max("v")
        )
        rows = [r["n"] for r in sizes.collect()]
        assert joined.filter("d is null").count() == 133_333
    assert sum(rows) == 400_000
    assert max(rows) < 400_000 / 4
