"""Reading and writing the layer tables and small result artefacts."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlake.plans.registry import gold_table, silver_table
from wardlake.sources.staging import TABLE_OPTIONS, replacing


def table_name(catalog: str, schema: str, table: str) -> str:
    """Three-part, back-quoted table name."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in (catalog, schema, table))


def static_table(spark: SparkSession, **columns: list) -> DataFrame:
    """A small table of fixed metadata, known to the planner with its size."""
    return spark.createDataFrame(pa.table(columns))


def union_all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def as_layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in layout order with layout types, so empty tables keep both."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def write_table(
    df: DataFrame, path: str, schema: T.StructType, max_records_per_file: int = 0
) -> int:
    """Replace a Parquet table; the row count is observed during the write. A write
    that fails leaves the table as it was."""
    counts = Observation("table_write")
    counted = as_layout(df, schema).observe(counts, F.count(F.lit(1)).alias("n"))
    with replacing(df.sparkSession, path) as ready:
        writer = counted.write.options(**TABLE_OPTIONS)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        writer.parquet(ready)
    return int(counts.get["n"])


def write_silver(df: DataFrame, root: str, name: str, max_records: int = 0) -> int:
    return write_table(df, f"{root}/{name}", silver_table(name).schema, max_records)


def write_gold(df: DataFrame, root: str, name: str, max_records: int = 0) -> int:
    return write_table(df, f"{root}/{name}", gold_table(name).schema, max_records)


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(silver_table(name).schema).parquet(f"{root}/{name}")


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(gold_table(name).schema).parquet(f"{root}/{name}")


def save_managed(df: DataFrame, name: str, table_format: str = "parquet") -> None:
    """Overwrite a catalog table together with its schema."""
    df.write.format(table_format).mode("overwrite").option(
        "overwriteSchema", "true"
    ).saveAsTable(name)


def write_json_rows(df: DataFrame, path: str) -> None:
    """Write a small result table as JSON lines."""
    df.write.mode("overwrite").json(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_together(tasks: dict[str, Callable[[], object]], width: int = 4) -> dict:
    """Run independent Spark actions from a few threads, so that small jobs
    overlap; the first error is raised after all have ended."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        running = {name: pool.submit(task) for name, task in tasks.items()}
    return {name: future.result() for name, future in running.items()}
