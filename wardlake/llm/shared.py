"""Scratch tables on the shared folder, and the view of documents all operators use."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources.staging import shuffles_removed

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])
#: Bytes of the white space that ends a word; a word is a run of all others.
WHITE_BYTES = b" \t\n\x0b\x0c\r"
#: The same set as a pattern of Java's and DuckDB's regular expressions.
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster shares; a local session without one gets its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder the cluster shares")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, so lineage ends here, and
    the shuffles behind it are not kept. ``options`` are those of the Parquet writer.

    The table goes away when the session's file system closes.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/corpus-{uuid.uuid4().hex}/{name}"
    with shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parent = jvm.org.apache.hadoop.fs.Path(path).getParent()
    parent.getFileSystem(hadoop).deleteOnExit(parent)
    return spark.read.schema(df.schema).parquet(path)


def in_workers(df: DataFrame) -> DataFrame:
    """``df``, after making this package importable in the session's Python workers
    where it is installed at the same place as here."""
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), PACKAGE_ROOT])
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null: empty) with the named further columns only."""
    return docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def holdout(doc_id: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves ``part``; a null id is held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(True))


def unit(*columns: Column | str) -> Column:
    """A hash of the columns, spread evenly over [0, 1)."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / F.lit(float(1 << 53))
