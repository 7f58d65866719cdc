"""Publishing of tables: written beside their place, put there when they are whole.

A reader sees the old table or the new one. Between the two renames of a publication
the old one is kept under a name of its own, from which an interrupted publication is
undone the next time. Renames within a file system move no data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Texts of resources repeat much, over more than the megabyte or the 20,000 rows of a
#: page by default: two thirds of the size of zstd's own level in pages of that size.
TABLE_OPTIONS = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "6",
    "parquet.page.size": str(8 << 20),
    "parquet.page.row.count.limit": "1000000",
}
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and a maker of paths on it."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return make(path).getFileSystem(conf), make


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Let a task keep a file open for each of a few partitions while the block runs.

    Otherwise every partitioned write sorts its rows, whole texts included, by partition,
    and large tasks spill. With more partitions than that a task sorts the rest of its
    rows. A value the session already sets is kept.
    """
    own = int(spark.conf.get(OPEN_WRITERS)) > 0
    if not own:
        spark.conf.set(OPEN_WRITERS, "8")
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(OPEN_WRITERS)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let shuffle files go at the end of the query that wrote them while the block runs.

    Otherwise they stay until the driver collects its garbage, and those of all queries
    of a session add up. A value the session already sets is kept.
    """
    own = spark.conf.get(SHUFFLE_CLEANUP, None)
    if own is None:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(SHUFFLE_CLEANUP)


def exists(spark: SparkSession, path: str) -> bool:
    files, make = _hadoop(spark, path)
    return bool(files.exists(make(path)))


def remove(spark: SparkSession, path: str) -> None:
    files, make = _hadoop(spark, path)
    files.delete(make(path), True)


def undo_unfinished(spark: SparkSession, path: str) -> None:
    """Put the old table back where a publication ended between its renames."""
    files, make = _hadoop(spark, path)
    old = make(f"{path}-previous")
    if files.exists(old):
        if files.exists(make(path)):
            files.delete(old, True)
        else:
            files.rename(old, make(path))


def publish(spark: SparkSession, ready: str, path: str) -> None:
    """Put the whole folder ``ready`` in the place of ``path``."""
    files, make = _hadoop(spark, path)
    undo_unfinished(spark, path)
    old = make(f"{path}-previous")
    files.mkdirs(make(path).getParent())
    if files.exists(make(path)) and not files.rename(make(path), old):
        raise OSError(f"{path} cannot be moved aside")
    if not files.rename(make(ready), make(path)):
        undo_unfinished(spark, path)
        raise OSError(f"{ready} cannot be moved to {path}")
    files.delete(old, True)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write to. It takes the place of ``path`` when the block ends, and
    goes without a trace if the block fails."""
    undo_unfinished(spark, path)
    ready = f"{path}-staging-{uuid.uuid4().hex}"
    try:
        yield ready
        publish(spark, ready, path)
    finally:
        remove(spark, ready)
