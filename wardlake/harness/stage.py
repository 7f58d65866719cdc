"""Written Bronze, Silver and Gold tables over the test tables, built on demand.

A table is written once per session and source folder, below the shared folder
of the cluster, and then read back: checks, audits and marts scan columnar
tables as they would in production instead of deriving them anew each time.
"""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.harness import testbed
from wardlake.operators.gold import build_gold
from wardlake.operators.silver import build_silver
from wardlake.plans.registry import (
    BRONZE_COLUMNS,
    GOLD_TABLES,
    RESOURCE_TABLES,
    SILVER_TABLES,
    silver_table,
)
from wardlake.sources.bronze import read_bronze
from wardlake.sources.staging import TABLE_OPTIONS, shuffles_removed, unsorted_writes
from wardlake.sources.tables import (
    read_gold,
    read_silver,
    run_together,
    shared_folder,
    write_gold,
    write_silver,
)

RESOURCE_TYPES = tuple(table.resource_type for table in RESOURCE_TABLES)

# Silver tables each Gold table reads.
_EVENTS = (
    "medication_request",
    "medication_administration",
    "medication_dispense",
    "medication_statement",
)
GOLD_INPUTS = {
    "encounter_summary": (
        "encounter",
        "observation",
        "condition",
        "procedure",
        *_EVENTS,
    ),
    "condition_summary": ("condition", "encounter"),
    "vitals_daily": ("observation", "encounter"),
    "labs_daily": ("observation", "encounter"),
    "medication_activity": ("encounter", *_EVENTS),
    "medication_order_fulfillment": _EVENTS[:3],
    "procedure_summary": ("procedure", "encounter"),
}


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Remove a folder when the session's file system closes."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).deleteOnExit(target)


class Lake:
    """Layer tables of one source folder in one session."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"
        delete_at_end(spark, self.root)
        self._done: set[str] = set()
        self._locks: defaultdict[str, threading.Lock] = defaultdict(threading.Lock)
        self._lock = threading.Lock()

    def _once(self, label: str, build) -> None:
        """A table waits for its own inputs only, so that others are built meanwhile."""
        with self._lock:
            own = self._locks[label]
        with own:
            if label not in self._done:
                with shuffles_removed(self.spark):
                    build()
                self._done.add(label)

    def _all(self, build: Callable[[str], DataFrame], names: Iterable[str]) -> dict:
        """Several tables, built side by side: few tasks of one keep the cluster busy."""
        with shuffles_removed(self.spark):
            return run_together({name: lambda name=name: build(name) for name in names})

    def bronze(self, types: Iterable[str] = RESOURCE_TYPES) -> DataFrame:
        """Bronze rows of the given types, as the partitioned Bronze table."""
        path = f"{self.root}/bronze"
        types = list(types)

        def write(kind: str) -> None:
            part = f"{path}/resource_type={kind}"
            self._once(part, lambda: self._write_type(kind, part))

        self._all(write, types)
        bronze = read_bronze(self.spark, path)
        return bronze.filter(F.col("resource_type").isin(*types)).select(
            *BRONZE_COLUMNS
        )

    def _write_type(self, kind: str, path: str) -> None:
        rows = testbed.bronze_of(self.spark, self.sf_dir, kind)
        rows.drop("resource_type").write.mode("overwrite").options(
            **TABLE_OPTIONS
        ).parquet(path)

    def stored(self, label: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A small derived table, written on first use."""
        path = f"{self.root}/stored/{label}"
        self._once(label, lambda: build().write.mode("overwrite").parquet(path))
        return self.spark.read.parquet(path)

    def silver(self, name: str) -> DataFrame:
        def build() -> None:
            bronze = self.bronze([silver_table(name).resource_type])
            medications = None
            if name == "medication_request":
                medications = self.silver("medication")
            write_silver(
                build_silver(name, bronze, medications), f"{self.root}/silver", name
            )

        self._once(f"silver.{name}", build)
        return read_silver(self.spark, f"{self.root}/silver", name)

    def silver_tables(self, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return self._all(self.silver, names or [table.name for table in SILVER_TABLES])

    def gold(self, name: str) -> DataFrame:
        def build() -> None:
            silver = self.silver_tables(GOLD_INPUTS[name])
            write_gold(build_gold(name, silver), f"{self.root}/gold", name)

        self._once(f"gold.{name}", build)
        return read_gold(self.spark, f"{self.root}/gold", name)

    def gold_tables(self, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return self._all(self.gold, names or [table.name for table in GOLD_TABLES])

    def landing(self) -> str:
        """Folder of gzipped NDJSON source files, one or more per family.

        Order and medication links all resolve here, so that a run gets past its
        Silver check; other references and the texts are as they come.
        """
        lines = (
            testbed.source_lines(self.spark, self.sf_dir, kind, dangling=False)
            for kind in RESOURCE_TYPES
        )
        return self.landed("landing", lines)

    def clean_landing(self) -> str:
        """The landing without what fails a run: resources with a reference that
        leads nowhere, and free-text notes."""
        return self.landed("clean", [self._resolving_lines()])

    def _resolving_lines(self) -> DataFrame:
        """Lines whose references all lead to a line that is kept. One round for each
        link of the chains, of which ingredients make long ones, until none is lost. A
        target's id tells its kind, so losing the line of an id loses the id."""
        lines = self.stored(
            "source_lines", lambda: testbed.all_source_lines(self.spark, self.sf_dir)
        )
        targets = ("Patient", "Encounter", "Medication", "MedicationRequest")
        kinds = "|".join(targets)
        # A reference with its kind may be a plain text; one without is an object's.
        tails = F.concat(
            *[
                F.regexp_extract_all("value", F.lit(pattern), F.lit(1))
                for pattern in (rf'"(?:[^"]*/)?(?:{kinds})/([^"/]*)"',
                                r'"reference":"([^"/]*)"')
            ]
        )
        links = self.stored(
            "links", lambda: lines.select("kind", "id", F.explode(tails).alias("tail"))
        )
        ids = lines.filter(F.col("kind").isin(*targets)).select(F.col("id").alias("tail"))
        found = links.join(ids.distinct(), "tail", "left_anti")
        rounds: list[DataFrame] = []
        while True:
            lost = found.select("kind", "id").distinct()
            for earlier in rounds:
                lost = lost.join(earlier, ["kind", "id"], "left_anti")
            lost = self.stored(f"lost-{len(rounds)}", lambda lost=lost: lost)
            if lost.isEmpty():
                break
            rounds.append(lost)
            gone = lost.filter(F.col("kind").isin(*targets)).select(F.col("id").alias("tail"))
            found = links.join(gone, "tail", "left_semi")
        for lost in rounds:
            lines = lines.join(lost, ["kind", "id"], "left_anti")
        return lines.select("source_file", "value")

    def landed(
        self, label: str, lines: Iterable[DataFrame], order: str | None = None
    ) -> str:
        path = f"{self.root}/{label}"
        self._once(label, lambda: write_landing(self.spark, lines, path, order))
        return path


def write_landing(
    spark: SparkSession,
    lines: Iterable[DataFrame],
    path: str,
    order: str | None = None,
) -> None:
    """Write ``source_file, value`` rows as ``<family>[.part-N].ndjson.gz``; with the
    column ``order`` a family is one file with its lines in that order.

    Spark writes the compressed parts, each of ``lines`` below a folder of its own so
    that they are written side by side; they are renamed several at a time.
    """
    work = f"{path}-parts"
    # Never null: else the writer sorts once more, by family alone, and that sort does
    # not keep the order of lines when it spills.
    family = F.coalesce(F.regexp_replace("source_file", r"\.ndjson\.gz$", ""), F.lit(""))

    def write(number: int, some: DataFrame) -> None:
        rows = some.withColumn("family", family)
        if order:
            rows = rows.repartition("family").sortWithinPartitions("family", order)
        rows.select("family", "value").write.partitionBy("family").option(
            "compression", "gzip"
        ).text(f"{work}/{number}")

    with nullcontext() if order else unsorted_writes(spark):
        run_together(
            {n: lambda n=n, some=some: write(n, some) for n, some in enumerate(lines)}
        )
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(work).getFileSystem(conf)
    fs.mkdirs(hadoop_path(path))
    moves, families = {}, defaultdict(list)
    for folder in fs.globStatus(hadoop_path(f"{work}/*/family=*")) or []:
        families[folder.getPath().getName()] += [
            str(status.getPath())
            for status in fs.listStatus(folder.getPath())
            if status.getPath().getName().startswith("part-")
        ]
    for name, parts in families.items():
        parts.sort()
        for number, part in enumerate(parts):
            shard = f".part-{number}" if len(parts) > 1 else ""
            target = f"{path}/{name.removeprefix('family=')}{shard}.ndjson.gz"
            moves[part] = lambda a=part, b=target: fs.rename(
                hadoop_path(a), hadoop_path(b)
            )
    run_together(moves, width=8)
    fs.delete(hadoop_path(work), True)


_lakes: dict[tuple[str, str], Lake] = {}
_lakes_lock = threading.Lock()


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of this session and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lakes_lock:
        if key not in _lakes:
            _lakes[key] = Lake(spark, sf_dir)
        return _lakes[key]
