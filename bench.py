"""Benchmark: the whole job over landed source files, then the dashboard marts.

The source files (gzipped NDJSON derived from the given tables) are written
before the clock starts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardlake.harness import testbed  # noqa: E402
from wardlake.harness.stage import lake  # noqa: E402
from wardlake.operators import marts  # noqa: E402
from wardlake.plans.job import run_pipeline  # noqa: E402
from wardlake.sources.tables import run_together  # noqa: E402

MARTS = (
    marts.encounters_by_class,
    marts.discharge_dispositions,
    marts.length_of_stay_bins,
    marts.observation_load_bins,
    marts.vitals_volume,
    marts.labs_volume,
    marts.vitals_trend,
    marts.labs_trend,
    marts.medication_by_activity,
    marts.top_medications,
    marts.fulfillment_paths,
    marts.top_procedures,
)


def timed_run(spark: SparkSession, source: str, output: str) -> dict:
    """Seconds of every step of one job and of the marts over its tables."""
    run = run_pipeline(
        spark, source, output, testbed.DATASET_NAME, testbed.DATASET_VERSION
    )
    seconds = {step.name: step.duration_seconds for step in run.entries}
    rows = {step.name: step.rows for step in run.entries}

    started = time.perf_counter()
    gold, silver = run.gold(), run.silver()
    reports = {mart.__name__: lambda m=mart: m(gold).collect() for mart in MARTS}
    reports["top_conditions"] = lambda: marts.top_conditions(silver).collect()
    run_together(reports)
    seconds["marts"] = round(time.perf_counter() - started, 3)

    total = round(sum(seconds.values()), 3)
    resources = rows.get("bronze", 0)
    return {
        "value": total,
        "queries": seconds,
        "resources": resources,
        "resources_per_sec": round(resources / total) if total else 0,
        "steps": {step.name: step.status for step in run.entries},
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardlake-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    place = lake(spark, sf_dir)
    # Landed before any clock starts: all rows as they come, and those without
    # references that lead nowhere, with which the quality gate passes.
    full, clean = place.landing(), place.clean_landing()
    whole = timed_run(spark, full, f"{place.root}/bench")
    passing = timed_run(spark, clean, f"{place.root}/bench-clean")
    result = {"metric": "clinical_lakehouse_job", **whole, "unit": "sec"}
    result["sf"] = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result["clean_run"] = passing
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
