"""Dashboard marts: small ordered summaries over Gold, Silver and the audits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wardlake.plans.registry import (
    BRONZE_TABLE,
    GOLD_TABLES,
    MEDICATION_EVENTS,
    SILVER_TABLES,
)
from wardlake.sources.tables import union_all

Tables = Mapping[str, DataFrame]


def _ranked(df: DataFrame, *ties: str, limit: int | None = None) -> DataFrame:
    """Largest value first; ties in label order. With a limit: a top-k report."""
    ordered = df.orderBy(F.desc("value"), *ties)
    return ordered.limit(limit) if limit else ordered


def _count_by(df: DataFrame, column: str) -> DataFrame:
    label = F.coalesce(column, F.lit("unknown")).alias("label")
    return df.groupBy(label).agg(F.count("*").alias("value"))


def encounters_by_class(gold: Tables) -> DataFrame:
    return _ranked(_count_by(gold["encounter_summary"], "encounter_class"), "label")


def discharge_dispositions(gold: Tables) -> DataFrame:
    counted = _count_by(gold["encounter_summary"], "discharge_disposition")
    return _ranked(counted, "label", limit=12)


def _binned(df: DataFrame, bins: list[tuple[str, Column]]) -> DataFrame:
    """Count rows per bin; the first matching bin wins, order as listed."""
    rank = F.lit(None)
    label = F.lit(None)
    for position, (name, condition) in reversed(list(enumerate(bins))):
        rank = F.when(condition, F.lit(position)).otherwise(rank)
        label = F.when(condition, F.lit(name)).otherwise(label)
    return (
        df.groupBy(rank.alias("rank"), label.alias("label"))
        .agg(F.count("*").alias("value"))
        .orderBy("rank")
        .select("label", "value")
    )


def length_of_stay_bins(gold: Tables) -> DataFrame:
    hours = F.col("length_of_stay_hours")
    return _binned(
        gold["encounter_summary"],
        [
            ("< 1 day", hours < 24),
            ("1-3 days", hours < 72),
            ("3-7 days", hours < 168),
            ("7+ days", hours.isNotNull()),
            ("unknown", F.lit(True)),
        ],
    )


def observation_load_bins(gold: Tables) -> DataFrame:
    count = F.col("observation_count")
    return _binned(
        gold["encounter_summary"],
        [
            ("0", count == 0),
            ("1-99", count < 100),
            ("100-999", count < 1000),
            ("1k-5k", count < 5000),
            ("5k+", F.lit(True)),
        ],
    )


def top_conditions(silver: Tables) -> DataFrame:
    """Folded per (display, patient, encounter) first, then counted distinct."""
    folded = (
        silver["condition"]
        .filter(F.col("display").isNotNull())
        .groupBy(F.col("display").alias("label"), "patient_id", "encounter_id")
        .agg(F.count("*").alias("n"))
    )
    counted = folded.groupBy("label").agg(
        F.countDistinct("patient_id").alias("patient_count"),
        F.countDistinct("encounter_id").alias("encounter_count"),
        F.sum("n").alias("value"),
    )
    return counted.orderBy(F.desc("value"), F.desc("patient_count"), "label").limit(12)


def _volume(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.col("measurement_name").alias("label")).agg(
        F.sum("measurement_count").alias("value")
    )


def vitals_volume(gold: Tables) -> DataFrame:
    return _ranked(_volume(gold["vitals_daily"]), "label")


def labs_volume(gold: Tables, limit: int = 15) -> DataFrame:
    return _ranked(_volume(gold["labs_daily"]), "label", limit=limit)


def _trend(daily: DataFrame) -> DataFrame:
    """First week: mean of daily means, and its index against the first day.

    The window runs over at most eight rows per measurement.
    """
    week = (
        daily.filter(F.col("event_day_index").between(0, 7))
        .groupBy("measurement_name", "event_day_index")
        .agg(
            F.round(F.avg("avg_value"), 2).alias("avg_value"),
            F.sum("measurement_count").alias("measurement_count"),
        )
    )
    by_day = Window.partitionBy("measurement_name").orderBy("event_day_index")
    baseline = F.nullif(F.first("avg_value").over(by_day), F.lit(0.0))
    return week.select(
        "measurement_name",
        "event_day_index",
        "avg_value",
        F.round(F.try_divide("avg_value", baseline) * 100, 2).alias("index_value"),
        "measurement_count",
    ).orderBy("measurement_name", "event_day_index")


def vitals_trend(gold: Tables) -> DataFrame:
    return _trend(gold["vitals_daily"])


def labs_trend(gold: Tables, limit: int = 6) -> DataFrame:
    """Trend of the laboratory tests with the largest volume."""
    top = labs_volume(gold, limit).select(F.col("label").alias("measurement_name"))
    return _trend(gold["labs_daily"].join(top, "measurement_name", "left_semi"))


def medication_by_activity(gold: Tables) -> DataFrame:
    counted = (
        gold["medication_activity"]
        .groupBy(F.col("activity_type").alias("label"))
        .agg(F.sum("event_count").alias("value"))
    )
    return _ranked(counted, "label")


def top_medications(gold: Tables) -> DataFrame:
    """Sums of per-class distinct counts: people may count in several classes."""
    counted = (
        gold["medication_activity"]
        .filter(F.col("medication_display").isNotNull())
        .groupBy(
            F.col("medication_display").alias("label"), "activity_type", "source_system"
        )
        .agg(
            F.sum("event_count").alias("value"),
            F.sum("patient_count").alias("patient_count"),
            F.sum("encounter_count").alias("encounter_count"),
        )
    )
    return _ranked(counted, "label", "activity_type", "source_system", limit=15)


def fulfillment_paths(gold: Tables) -> DataFrame:
    counted = (
        gold["medication_order_fulfillment"]
        .groupBy(F.col("fulfillment_path").alias("label"))
        .agg(F.count("*").alias("value"))
    )
    return _ranked(counted, "label")


def top_procedures(gold: Tables) -> DataFrame:
    counted = (
        gold["procedure_summary"]
        .filter(F.col("procedure_display").isNotNull())
        .groupBy(F.col("procedure_display").alias("label"), "source_system")
        .agg(
            F.sum("procedure_count").alias("value"),
            F.sum("patient_count").alias("patient_count"),
            F.sum("encounter_count").alias("encounter_count"),
        )
    )
    return _ranked(counted, "label", "source_system", limit=15)


def table_counts(bronze: DataFrame, silver: Tables, gold: Tables) -> DataFrame:
    named = [("Bronze", BRONZE_TABLE, bronze)]
    named += [("Silver", t.name, silver[t.name]) for t in SILVER_TABLES]
    named += [("Gold", t.name, gold[t.name]) for t in GOLD_TABLES]
    return union_all(
        [
            df.agg(F.count("*").alias("rows")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows"
            )
            for layer, name, df in named
        ]
    )


def headline_metrics(counts: DataFrame, report: DataFrame) -> DataFrame:
    """One row of totals from the table counts and the quality report."""

    def rows(*tables: str) -> Column:
        chosen = F.col("layer").isin("Bronze", "Silver") & F.col("table").isin(*tables)
        return F.coalesce(F.sum(F.when(chosen, F.col("rows"))), F.lit(0))

    verdict = report.select(
        F.col("status").alias("quality_status"),
        F.col("failed_check_count").alias("failed_checks"),
        F.col("warning_check_count").alias("warning_checks"),
    )
    return counts.unionByName(verdict, allowMissingColumns=True).agg(
        rows(BRONZE_TABLE).alias("source_resources"),
        rows("patient").alias("patients"),
        rows("encounter").alias("encounters"),
        rows("observation").alias("observations"),
        rows("condition").alias("conditions"),
        rows(*[t.name for t in MEDICATION_EVENTS]).alias("medication_events"),
        rows("procedure").alias("procedures"),
        F.max("quality_status").alias("quality_status"),
        F.max("failed_checks").alias("failed_checks"),
        F.max("warning_checks").alias("warning_checks"),
    )


def mart_validation(
    sections: Mapping[str, DataFrame],
    headline: DataFrame,
    relationships: DataFrame,
    expected: Mapping[str, int],
) -> DataFrame:
    """Assertions over the marts: one row each with what was seen and wanted.

    Sections must hold rows, no check may have failed, no reference may be an
    orphan, and headline numbers must equal the given expectations.
    """

    def row(df: DataFrame, name: str, observed: Column, passed: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("assertion"),
            observed.cast("bigint").alias("observed"),
            passed.alias("passed"),
        )

    parts = [
        row(
            df.agg(F.count("*").alias("n")),
            f"{name} is not empty",
            F.col("n"),
            F.col("n") > 0,
        )
        for name, df in sections.items()
    ]
    failed = F.col("failed_checks")
    parts.append(row(headline, "no failed checks", failed, failed == 0))
    orphans = relationships.agg(
        F.coalesce(
            F.sum(F.when(F.col("metric").contains("_orphan_"), F.col("value"))),
            F.lit(0),
        ).alias("n")
    )
    parts.append(
        row(orphans, "references resolve", F.col("n"), F.col("n") == 0)
    )
    for name, value in expected.items():
        parts.append(
            row(headline, f"{name} as expected", F.col(name), F.col(name) == value)
        )
    return union_all(parts)
