"""Referential audit: row counts, missing references, orphans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.plans.registry import SILVER_TABLES, SilverTable
from wardlake.sources.tables import static_table, union_all

Tables = Mapping[str, DataFrame]

# Target table -> its key column.
TARGET_KEYS = {
    "patient": "patient_id",
    "encounter": "encounter_id",
    "medication": "medication_id",
    "medication_request": "medication_request_id",
}


class RelationshipAuditError(ValueError):
    """The audit lacks tables to work on."""


def missing_rules(table: SilverTable) -> dict[str, tuple[Column, str | None]]:
    """Metric name -> (row is missing this reference, warning text)."""
    rules = {
        f"{table.name}_missing_{ref.label}": (F.col(ref.column).isNull(), ref.warning)
        for ref in table.references
        if ref.count_missing
    }
    if table.name == "medication_request":
        neither = F.col("medication_id").isNull() & F.col("medication_code").isNull()
        rules["medication_request_missing_medication_concept"] = (neither, None)
    return rules


def orphan_metric(table: SilverTable, label: str) -> str:
    return f"{table.name}_orphan_{label}"


ORPHAN_METRICS = tuple(
    orphan_metric(table, ref.label)
    for table in SILVER_TABLES
    for ref in table.references
)


def require_tables(silver: Tables) -> None:
    absent = [table.name for table in SILVER_TABLES if table.name not in silver]
    if absent:
        raise RelationshipAuditError(
            f"Missing Silver tables for audit: {', '.join(absent)}"
        )


def completeness_metrics(silver: Tables) -> DataFrame:
    """Row counts and missing-reference counts: one scan and fold per table."""
    require_tables(silver)
    parts = []
    for table in SILVER_TABLES:
        rules = missing_rules(table)
        metrics = {
            f"{table.name}_rows": ("rows", F.count(F.lit(1)), None),
            **{n: ("missing", F.count_if(c), w) for n, (c, w) in rules.items()},
        }
        folded = silver[table.name].agg(
            *[value.alias(name) for name, (_, value, _) in metrics.items()]
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(name).alias("metric"),
                    F.lit(kind).alias("kind"),
                    F.col(name).alias("value"),
                    F.lit(warning).cast("string").alias("warning"),
                )
                for name, (kind, _, warning) in metrics.items()
            ]
        )
        parts.append(
            folded.select(F.inline(entries)).withColumn(
                "table_name", F.lit(table.name)
            )
        )
    return union_all(parts).select("metric", "kind", "table_name", "value", "warning")


def reference_keys(silver: Tables) -> DataFrame:
    """All populated references as (target, key) with their row count per metric.

    Each table is read once. The fold runs before the shuffle, so a key shared
    by very many rows becomes one partial row per task; its exchange on target and
    key is the one the anti join needs.
    """
    parts = []
    for table in SILVER_TABLES:
        if not table.references:
            continue
        entries = F.array(
            *[
                F.struct(
                    F.lit(orphan_metric(table, ref.label)).alias("metric"),
                    F.lit(ref.target).alias("target"),
                    F.col(ref.column).alias("key"),
                )
                for ref in table.references
            ]
        )
        parts.append(silver[table.name].select(F.inline(entries)))
    return (
        union_all(parts)
        .filter(F.col("key").isNotNull())
        .groupBy("target", "key")
        .agg(
            *[F.count_if(F.col("metric") == name).alias(name) for name in ORPHAN_METRICS]
        )
    )


def target_keys(silver: Tables) -> DataFrame:
    """Distinct keys of the four target tables.

    Made distinct on the join key, which the join needs exchanged anyway, so a
    much repeated target id costs one row.
    """
    return union_all(
        [
            silver[name].select(F.lit(name).alias("target"), F.col(key).alias("key"))
            for name, key in TARGET_KEYS.items()
        ]
    ).distinct()


def orphan_metrics(spark: SparkSession, silver: Tables) -> DataFrame:
    """All nineteen orphan counts from one anti join; zero counts included."""
    require_tables(silver)
    lost = reference_keys(silver).join(
        target_keys(silver), ["target", "key"], "left_anti"
    )
    totals = lost.agg(*[F.sum(name).alias(name) for name in ORPHAN_METRICS])
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("metric"), F.col(name).alias("value"))
            for name in ORPHAN_METRICS
        ]
    )
    orphans = totals.select(F.inline(entries))
    pairs = [(table, ref) for table in SILVER_TABLES for ref in table.references]
    scope = static_table(
        spark,
        metric=[orphan_metric(table, ref.label) for table, ref in pairs],
        table_name=[table.name for table, _ in pairs],
    )
    return scope.join(orphans, "metric", "left").select(
        "metric",
        F.lit("orphan").alias("kind"),
        "table_name",
        F.coalesce("value", F.lit(0)).alias("value"),
        F.lit(None).cast("string").alias("warning"),
    )


def relationship_metrics(spark: SparkSession, silver: Tables) -> DataFrame:
    """The whole audit as one long table."""
    return completeness_metrics(silver).unionByName(orphan_metrics(spark, silver))


def relationship_verdict(metrics: DataFrame) -> DataFrame:
    """One row: passed when no populated reference is an orphan."""
    orphans = F.sum(F.when(F.col("kind") == "orphan", F.col("value")).otherwise(0))
    return metrics.agg(
        F.coalesce(orphans, F.lit(0)).alias("orphan_rows"),
        F.count_if((F.col("kind") == "orphan") & (F.col("value") > 0)).alias(
            "orphan_metrics"
        ),
    ).withColumn("passed", F.col("orphan_rows") == 0)


def relationship_wide(metrics: DataFrame) -> DataFrame:
    """One row with a column per metric."""
    names = [
        *[f"{table.name}_rows" for table in SILVER_TABLES],
        *[name for table in SILVER_TABLES for name in missing_rules(table)],
        *ORPHAN_METRICS,
    ]
    value = F.col("value")
    return metrics.agg(
        *[
            F.coalesce(
                F.sum(F.when(F.col("metric") == name, value)), F.lit(0)
            ).alias(name)
            for name in names
        ]
    )


def relationship_warnings(metrics: DataFrame) -> DataFrame:
    """Missing-reference counts worth a warning: annotated and not zero."""
    return metrics.filter(F.col("warning").isNotNull() & (F.col("value") > 0)).select(
        "metric", "value", "warning"
    )
