"""Silver checks: row parity with Bronze and resolvable keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.plans.registry import RESOURCE_TABLES
from wardlake.sources.tables import run_together, static_table, union_all

Tables = Mapping[str, DataFrame]


class SilverCheckError(ValueError):
    """Silver does not match Bronze or holds unresolvable keys."""


def silver_parity(
    spark: SparkSession, bronze: DataFrame, silver: Tables
) -> DataFrame:
    """Expected and actual rows per table; an absent table has no rows."""
    expected = bronze.groupBy("resource_type").agg(F.count("*").alias("expected_rows"))
    scope = static_table(
        spark,
        table_name=[t.name for t in RESOURCE_TABLES],
        resource_type=[t.resource_type for t in RESOURCE_TABLES],
    )
    present = [t.name for t in RESOURCE_TABLES if t.name in silver]
    named = scope.join(expected, "resource_type", "left")
    if present:
        actual = union_all(
            [
                silver[name]
                .agg(F.count("*").alias("actual_rows"))
                .withColumn("table_name", F.lit(name))
                for name in present
            ]
        )
        named = named.join(actual, "table_name", "left")
    else:
        named = named.withColumn("actual_rows", F.lit(0).cast("bigint"))
    return named.select(
        "table_name",
        "resource_type",
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
    )


def unresolved_keys(
    source: DataFrame,
    column: str,
    target: DataFrame | None,
    target_column: str,
    null_is_unresolved: bool = False,
) -> DataFrame:
    """Number of source rows whose key has no target row.

    The source is folded to one row per key first. Without a target table every
    populated key is unresolved.
    """
    keys = source.groupBy(F.col(column).alias("key")).agg(F.count("*").alias("n"))
    if not null_is_unresolved:
        keys = keys.filter(F.col("key").isNotNull())
    if target is not None:
        known = target.select(F.col(target_column).alias("key")).distinct()
        keys = keys.join(known, "key", "left_anti")
    return keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unresolved_rows"))


def ingredient_parents(silver: Tables) -> DataFrame:
    """Ingredients without a parent medication; a null parent counts too."""
    return unresolved_keys(
        silver["medication_ingredient"],
        "medication_id",
        silver["medication"],
        "medication_id",
        null_is_unresolved=True,
    )


def request_medications(silver: Tables) -> DataFrame:
    return unresolved_keys(
        silver["medication_request"],
        "medication_id",
        silver.get("medication"),
        "medication_id",
    )


def administration_requests(silver: Tables) -> DataFrame:
    return unresolved_keys(
        silver["medication_administration"],
        "medication_request_id",
        silver.get("medication_request"),
        "medication_request_id",
    )


def dispense_requests(silver: Tables) -> DataFrame:
    return unresolved_keys(
        silver["medication_dispense"],
        "medication_request_id",
        silver.get("medication_request"),
        "medication_request_id",
    )


# Check name -> (table that must exist, check).
KEY_CHECKS = {
    "medication_ingredient.medication_id": ("medication_ingredient", ingredient_parents),
    "medication_request.medication_id": ("medication_request", request_medications),
    "medication_administration.medication_request_id": (
        "medication_administration",
        administration_requests,
    ),
    "medication_dispense.medication_request_id": (
        "medication_dispense",
        dispense_requests,
    ),
}


def require_valid_silver(
    spark: SparkSession, bronze: DataFrame, silver: Tables
) -> list:
    """Parity rows (ten at most), or an error naming the first problem."""
    tasks = {
        label: lambda c=check: c(silver).first()["unresolved_rows"]
        for label, (table, check) in KEY_CHECKS.items()
        if table in silver
        and not (table == "medication_ingredient" and "medication" not in silver)
    }
    tasks["parity"] = lambda: silver_parity(spark, bronze, silver).collect()
    results = run_together(tasks)
    order = {t.name: i for i, t in enumerate(RESOURCE_TABLES)}
    rows = sorted(results.pop("parity"), key=lambda row: order[row["table_name"]])
    for row in rows:
        if row["expected_rows"] != row["actual_rows"]:
            raise SilverCheckError(
                f"Silver {row['table_name']} row count mismatch: "
                f"expected={row['expected_rows']}, actual={row['actual_rows']}"
            )
    if "medication_ingredient" in silver and "medication" not in silver:
        raise SilverCheckError("Silver medication table is missing.")
    for label, count in results.items():
        if count:
            raise SilverCheckError(f"Silver {label}: {count} rows do not resolve")
    return rows
