"""Joins that stay balanced when one key, or no key, holds most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left outer join on ``key`` in which null keys are spread over all tasks.

    A null key matches nothing, yet a plain left join sends all such rows to one
    task. Here each gets a made-up key from the hash of its row instead; real keys
    carry another prefix, so no made-up key can meet a dimension row and the result is the same.
    Neither side is hinted: the dimension is broadcast only when its measured size
    allows. Beyond that both sides are exchanged on the derived key, also when the
    dimension is an aggregate already hashed on ``key``: the adaptive skew join can
    split a hot key only between two exchanges.
    """
    spread = F.xxhash64(*_hashable(facts))
    made_up = F.concat(F.lit("-"), spread.cast("string"))
    real = F.concat(F.lit("+"), F.col(key))
    left = facts.withColumn("_join_key", F.coalesce(real, made_up))
    right = (
        dimension.filter(F.col(key).isNotNull())
        .withColumn("_join_key", real)
        .drop(key)
    )
    return left.join(right, "_join_key", "left").drop("_join_key")


def _hashable(df: DataFrame) -> list[str]:
    """Plain columns to hash; nested ones cost time and add no spread."""
    simple = [
        field.name
        for field in df.schema.fields
        if field.dataType.typeName() in ("string", "long", "integer", "date")
    ]
    return simple or df.columns[:1]
