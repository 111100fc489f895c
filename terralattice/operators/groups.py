"""Joins of per-group results that keep groups with a missing key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_by(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on the keys as one struct: never null itself, and nulls inside it are equal."""
    rest = [c for c in right.columns if c not in keys]
    keyed = right.select(F.struct(*keys).alias("_key"), *rest)
    return left.withColumn("_key", F.struct(*keys)).join(keyed, "_key", how).drop("_key")


def spread_join(rows: DataFrame, per_key: DataFrame, keys: list[str], by: str, parts: int = 32) -> DataFrame:
    """Join few large groups with one row each: `parts` copies of that row meet the group's rows in as many parts, cut by `by`."""
    part = F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")
    copies = per_key.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return join_by(rows.withColumn("_part", part), copies, [*keys, "_part"]).drop("_part")
