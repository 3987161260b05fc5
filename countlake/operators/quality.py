"""Declared constraints as rule tables, and foreign-key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _at_least_zero(name: str) -> Column:
    return F.col(name) >= 0


def _text_up_to(name: str, length: int) -> Column:
    return F.length(name) <= length


def footfall_rules() -> dict[str, Column]:
    """Rule name to the condition a valid row meets; null fails."""
    return {
        "branch_id_present": F.col("branch_id").isNotNull(),
        "detector_id_max_50": _text_up_to("detector_id", 50),
        "timestamp_present": F.col("timestamp").isNotNull(),
        "visitor_count_min_0": _at_least_zero("visitor_count"),
        "entry_count_min_0": _at_least_zero("entry_count"),
        "exit_count_min_0": _at_least_zero("exit_count"),
    }


def branch_rules() -> dict[str, Column]:
    """Coordinates are optional and ``is_active`` has a default: no rule."""
    return {
        "name_max_100": _text_up_to("name", 100),
        "address_max_200": _text_up_to("address", 200),
        "city_max_50": _text_up_to("city", 50),
        "postal_code_max_10": _text_up_to("postal_code", 10),
    }


def _fails(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def with_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``violations``: the names of the rules a row breaks."""
    broken = F.array(*[F.when(_fails(ok), F.lit(name)) for name, ok in rules.items()])
    return df.withColumn("violations", F.array_compact(broken))


def violation_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule, from a single pass: (rule, violations, rows_checked)."""
    counts = [F.count_if(_fails(ok)).alias(name) for name, ok in rules.items()]
    totals = df.agg(F.count("*").alias("rows_checked"), *counts)
    per_rule = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations"), "rows_checked")
        for name in rules
    ]
    return totals.select(F.inline(F.array(*per_rule)))


def with_branch_defaults(branches: DataFrame) -> DataFrame:
    return branches.withColumn("is_active", F.coalesce("is_active", F.lit(True)))


def orphan_footfall(footfall: DataFrame, branches: DataFrame) -> DataFrame:
    """Footfall whose branch does not exist."""
    ids = branches.select(F.col("id").alias("branch_id"))
    return footfall.join(ids, "branch_id", "left_anti")
