"""Dimension rows with the time they are valid from, and joins as of a time.

An upsert overwrites; here every change becomes a version. A key has few
versions, so they travel as one small array per key: readings meet it in an
equi-join, and the version of a reading's time is picked in the row. No reading
is sorted, no range is compared across rows, and a key with a third of all
readings is split like in any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_versions(
    history: DataFrame, updates: DataFrame, key: str, valid_from: str = "valid_from"
) -> DataFrame:
    """The history with the updates as further versions, and ``valid_to`` of each (null for the last).

    Both have the key, ``valid_from`` and the attributes of ``history``. An
    update of the same key and time takes the place of the earlier version; of
    several, the greatest does, so a rerun agrees. A version that changes
    nothing is left out. Updates may come in any order. Rows without a key or
    a time are left out.
    """
    columns = [c for c in history.columns if c != "valid_to"]
    rest = [c for c in columns if c not in (key, valid_from)]
    both = history.select(*columns, F.lit(0).alias("turn")).unionByName(
        updates.select(*columns, F.lit(1).alias("turn"))
    )
    versions = (
        both.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
        .groupBy(key, valid_from)
        .agg(F.max(F.struct("turn", F.struct(*rest).alias("row"))).alias("last"))
        .select(key, valid_from, "last.row")
    )
    order = Window.partitionBy(key).orderBy(valid_from)
    changed = (
        versions.withColumn("before", F.lag("row").over(order))
        .filter(F.col("before").isNull() | ~F.col("before").eqNullSafe(F.col("row")))
        .withColumn("valid_to", F.lead(valid_from).over(order))
    )
    return changed.select(key, valid_from, "row.*", "valid_to").select(*columns, "valid_to")


def join_as_of(
    rows: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    valid_from: str = "valid_from",
) -> DataFrame:
    """Every row with the attributes of its key at its time; null before the first version.

    A version counts from ``valid_from`` on, until the next one. Rows with an
    unknown or null key, or without a time, stay with null attributes.
    """
    rest = [c for c in versions.columns if c not in (key, valid_from, "valid_to")]
    one = F.struct(F.col(valid_from).alias("from"), F.struct(*rest).alias("row"))
    known = versions.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_list(one)).alias("versions")
    )
    past = F.filter("versions", lambda v: v["from"] <= F.col(time))
    picked = rows.join(known, key, "left").withColumn("picked", F.try_element_at(past, F.lit(-1))["row"])
    return picked.select(*rows.columns, *[F.col("picked")[c].alias(c) for c in rest])
