"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they are identical after every separating character is
deleted; null counts as empty. Each level groups only what the level before
found more than once, so the later and dearer keys are looked at for few rows.

* Level 1, length: the number of distinct lengths is small, so the counts are
  partial sums and the table of repeated lengths is tiny.
* Level 2, hash of the first ``prefix_chars`` characters.
* Level 3, SHA-256 of the whole normalised text.

A hot group (one text in a third of all rows) costs one row per task in the
counts; the joins back are sort-merge joins whose hot partitions adaptive
execution splits, and no group is ever held in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countlake.llm.common import without_spaces
from countlake.session import write_through

#: Characters of the normalised text that the second level looks at.
PREFIX_CHARS = 256

_LENGTH, _PREFIX = ["__length"], ["__length", "__prefix"]
_FULL = ["__length", "__prefix", "__digest"]


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys)


def _candidates(rows: DataFrame) -> DataFrame:
    """(length, prefix) pairs that survive the first two levels."""
    by_length = rows.join(_repeated(rows, _LENGTH), _LENGTH, "left_semi")
    return _repeated(by_length, _PREFIX)


def _digest(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


def duplicate_groups(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points in its original text
    stays, then the smallest key; null keys come last. A row given several
    times has the same key each time: exactly one of its copies is kept. Null
    and empty texts form one group. An empty table gives an empty result.
    Other columns of ``docs`` are not looked at, whatever their names.

    The text is read once and never shuffled: since the result carries the
    digest of every row, it is computed in that scan, and the levels work on
    narrow rows of the written result. Rows that are alone at level 1 or 2 do
    not take part in the level below.
    """
    plain = without_spaces(F.coalesce(F.col(text), F.lit("")))
    narrow = docs.select(
        F.col(key).alias("__key"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("__chars"),
        plain.alias("__plain"),
    ).select(
        "__key",
        "__chars",
        F.length("__plain").alias("__length"),
        F.xxhash64(F.substring("__plain", 1, prefix_chars)).alias("__prefix"),
        F.unhex(_digest(F.col("__plain"))).alias("__digest"),
    )
    rows = write_through(narrow, "exact-keys")
    survivors = rows.join(_candidates(rows), _PREFIX, "left_semi")
    groups = (
        survivors.groupBy(*_FULL)
        .agg(
            F.count(F.lit(1)).alias("__size"),
            F.max(_order("__chars", "__key")).alias("__best"),
        )
        .where("__size > 1")
    )
    # Copies of one row are counted, so that one of them can be told from the rest.
    counted = rows.groupBy("__key", "__chars", *_FULL).agg(F.count(F.lit(1)).alias("__copies"))
    grouped = counted.join(groups, _FULL, "left").withColumn(
        "__own", _order("__chars", "__key")
    )
    alone = F.col("__best").isNull()
    stays = alone | F.col("__own").eqNullSafe(F.col("__best"))
    keep = F.when(alone, F.col("__key")).otherwise(F.bitwise_not(F.col("__best.low")))
    return grouped.withColumn(
        "__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))
    ).select(
        F.col("__key").alias(key),
        keep.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        (stays & (F.col("__copy") == 1)).alias("kept"),
        F.lower(F.hex("__digest")).alias("text_sha256"),
    )


def _order(chars: str, key: str) -> F.Column:
    """Greatest for the most characters, then for the smallest key, null keys last."""
    return F.struct(
        F.col(chars).alias("chars"),
        F.col(key).isNotNull().alias("known"),
        F.bitwise_not(F.col(key)).alias("low"),
    )


def drop_duplicates(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Same rule as :func:`duplicate_groups`. Here the full text is hashed and
    moved for surviving groups only; rows alone at an earlier level pass
    through. Among copies of one whole row, any one stays.
    """
    names = docs.columns
    body = F.coalesce(F.col("__row")[text], F.lit(""))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row")).withColumn(
        "__plain", without_spaces(body)
    )
    keyed = packed.select(
        "__row",
        F.length("__plain").alias("__length"),
        F.xxhash64(F.substring("__plain", 1, prefix_chars)).alias("__prefix"),
    )
    candidates = write_through(_candidates(keyed.select(*_PREFIX)), "exact-candidates")
    met = keyed.join(candidates.withColumn("__again", F.lit(True)), _PREFIX, "left")
    single = met.where(F.col("__again").isNull()).select("__row")
    survivors = met.where("__again").withColumn("__digest", _digest(without_spaces(body)))
    best = (
        survivors.withColumn("__chars", F.length(body))
        .withColumn("__key", F.col("__row")[key])
        .groupBy(*_FULL)
        .agg(F.max_by("__row", _order("__chars", "__key")).alias("__row"))
        .select("__row")
    )
    return single.unionByName(best).select("__row.*")
