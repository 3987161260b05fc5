"""Importance resampling of documents towards a target distribution.

Features are runs of words, hashed into buckets (:mod:`word_buckets`). Three
steps:

1. Counts. Every task sums the buckets of its texts, so one row per bucket and
   task is shuffled, whatever the texts hold. The counts of source and target
   are one row per bucket, a number set by a parameter.
2. Gains. A bucket's gain is how much more often the target has it, smoothed,
   as a whole number of thousandths of a natural logarithm. A document's weight
   is the mean over its features.
3. Draw. A seeded Gumbel number is added to each weight; the highest scores are
   a weighted draw without replacement. Ranks come from a range-partitioned
   sort and the number of rows before each part, so no task holds them all.

Texts are read twice and never moved; what is sorted is four numbers a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countlake.llm.word_buckets import scanned
from countlake.session import write_through

BUCKETS = 10_000
#: Words of a run that is a feature, at most.
LONGEST = 1
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
#: Hundredths of the eligible documents that are drawn.
PERCENT = 10
SEED = 2024


def bucket_counts(
    docs: DataFrame, *, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST
) -> DataFrame:
    """(bucket, n): features of all texts by bucket; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype="int64")
        for _, bucket, _, _ in scanned(batches, "text", longest, buckets):
            total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.record_batch([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket: floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))."""
    spark = source.sparkSession
    counts = write_through(
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(source.select("bucket", F.col("n").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
        .fillna(0, ["s", "t"]),
        "bucket-counts",
    )
    whole = counts.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()

    def double(column: Column) -> Column:
        return column.cast("double")

    ratio = (double(F.col("t") + 1) * double(F.lit((whole.s or 0) + buckets))) / (
        double(F.col("s") + 1) * double(F.lit((whole.t or 0) + buckets))
    )
    return counts.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def _weights(
    docs: DataFrame, gain: np.ndarray, key: str, text: str, longest: int
) -> DataFrame:
    """key, n_words, n_features and weight of every row."""
    gained = docs.sparkSession.sparkContext.broadcast(gain)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gained.value
        for batch, bucket, row, n_words in scanned(batches, "text", longest, len(table)):
            n = np.bincount(row, minlength=batch.num_rows)
            # Whole numbers, exact in a double.
            total = np.bincount(row, table[bucket], minlength=batch.num_rows).astype("int64")
            yield pa.record_batch(
                [
                    batch.column("key"),
                    pa.array(n_words.astype("int64")),
                    pa.array(n.astype("int64")),
                    pa.array(total // np.maximum(n, 1)),
                ],
                names=["key", "n_words", "n_features", "weight"],
            )

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_words long, n_features long, weight long"
    )


def noise(key: Column, seed: int = SEED) -> Column:
    """A Gumbel number of the key and the seed, in whole thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def _ranked(rows: DataFrame, eligible: Column, drawn: int) -> DataFrame:
    """Adds rank: 1, 2, 3, ... by falling score and then key to the first ``drawn`` eligible rows."""
    order = [F.desc("eligible"), F.desc("score"), F.asc_nulls_first("key"), "row"]
    numbered = rows.withColumn("eligible", eligible).withColumn("row", F.monotonically_increasing_id())
    # The number names the part in its upper bits and counts the rows within it.
    placed = write_through(
        numbered.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()),
        "resampling-order",
    )
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("part", F.shiftright("place", 33).cast("int"))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = dict(zip([s.part for s in sizes], np.cumsum([0, *(s.n for s in sizes)]).tolist()))
    offsets = placed.sparkSession.createDataFrame(list(before.items()), "part int, before long")
    place = F.col("before") + within + 1
    return (
        placed.join(F.broadcast(offsets), "part")  # one row per task
        .withColumn("rank", F.when(F.col("eligible") & (place <= drawn), place))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_features, weight, score, rank.

    ``rank`` is null for rows that are not drawn: ``percent`` hundredths of the
    rows with at least ``least_words`` words are, highest scores first, ties to
    the smaller key, null first. Null and empty texts have no features and
    weigh 0. A null key gets the noise of an empty one. Repeated rows are
    scored alike and ranked one after the other. With an empty target, or an
    empty table as source, its counts are zero; no rows give no rows. Other
    columns are not looked at.
    """
    of = {"buckets": buckets, "longest": longest}
    table = gains(
        bucket_counts(docs, text=text, **of), bucket_counts(target, text=target_text, **of), buckets
    )
    gain = np.zeros(buckets, dtype="int64")
    found = table.toArrow()  # one row per bucket
    gain[found.column("bucket").to_numpy()] = found.column("gain").to_numpy()
    scored = write_through(
        _weights(docs, gain, key, text, longest).withColumn(
            "score", F.col("weight") + noise(F.col("key"), seed)
        ),
        "resampling-scores",
    )
    eligible = F.col("n_words") >= least_words
    n = scored.where(eligible).count()
    ranked = _ranked(scored, eligible, percent * n // 100)
    return ranked.select(
        F.col("key").alias(key), "n_words", "n_features", "weight", "score", "rank"
    )
