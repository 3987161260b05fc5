"""Daily metrics of a stream of daily counts, with the baselines kept as state.

The state is one row per sensor and weekday with its last four counts, which is
all that the metrics of later days need. Each batch reads the state of the one
before and writes its own, so no history is looked up, and a replayed batch
starts from the same state. It has a row per sensor and weekday however long
the history is.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countlake.operators.metrics import WEEKDAY_GROUP, rolling_metrics, with_weekday
from countlake.session import path_is_missing

#: Counts that the metrics of the next day are made from.
RING = 4
_STATE = (
    "agency_name string, counter_id int, weekday int, "
    "ring array<struct<date: date, unit: string, daily_visitor_count: bigint>>"
)
_COUNTS = ["date", "agency_name", "counter_id", "unit", "daily_visitor_count"]


def last_counts(daily: DataFrame) -> DataFrame:
    """The state after the given days: the last four counts per sensor and weekday, newest first."""
    one = F.struct("date", "unit", "daily_visitor_count")
    newest_first = F.sort_array(F.collect_list(one), asc=False)  # a row per week and unit at most
    dated = with_weekday(daily.select(*_COUNTS).filter("date is not null"))
    return dated.groupBy(*WEEKDAY_GROUP).agg(F.slice(newest_first, 1, RING).alias("ring"))


def _unrolled(state: DataFrame) -> DataFrame:
    return state.select("agency_name", "counter_id", F.explode("ring").alias("one")).select(
        "agency_name", "counter_id", "one.*"
    )


def roll(state: DataFrame, counts: DataFrame) -> DataFrame:
    """Metrics of new daily counts that follow those in the state."""
    rows = _unrolled(state).withColumn("is_new", F.lit(False)).unionByName(
        counts.select(*_COUNTS).withColumn("is_new", F.lit(True))
    )
    return rolling_metrics(rows, keep=["is_new"]).filter("is_new").drop("is_new")


def after(state: DataFrame, counts: DataFrame) -> DataFrame:
    """The state once the counts are in."""
    return last_counts(_unrolled(state).unionByName(counts.select(*_COUNTS).filter("date is not null")))


def _in_order(state: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts with ``behind``: whether a day of the sensor and weekday as late or later is in the state."""
    newest = state.select(*WEEKDAY_GROUP, F.col("ring")[0]["date"].alias("newest"))
    joined = with_weekday(counts.select(*_COUNTS)).join(newest, WEEKDAY_GROUP, "left")
    behind = F.coalesce(F.col("date") <= F.col("newest"), F.col("date").isNull())
    return joined.select(*_COUNTS, behind.alias("behind"))


def _state_before(spark: SparkSession, path: str, batch_id: int, initial: DataFrame | None) -> DataFrame:
    try:
        known = [
            int(r.batch_id)
            for r in spark.read.schema(f"{_STATE}, batch_id long")
            .parquet(path)
            .filter(F.col("batch_id") < batch_id)
            .groupBy()
            .agg(F.max("batch_id").alias("batch_id"))
            .collect()
            if r.batch_id is not None
        ]
    except AnalysisException as error:
        if not path_is_missing(error):
            raise
        known = []
    if known:
        return spark.read.schema(_STATE).parquet(f"{path}/batch_id={known[0]}")
    return initial if initial is not None else spark.createDataFrame([], _STATE)


def start_rolling(
    counts: DataFrame,
    daily_path: str,
    behind_path: str,
    state_path: str,
    checkpoint_path: str,
    stored: DataFrame | None = None,
) -> StreamingQuery:
    """Metrics of newly landed daily counts, one row per daily key, to ``daily_path``.

    ``stored`` are the days known before the first batch. Days have to come in
    order per sensor and weekday; a count of a day that the state has passed,
    or without a date, goes to ``behind_path`` as it came, to be merged with
    ``append_counts``, which looks its history up. Each batch writes to folders
    of its own.
    """
    initial = last_counts(stored) if stored is not None else None

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = _state_before(spark, state_path, batch_id, initial)
        own = f"batch_id={batch_id}"
        judged = _in_order(state, batch)
        behind = judged.filter("behind").drop("behind")
        behind.write.mode("overwrite").parquet(f"{behind_path}/{own}")
        fresh = judged.filter("not behind").drop("behind")
        roll(state, fresh).write.mode("overwrite").parquet(f"{daily_path}/{own}")
        after(state, fresh).write.mode("overwrite").parquet(f"{state_path}/{own}")

    return (
        counts.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
