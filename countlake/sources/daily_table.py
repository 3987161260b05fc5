"""The stored daily metrics: Parquet, partitioned by year and month, in versions once merged into."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countlake.schemas import DAILY_METRICS
from countlake.session import path_is_missing
from countlake.sources.versions import Snapshot, commit, read_snapshot, snapshot, versions

PARTITION_COLUMNS = ["year", "month"]
#: How Spark names a folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_LAYOUT = ["year", "month", "agency_name", "counter_id", "date"]


def read_daily(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one asked for; the whole directory where there are none.

    Rows stay those of that version whatever is written later. Partition columns
    are added where they exist.
    """
    if version is None and not versions(spark, path):
        return spark.read.schema(DAILY_METRICS).parquet(path)
    return read_snapshot(spark, path, snapshot(spark, path, version), DAILY_METRICS)


def is_flat(spark: SparkSession, path: str) -> bool:
    """Whether rows are stored, but neither in versions nor by year and month."""
    if snapshot(spark, path).folders:
        return False
    try:
        return not spark.read.schema(DAILY_METRICS).parquet(path).isEmpty()
    except AnalysisException as error:
        if path_is_missing(error):
            return False
        raise


def lay_out(daily: DataFrame) -> DataFrame:
    """Range-partitioned and sorted for writing.

    The range key ends in the full daily key, so a large month or agency is
    split over several tasks while each task touches few months; sorted files
    give tight column statistics for agency and date filters.
    """
    dated = daily.select(
        *DAILY_METRICS.names,
        F.year("date").alias("year"),
        F.month("date").alias("month"),
    )
    return dated.repartitionByRange(*_LAYOUT).sortWithinPartitions(*_LAYOUT)


def write_daily(daily: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lay_out(daily).write.mode(mode).partitionBy(*PARTITION_COLUMNS).parquet(path)


def commit_daily(
    spark: SparkSession,
    path: str,
    change: Callable[[DataFrame | None], DataFrame | None],
    replace: bool = False,
) -> Snapshot:
    """Adds a version with the rows that ``change`` makes from the newest one, or None.

    ``change`` gets None where nothing is stored yet, and is called again if
    another writer commits in between. With ``replace`` its rows take the place
    of the months they lie in.
    """

    def write(base: Snapshot, folder: str) -> None:
        held = bool(base.folders)
        rows = change(read_snapshot(spark, path, base, DAILY_METRICS) if held else None)
        if rows is not None:
            write_daily(rows, folder)

    return commit(spark, path, write, replace)


def compact(spark: SparkSession, path: str, most: int = 1) -> Snapshot:
    """Rewrites the months that lie in more than ``most`` folders into one folder each."""
    held = Counter(Snapshot.month(f) for f in snapshot(spark, path).folders)
    many = sorted(m for m, n in held.items() if n > most)

    def change(stored: DataFrame | None) -> DataFrame | None:
        if stored is None or not many:
            return None
        place = F.concat(
            F.lit("year="), F.coalesce(F.col("year").cast("string"), F.lit(NO_VALUE)),
            F.lit("/month="), F.coalesce(F.col("month").cast("string"), F.lit(NO_VALUE)),
        )
        return stored.where(place.isin(many))

    return commit_daily(spark, path, change, replace=True)


def peek(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
