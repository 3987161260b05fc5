"""Incremental ingest of newly landed raw files."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from countlake.operators.cleaning import (
    corrected_counts,
    judge_lines,
    keep_valid,
    standardise_names,
)
from countlake.operators.merge import append_counts, recompute_into
from countlake.plans.transform import REJECT_COLUMNS
from countlake.session import build_session, scratch, write_through
from countlake.sources.agencies import read_agencies
from countlake.sources.raw_csv import map_by_header, typed_readings, with_file_origin

READING_COLUMNS = ["date_time", "date", "agency_name", "counter_id", "visitor_count", "unit"]


def read_clean_readings(spark: SparkSession, path: str) -> DataFrame:
    """All batches, or the folder of one, names in standard spelling but not corrected.

    Date and batch come from the folders.
    """
    schema = (
        "date_time string, date date, agency_name string, counter_id int, visitor_count int, unit string"
    )
    return spark.read.schema(schema).parquet(path)


def start_ingest(
    spark: SparkSession,
    raw_path: str,
    dictionary: DataFrame | None,
    readings_path: str,
    daily_path: str,
    checkpoint_path: str,
    on_conflict: str = "keep",
    max_distance: int | None = None,
    rejects_path: str | None = None,
    corrections_path: str | None = None,
) -> StreamingQuery:
    """Reads all files that are new since the last run, then stops.

    The valid readings of a batch go to its own folder of the readings table,
    by date, with names in standard spelling; their daily counts, under
    corrected names, are merged into the daily table. ``on_conflict`` "keep"
    leaves stored days as they are and takes the baselines of new ones from
    them; "recompute" redoes the touched days from all stored readings. Lines
    left out, whole files without a header among them, go to ``rejects_path``
    with their reason; without that path such a file fails the run, and is read
    again by the next. A name is matched once for all runs: corrections are kept in
    ``corrections_path``, by default beside the readings. A batch that is
    replayed after a failure overwrites its own folders and merges to the same
    table.
    """
    corrections_path = corrections_path or f"{readings_path.rstrip('/')}_corrections"
    if on_conflict not in ("keep", "recompute"):
        raise ValueError(f"on_conflict must be 'keep' or 'recompute', not {on_conflict!r}")
    lines = with_file_origin(spark.readStream.text(raw_path))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            ingest(batch, batch_id)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        mapped = map_by_header(batch)
        if rejects_path:
            mapped = write_through(judge_lines(mapped), "judged")
            rejected = mapped.filter("reason is not null").select(*REJECT_COLUMNS)
            rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch_id={batch_id}")
        elif not mapped.filter("not has_header").isEmpty():
            raise ValueError("files without a header: give rejects_path to go on without them")
        valid = standardise_names(keep_valid(typed_readings(mapped.filter("has_header"))))
        own_folder = f"{readings_path}/batch_id={batch_id}"
        # Rebalancing gathers each date's rows for few files and splits a date
        # that is too large, without a sampling pass over the raw files.
        (
            valid.select(*READING_COLUMNS)
            .hint("rebalance", "date")
            .write.mode("overwrite")
            .partitionBy("date")
            .parquet(own_folder)
        )
        session = batch.sparkSession
        own = read_clean_readings(session, own_folder)

        def counts(readings: DataFrame) -> DataFrame:
            return corrected_counts(readings, dictionary, max_distance, corrections_path)

        if on_conflict == "keep":
            append_counts(session, daily_path, counts(own))
            return
        span = own.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
        if span["first"] is None:
            return
        # The span prunes the date folders; the join then keeps the touched days.
        stored = read_clean_readings(session, readings_path)
        in_span = stored.filter(F.col("date").between(span["first"], span["last"]))
        touched = in_span.join(own.select("date").distinct(), "date", "left_semi")
        recompute_into(session, daily_path, counts(touched))

    return (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Ingest raw files that landed since the last run")
    parser.add_argument("--raw", required=True, help="folder the raw CSV files land in")
    parser.add_argument("--agencies", help="agency dimension (Parquet) for name correction")
    parser.add_argument("--readings", required=True, help="cleaned readings table")
    parser.add_argument("--daily", required=True, help="daily metrics table")
    parser.add_argument("--rejects", required=True, help="folder for the lines left out")
    parser.add_argument("--checkpoint", required=True, help="checkpoint of this stream")
    parser.add_argument("--on-conflict", choices=["keep", "recompute"], default="keep")
    parser.add_argument("--max-distance", type=int)
    args = parser.parse_args(argv)
    spark = build_session("countlake-ingest")
    start_ingest(
        spark,
        args.raw,
        read_agencies(spark, args.agencies) if args.agencies else None,
        args.readings,
        args.daily,
        args.checkpoint,
        args.on_conflict,
        args.max_distance,
        args.rejects,
    ).awaitTermination()
    spark.stop()


if __name__ == "__main__":
    main()
