"""The batch job: raw files in, merged daily table and rejected lines out."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from countlake.operators.cleaning import (
    corrected_counts,
    judge_lines,
    keep_valid,
    standardise_names,
)
from countlake.operators.merge import append_counts, recompute_into
from countlake.schemas import RAW_COLUMNS
from countlake.session import build_session, scratch, write_through
from countlake.sources.agencies import read_agencies
from countlake.sources.raw_csv import map_by_header, read_lines, typed_readings

REJECT_COLUMNS = [*RAW_COLUMNS, "source_file", "value", "reason"]


def run_transform(
    spark: SparkSession,
    raw_path: str,
    dictionary: DataFrame | None,
    daily_path: str,
    on_conflict: str = "keep",
    keep_bad_dates: bool = False,
    max_distance: int | None = None,
    rejects_path: str | None = None,
) -> None:
    """Reads, cleans, aggregates and merges.

    ``on_conflict`` "keep" leaves stored days as they are, "recompute"
    replaces them by the counts of this run. With ``rejects_path`` every line
    that is left out is written there, with its reason; lines of files without
    a header are among them. The text is read twice: for headers, and for the
    readings.
    """
    if on_conflict not in ("keep", "recompute"):
        raise ValueError(f"on_conflict must be 'keep' or 'recompute', not {on_conflict!r}")
    with scratch(spark):
        lines = map_by_header(read_lines(spark, raw_path))
        if rejects_path:
            lines = write_through(judge_lines(lines, keep_bad_dates), "judged")
            rejected = lines.filter("reason is not null").select(*REJECT_COLUMNS)
            rejected.write.mode("overwrite").parquet(rejects_path)
        readings = typed_readings(lines.filter("has_header"))
        valid = standardise_names(keep_valid(readings, keep_bad_dates))
        counts = corrected_counts(valid, dictionary, max_distance)
        merge = append_counts if on_conflict == "keep" else recompute_into
        merge(spark, daily_path, counts)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Raw reading files to daily metrics")
    parser.add_argument("--raw", required=True, help="raw CSV files or folder")
    parser.add_argument("--agencies", help="agency dimension (Parquet) for name correction")
    parser.add_argument("--daily", required=True, help="daily metrics table (Parquet)")
    parser.add_argument("--rejects", required=True, help="folder for the lines left out (Parquet)")
    parser.add_argument("--on-conflict", choices=["keep", "recompute"], default="keep")
    parser.add_argument("--keep-bad-dates", action="store_true")
    parser.add_argument("--max-distance", type=int)
    args = parser.parse_args(argv)
    spark = build_session("countlake-transform")
    dictionary = read_agencies(spark, args.agencies) if args.agencies else None
    run_transform(
        spark,
        args.raw,
        dictionary,
        args.daily,
        args.on_conflict,
        args.keep_bad_dates,
        args.max_distance,
        args.rejects,
    )
    spark.stop()


if __name__ == "__main__":
    main()
