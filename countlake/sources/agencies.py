"""The agency dimension table."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from countlake.operators.dimensions import agency_dimension
from countlake.schemas import AGENCY
from countlake.session import build_session

# The agencies a table is built from when there is none.
DEFAULT_AGENCIES = [
    ("Lyon_1", "big", "metropolis"),
    ("Lyon_2", "medium", "metropolis"),
    ("Lyon_3", "small", "metropolis"),
    ("Grenoble_1", "big", "metropolis"),
    ("Grenoble_2", "medium", "metropolis"),
    ("Chambery_1", "big", "mid_sized_city"),
    ("Chambery_2", "small", "mid_sized_city"),
    ("Aix_les_bains_1", "small", "mid_sized_city"),
    ("La_Biolle_1", "small", "countryside"),
    ("Cognin_1", "medium", "countryside"),
    ("La_Motte_Servolex_1", "medium", "countryside"),
]


def default_agencies(spark: SparkSession) -> DataFrame:
    keys = "agency_name string, agency_size string, location_type string"
    return agency_dimension(spark.createDataFrame(DEFAULT_AGENCIES, keys))


def build_agencies(spark: SparkSession, path: str) -> None:
    """Writes the table of the default agencies; a path that exists is an error."""
    default_agencies(spark).write.parquet(path)


def read_agencies(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``. A missing path is an error, not an empty table."""
    return spark.read.schema(AGENCY).parquet(path)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the table of the default agencies")
    parser.add_argument("--path", required=True, help="folder to write, which must not exist")
    args = parser.parse_args(argv)
    spark = build_session("countlake-agencies")
    build_agencies(spark, args.path)
    spark.stop()


if __name__ == "__main__":
    main()
