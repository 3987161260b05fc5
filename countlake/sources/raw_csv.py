"""Raw reading files: CSV whose columns are found by the names in each file's header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from countlake.functions.parsing import signed_number
from countlake.schemas import RAW_COLUMNS
from countlake.session import write_through

UNMAPPED = "unmapped_file"


def _names(value: Column) -> Column:
    """The fields of a line as column names: trimmed, unquoted, lower case."""
    plain = F.regexp_replace(value, '[\\s"\\ufeff]', "")
    return F.split(F.lower(plain), ",")


def _is_header() -> Column:
    """Whether a line names all reading columns; others may stand between them."""
    value = F.lower("value")
    # The first test is cheap and decides almost every line.
    wanted = F.array(*[F.lit(n) for n in RAW_COLUMNS])
    all_named = F.size(F.array_intersect(_names(F.col("value")), wanted)) == len(RAW_COLUMNS)
    return F.coalesce(value.contains(RAW_COLUMNS[0]) & all_named, F.lit(False))


def with_file_origin(lines: DataFrame) -> DataFrame:
    """Adds file path and block start to lines read as text; blank lines are left out."""
    return lines.filter("trim(value) <> ''").select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return with_file_origin(spark.read.text(path))


def file_headers(lines: DataFrame) -> DataFrame:
    """(source_file, header) of every file: the names in its first header line, else null."""
    place = F.struct("block_start", F.monotonically_increasing_id())
    found = lines.select(
        "source_file",
        F.when(_is_header(), place).alias("place"),
        F.when(_is_header(), _names(F.col("value"))).alias("names"),
    )
    return found.groupBy("source_file").agg(F.min_by("names", "place").alias("header"))


def map_by_header(lines: DataFrame) -> DataFrame:
    """Gives every line its columns by the names in its own file's header.

    Names are compared in lower case and trimmed; columns with other names are
    passed over, however many there are. Most files have one layout, which is
    taken for every line; only a file that differs, or has no header, is in
    the table that is joined to the lines. All columns stay text. Lines of a
    file without a header have ``has_header`` false and no columns; ``value``
    is the line as it stands.
    """
    headers = write_through(file_headers(lines), "headers")
    main = (
        headers.filter("header is not null")
        .groupBy("header")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "header")
        .first()
    )
    width = headers.agg(F.max(F.size("header"))).first()[0]
    usual = list(main["header"]) if main else []
    fields = [f"c{i}" for i in range(max(width or 0, len(RAW_COLUMNS)))]
    layout = F.array(*[F.lit(n) for n in usual]) if usual else F.lit(None).cast("array<string>")
    other = headers.filter(~F.col("header").eqNullSafe(layout)).withColumn("differs", F.lit(True))
    parsed = F.from_csv("value", ", ".join(f"{f} string" for f in fields))
    named = (
        lines.filter(~_is_header())
        .withColumn("fields", parsed)
        .withColumn("row", F.array(*[F.col(f"fields.{f}") for f in fields]))
    )
    if main is None or not other.isEmpty():
        named = named.join(other, "source_file", "left")
    else:
        named = named.withColumn("header", layout).withColumn("differs", F.lit(False))
    own = F.when(F.col("differs"), F.col("header")).otherwise(layout)

    def column(name: str) -> Column:
        usually = F.col("row")[usual.index(name)] if usual else F.lit(None).cast("string")
        place = F.array_position("header", F.lit(name)).cast("int")
        return F.when(F.col("differs"), F.element_at("row", place)).otherwise(usually).alias(name)

    return named.select(
        *[column(n) for n in RAW_COLUMNS],
        "source_file",
        own.isNotNull().alias("has_header"),
        "value",
    )


def read_raw_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All readings below ``path`` as text, by column name."""
    return map_by_header(read_lines(spark, path)).filter("has_header").select(*RAW_COLUMNS)


def typed_readings(text: DataFrame) -> DataFrame:
    """Text readings with numbers; numbers that do not parse become null."""
    return text.select(
        "date_time",
        "agency_name",
        signed_number("counter_id").alias("counter_id"),
        signed_number("visitor_count").alias("visitor_count"),
        "unit",
    )


def read_raw_readings(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return typed_readings(read_raw_text(spark, path))


def headerless_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Files that cannot be mapped, with the number of lines left out."""
    return (
        map_by_header(read_lines(spark, path))
        .filter(~F.col("has_header"))
        .groupBy("source_file")
        .agg(F.count("*").alias("line_count"))
    )


def write_raw_csv(readings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Readings as CSV files with a header, in the frame's column order."""
    readings.write.mode(mode).option("header", True).csv(path)
