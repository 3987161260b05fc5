"""Reading records delivered as JSON objects, one per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First failing field wins, in this order.
_FIELDS = ["agency_name", "date_time", "visitor_count", "unit", "counter_id"]
_NUMBERS = ["visitor_count", "counter_id"]

# Text that a JSON value other than a string may have.
_OTHER_JSON = r"(?s)^(-?\d+(\.\d+)?([eE][+-]?\d+)?|-?Infinity|NaN|true|false|[\[{].*)$"


def _parsed(json: Column) -> Column:
    """The fields as text; null for anything but one JSON object."""
    schema = ", ".join(f"{name} string" for name in _FIELDS) + ", corrupt string"
    parsed = F.from_json(json, schema, {"columnNameOfCorruptRecord": "corrupt"})
    return F.when(F.ltrim(json).startswith("{"), parsed)


def _string(json: Column, name: str, text: Column) -> Column:
    """The text of a JSON string; null for any other JSON type.

    Text that could also be a number, a truth value, an array or an object is
    rare here; only then is the type looked up in the document.
    """
    field = F.variant_get(F.try_parse_json(json), f"$.{name}", "variant")
    is_string = F.schema_of_variant(field) == "STRING"
    return F.when(~text.rlike(_OTHER_JSON), text).when(is_string, text)


def _integer(text: Column) -> Column:
    """A JSON integer, or a number or text that holds one; else null."""
    return F.coalesce(text.try_cast("int"), F.regexp_replace(text, r"\.0*$", "").try_cast("int"))


def validate_records(df: DataFrame, json_column: str = "json") -> DataFrame:
    """Typed columns plus ``error``: null, 'malformed' or the first bad field.

    agency_name, date_time, visitor_count and unit are required; counter_id
    may be absent or null. Text fields must be JSON strings.
    """
    json, record = F.col("json"), F.col("record")
    parsed = df.select(F.col(json_column).alias("json")).withColumn("record", _parsed(json))
    typed = parsed.select(
        "json",
        *[
            (_integer(record[n]) if n in _NUMBERS else _string(json, n, record[n])).alias(n)
            for n in _FIELDS
        ],
        (record.isNull() | record["corrupt"].isNotNull()).alias("malformed"),
        record["counter_id"].isNotNull().alias("has_counter"),
    )
    error = F.when(F.col("malformed"), F.lit("malformed"))
    for name in _FIELDS:
        bad = F.col(name).isNull()
        error = error.when(bad & F.col("has_counter") if name == "counter_id" else bad, F.lit(name))
    return typed.select("json", *_FIELDS, error.alias("error"))


def read_records(df: DataFrame, json_column: str = "json") -> DataFrame:
    """The valid records only.

    A filter on ``error`` would be pushed below the parsing, which is then
    repeated for every field the filter looks at; a row that unfolds to one
    record or none is parsed once.
    """
    checked = validate_records(df, json_column)
    record = F.array(F.struct(*_FIELDS))
    return checked.select(F.inline(F.when(F.col("error").isNull(), record)))


def rejected_records(df: DataFrame, json_column: str = "json") -> DataFrame:
    """The other records, each with its error."""
    checked = validate_records(df, json_column)
    record = F.array(F.struct("json", "error"))
    return checked.select(F.inline(F.when(F.col("error").isNotNull(), record)))
