"""Text to typed values. Malformed text gives null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

READING_TIME_FORMAT = "yyyy-MM-dd HH:mm"
_USUAL_TIME = r"^(?!0000)\d{4}-\d{2}-\d{2} ([01]\d|2[0-3]):[0-5]\d\z"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def reading_time(column: Column | str) -> Column:
    """Timestamp of a reading; the whole text must fit the format."""
    return F.try_to_timestamp(_col(column), F.lit(READING_TIME_FORMAT))


def reading_date(column: Column | str) -> Column:
    """Date of a reading, null unless the whole text fits the format.

    Text in the usual shape only needs its date part cast, which is several
    times cheaper than the format parser; anything else goes to the parser.
    """
    text = _col(column)
    return F.when(text.rlike(_USUAL_TIME), F.substring(text, 1, 10).try_cast("date")).otherwise(
        F.to_date(reading_time(text))
    )


def whole_number(column: Column | str) -> Column:
    """Digits only, within 32 bits; anything else is null."""
    text = _col(column).cast("string")
    return F.when(text.rlike(r"^\d+$"), text.try_cast("int"))


def signed_number(column: Column | str) -> Column:
    """As ``whole_number``, with a leading minus for the negative sentinels."""
    text = _col(column).cast("string")
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("int"))


def standard_name(column: Column | str) -> Column:
    """Lower case with each space turned into an underscore; no trimming."""
    return F.translate(F.lower(_col(column)), " ", "_")
