"""Opening calendar: how a sensor's base traffic spreads over week and day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, Monday to Sunday. Zero means closed.
WEEKDAY_MULTIPLIERS = [1.0, 1.25, 1.3, 1.6, 1.8, 0.0, 0.0]

# Fixed values by hour of day. Hours not listed are closed.
HOUR_MULTIPLIERS = {
    9: 0.2,
    10: 0.25,
    11: 0.25,
    13: 0.1,
    14: 0.1,
    15: 0.02,
    16: 0.03,
    17: 0.05,
}

# Fixed values.
MONTH_NAMES = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]


def weekday_multiplier(date: Column) -> Column:
    values = F.array(*[F.lit(m) for m in WEEKDAY_MULTIPLIERS])
    return F.element_at(values, F.weekday(date) + 1)


def hour_multiplier(hour: Column) -> Column:
    values = F.array(*[F.lit(HOUR_MULTIPLIERS.get(h, 0.0)) for h in range(24)])
    return F.element_at(values, hour + 1)


def is_open(date: Column, hour: Column) -> Column:
    """Literal tests, so the check can be pushed below joins."""
    open_days = [d for d, m in enumerate(WEEKDAY_MULTIPLIERS) if m > 0]
    return F.weekday(date).isin(open_days) & hour.isin(sorted(HOUR_MULTIPLIERS))


def month_numbers(names: list[str]) -> list[int]:
    unknown = [n for n in names if n not in MONTH_NAMES]
    if unknown:
        raise ValueError(f"unknown month names: {unknown}")
    return [MONTH_NAMES.index(n) + 1 for n in names]
