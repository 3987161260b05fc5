"""Ratios, thresholds and stable hash buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_over(actual: Column, baseline: Column) -> Column:
    """Change over the baseline in percent, unrounded; null without a baseline."""
    return F.lit(100) * (F.try_divide(actual, baseline) - F.lit(1))


def pct_over_total(actual: Column, baseline: Column) -> Column:
    """As ``pct_over`` with floating-point division by zero.

    A positive count over a zero baseline is +infinity, 0 / 0 is NaN.
    """
    over_zero = (
        F.when(actual > 0, F.lit(float("inf")))
        .when(actual < 0, F.lit(float("-inf")))
        .otherwise(F.lit(float("nan")))
    )
    return F.when(baseline == 0, over_zero).otherwise(pct_over(actual, baseline))


def threshold_factor(pct: float) -> float:
    return 1 + pct / 100


def exceeds(actual: Column, baseline: Column, factor: float) -> Column:
    """Strictly above ``factor`` times a positive baseline; null counts as no."""
    return F.coalesce((baseline > 0) & (actual > F.lit(factor) * baseline), F.lit(False))


def falls_below(actual: Column, baseline: Column, factor: float) -> Column:
    """Strictly below the mirrored factor ``2 - factor`` of a positive baseline."""
    return F.coalesce((baseline > 0) & (actual < F.lit(2 - factor) * baseline), F.lit(False))


def round_half_even(value: Column, digits: int) -> Column:
    """Half-even rounding of the binary value (scale, round, scale back)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def variation_sign(pct: Column) -> Column:
    """'up' for zero and above, 'down' below, null stays null."""
    return F.when(pct >= 0, F.lit("up")).when(pct < 0, F.lit("down"))


def stable_seed(date: Column, *parts: Column) -> Column:
    """SHA-256 of ``yyyymmdd`` and the parts as text, modulo 2**32."""
    text = F.concat(F.date_format(date, "yyyyMMdd"), *[p.cast("string") for p in parts])
    # The last eight hex digits are the value modulo 2**32.
    return F.conv(F.substring(F.sha2(text, 256), 57, 8), 16, 10).cast("long")
