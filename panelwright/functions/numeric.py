"""Numeric expressions: bins, bands, labels and percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def years_and_months(years: Column, months: Column) -> Column:
    return years + months / F.lit(12)


def log_bin(value: Column, per_unit: int = 4) -> Column:
    """Lower edge of the log10 bin; ``per_unit`` bins per power of ten."""
    return F.floor(F.log10(value) * per_unit) / F.lit(float(per_unit))


def percent(part: Column, whole: Column) -> Column:
    """Part of a whole in percent as a double; NULL for an empty whole."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def band(value: Column, edges: list[tuple[Column, str]], last: str) -> Column:
    """Label of the first upper edge that the value does not exceed, else ``last``."""
    (edge, label), *rest = edges
    expr = F.when(value <= edge, F.lit(label))
    for edge, label in rest:
        expr = expr.when(value <= edge, F.lit(label))
    return expr.otherwise(F.lit(last))


def ratio_label(ratio: Column, high: str, low: str, mid: str, upper: float = 1.1, lower: float = 0.9) -> Column:
    """Above ``upper`` is high, below ``lower`` is low, else mid."""
    return F.when(ratio > F.lit(upper), high).when(ratio < F.lit(lower), low).otherwise(mid)


def bias_label(mean_error: Column, under: str, over: str, none: str, tolerance: float = 1e-9) -> Column:
    """Sign of a mean residual (actual - predicted): positive means underestimated."""
    return F.when(F.abs(mean_error) < F.lit(tolerance), none).when(mean_error > 0, under).otherwise(over)
