"""Wide to long, long to wide, union by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def to_long(frame: DataFrame, ids: list[str], columns: list[str], variable: str, value: str) -> DataFrame:
    return frame.unpivot(ids, list(columns), variable, value)


def to_wide(frame: DataFrame, rows: list[str], column: str, values: list, count: str | None = None) -> DataFrame:
    """Cross-tabulation with the column values named, so no extra job looks for them; gaps are 0."""
    cell = F.count(F.lit(1)) if count is None else F.sum(count)
    wide = frame.groupBy(*rows).pivot(column, list(values)).agg(cell)
    return wide.na.fill(0, [str(v) for v in values])


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union by column name, never by position."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
