"""Parquet, JSON and model outputs, and their read-back checks."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from panelwright.functions.hashing import content_sums


class Contents(NamedTuple):
    """What a table holds, whatever its order: rows, and sums over all cells that add up over parts of a table."""

    rows: int
    sums: tuple[int, ...]

    def __add__(self, other: Contents) -> Contents:
        return Contents(self.rows + other.rows, tuple(a + b for a, b in zip(self.sums, other.sums, strict=True)))


def _written(frame: DataFrame, path: str, period: str | None, mixed: bool, facts: list[Column]) -> dict:
    """Writes a table and returns what the tasks that wrote it saw.

    They are watched behind the last shuffle, where a task counts once however often others run again after a lost executor.
    """
    seen = Observation()
    laid_out = frame.hint("rebalance", period) if period is not None and mixed else frame
    writer = laid_out.observe(seen, *facts).write.mode("overwrite")
    (writer if period is None else writer.partitionBy(period)).parquet(path)
    return seen.get


def write_table(frame: DataFrame, path: str, period: str | None = None, mixed: bool = False) -> int:
    """Overwrites a Parquet table and returns the rows written, counted by the write itself.

    With ``period`` the table is partitioned by it. Rows scanned from period files already
    lie apart and are written as they come. ``mixed`` says that every task holds rows of many
    periods: they are rebalanced first, so that a period of any size becomes evenly sized
    files and small ones are not scattered over one file per task.
    """
    return _written(frame, path, period, mixed, [F.count(F.lit(1)).alias("rows")])["rows"]


def _facts(columns: list[str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *content_sums(columns)]


def _contents(found: Row | dict) -> Contents:
    found = found if isinstance(found, dict) else found.asDict()
    return Contents(found["rows"], tuple(int(found[k]) for k in sorted(found) if k.startswith("sum_")))


def write_checked(frame: DataFrame, path: str, period: str | None = None, mixed: bool = False) -> Contents:
    """As ``write_table``, and returns rows and sums of the content, worked out by the write itself."""
    return _contents(_written(frame, path, period, mixed, _facts(frame.columns)))


def contents(frame: DataFrame) -> Contents:
    """Rows and sums of the content, in one aggregation; equal for equal rows in any order, with the same column names."""
    return _contents(frame.agg(*_facts(frame.columns)).first())


def schema_faults(found: DataFrame, like: DataFrame, ignore: tuple[str, ...] = ()) -> list[str]:
    """Columns whose name or type is on one side only."""
    def types(frame: DataFrame) -> set[tuple[str, str]]:
        return {(f.name, f.dataType.simpleString()) for f in frame.schema if f.name not in ignore}

    return sorted(f"{name}: {kind}" for name, kind in types(found) ^ types(like))


def read_back(spark: SparkSession, path: str, like: DataFrame, rows: int | Contents, period: str | None = None) -> DataFrame:
    """Re-reads a table; raises if its column names, types or row count are not those of ``like``.

    Given the contents that ``write_checked`` returned instead of a number of rows, it raises if any cell differs as well.

    The partition column lives in the paths and comes back last with a guessed type,
    so it gets its type from ``like``, and all columns their order.
    """
    again = spark.read.parquet(path)
    if period is not None:
        again = again.withColumn(period, F.col(period).cast(like.schema[period].dataType))
    faults = schema_faults(again, like)
    if faults:
        raise ValueError(f"schema of {path} differs: {faults}")
    again = again.select(*like.columns)
    if isinstance(rows, Contents):
        found = contents(again)
        if found.rows == rows.rows and found != rows:
            raise ValueError(f"content of {path} differs: {found.sums}, expected {rows.sums}")
        found, rows = found.rows, rows.rows
    else:
        found = again.count()
    if found != rows:
        raise ValueError(f"{path} holds {found} rows, expected {rows}")
    return again


def write_document(document: DataFrame, path: str) -> None:
    """One-row nested document as JSON; NULL fields are kept."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_document(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
