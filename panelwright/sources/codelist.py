"""Code lists out of dictionary sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.functions.codes import dictionary_code, stripped
from panelwright.operators.joins import lookup
from panelwright.session import sized


def block_starts(sheet: DataFrame, sheet_id: list[str], variables: list[str]) -> DataFrame:
    """Per sheet and wanted variable: how many blocks start with it and the row of the last one."""
    return (
        sheet.withColumn("variable", dictionary_code(F.col("c0")))
        .filter(F.col("variable").isin(*variables))
        .groupBy(*sheet_id, "variable")
        .agg(F.count(F.lit(1)).alias("starts"), F.max("row_no").alias("first_row"))
    )


def code_lists(sheet: DataFrame, sheet_id: list[str], variables: list[str], min_starts: int = 2) -> DataFrame:
    """(sheet..., variable, code, label) from the last block of each variable.

    A sheet row is (row_no, c0 variable, c1 code, c2 label). A block runs from the row
    that names the variable to the row before the next named one. Later rows win.
    Blocks are found by aggregation and an equality join on the sheet, not by ordering a
    sheet in one task. A variable needs ``min_starts`` blocks; ``incomplete`` lists the rest.
    """
    starts = sized(
        block_starts(sheet, sheet_id, variables).filter(F.col("starts") >= min_starts), "block-starts"
    )
    after = sheet.join(starts, sheet_id).filter(F.col("row_no") >= F.col("first_row"))
    ends = sized(
        after.filter(F.col("c0").isNotNull() & (F.col("row_no") > F.col("first_row")))
        .groupBy(*sheet_id, "variable").agg(F.min("row_no").alias("end_row")),
        "block-ends",
    )
    block = after.join(ends, [*sheet_id, "variable"], "left").filter(
        F.col("end_row").isNull() | (F.col("row_no") < F.col("end_row"))
    )
    return (
        block.filter(F.col("c1").isNotNull() & F.col("c2").isNotNull())
        .groupBy(*sheet_id, "variable", dictionary_code(F.col("c1")).alias("code"))
        .agg(F.max_by(stripped(F.col("c2")), "row_no").alias("label"))
    )


def incomplete(sheet: DataFrame, lists: DataFrame, sheet_id: list[str], variables: list[str], min_starts: int = 2) -> DataFrame:
    """Sheets and variables with too few blocks, or whose last block holds no code."""
    wanted = sheet.select(*sheet_id).distinct().withColumn(
        "variable", F.explode(F.array(*[F.lit(v) for v in variables]))
    )
    starts = block_starts(sheet, sheet_id, variables).select(*sheet_id, "variable", "starts")
    held = lists.groupBy(*sheet_id, "variable").agg(F.count(F.lit(1)).alias("codes"))
    key = [*sheet_id, "variable"]
    return (
        wanted.join(starts, key, "left").join(held, key, "left").na.fill(0, ["starts", "codes"])
        .filter((F.col("starts") < min_starts) | (F.col("codes") == 0))
    )


def lists_missing(frame: DataFrame, lists: DataFrame, period: str, list_period: str, variables: list[str]) -> DataFrame:
    """(period, missing variables) of the frame's periods that have no list for one of the variables."""
    held = lists.filter(F.col("variable").isin(*variables)).groupBy(F.col(list_period).alias("_p")).agg(
        F.collect_set("variable").alias("_held")
    )
    joined = frame.select(period).distinct().join(held, F.col(period).eqNullSafe(F.col("_p")), "left")
    wanted = F.array(*[F.lit(v) for v in sorted(variables)])
    missing = F.array_except(wanted, F.coalesce("_held", F.array().cast("array<string>")))
    return joined.select(period, missing.alias("missing")).filter(F.size("missing") > 0)


def recode_by_list(
    frame: DataFrame, lists: DataFrame, variable: str, code: str, sheet_id: dict[str, str], unknown: str
) -> DataFrame:
    """Keeps codes that the row's own sheet lists for the variable; the rest becomes ``unknown``.

    ``sheet_id`` maps a column of the frame to the sheet's column (period to period).
    """
    known = (
        lists.filter(F.col("variable") == variable)
        .select(*[F.col(s).alias(f"_l_{s}") for s in sheet_id.values()], F.col("code").alias("_l_code"), F.lit(True).alias("_listed"))
        .distinct()
    )
    keys = {f: f"_l_{s}" for f, s in sheet_id.items()} | {code: "_l_code"}
    return lookup(frame, known, keys, "code-list").withColumn(
        code, F.when(F.col("_listed"), F.col(code)).otherwise(F.lit(unknown))
    ).drop("_listed")


def with_labels(frame: DataFrame, lists: DataFrame, on: dict[str, str], label: str, output: str, unknown: str) -> DataFrame:
    """Looks up a label; rows without one get ``unknown``. ``on`` maps columns of the frame to the key of ``lists``."""
    found = lookup(frame, lists.select(*on.values(), F.col(label).alias("_found")), on, "labels")
    return found.withColumn(output, F.coalesce(F.col("_found"), F.lit(unknown))).drop("_found")
