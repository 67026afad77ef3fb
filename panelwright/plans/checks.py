"""Independent re-check of prepared outputs and of the experiment tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.operators.rules import first_failing
from panelwright.spec import PanelSpec


def prepared_faults(prepared: DataFrame, spec: PanelSpec, periods: list[str], allowed: dict[str, list[str]]) -> DataFrame:
    """(check, faults) of a prepared table, all counted in one aggregation.

    Rule violations, rows of unexpected periods, expected periods without rows, and
    codes that are neither listed nor the unknown label.
    """
    counts = {
        "rule_violations": F.count_if(first_failing(spec.rules()) != 0),
        "unexpected_period": F.count_if(~F.coalesce(F.col(spec.period).isin(*periods), F.lit(False))),
        "absent_periods": F.lit(len(periods)) - F.size(
            F.collect_set(F.when(F.col(spec.period).isin(*periods), F.col(spec.period)))
        ),
    }
    for column, codes in allowed.items():
        listed = F.coalesce(F.col(column).isin(*codes, spec.unknown), F.lit(False))
        counts[f"codes_{column}"] = F.count_if(~listed)
    row = prepared.agg(*[c.cast("long").alias(name) for name, c in counts.items()])
    return row.unpivot([], list(counts), "check", "faults")


def remaining_faults(prepared: DataFrame, waterfall: DataFrame, spec: PanelSpec) -> DataFrame:
    """Periods whose prepared rows are not the rows that the last step of the waterfall left."""
    left = waterfall.groupBy(spec.period).agg(F.max_by("remaining", "rule").alias("remaining"))
    held = prepared.groupBy(spec.period).agg(F.count(F.lit(1)).alias("rows"))
    both = left.join(held, spec.period, "full").na.fill(0, ["remaining", "rows"])
    return both.filter(F.col("remaining") != F.col("rows"))


def experiment_faults(experiments: DataFrame, expected_runs: int, rows: DataFrame) -> DataFrame:
    """Variants with a wrong number of runs, or runs whose cluster sizes do not add up to the rows."""
    total = F.aggregate(F.map_values("sizes"), F.lit(0).cast("long"), lambda a, n: a + n)
    return (
        experiments.withColumn("_short", (total != rows.scalar()) | (F.size("sizes") != F.col("k")))
        .groupBy("variant").agg(F.count(F.lit(1)).alias("runs"), F.count_if("_short").alias("wrong_sizes"))
        .filter((F.col("runs") != expected_runs) | (F.col("wrong_sizes") > 0))
    )
