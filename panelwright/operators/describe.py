"""Distribution summaries, group medians, shares, histograms and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from panelwright.functions.numeric import log_bin, percent
from panelwright.operators.percentiles import ACCURACY, exact_percentiles
from panelwright.operators.reshape import to_long
from panelwright.session import stored

SUMMARY_PERCENTILES = [0.25, 0.5, 0.75, 0.95]


def summary(frame: DataFrame, columns: list[str], exact: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """n, mean, sd (sample), min, max, p25, p50, p75, p95 per column; n counts non-NULL values.

    The sketch mode computes all columns in one aggregation; the exact mode takes the
    moments along in the first of its two passes over (variable, value).
    """
    def moments(c: str) -> dict[str, Column]:
        return {
            "mean": F.avg(c), "sd": F.stddev_samp(c), "lo": F.min(c).cast("double"), "hi": F.max(c).cast("double")
        }

    if exact:
        doubles = frame.select(*[F.col(c).cast("double").alias(c) for c in columns])
        long = to_long(doubles, [], columns, "variable", "value")
        rows = exact_percentiles(long, ["variable"], "value", SUMMARY_PERCENTILES, accuracy, also=moments("value"))
    else:
        cuts = F.array(*[F.lit(p) for p in SUMMARY_PERCENTILES])
        per_column = [
            F.struct(
                F.lit(c).alias("variable"),
                F.count(c).alias("n"),
                *[m.alias(name) for name, m in moments(c).items()],
                F.percentile_approx(F.col(c).cast("double"), cuts, F.lit(accuracy)).alias("percentiles"),
            ).alias(c)
            for c in columns
        ]
        rows = frame.agg(*per_column).select(F.inline(F.array(*columns)))
    named = [F.col("percentiles")[i].alias(f"p{round(100 * p)}") for i, p in enumerate(SUMMARY_PERCENTILES)]
    return rows.select("variable", "n", "mean", "sd", "lo", "hi", *named)


def mean_median_gap(summary_rows: DataFrame) -> DataFrame:
    return summary_rows.select("variable", (F.col("mean") - F.col("p50")).alias("gap"))


def group_median(
    frame: DataFrame, groups: list[str], value: str, exact: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """Row count and median of ``value`` per group."""
    count = F.count(F.lit(1))
    if exact:
        rows = exact_percentiles(frame, groups, value, [0.5], accuracy, also={"rows": count})
        return rows.select(*groups, F.col("rows").alias("n"), F.col("percentiles")[0].alias("median"))
    median = F.percentile_approx(F.col(value).cast("double"), F.lit(0.5), F.lit(accuracy))
    return frame.groupBy(*groups).agg(count.alias("n"), median.alias("median"))


def medians_by_each(
    frame: DataFrame, groups: list[str], value: str, accuracy: int = ACCURACY
) -> DataFrame:
    """``group_median`` of several single columns in one scan: (variable, code, n, median)."""
    long = to_long(frame.withColumns({g: F.col(g).cast("string") for g in groups}), [value], groups, "variable", "code")
    return group_median(long, ["variable", "code"], value, accuracy=accuracy)


def with_share(groups: DataFrame, count: str = "n", share: str = "pct", within: list[str] | None = None) -> DataFrame:
    """Percent of the total (or of the ``within`` group) held by each row of an aggregated table.

    For a share of the total the table is stored once and its sum comes in as a scalar:
    the rows behind it are not aggregated twice, nor the table gathered in one task.
    """
    if within:
        whole = F.sum(count).over(Window.partitionBy(*[F.col(c) for c in within]))
        return groups.withColumn(share, percent(F.col(count), whole))
    kept = stored(groups, "groups")
    return kept.withColumn(share, percent(F.col(count), kept.agg(F.sum(count)).scalar()))


def log_histogram(frame: DataFrame, value: str, per_unit: int = 4) -> DataFrame:
    return frame.groupBy(log_bin(F.col(value), per_unit).alias("log_bin")).agg(F.count(F.lit(1)).alias("n"))


def extremes(groups: DataFrame, group: str, count: str = "n", median: str = "median") -> DataFrame:
    """One row: the largest group, and the groups with the highest and lowest median."""
    return groups.agg(
        F.max_by(group, F.struct(F.col(count), F.col(group))).alias("top_group"),
        F.max(count).alias("top_n"),
        F.max_by(group, F.struct(F.col(median), F.col(group))).alias("hi_group"),
        F.max(median).alias("hi"),
        F.min_by(group, F.struct(F.col(median), F.col(group))).alias("lo_group"),
        F.min(median).alias("lo"),
    )


def trend_change(periods: DataFrame, period: str, measures: list[str]) -> DataFrame:
    """One row: first and last period and the change of each measure between them."""
    return periods.agg(
        F.min(period).alias("first_period"),
        F.max(period).alias("last_period"),
        *[(F.max_by(m, period) - F.min_by(m, period)).alias(f"{m}_change") for m in measures],
    )
