"""Error tables by group and by band of the target, bias labels and point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.functions.numeric import band, bias_label
from panelwright.operators.percentiles import ACCURACY, percentiles
from panelwright.operators.sampling import hash_sample
from panelwright.operators.supervise import residual

BAND_PROBABILITIES = [0.5, 0.75, 0.9, 0.95]
BAND_LABELS = ["P00-P50", "P50-P75", "P75-P90", "P90-P95"]
LAST_BAND = "P95-P100"


def residuals(frame: DataFrame, label: str, predictions: dict[str, str], keep: list[str]) -> DataFrame:
    """One row per row and model: (keep..., model, residual)."""
    per_model = F.array(
        *[
            F.struct(F.lit(model).alias("model"), residual(label, prediction).alias("residual"))
            for model, prediction in predictions.items()
        ]
    )
    return frame.select(*keep, F.inline(per_model))


def error_aggregates() -> list:
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs("residual")).alias("mae"),
        F.avg("residual").alias("mean_error"),
    ]


def errors_by_group(frame: DataFrame, label: str, predictions: dict[str, str], group: str) -> DataFrame:
    """n, MAE and mean error per model and group; all models in one aggregation."""
    return residuals(frame, label, predictions, [group]).groupBy("model", group).agg(*error_aggregates())


def errors_by_groupings(frame: DataFrame, label: str, predictions: dict[str, str], groups: list[str]) -> DataFrame:
    """The same for several single groupings in one scan; columns of other groupings are NULL.

    ``grouping`` names the grouping a row belongs to, so a NULL category stays readable.
    """
    long = residuals(frame, label, predictions, groups)
    sets = [[F.col("model"), F.col(g)] for g in groups]
    which = F.coalesce(*[F.when(F.grouping(g) == 0, F.lit(g)) for g in groups])
    return long.groupingSets(sets, "model", *groups).agg(which.alias("grouping"), *error_aggregates())


def band_edges(frame: DataFrame, label: str, exact: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """One row with the band percentiles of the evaluated target."""
    return percentiles(frame, [], label, BAND_PROBABILITIES, exact=exact, accuracy=accuracy).select("percentiles")


def with_band(frame: DataFrame, label: str, edges: DataFrame, output: str = "band") -> DataFrame:
    """Adds the percentile band; the edges come in as a scalar, so no join is needed."""
    attached = frame.withColumn("_edges", edges.scalar())
    cuts = [(F.col("_edges")[i], name) for i, name in enumerate(BAND_LABELS)]
    return attached.withColumn(output, band(F.col(label), cuts, LAST_BAND)).drop("_edges")


def percentile_table(edges: DataFrame, probabilities: list[float]) -> DataFrame:
    """(name, value) rows out of a percentile array."""
    names = F.array(*[F.lit(f"P{round(100 * p)}") for p in probabilities])
    return edges.select(F.inline(F.arrays_zip(names.alias("name"), F.col("percentiles").alias("value"))))


def with_bias(errors: DataFrame, under: str = "subestimación", over: str = "sobreestimación", none: str = "sin sesgo medio") -> DataFrame:
    return errors.withColumn("bias", bias_label(F.col("mean_error"), under, over, none))


def chart_points(frame: DataFrame, columns: list[str], key: list[str], label: str, predictions: dict[str, str], limit: int = 5000) -> DataFrame:
    """Actual, predicted and residual of the same repeatable sample for every model."""
    sample = hash_sample(frame, columns, key, limit)
    per_model = F.array(
        *[
            F.struct(
                F.lit(model).alias("model"),
                F.col(label).alias("actual"),
                F.col(prediction).alias("predicted"),
                residual(label, prediction).alias("residual"),
            )
            for model, prediction in predictions.items()
        ]
    )
    return sample.select(*key, F.inline(per_model))


def axis_limits(points: DataFrame) -> DataFrame:
    """Joint lower (at most 0) and upper limit of actual and predicted values."""
    return points.agg(
        F.least(F.lit(0.0), F.min("actual"), F.min("predicted")).alias("lo"),
        F.greatest(F.max("actual"), F.max("predicted")).alias("hi"),
    )


def uncovered(errors: DataFrame, expected: DataFrame, grouping: list[str]) -> DataFrame:
    """Models (per grouping) whose group sizes do not add up to the expected row count."""
    return (
        errors.groupBy(*grouping).agg(F.sum("n").alias("n"))
        .withColumn("expected", expected.scalar())
        .filter(F.col("n") != F.col("expected"))
    )
