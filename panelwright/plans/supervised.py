"""Supervised run: selection on the validation period, refit, one test, and its re-verification."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.operators import supervise
from panelwright.operators.quality import require_empty
from panelwright.operators.reshape import union_all
from panelwright.sources.sinks import load_model, read_document, save_model, write_document
from panelwright.spec import PanelSpec

METRICS_SCHEMA = (
    "partitions map<string, bigint>,"
    " selection array<struct<family: string, config: string>>,"
    " validation array<struct<model: string, n: bigint, mae: double, rmse: double, r2: double>>,"
    " test array<struct<model: string, n: bigint, mae: double, rmse: double, r2: double>>,"
    " residual string,"
    " parameters map<string, map<string, double>>"
)


@dataclass
class Selection:
    """Validation metrics of all configurations, and per family the chosen one with its pipeline."""

    metrics: DataFrame
    chosen: dict[str, str]
    pipelines: dict[str, PipelineModel]


def select(
    fit: DataFrame, validation: DataFrame, families: dict[str, dict[str, Estimator]], spec: PanelSpec
) -> Selection:
    """Fits every configuration of every family on ``fit`` and picks, per family, the lowest validation RMSE."""
    estimators = {name: e for family in families.values() for name, e in family.items()}
    family_of = F.create_map(
        *[F.lit(x) for family, members in families.items() for name in members for x in (name, family)]
    )
    fits = supervise.fit_and_score(fit, validation, estimators, spec)
    # A row per configuration; kept as data because the choice and the report both read it.
    metrics = fit.sparkSession.createDataFrame(fits.metrics.collect(), fits.metrics.schema)
    metrics = metrics.withColumn("family", family_of[F.col("model")])
    best = supervise.select_config(metrics.filter(F.col("model") != supervise.BASELINE), by=["family"])
    chosen = {r["family"]: r["model"] for r in best.select("family", "model").collect()}
    return Selection(metrics, chosen, {family: fits.pipelines[name] for family, name in chosen.items()})


def refit_and_test(
    fit: DataFrame, test: DataFrame, chosen: dict[str, Estimator], spec: PanelSpec
) -> supervise.Fits:
    """Refits the chosen estimators on all fit periods and scores the test rows once, baseline included."""
    return supervise.fit_and_score(fit, test, chosen, spec)


def metrics_document(
    partitions: dict[str, DataFrame], selection: dict[str, str], validation: DataFrame, test: DataFrame,
    parameters: dict[str, dict[str, float]] | None = None,
) -> DataFrame:
    """One-row nested document: partition sizes, chosen configurations, metric records, settings of all configurations."""
    spark = validation.sparkSession
    sizes = F.create_map(
        *[x for name, frame in partitions.items()
          for x in (F.lit(name), frame.agg(F.count(F.lit(1))).scalar())]
    )
    record = F.struct("model", "n", "mae", "rmse", "r2")
    chosen = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(c).alias("config")) for f, c in selection.items()])
    return spark.range(1).select(
        sizes.alias("partitions"),
        chosen.alias("selection"),
        validation.agg(F.collect_list(record)).scalar().alias("validation"),
        test.agg(F.collect_list(record)).scalar().alias("test"),
        F.lit(supervise.RESIDUAL_NOTE).alias("residual"),
        F.from_json(F.lit(json.dumps(parameters or {})), "map<string, map<string, double>>").alias("parameters"),
    )


def settings(estimators: dict[str, Estimator]) -> dict[str, dict[str, float]]:
    """The penalty, tree and seed settings that each configuration was fitted with."""
    names = ("regParam", "elasticNetParam", "numTrees", "maxDepth", "seed")
    held = {n: {p.name: e.getOrDefault(p) for p in e.params if p.name in names and e.isDefined(p)} for n, e in estimators.items()}
    return {n: {k: float(v) for k, v in found.items()} for n, found in held.items()}


def save(pipelines: dict[str, PipelineModel], document: DataFrame, folder: str) -> None:
    for name, pipeline in pipelines.items():
        save_model(pipeline, f"{folder}/{name}")
    write_document(document, f"{folder}/metrics")


def reverify(
    spark: SparkSession, folder: str, names: list[str], test: DataFrame, spec: PanelSpec,
    relative: float = 1e-9, absolute: float = 1e-6, partitions: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Reloads saved pipelines, rescores the test rows and compares with the saved document.

    (model, metric, expected, observed, agrees); pipelines with other predictors raise. The sizes of
    ``partitions`` are compared with the stored ones, as rows of model ``partition``.
    """
    pipelines = {name: load_model(f"{folder}/{name}") for name in names}
    for pipeline in pipelines.values():
        supervise.require_inputs(pipeline, spec)
    scored = supervise.score(test, pipelines)
    observed = supervise.regression_metrics(
        scored, spec.target, {n: supervise.prediction_column(n) for n in names}
    )
    saved = read_document(spark, f"{folder}/metrics", METRICS_SCHEMA).select(F.inline("test"))

    def long(frame: DataFrame, value: str) -> DataFrame:
        doubles = frame.withColumn("n", F.col("n").cast("double"))
        return doubles.unpivot("model", ["n", "mae", "rmse", "r2"], "metric", value)

    both = long(observed, "observed").join(long(saved, "expected"), ["model", "metric"], "left")
    if partitions:
        sizes = union_all([
            f.agg(F.lit("partition").alias("model"), F.lit(name).alias("metric"), F.count(F.lit(1)).cast("double").alias("observed"))
            for name, f in partitions.items()
        ])
        stored = read_document(spark, f"{folder}/metrics", METRICS_SCHEMA).select(F.explode("partitions").alias("metric", "expected"))
        stored = stored.select(F.lit("partition").alias("model"), "metric", F.col("expected").cast("double"))
        both = both.unionByName(sizes.join(stored, ["model", "metric"], "full"))
    gap = F.abs(F.col("observed") - F.col("expected"))
    allowed = F.greatest(
        F.lit(relative) * F.greatest(F.abs("observed"), F.abs("expected")), F.lit(absolute)
    )
    return both.select("model", "metric", "expected", "observed", F.coalesce(gap <= allowed, F.lit(False)).alias("agrees"))


def require_verified(comparison: DataFrame) -> None:
    require_empty(comparison.filter(~F.col("agrees")), "recomputed metrics differ")
