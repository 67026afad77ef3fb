"""Temporally split regression: preprocessing, grids, metrics and the choice of a configuration."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    OneHotEncoderModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from panelwright.operators.labels import LabelIndex, LabelIndexModel
from panelwright.session import iterated
from panelwright.spec import PanelSpec

# The configurations compared on the validation period.
LINEAR_CONFIGS = {
    "sin_regularizacion": {"regParam": 0.0, "elasticNetParam": 0.0},
    "ridge_1": {"regParam": 1.0, "elasticNetParam": 0.0},
    "ridge_10": {"regParam": 10.0, "elasticNetParam": 0.0},
    "elastic_net_10": {"regParam": 10.0, "elasticNetParam": 0.5},
}
FOREST_CONFIGS = {
    "rf_40_d7": {"numTrees": 40, "maxDepth": 7},
    "rf_80_d10": {"numTrees": 80, "maxDepth": 10},
}
BASELINE = "baseline"
# Codes that a category may have for the library's indexer, which gathers them on the driver; more go to a stored index.
MOST_CODES = 10_000
FITS_AT_ONCE = 4
RESIDUAL_NOTE = "salario_mensual - prediction; positivo = subestimacion"


def preprocessing_stages(
    categorical: tuple[str, ...], numeric: tuple[str, ...], features: str = "features", many: tuple[str, ...] = ()
) -> list:
    """Alphabetical index and one-hot per category, then one vector.

    Unseen and NULL categories get a slot of their own; NULL numbers are an error. The library's indexer gathers
    labels; those of the categories in ``many`` are indexed as a stored table and looked up by a join.
    """
    few = [c for c in categorical if c not in many]
    indexers = []
    if few or not many:
        indexers.append(StringIndexer(
            inputCols=few, outputCols=[f"{c}_idx" for c in few], handleInvalid="keep", stringOrderType="alphabetAsc",
        ))
    if many:
        indexers.append(LabelIndex(inputCols=list(many), outputCols=[f"{c}_idx" for c in many], handleInvalid="keep"))
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categorical],
        outputCols=[f"{c}_ohe" for c in categorical],
        handleInvalid="keep",
        dropLast=True,
    )
    assembler = VectorAssembler(
        inputCols=[*numeric, *[f"{c}_ohe" for c in categorical]], outputCol=features, handleInvalid="error"
    )
    return [*indexers, encoder, assembler]


def linear(label: str, config: dict, max_iter: int = 200, tol: float = 1e-6) -> LinearRegression:
    """Linear regression; predictors are standardised inside the penalty."""
    return LinearRegression(
        featuresCol="features", labelCol=label, predictionCol="prediction",
        standardization=True, maxIter=max_iter, tol=tol, **config,
    )


def forest(label: str, config: dict, seed: int = 42) -> RandomForestRegressor:
    settings = {"minInstancesPerNode": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "auto", **config}
    return RandomForestRegressor(
        featuresCol="features", labelCol=label, predictionCol="prediction", seed=seed, **settings
    )


def in_periods(frame: DataFrame, period: str, values: list) -> DataFrame:
    """Rows of the given periods; on a table partitioned by period only those files are read."""
    return frame.filter(F.col(period).isin(*values))


def split_faults(splits: dict[str, DataFrame], period: str, expected: dict[str, list[str]]) -> DataFrame:
    """Splits whose set of periods is not the expected one."""
    found = None
    for name, frame in splits.items():
        part = frame.select(F.lit(name).alias("split"), F.col(period).alias("period")).distinct()
        found = part if found is None else found.unionByName(part)
    wanted = F.create_map(
        *[x for name, periods in expected.items() for x in (F.lit(name), F.array(*[F.lit(p) for p in sorted(periods)]))]
    )
    sets = found.groupBy("split").agg(F.array_sort(F.collect_set("period")).alias("periods"))
    return sets.filter(F.col("periods") != wanted[F.col("split")])


def with_constant(fit: DataFrame, evaluated: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """The baseline: every row is predicted with the mean of the fit rows."""
    return evaluated.withColumn(prediction, fit.agg(F.avg(label)).scalar())


def residual(label: str, prediction: str) -> Column:
    """Actual minus predicted; positive means underestimated."""
    return F.col(label) - F.col(prediction)


def regression_metrics(frame: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """(model, n, mae, rmse, r2) of several prediction columns in one aggregation.

    R² is 1 - SSE/SST with SST about the mean of the evaluated rows.
    """
    per_model = []
    for model, prediction in predictions.items():
        r = residual(label, prediction)
        per_model.append(
            F.struct(
                F.lit(model).alias("model"),
                F.count(prediction).alias("n"),
                F.avg(F.abs(r)).alias("mae"),
                F.sqrt(F.avg(r * r)).alias("rmse"),
                (F.lit(1.0) - F.try_divide(F.sum(r * r), F.var_pop(label) * F.count(label))).alias("r2"),
            ).alias(f"_{len(per_model)}")
        )
    one_row = frame.agg(*per_model)
    return one_row.select(F.inline(F.array(*one_row.columns)))


@dataclass
class Fits:
    """Fitted pipelines by configuration name, the scored rows and the metrics of all of them."""

    scored: DataFrame
    metrics: DataFrame
    pipelines: dict[str, PipelineModel]


def fit_and_score(
    fit: DataFrame, evaluated: DataFrame, estimators: dict[str, Estimator], spec: PanelSpec
) -> Fits:
    """Fits every estimator on ``fit`` and scores all of them, and the baseline, in one pass.

    The fit rows are stored once (predictors and target only). Indexers and encoder are
    fitted once and shared; the assembled rows are kept for all estimators.
    """
    rows = iterated(fit.select(*spec.predictors, spec.target), "fit")
    many = many_codes(rows, spec.categorical_predictors)
    stages = preprocessing_stages(spec.categorical_predictors, spec.numeric_predictors, many=many)
    prepared = Pipeline(stages=stages).fit(rows)
    vectors = prepared.transform(rows).select("features", spec.target).persist(StorageLevel.MEMORY_AND_DISK)
    fitted = inheritable_thread_target(fit.sparkSession)(lambda estimator: estimator.fit(vectors))
    # Independent fits share the kept vectors; some run at once, so a short job leaves no core idle.
    with ThreadPool(FITS_AT_ONCE) as pool:
        models = pool.map(fitted, estimators.values(), chunksize=1)
    pipelines = {
        name: PipelineModel(stages=[*prepared.stages, model]) for name, model in zip(estimators, models, strict=True)
    }
    vectors.unpersist()
    mean = rows.agg(F.avg(spec.target)).first()[0]
    scored = score(evaluated, pipelines).withColumn(prediction_column(BASELINE), F.lit(mean))
    names = {name: prediction_column(name) for name in [BASELINE, *estimators]}
    return Fits(scored, regression_metrics(scored, spec.target, names), pipelines)


def many_codes(rows: DataFrame, categorical: tuple[str, ...]) -> tuple[str, ...]:
    """The categories with more values than the driver should gather, such as keys."""
    if not categorical:
        return ()
    found = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
    return tuple(c for c in categorical if found[c] > MOST_CODES)


def prediction_column(name: str) -> str:
    return f"prediction_{name}"


def score(frame: DataFrame, pipelines: dict[str, PipelineModel]) -> DataFrame:
    """One prediction column per pipeline, side by side on the same rows.

    Pipelines that share their fitted preprocessing run it once.
    """
    scored, done, added = frame, None, []
    for name, pipeline in pipelines.items():
        *preparing, model = pipeline.stages
        uids = [stage.uid for stage in preparing]
        if uids != done:
            before = scored = scored.drop(*added)
            for stage in preparing:
                scored = stage.transform(scored)
            added = [c for c in scored.columns if c not in before.columns]
            done = uids
        scored = model.copy().setPredictionCol(prediction_column(name)).transform(scored)
    return scored.drop(*added)


def select_config(metrics: DataFrame, baseline: str | None = None, by: list[str] | None = None) -> DataFrame:
    """The configuration with the lowest RMSE (ties by name), and its gain over the baseline in percent.

    Works on the small metrics table; with ``by`` it picks one per group.
    """
    group = Window.partitionBy(*(by or [F.lit(0)]))
    rows = metrics.withColumn("_is_base", F.col("model") == F.lit(baseline if baseline is not None else ""))
    rows = rows.withColumn("_base", F.max(F.when(F.col("_is_base"), F.col("rmse"))).over(group)).filter(~F.col("_is_base"))
    ranked = rows.withColumn("_rank", F.row_number().over(group.orderBy("rmse", "model")))
    gain = F.lit(100.0) * (F.col("_base") - F.col("rmse")) / F.col("_base")
    return ranked.filter("_rank = 1").withColumn("gain_pct", gain).drop("_rank", "_base", "_is_base")


def comparison(metrics: DataFrame, baseline: str) -> DataFrame:
    """Every model with its rank by RMSE (baseline included) and change against the baseline."""
    everything = Window.partitionBy(F.lit(0))
    base = F.max(F.when(F.col("model") == baseline, F.col("rmse"))).over(everything)
    return metrics.withColumns(
        {
            "place": F.row_number().over(everything.orderBy("rmse", "model")),
            "gain_pct": F.lit(100.0) * (base - F.col("rmse")) / base,
        }
    ).orderBy("place")


def same_winner(validation: DataFrame, test: DataFrame, baseline: str) -> DataFrame:
    """Whether the model that won the validation also wins the test."""
    v = select_config(validation, baseline).select(F.col("model").alias("validation_winner"))
    t = select_config(test, baseline).select(F.col("model").alias("test_winner"))
    return v.select("validation_winner", t.scalar().alias("test_winner")).withColumn(
        "same", F.col("validation_winner") == F.col("test_winner")
    )


def pipeline_inputs(model: PipelineModel) -> dict[str, list[str]]:
    """Input columns of the indexers, and the raw columns that reach the assembler."""
    indexed, encoded, assembled = [], [], []
    for stage in model.stages:
        if isinstance(stage, LabelIndexModel):
            indexed += stage.getInputCols()
        elif isinstance(stage, StringIndexerModel):
            indexed += stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
        elif isinstance(stage, OneHotEncoderModel):
            encoded.append(stage.getOutputCols())
        elif isinstance(stage, VectorAssembler):
            assembled.append(stage.getInputCols())
    if len(encoded) != 1 or len(assembled) != 1:
        raise ValueError("expected one encoder and one assembler")
    raw = [c for c in assembled[0] if c not in encoded[0]]
    return {"indexed": sorted(indexed), "raw": sorted(raw)}


def require_inputs(model: PipelineModel, spec: PanelSpec) -> None:
    """Raise unless the pipeline uses exactly the panel's predictors."""
    inputs = pipeline_inputs(model)
    if inputs["indexed"] != sorted(spec.categorical_predictors) or inputs["raw"] != sorted(spec.numeric_predictors):
        raise ValueError(f"unexpected predictors: {inputs}")
