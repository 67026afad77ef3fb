import math
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwright.operators import errors, supervise
from panelwright.operators.quality import CheckFailed
from panelwright.plans import supervised
from panelwright.session import new_folder
from panelwright.spec import labour_spec

SPEC = labour_spec()


@pytest.fixture(scope="module")
def panel(spark):
    generator = random.Random(11)
    rows = []
    for i in range(1500):
        period = ["2025T1", "2025T2", "2025T3", "2025T4", "2026T1"][i % 5]
        age, level = generator.uniform(18, 60), generator.randrange(4)
        pay = 1000 + 40 * age + 800 * level + generator.gauss(0, 100)
        rows.append((period, str(i), "1", age, age / 4, 40.0, str(level), str(1 + i % 2), str(1 + i % 3), pay))
    names = ["periodo_archivo", "NUM_HOGAR", "NUM_PERSONA", *SPEC.predictors, "salario_mensual"]
    return spark.createDataFrame(rows, names).cache()


def split(panel):
    return (
        supervise.in_periods(panel, SPEC.period, ["2025T1", "2025T2", "2025T3"]),
        supervise.in_periods(panel, SPEC.period, ["2025T4"]),
        supervise.in_periods(panel, SPEC.period, ["2026T1"]),
    )


def test_one_hot_keeps_a_slot_for_the_unseen(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    stages = supervise.preprocessing_stages(("c",), ())
    coded = Pipeline(stages=stages).fit(seen).transform(spark.createDataFrame([("b",), ("z",), (None,)], "c string"))
    assert [r[0] for r in coded.select(vector_to_array("c_ohe")).collect()] == [[0, 1, 0, 0], [0, 0, 0, 1], [0, 0, 0, 1]]


def test_metrics_against_the_library(spark):
    frame = spark.createDataFrame([(1.0, 1.5, 0.0), (2.0, 1.0, 2.0), (4.0, 4.5, 4.0)], "y double, p double, q double")
    rows = {r.model: r for r in supervise.regression_metrics(frame, "y", {"P": "p", "Q": "q"}).collect()}
    for model, column in (("P", "p"), ("Q", "q")):
        for metric in ("mae", "rmse", "r2"):
            library = RegressionEvaluator(labelCol="y", predictionCol=column, metricName=metric).evaluate(frame)
            assert math.isclose(rows[model][metric], library, rel_tol=1e-12)
        assert rows[model].n == 3


def test_baseline_uses_the_fit_rows_only(spark):
    fit = spark.createDataFrame([(1.0,), (3.0,)], "y double")
    test = spark.createDataFrame([(10.0,), (20.0,)], "y double")
    scored = supervise.with_constant(fit, test, "y")
    assert {r.prediction for r in scored.collect()} == {2.0}
    assert supervise.regression_metrics(scored, "y", {"mean": "prediction"}).first().r2 < 0


def test_split_faults(spark, panel):
    fit, validation, test = split(panel)
    expected = {"fit": ["2025T1", "2025T2", "2025T3"], "validation": ["2025T4"], "test": ["2026T1"]}
    assert supervise.split_faults({"fit": fit, "validation": validation, "test": test}, SPEC.period, expected).isEmpty()
    wrong = supervise.split_faults({"fit": panel, "validation": validation}, SPEC.period, expected)
    assert [r.split for r in wrong.collect()] == ["fit"]


def test_select_config_breaks_ties_by_name(spark):
    metrics = spark.createDataFrame(
        [("baseline", 100.0), ("ridge_1", 82.5), ("ridge_10", 80.0), ("none", 80.0)], "model string, rmse double"
    )
    row = supervise.select_config(metrics, "baseline").first()
    assert (row.model, row.rmse, row.gain_pct) == ("none", 80.0, 20.0)
    places = [(r.model, r.place) for r in supervise.comparison(metrics, "baseline").collect()]
    assert places == [("none", 1), ("ridge_10", 2), ("ridge_1", 3), ("baseline", 4)]
    other = metrics.withColumn("rmse", F.when(F.col("model") == "ridge_1", 1.0).otherwise(F.col("rmse")))
    assert supervise.same_winner(metrics, metrics, "baseline").first().same
    row = supervise.same_winner(metrics, other, "baseline").first()
    assert (row.validation_winner, row.test_winner, row.same) == ("none", "ridge_1", False)


def test_supervised_run_and_reverification(spark, panel):
    fit, validation, test = split(panel)
    families = {
        "linear": {n: supervise.linear(SPEC.target, supervise.LINEAR_CONFIGS[n]) for n in ("sin_regularizacion", "ridge_10")},
        "forest": {"rf_5_d4": supervise.forest(SPEC.target, {"numTrees": 5, "maxDepth": 4})},
    }
    selection = supervised.select(fit, validation, families, SPEC)
    metrics = {r.model: r for r in selection.metrics.collect()}
    assert set(metrics) == {"baseline", "sin_regularizacion", "ridge_10", "rf_5_d4"}
    assert all(m.n == validation.count() for m in metrics.values())
    assert metrics["sin_regularizacion"].rmse < 130 < metrics["baseline"].rmse
    best = min(("sin_regularizacion", "ridge_10"), key=lambda n: (metrics[n].rmse, n))
    assert selection.chosen == {"linear": best, "forest": "rf_5_d4"}

    # The shared preprocessing gives what separate pipelines give.
    stages = supervise.preprocessing_stages(SPEC.categorical_predictors, SPEC.numeric_predictors)
    alone = Pipeline(stages=[*stages, families["linear"]["ridge_10"]]).fit(fit).transform(validation)
    rmse = RegressionEvaluator(labelCol=SPEC.target, metricName="rmse").evaluate(alone)
    assert math.isclose(rmse, metrics["ridge_10"].rmse, rel_tol=1e-6)

    chosen = {family: families[family][name] for family, name in selection.chosen.items()}
    fits = supervised.refit_and_test(fit.unionByName(validation), test, chosen, SPEC)
    assert {r.model for r in fits.metrics.collect()} == {"baseline", "linear", "forest"}
    folder = new_folder(spark, "test-models")
    document = supervised.metrics_document(
        {"fit": fit, "validation": validation, "test": test}, selection.chosen, selection.metrics, fits.metrics
    )
    assert document.first().partitions["test"] == test.count()
    supervised.save(fits.pipelines, document, folder)
    again = supervised.reverify(spark, folder, ["linear", "forest"], test, SPEC)
    assert again.count() == 8
    supervised.require_verified(again)
    fewer = supervised.reverify(spark, folder, ["linear"], test.limit(100), SPEC)
    with pytest.raises(CheckFailed):
        supervised.require_verified(fewer)

    predictions = {"linear": "prediction_linear", "forest": "prediction_forest"}
    edges = errors.band_edges(test, SPEC.target, exact=True)
    banded = errors.with_band(fits.scored, SPEC.target, edges)
    for group in ("nivel_educativo", "dominio", "band"):
        table = errors.errors_by_group(banded, SPEC.target, predictions, group)
        assert errors.uncovered(table, test.agg(F.count(F.lit(1))), ["model"]).isEmpty()
    each = errors.errors_by_groupings(banded, SPEC.target, predictions, ["nivel_educativo", "band"])
    one = errors.errors_by_group(banded, SPEC.target, predictions, "band")
    assert {(r.model, r.band, r.n) for r in each.filter("grouping = 'band'").collect()} == {
        (r.model, r.band, r.n) for r in one.collect()
    }
    points = errors.chart_points(fits.scored, [*SPEC.key, SPEC.target], list(SPEC.key), SPEC.target, predictions, 100)
    assert points.count() == 200
    assert points.groupBy(*SPEC.key).count().filter("count != 2").isEmpty()
    limits = errors.axis_limits(points).first()
    assert limits.lo <= 0 < limits.hi


def test_other_predictors_are_refused(spark, panel):
    stages = supervise.preprocessing_stages(("dominio",), ("edad",))
    model = Pipeline(stages=stages).fit(panel)
    with pytest.raises(ValueError, match="unexpected"):
        supervise.require_inputs(model, SPEC)


def test_bands_are_closed_above(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(1, 101)], "y double")
    banded = errors.with_band(frame, "y", errors.band_edges(frame, "y", exact=True))
    counts = {r.band: r["count"] for r in banded.groupBy("band").count().collect()}
    assert counts == {"P00-P50": 50, "P50-P75": 25, "P75-P90": 15, "P90-P95": 5, "P95-P100": 5}
    table = errors.percentile_table(errors.band_edges(frame, "y", exact=True), errors.BAND_PROBABILITIES)
    assert [tuple(r) for r in table.collect()] == [("P50", 50.0), ("P75", 75.0), ("P90", 90.0), ("P95", 95.0)]


def test_error_table_of_a_hot_group(spark):
    frame = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 100)).alias("g"),
        F.lit(2.0).alias("y"), F.lit(1.0).alias("p"),
    )
    rows = {r.g: r for r in errors.errors_by_group(frame, "y", {"m": "p"}, "g").collect()}
    assert (rows["hot"].n, rows["hot"].mae, rows["hot"].mean_error) == (3000, 1.0, 1.0)
