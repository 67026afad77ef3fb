import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from panelwright.operators import gram, supervise
from panelwright.session import stored

NUMERIC, CODES = ("a", "b"), ("c", "d")


@pytest.fixture(scope="module")
def rows(spark):
    """Three periods; one code holds a third of the rows, some have none, numbers lie far from zero."""
    generator = random.Random(8)
    made = []
    for i in range(900):
        a, b = generator.gauss(5_000, 3), generator.uniform(-1, 1)
        c = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"k{i % 5}"
        y = 1e6 + 7 * a - 50 * b + 20 * (c == "hot") + generator.gauss(0, 9)
        made.append((f"p{i % 3}", a, b, c, str(i % 2), y, 1.0))
    return spark.createDataFrame(made, "p string, a double, b double, c string, d string, y double, one double").cache()


def by_library(rows, config):
    stages = supervise.preprocessing_stages(CODES, NUMERIC)
    model = Pipeline(stages=[*stages, supervise.linear("y", config, max_iter=2000, tol=1e-12)]).fit(rows)
    return model.transform(rows).select("a", "prediction")


@pytest.mark.parametrize("name", list(supervise.LINEAR_CONFIGS))
def test_predictions_agree_with_the_library(rows, name):
    config = supervise.LINEAR_CONFIGS[name]
    known = rows.filter("c IS NOT NULL")  # the library gives NULL a slot, which fits differ by
    made = gram.design(known, NUMERIC, CODES, "y")
    sums = gram.matrix(gram.gram(known, "p", made), None, made)
    model = gram.solve(sums, made, config["regParam"], config["elasticNetParam"])
    mine = sorted((r.a, r.prediction) for r in known.select("a", model.prediction().alias("prediction")).collect())
    wanted = sorted((r.a, r.prediction) for r in by_library(known, config).collect())
    assert np.allclose([m[1] for m in mine], [w[1] for w in wanted], rtol=0, atol=2e-3)
    direct = known.agg(F.sqrt(F.avg((F.col("y") - model.prediction()) ** 2))).first()[0]
    assert math.isclose(gram.scores(sums, model)["rmse"], direct, rel_tol=1e-9)


def test_periods_add_up_and_refits_read_no_rows(rows):
    made = gram.design(rows, NUMERIC, CODES, "y")
    grams = stored(gram.gram(rows, "p", made), "gram")
    whole = gram.matrix(gram.gram(rows.withColumn("p", F.lit("all")), "p", made), None, made)
    parts = sum(gram.matrix(grams, [p], made) for p in ("p0", "p1", "p2"))
    assert np.allclose(parts, whole, rtol=1e-12)
    alone = gram.solve(gram.matrix(gram.gram(rows.filter("p <> 'p2'"), "p", made), None, made), made, 1.0)
    refit = gram.solve(gram.matrix(grams, ["p0", "p1"], made), made, 1.0)
    assert np.allclose(alone.coefficients, refit.coefficients, rtol=1e-10)


def test_grid(rows):
    made = gram.design(rows.filter("p <> 'p2'"), NUMERIC, CODES, "y")
    metrics, models, _ = gram.grid(rows, "p", ["p0", "p1"], ["p2"], made, supervise.LINEAR_CONFIGS)
    found = {r.model: r for r in metrics.collect()}
    assert set(found) == {"baseline", *supervise.LINEAR_CONFIGS}
    late = rows.filter("p = 'p2'")
    for name, model in models.items():
        scored = supervise.regression_metrics(late.withColumn("q", model.prediction()), "y", {name: "q"}).first()
        assert found[name].n == scored.n
        assert math.isclose(found[name].rmse, scored.rmse, rel_tol=1e-8)
        assert math.isclose(found[name].r2, scored.r2, rel_tol=1e-8)
    assert supervise.select_config(metrics, "baseline").first().model in models


def test_constant_features_and_labels(rows):
    made = gram.design(rows, ("one", "a"), (), "y")
    model = gram.solve(gram.matrix(gram.gram(rows, "p", made), None, made), made)
    assert model.coefficients[0] == 0 and model.coefficients[1] != 0
    flat = gram.design(rows, ("a",), (), "one")
    model = gram.solve(gram.matrix(gram.gram(rows, "p", flat), None, flat), flat, 1.0, 0.5)
    assert model.coefficients[0] == 0 and math.isclose(model.intercept, 1.0)


def test_what_cannot_be_fitted(rows, monkeypatch):
    made = gram.design(rows, NUMERIC, CODES, "y")
    with pytest.raises(Exception, match="a number is missing"):
        gram.gram(rows.withColumn("a", F.when(F.col("p") != "p0", F.col("a"))), "p", made).collect()
    with pytest.raises(ValueError, match="no rows"):
        gram.solve(gram.matrix(gram.gram(rows.limit(0), "p", made), None, made), made)
    monkeypatch.setattr(gram, "MOST_FEATURES", 5)
    with pytest.raises(ValueError, match="more than 5"):
        gram.design(rows, NUMERIC, CODES, "y")
