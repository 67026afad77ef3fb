"""The stored label index against the library's, and its split lookup."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwright.operators import joins, labels, supervise
from panelwright.operators.joins import lookup
from panelwright.session import new_folder


@pytest.fixture(scope="module")
def coded(spark):
    """A third of the rows under one code, nulls, an empty code and a few hundred others."""
    code = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 31 == 0, None).when(F.col("id") % 37 == 0, "")
    return spark.range(4000).select("id", code.otherwise(F.concat(F.lit("c"), F.pmod(F.hash("id"), F.lit(211)))).alias("c"), (F.col("id") % 5).alias("d"))


def test_numbers_run_through_all_ranges(spark, monkeypatch):
    monkeypatch.setattr(labels, "RANGE_ROWS", 10)
    rows = spark.range(500).select((F.col("id") * 7919 % 500).alias("v"), F.col("id").alias("x"))
    found = labels.dense_numbers(rows, ["v"], "place", "test").collect()
    assert sorted((r.v, r.place) for r in found) == [(k, k) for k in range(500)]
    assert {(r.v, r.x) for r in found} == {(r.v, r.x) for r in rows.collect()}


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_index_agrees_with_the_library(coded, broadcast_rows, monkeypatch):
    monkeypatch.setattr("panelwright.session.BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(labels, "RANGE_ROWS", 50)
    fit = coded.filter("id < 1500")
    library = StringIndexer(inputCols=["c", "d"], outputCols=["ci", "di"], handleInvalid="keep", stringOrderType="alphabetAsc").fit(fit)
    mine = labels.LabelIndex(inputCols=["c", "d"], outputCols=["ci", "di"]).fit(fit)
    wanted = {r.id: (r.ci, r.di) for r in library.transform(coded).collect()}
    assert {r.id: (r.ci, r.di) for r in mine.transform(coded).collect()} == wanted


def test_unseen_labels(spark, coded):
    seen = coded.filter("c = 'hot' OR c = 'c1'")
    index = labels.label_index(seen, "c")
    assert {(r.label, r.idx) for r in index.collect()} == {("c1", 0), ("hot", 1)}
    skipped = labels.with_index(coded, index, 2, "c", "i", "skip")
    assert skipped.count() == seen.count()
    with pytest.raises(Exception, match="unseen label in c"):
        labels.with_index(coded, index, 2, "c", "i", "error").collect()
    with pytest.raises(ValueError, match="unknown way"):
        labels.with_index(coded, index, 2, "c", "i", "drop")


def test_empty_table(spark):
    none = spark.createDataFrame([], "c string")
    model = labels.LabelIndex(inputCols=["c"], outputCols=["i"]).fit(none)
    found = model.transform(spark.createDataFrame([("a",), (None,)], "c string")).collect()
    assert [r.i for r in found] == [0.0, 0.0]


def test_stages_of_many_codes_give_the_same_vectors(spark, coded):
    # The library's encoder takes no empty code.
    numbers = coded.filter("c <> '' OR c IS NULL").select("c", F.col("d").cast("string").alias("d"), F.col("id").cast("double").alias("x"), "id")
    fit = numbers.filter("id < 1500")
    few = Pipeline(stages=supervise.preprocessing_stages(("c", "d"), ("x",))).fit(fit)
    many = Pipeline(stages=supervise.preprocessing_stages(("c", "d"), ("x",), many=("c",))).fit(fit)
    folder = new_folder(spark, "many")
    many.save(folder)
    again = PipelineModel.load(folder)
    wanted = {r.id: r.v for r in few.transform(numbers).select("id", vector_to_array("features").alias("v")).collect()}
    for model in (many, again):
        assert {r.id: r.v for r in model.transform(numbers).select("id", vector_to_array("features").alias("v")).collect()} == wanted
    assert supervise.pipeline_inputs(again) == {"indexed": ["c", "d"], "raw": ["x"]}


def test_fits_with_many_codes(coded, monkeypatch):
    from panelwright.spec import PanelSpec

    spec = PanelSpec(period="d", key=(), source_columns=(), numeric={}, codes={}, rules=list, target="y", numeric_predictors=("x",), categorical_predictors=("c",))
    rows = coded.filter("c <> '' OR c IS NULL").select("d", "c", F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + F.length(F.coalesce("c", F.lit("")))).alias("y"))
    estimators = {"ridge": supervise.linear("y", supervise.LINEAR_CONFIGS["ridge_1"])}
    few = {r.model: r for r in supervise.fit_and_score(rows, rows, estimators, spec).metrics.collect()}
    monkeypatch.setattr(supervise, "MOST_CODES", 20)
    many = {r.model: r for r in supervise.fit_and_score(rows, rows, estimators, spec).metrics.collect()}
    for name in few:
        assert many[name].n == few[name].n
        assert many[name].rmse == pytest.approx(few[name].rmse, rel=1e-9)


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
@pytest.mark.parametrize("known", ["c != 'hot'", "true"])
def test_lookup_keeps_every_row(coded, broadcast_rows, known):
    table = coded.filter(known).groupBy(F.col("c").alias("k")).agg(F.max("id").alias("last"))
    of = {r.k: r.last for r in table.collect() if r.k is not None}
    found = lookup(coded, table.filter("k IS NOT NULL"), {"c": "k"}, "test", broadcast_rows)
    assert found.columns == ["id", "c", "d", "last"]
    assert sorted((r.id, r.last) for r in found.collect()) == sorted(((r.id, of.get(r.c)) for r in coded.collect()))


def test_hot_code_stays_and_no_ranking_in_one_task(coded):
    table = coded.filter("c IS NOT NULL").groupBy(F.col("c").alias("k")).agg(F.max("id").alias("last"))
    assert coded.filter("c = 'hot'").select(F.xxhash64("c").alias("h")).distinct().join(joins.heavy_keys(coded, ["c"]), "h").count() == 1
    split = lookup(coded, table, {"c": "k"}, "test", 0)
    totals = coded.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    inner = joins.join_aggregate(coded, totals, ["c"], "n", "inner", "test", True, 0, 3)
    for frame in (split, inner):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Limit" not in plan
    hot = split.filter("c = 'hot'")
    assert hot.count() == coded.filter("c = 'hot'").count()
