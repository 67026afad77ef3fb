"""Encoding, baselines, regressions, selection of configurations, errors, re-verification."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwright.operators import errors, gram, rules, segment, supervise
from panelwright.operators.labels import LabelIndex, label_index
from panelwright.operators.percentiles import percentiles
from panelwright.operators.quality import duplicate_audit
from panelwright.operators.reshape import to_long, union_all
from panelwright.operators.sampling import hash_sample
from panelwright.plans import supervised
from panelwright.plans.checks import remaining_faults
from panelwright.session import new_folder, stored
from panelwright.sources.sinks import read_document, write_document, write_table
from panelwright.spec import PanelSpec
from workload.tables import ALLOWED, CLEAN, SPEC, judged, query, table

PRICE = "o_totalprice"


def _between(column: str, first: int, last: int) -> Column:
    """Bounds of whole years on the date itself, which reach the statistics of the files; a year taken of it does not."""
    return (F.col(column) >= F.lit(f"{first}-01-01").cast("timestamp")) & (F.col(column) < F.lit(f"{last + 1}-01-01").cast("timestamp"))


def _year(spark: SparkSession, sf: str, *years: int) -> DataFrame:
    orders = table(spark, sf, "orders").filter(_between("o_orderdate", min(years), max(years)))
    return supervise.in_periods(orders.withColumn("year", F.year("o_orderdate")), "year", list(years))


@query("""
SELECT c_mktsegment, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS idx, count(*) AS n FROM customer GROUP BY c_mktsegment""")
def q_string_index(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    indexer = supervise.preprocessing_stages(("c_mktsegment",), ())[0]
    indexed = indexer.fit(customer).transform(customer)
    return indexed.groupBy("c_mktsegment", F.col("c_mktsegment_idx").alias("idx")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH i AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS label FROM lineitem WHERE l_quantity <= 25))
SELECT l_orderkey, l_linenumber, CAST(coalesce(idx, (SELECT count(*) FROM i)) AS DOUBLE) AS idx FROM lineitem LEFT JOIN i ON label = CAST(l_partkey AS VARCHAR)""")
def q_label_index(spark: SparkSession, sf: str) -> DataFrame:
    """Parts numbered by the lines of small quantity, by an index that is a table; parts that it never saw share the last number."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    index = LabelIndex(inputCols=["l_partkey"], outputCols=["idx"]).fit(lines.filter("l_quantity <= 25"))
    return index.transform(lines).select("l_orderkey", "l_linenumber", "idx")


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS label, dense_rank() OVER (ORDER BY CAST(o_custkey AS VARCHAR)) - 1 AS idx, count(*) AS n FROM orders GROUP BY o_custkey""")
def q_label_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Customers numbered by range: every label, its place and its rows."""
    return label_index(table(spark, sf, "orders"), "o_custkey")


@query("""
SELECT c_mktsegment, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS s0, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS s1,
  CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING') THEN 1 ELSE 0 END AS s_unknown, count(*) AS n FROM customer GROUP BY c_mktsegment""")
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Slots by alphabetical index; segments the fit never saw share the last slot."""
    customer = table(spark, sf, "customer")
    seen = customer.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"))
    stages = supervise.preprocessing_stages(("c_mktsegment",), ("c_acctbal",))
    coded = Pipeline(stages=stages).fit(seen).transform(customer)
    slots = vector_to_array("c_mktsegment_ohe")
    coded = coded.select("c_mktsegment", *[slots[i].cast("int").alias(s) for i, s in enumerate(["s0", "s1", "s_unknown"])])
    return coded.groupBy("c_mktsegment", "s0", "s1", "s_unknown").agg(F.count(F.lit(1)).alias("n"))


BASELINE_SQL = """
WITH b AS (SELECT avg(o_totalprice) AS v FROM orders WHERE year(o_orderdate) IN (1995,1996,1997)),
e AS (SELECT o_totalprice AS y, o_totalprice - v AS r FROM orders CROSS JOIN b WHERE year(o_orderdate) = 1998)
SELECT round(avg(abs(r)), 6) AS mae, round(sqrt(avg(r*r)), 6) AS rmse, round(1 - sum(r*r) / (var_pop(y) * count(*)), 8) AS r2 FROM e"""


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({"mae": F.round("mae", 6), "rmse": F.round("rmse", 6), "r2": F.round("r2", 8)})


@query(BASELINE_SQL)
def q_baseline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = supervise.with_constant(_year(spark, sf, 1995, 1996, 1997), _year(spark, sf, 1998), PRICE)
    metrics = supervise.regression_metrics(scored, PRICE, {"mean": "prediction"})
    return _rounded(metrics).select("mae", "rmse", "r2")


@query("""
SELECT DISTINCT 'validation' AS "split", CAST(year(o_orderdate) AS INTEGER) AS period FROM orders WHERE year(o_orderdate) IN (1998, 1999)""")
def q_split_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Splits that hold other periods than they should; the validation split is wrong on purpose."""
    splits = {"fit": _year(spark, sf, 1995, 1996, 1997), "validation": _year(spark, sf, 1998, 1999)}
    faults = supervise.split_faults(splits, "year", {"fit": [1995, 1996, 1997], "validation": [1998]})
    return faults.select("split", F.explode("periods").alias("period"))


def _line_fit(spark: SparkSession, sf: str, config: dict):
    assembler = segment.assemble(["l_quantity"], "features")
    lines = assembler.transform(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice"))
    return supervise.linear("l_extendedprice", config).fit(lines)


@query("""
SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def q_ols(spark: SparkSession, sf: str) -> DataFrame:
    model = _line_fit(spark, sf, supervise.LINEAR_CONFIGS["sin_regularizacion"])
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 5), round(float(model.intercept), 4))], "slope double, intercept double"
    )


@query("""
SELECT round(covar_pop(l_extendedprice, l_quantity) / (var_pop(l_quantity) * (1 + 10.0 / stddev_samp(l_extendedprice))), 6) AS slope FROM lineitem""")
def q_ridge(spark: SparkSession, sf: str) -> DataFrame:
    model = _line_fit(spark, sf, supervise.LINEAR_CONFIGS["ridge_10"])
    return spark.createDataFrame([(round(float(model.coefficients[0]), 6),)], "slope double")


# One predictor has closed forms, so SQL can follow fit, validation and choice.
@query("""
WITH d AS (SELECT l_extendedprice AS y, l_quantity AS x, year(l_shipdate) AS yr FROM lineitem),
f AS (SELECT avg(y) AS my, avg(x) AS mx, covar_pop(y, x) AS cxy, var_pop(x) AS vx, stddev_samp(y) AS sy FROM d WHERE yr < 2000),
c AS (SELECT * FROM (VALUES ('sin_regularizacion', 0.0, 0.0), ('ridge_1', 1.0, 0.0), ('ridge_10', 10.0, 0.0), ('elastic_net_10', 10.0, 0.5)) AS v(model, penalty, mix)),
m AS (SELECT model, sign(cxy) * greatest(abs(cxy) / sqrt(vx) - mix * penalty, 0) / (sqrt(vx) * (1 + (1 - mix) * penalty / sy)) AS slope, my, mx FROM c CROSS JOIN f),
p AS (SELECT model, y, y - (my + slope * (x - mx)) AS r FROM d CROSS JOIN m WHERE yr >= 2000
      UNION ALL SELECT 'baseline', y, y - my FROM d CROSS JOIN f WHERE yr >= 2000),
t AS (SELECT model, sqrt(avg(r*r)) AS rmse FROM p GROUP BY model),
r AS (SELECT model, rmse, row_number() OVER (ORDER BY rmse, model) AS rn FROM t WHERE model <> 'baseline')
SELECT r.model AS config, round(r.rmse, 4) AS rmse, round(100 * (b.rmse - r.rmse) / b.rmse, 6) AS gain_pct
FROM r CROSS JOIN (SELECT rmse FROM t WHERE model = 'baseline') b WHERE rn = 1""")
def q_select_config(spark: SparkSession, sf: str) -> DataFrame:
    """Fits the four configurations before 2000, scores them and the baseline after, picks the lowest RMSE."""
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_shipdate")
    cut = F.lit("2000-01-01").cast("timestamp")
    spec = PanelSpec(
        period="l_shipdate", key=(), source_columns=(), numeric={}, codes={}, rules=list,
        target="l_extendedprice", numeric_predictors=("l_quantity",),
    )
    estimators = {n: supervise.linear("l_extendedprice", config) for n, config in supervise.LINEAR_CONFIGS.items()}
    fits = supervise.fit_and_score(lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut), estimators, spec)
    best = supervise.select_config(fits.metrics, supervise.BASELINE)
    return best.select(
        F.col("model").alias("config"), F.round("rmse", 4).alias("rmse"), F.round("gain_pct", 6).alias("gain_pct")
    )


LINES_SQL = "d AS (SELECT l_extendedprice AS y, l_quantity AS x, l_discount AS z, year(l_shipdate) AS yr FROM lineitem)"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_extendedprice", F.year("l_shipdate").alias("year"))


@query(f"""
WITH {LINES_SQL}, v AS (SELECT yr, [1.0, x - (SELECT avg(x) FROM d), z - (SELECT avg(z) FROM d), y - (SELECT avg(y) FROM d)] AS e FROM d)
SELECT CAST(yr AS INTEGER) AS period, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(sum(e[i + 1] * e[j + 1]) / count(*), 4) AS mean_product
FROM v CROSS JOIN (SELECT unnest(range(4)) AS i) CROSS JOIN (SELECT unnest(range(4)) AS j) WHERE i <= j GROUP BY ALL""")
def q_gram_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Sums of products per year, over the rows: all years in one aggregation."""
    lines = _lines(spark, sf)
    made = gram.design(lines, ("l_quantity", "l_discount"), (), "l_extendedprice")
    sums = stored(gram.gram(lines, "year", made), "gram")
    rows = sums.filter("i = 0 AND j = 0").select(F.col("period").alias("_p"), F.col("value").alias("_n"))
    return sums.join(rows, F.col("period") == F.col("_p")).select(
        "period", "i", "j", (F.round(F.col("value") / F.col("_n"), 4) + F.lit(0.0)).alias("mean_product"))


# Two predictors have closed forms for every penalty on squares.
@query(f"""
WITH {LINES_SQL}, f AS (SELECT avg(y) AS my, avg(x) AS mx, avg(z) AS mz, stddev_pop(y) AS sy, stddev_pop(x) AS sx, stddev_pop(z) AS sz,
  corr(x, z) AS xz, corr(x, y) AS xy, corr(z, y) AS zy FROM d WHERE yr < 2000),
c AS (SELECT * FROM (VALUES ('sin_regularizacion', 0.0), ('ridge_1', 1.0), ('ridge_10', 10.0)) AS v(model, penalty)),
k AS (SELECT *, 1 + penalty / sy AS g FROM c CROSS JOIN f),
m AS (SELECT model, my, mx, mz, (g * xy - xz * zy) / (g * g - xz * xz) * sy / sx AS bx, (g * zy - xz * xy) / (g * g - xz * xz) * sy / sz AS bz FROM k),
p AS (SELECT model, y, y - my - bx * (x - mx) - bz * (z - mz) AS r FROM d CROSS JOIN m WHERE yr >= 2000
      UNION ALL SELECT 'baseline', y, y - my FROM d CROSS JOIN f WHERE yr >= 2000)
SELECT model, count(*) AS n, round(sqrt(avg(r * r)), 4) AS rmse, round(1 - sum(r * r) / (var_pop(y) * count(*)), 8) AS r2 FROM p GROUP BY model""")
def q_gram_two_predictors(spark: SparkSession, sf: str) -> DataFrame:
    """Plain and ridge fits of two predictors, fitted and scored by sums of products of their periods."""
    lines = _lines(spark, sf)
    made = gram.design(lines, ("l_quantity", "l_discount"), (), "l_extendedprice")
    years = [r["year"] for r in lines.select("year").distinct().collect()]
    configs = {n: c for n, c in supervise.LINEAR_CONFIGS.items() if not c["elasticNetParam"]}
    metrics, _, _ = gram.grid(lines, "year", [y for y in years if y < 2000], [y for y in years if y >= 2000], made, configs)
    return metrics.withColumns({"rmse": F.round("rmse", 4), "r2": F.round("r2", 8)})


# One predictor has a closed form for both kinds of penalty, so SQL can follow the refit over more periods.
@query(f"""
WITH {LINES_SQL}, f AS (SELECT avg(y) AS my, avg(x) AS mx, covar_pop(y, x) AS cxy, var_pop(x) AS vx, stddev_pop(y) AS sy FROM d WHERE yr <= 2000),
c AS (SELECT * FROM (VALUES ('sin_regularizacion', 0.0, 0.0), ('ridge_1', 1.0, 0.0), ('ridge_10', 10.0, 0.0), ('elastic_net_10', 10.0, 0.5)) AS v(model, penalty, mix)),
m AS (SELECT model, sign(cxy) * greatest(abs(cxy) / sqrt(vx) - mix * penalty, 0) / (sqrt(vx) * (1 + (1 - mix) * penalty / sy)) AS slope, my, mx FROM c CROSS JOIN f)
SELECT model, round(slope, 5) AS slope, round(my - slope * mx, 3) AS intercept, round(sqrt(avg(power(y - my - slope * (x - mx), 2))), 4) AS rmse
FROM d CROSS JOIN m WHERE yr > 2000 GROUP BY model, slope, my, mx""")
def q_gram_refit(spark: SparkSession, sf: str) -> DataFrame:
    """The four configurations refitted over more years by adding matrices up: coefficients, and RMSE on the years after."""
    lines = _lines(spark, sf)
    made = gram.design(lines, ("l_quantity",), (), "l_extendedprice")
    years = [r["year"] for r in lines.select("year").distinct().collect()]
    _, _, grams = gram.grid(lines, "year", [y for y in years if y < 2000], [2000], made, supervise.LINEAR_CONFIGS)
    fit, test = (gram.matrix(grams, chosen, made) for chosen in ([y for y in years if y <= 2000], [y for y in years if y > 2000]))
    rows = []
    for name, config in supervise.LINEAR_CONFIGS.items():
        model = gram.solve(fit, made, config["regParam"], config["elasticNetParam"])
        rows.append((name, round(float(model.coefficients[0]), 5), round(float(model.intercept), 3), round(gram.scores(test, model)["rmse"], 4)))
    return spark.createDataFrame(rows, "model string, slope double, intercept double, rmse double")


@query(f"""
WITH e AS (SELECT * FROM ({CLEAN}) c WHERE first_fail = 0), f AS (SELECT * FROM e WHERE substr(period, 1, 4) < '1999')
SELECT unnest({list(supervise.LINEAR_CONFIGS)!r}) AS model, count(*) AS n, true AS optimal FROM f""")
def q_gram_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the panel's four models meet their optimality conditions, from a scan of the rows that knows nothing of the matrices."""
    fit, _, _ = _panel(spark, sf)
    made = gram.design(fit, SPEC.numeric_predictors, SPEC.categorical_predictors, SPEC.target)
    sums = gram.matrix(stored(gram.gram(fit, "period", made), "gram"), None, made)
    models = {n: gram.solve(sums, made, c["regParam"], c["elasticNetParam"]) for n, c in supervise.LINEAR_CONFIGS.items()}
    features = [F.col(c) for c in made.numeric] + [F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for c, values in made.codes.items() for v in values]
    named = {f"x{k}": x for k, x in enumerate(features)}
    scored = fit.select(SPEC.target, *[x.alias(k) for k, x in named.items()], *[(F.col(SPEC.target) - m.prediction()).alias(f"r_{n}") for n, m in models.items()])
    found = scored.agg(
        F.count(F.lit(1)).alias("n"), F.stddev_pop(SPEC.target).alias("sy"), *[F.stddev_pop(k).alias(f"s_{k}") for k in named],
        *[F.covar_pop(k, f"r_{n}").alias(f"c_{k}_{n}") for k in named for n in models], *[F.avg(f"r_{n}").alias(f"m_{n}") for n in models]).first()
    rows = []
    for name, config in supervise.LINEAR_CONFIGS.items():
        l2, l1 = ((config["regParam"] * part) / found["sy"] for part in (1 - config["elasticNetParam"], config["elasticNetParam"]))
        worst = abs(found[f"m_{name}"]) / found["sy"]
        for k, b in zip(named, models[name].coefficients, strict=True):
            if not (spread := found[f"s_{k}"]):
                continue
            w, pull = b * spread / found["sy"], found[f"c_{k}_{name}"] / (spread * found["sy"])
            worst = max(worst, max(0.0, abs(pull) - l1) if w == 0 else abs(pull - l2 * w - (l1 if w > 0 else -l1)))
        rows.append((name, found["n"], bool(worst < 1e-6)))
    return spark.createDataFrame(rows, "model string, n long, optimal boolean")


def _constants(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of 2000 with two constant predictions fitted on the years before."""
    orders, cut = table(spark, sf, "orders"), F.lit("2000-01-01").cast("timestamp")
    fit, test = orders.filter(F.col("o_orderdate") < cut), orders.filter(_between("o_orderdate", 2000, 2000))
    median = percentiles(fit, [], PRICE, [0.5], exact=True).select(F.col("percentiles")[0])
    scored = supervise.with_constant(fit, test, PRICE, "by_mean")
    return scored.withColumn("by_median", median.scalar())


CONSTANTS = {"mean": "by_mean", "median": "by_median"}
CONSTANTS_SQL = """p AS (
  SELECT 'mean' AS model, o.*, (SELECT avg(o_totalprice) FROM orders WHERE year(o_orderdate) < 2000) AS prediction FROM orders o WHERE year(o_orderdate) = 2000
  UNION ALL SELECT 'median', o.*, (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) FROM orders WHERE year(o_orderdate) < 2000) FROM orders o WHERE year(o_orderdate) = 2000)"""


@query(f"""
WITH {CONSTANTS_SQL}, m AS (SELECT model, count(*) AS n, avg(abs(o_totalprice - prediction)) AS mae,
  sqrt(avg(power(o_totalprice - prediction, 2))) AS rmse, 1 - sum(power(o_totalprice - prediction, 2)) / (var_pop(o_totalprice) * count(*)) AS r2 FROM p GROUP BY model)
SELECT model, n, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 8) AS r2, CAST(row_number() OVER (ORDER BY rmse, model) AS INTEGER) AS place,
  round(100 * ((SELECT rmse FROM m WHERE model = 'mean') - rmse) / (SELECT rmse FROM m WHERE model = 'mean'), 6) AS gain_pct FROM m""")
def q_comparison(spark: SparkSession, sf: str) -> DataFrame:
    metrics = supervise.regression_metrics(_constants(spark, sf), PRICE, CONSTANTS)
    rows = supervise.comparison(metrics, "mean")
    return _rounded(rows).withColumn("gain_pct", F.round("gain_pct", 6))


@query(f"""
WITH {CONSTANTS_SQL}, z AS (SELECT *, year(o_orderdate) AS yr FROM p), t AS (SELECT model, month(o_orderdate) <= 6 AS first_half, sqrt(avg(power(o_totalprice - prediction, 2))) AS rmse FROM z GROUP BY model, month(o_orderdate) <= 6),
w AS (SELECT first_half, min_by(model, rmse) AS winner FROM t GROUP BY first_half)
SELECT a.winner AS validation_winner, b.winner AS test_winner, a.winner = b.winner AS same FROM w a JOIN w b ON a.first_half AND NOT b.first_half""")
def q_same_winner(spark: SparkSession, sf: str) -> DataFrame:
    """Winner on the first half of the year against the winner on the second."""
    scored = _constants(spark, sf).withColumn("first_half", F.month("o_orderdate") <= 6)
    halves = [
        supervise.regression_metrics(scored.filter(F.col("first_half") == h), PRICE, CONSTANTS) for h in (True, False)
    ]
    return supervise.same_winner(*halves, baseline="baseline")


@query("""
WITH b AS (SELECT avg(o_totalprice) AS v FROM orders)
SELECT o_orderpriority AS grp, count(*) AS n, round(avg(abs(o_totalprice - v)), 6) AS mae, round(avg(o_totalprice - v), 6) AS mean_error,
  CASE WHEN abs(avg(o_totalprice - v)) < 1e-9 THEN 'none' WHEN avg(o_totalprice - v) > 0 THEN 'under' ELSE 'over' END AS bias
FROM orders CROSS JOIN b GROUP BY o_orderpriority""")
def q_error_by_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    scored = supervise.with_constant(orders, orders, PRICE)
    rows = errors.errors_by_group(scored, PRICE, {"mean": "prediction"}, "o_orderpriority")
    rows = errors.with_bias(rows, "under", "over", "none").drop("model")
    return rows.withColumnRenamed("o_orderpriority", "grp").withColumns(
        {"mae": F.round("mae", 6), "mean_error": F.round("mean_error", 6)}
    )


@query("""
WITH q AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS p50, percentile_disc(0.75) WITHIN GROUP (ORDER BY o_totalprice) AS p75,
  percentile_disc(0.9) WITHIN GROUP (ORDER BY o_totalprice) AS p90, percentile_disc(0.95) WITHIN GROUP (ORDER BY o_totalprice) AS p95, avg(o_totalprice) AS v FROM orders),
z AS (SELECT o_totalprice - v AS r, CASE WHEN o_totalprice <= p50 THEN 'P00-P50' WHEN o_totalprice <= p75 THEN 'P50-P75'
  WHEN o_totalprice <= p90 THEN 'P75-P90' WHEN o_totalprice <= p95 THEN 'P90-P95' ELSE 'P95-P100' END AS band FROM orders CROSS JOIN q)
SELECT band, count(*) AS n, round(avg(abs(r)), 6) AS mae, round(avg(r), 6) AS mean_error FROM z GROUP BY band""")
def q_error_by_band(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    scored = supervise.with_constant(orders, orders, PRICE)
    banded = errors.with_band(scored, PRICE, errors.band_edges(orders, PRICE, exact=True))
    rows = errors.errors_by_group(banded, PRICE, {"mean": "prediction"}, "band").drop("model")
    return rows.withColumns({"mae": F.round("mae", 6), "mean_error": F.round("mean_error", 6)})


@query(f"""
WITH {CONSTANTS_SQL}, r AS (SELECT model, o_orderpriority AS prio, o_orderstatus AS st, o_totalprice - prediction AS r FROM p)
SELECT model, prio, st, count(*) AS n, round(avg(abs(r)), 6) AS mae, round(avg(r), 6) AS mean_error FROM r GROUP BY GROUPING SETS ((model, prio), (model, st))""")
def q_error_by_model(spark: SparkSession, sf: str) -> DataFrame:
    scored = _constants(spark, sf).withColumnsRenamed({"o_orderpriority": "prio", "o_orderstatus": "st"})
    rows = errors.errors_by_groupings(scored, PRICE, CONSTANTS, ["prio", "st"]).drop("grouping")
    return rows.withColumns({"mae": F.round("mae", 6), "mean_error": F.round("mean_error", 6)})


@query(f"""
WITH {CONSTANTS_SQL}, c AS (SELECT model, o_orderpriority AS prio, count(*) AS n FROM p WHERE o_orderpriority <> '1-URGENT' OR model = 'mean' GROUP BY model, o_orderpriority)
SELECT model, CAST(sum(n) AS BIGINT) AS n, (SELECT count(*) FROM orders WHERE year(o_orderdate) = 2000) AS expected FROM c GROUP BY model
HAVING sum(n) <> (SELECT count(*) FROM orders WHERE year(o_orderdate) = 2000)""")
def q_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Models whose groups do not add up to the test rows; one group of one model is left out on purpose."""
    scored = _constants(spark, sf)
    rows = errors.errors_by_group(scored, PRICE, CONSTANTS, "o_orderpriority")
    partial = rows.filter((F.col("o_orderpriority") != "1-URGENT") | (F.col("model") == "mean"))
    return errors.uncovered(partial, scored.agg(F.count(F.lit(1))), ["model"])


@query(f"""
WITH {CONSTANTS_SQL}, s AS (SELECT DISTINCT o_orderkey, sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), o_orderstatus)) AS h FROM p ORDER BY h, o_orderkey LIMIT 5000)
SELECT o_orderkey, model, o_totalprice AS actual, round(prediction, 6) AS predicted, round(o_totalprice - prediction, 6) AS residual FROM p JOIN s USING (o_orderkey)""")
def q_chart_points(spark: SparkSession, sf: str) -> DataFrame:
    points = errors.chart_points(
        _constants(spark, sf), ["o_orderkey", "o_orderstatus"], ["o_orderkey"], PRICE, CONSTANTS
    )
    return points.withColumns({"predicted": F.round("predicted", 6), "residual": F.round("residual", 6)})


@query(f"""
WITH {CONSTANTS_SQL}, s AS (SELECT DISTINCT o_orderkey, sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), o_orderstatus)) AS h FROM p ORDER BY h, o_orderkey LIMIT 5000)
SELECT round(least(0.0, min(o_totalprice), min(prediction)), 6) AS lo, round(greatest(max(o_totalprice), max(prediction)), 6) AS hi FROM p JOIN s USING (o_orderkey)""")
def q_axis_limits(spark: SparkSession, sf: str) -> DataFrame:
    points = errors.chart_points(
        _constants(spark, sf), ["o_orderkey", "o_orderstatus"], ["o_orderkey"], PRICE, CONSTANTS
    )
    return errors.axis_limits(points).select(F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


# A tree grown to its end on two codes predicts the mean of each pair of codes.
@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_extendedprice), 6) AS prediction FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_tree_means(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    grown = {
        "numTrees": 1, "maxDepth": 8, "bootstrap": False, "subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 1,
    }
    tree = supervise.forest("l_extendedprice", grown)
    stages = supervise.preprocessing_stages(("l_returnflag", "l_linestatus"), ())
    scored = Pipeline(stages=[*stages, tree]).fit(lines).transform(lines)
    return scored.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 6).alias("prediction")
    )


def _panel(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Eligible rows split in time: fit before 1999, validation in 1999, test after.

    Prepared once and written by period; every split reads the files of its periods only.
    """
    rows = rules.eligible(judged(spark, sf), SPEC, ALLOWED).select("period", "row_id", *SPEC.predictors, SPEC.target)
    folder = new_folder(spark, "panel")
    write_table(rows, folder, "period", mixed=True)
    prepared = spark.read.schema(rows.schema).parquet(folder)
    return (
        prepared.filter(F.col("period") < "1999T1"), prepared.filter(F.col("period").between("1999T1", "1999T4")),
        prepared.filter(F.col("period") > "1999T4"),
    )


def _check(frame: DataFrame, condition, message: str) -> DataFrame:
    """Rows pass through; one that breaks the condition stops the query."""
    held = F.coalesce(condition, F.lit(False))
    return frame.filter(F.when(held, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


PANEL_PARTS_SQL = f"""e AS (SELECT * FROM ({CLEAN}) c WHERE first_fail = 0), f AS (SELECT * FROM e WHERE substr(period, 1, 4) < '1999'),
v AS (SELECT * FROM e WHERE substr(period, 1, 4) = '1999'), t AS (SELECT * FROM e WHERE substr(period, 1, 4) > '1999')"""


def _scores_sql(models: list[str], rows: str, fit: str) -> str:
    """Rows and baseline metrics per model; what a fitted model scores is only known to be a number."""
    residual = f"pay - (SELECT avg(pay) FROM {fit})"
    return f"""SELECT unnest({models!r}) AS model, count(*) AS n, true AS scored, round(avg(abs({residual})), 4) AS baseline_mae,
  round(sqrt(avg(power({residual}, 2))), 4) AS baseline_rmse FROM {rows}"""


def _scores(metrics: DataFrame) -> DataFrame:
    base = [F.max(F.when(F.col("model") == supervise.BASELINE, F.round(m, 4))) for m in ("mae", "rmse")]
    mae, rmse = (metrics.agg(b).scalar() for b in base)
    scored = (F.col("mae") > 0) & (F.col("rmse") >= F.col("mae")) & (F.col("r2") <= 1)
    return metrics.select("model", "n", scored.alias("scored"), mae.alias("baseline_mae"), rmse.alias("baseline_rmse"))


@query(f"""
WITH {PANEL_PARTS_SQL}, s AS ({_scores_sql(["baseline", *supervise.LINEAR_CONFIGS], "v", "f")}) SELECT *, CAST(1 AS BIGINT) AS n_chosen FROM s""")
def q_linear_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The four linear configurations on the validation period next to the baseline."""
    fit, validation, _ = _panel(spark, sf)
    selection = supervised.select(fit, validation, {"linear": _families()["linear"]}, SPEC)
    chosen = selection.metrics.agg(F.count_if(F.col("model") == selection.chosen["linear"]))
    return _scores(selection.metrics).withColumn("n_chosen", chosen.scalar())


PANEL_SQL = f"p AS (SELECT * FROM ({CLEAN}) c WHERE first_fail = 0 AND substr(period, 1, 4) < '1999')"


# Least squares with an intercept and a slot per code leaves no mean residual in any code of the fit rows.
@query(f"""
WITH {PANEL_SQL}
SELECT 'edu' AS "grouping", edu AS code, count(*) AS n, round(avg(pay), 4) AS mean_pay, true AS fitted FROM p GROUP BY edu
UNION ALL SELECT 'class_code', class_code, count(*), round(avg(pay), 4), true FROM p GROUP BY class_code
UNION ALL SELECT 'domain', domain, count(*), round(avg(pay), 4), true FROM p GROUP BY domain""")
def q_linear_fitted_means(spark: SparkSession, sf: str) -> DataFrame:
    """The unpenalised fit scored on its own rows: mean prediction against mean pay per code."""
    fit, _, _ = _panel(spark, sf)
    estimator = {"ols": supervise.linear(SPEC.target, supervise.LINEAR_CONFIGS["sin_regularizacion"])}
    scored = supervise.fit_and_score(fit, fit, estimator, SPEC).scored
    codes = list(SPEC.categorical_predictors)
    long = to_long(scored.select(*codes, SPEC.target, "prediction_ols"), [SPEC.target, "prediction_ols"], codes, "grouping", "code")
    gap = F.avg("prediction_ols") - F.avg("pay")
    return long.groupBy("grouping", "code").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("pay"), 4).alias("mean_pay"),
        (F.abs(gap) < 1e-5 * F.avg("pay")).alias("fitted"),
    )


@query(f"""
WITH {PANEL_SQL}, v AS (SELECT pay, pay - (SELECT avg(pay) FROM p) AS r FROM ({CLEAN}) c WHERE first_fail = 0 AND substr(period, 1, 4) = '1999')
SELECT 'baseline' AS model, count(*) AS n, round(avg(abs(r)), 4) AS mae, round(sqrt(avg(r*r)), 4) AS rmse, round(1 - sum(r*r) / (var_pop(pay) * count(*)), 8) AS r2 FROM v""")
def q_panel_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """The baseline row of a validation run over the prepared panel."""
    fit, validation, _ = _panel(spark, sf)
    estimator = {"ridge_1": supervise.linear(SPEC.target, supervise.LINEAR_CONFIGS["ridge_1"])}
    metrics = supervise.fit_and_score(fit, validation, estimator, SPEC).metrics
    rows = metrics.filter(F.col("model") == supervise.BASELINE)
    return rows.withColumns({"mae": F.round("mae", 4), "rmse": F.round("rmse", 4), "r2": F.round("r2", 8)})


@query(f"""
WITH {PANEL_PARTS_SQL} SELECT unnest({list(supervise.FOREST_CONFIGS)!r}) AS model, count(*) AS n, true AS inside,
  round((SELECT min(pay) FROM f), 4) AS fit_lo, round((SELECT max(pay) FROM f), 4) AS fit_hi FROM v""")
def q_forest_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Both forests; predictions stay inside the range of the fitted target."""
    fit, validation, _ = _panel(spark, sf)
    fits = supervise.fit_and_score(fit, validation, _families()["forest"], SPEC)
    span = fit.agg(F.struct(F.min("pay").alias("lo"), F.max("pay").alias("hi"))).scalar()
    names = list(supervise.FOREST_CONFIGS)
    ranges = fits.scored.agg(*[
        F.struct(F.lit(n).alias("model"), F.count(F.lit(1)).alias("n"), F.min(f"prediction_{n}").alias("lowest"), F.max(f"prediction_{n}").alias("highest")).alias(n)
        for n in names
    ]).select(F.inline(F.array(*names))).withColumn("span", span)
    inside = (F.col("lowest") >= F.col("span.lo")) & (F.col("highest") <= F.col("span.hi")) & (F.col("lowest") < F.col("highest"))
    return ranges.select("model", "n", inside.alias("inside"), F.round("span.lo", 4).alias("fit_lo"), F.round("span.hi", 4).alias("fit_hi"))


def _families() -> dict:
    return {
        "linear": {n: supervise.linear(SPEC.target, config) for n, config in supervise.LINEAR_CONFIGS.items()},
        "forest": {n: supervise.forest(SPEC.target, config) for n, config in supervise.FOREST_CONFIGS.items()},
    }


def _refit(spark: SparkSession, sf: str):
    fit, validation, test = _panel(spark, sf)
    families = _families()
    selection = supervised.select(fit, validation, families, SPEC)
    chosen = {family: families[family][name] for family, name in selection.chosen.items()}
    fits = supervised.refit_and_test(union_all([fit, validation]), test, chosen, SPEC)
    return selection, fits, (fit, validation, test)


@query(f"""
WITH {PANEL_PARTS_SQL}, fv AS (SELECT * FROM f UNION ALL SELECT * FROM v), s AS ({_scores_sql(["baseline", "linear", "forest"], "t", "fv")})
SELECT *, true AS placed FROM s""")
def q_refit_test(spark: SparkSession, sf: str) -> DataFrame:
    """Selection over all configurations, refit on all earlier periods, one test: models and baseline compared."""
    _, fits, _ = _refit(spark, sf)
    rows = supervise.comparison(fits.metrics, supervise.BASELINE)
    places = rows.agg(F.array_sort(F.collect_set("place")) == F.array(F.lit(1), F.lit(2), F.lit(3))).scalar()
    return _scores(fits.metrics).withColumn("placed", places)


@query(f"""
WITH {PANEL_PARTS_SQL}, q AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY pay) AS p50, percentile_disc(0.75) WITHIN GROUP (ORDER BY pay) AS p75,
  percentile_disc(0.9) WITHIN GROUP (ORDER BY pay) AS p90, percentile_disc(0.95) WITHIN GROUP (ORDER BY pay) AS p95 FROM t),
b AS (SELECT t.*, CASE WHEN pay <= p50 THEN 'P00-P50' WHEN pay <= p75 THEN 'P50-P75' WHEN pay <= p90 THEN 'P75-P90' WHEN pay <= p95 THEN 'P90-P95' ELSE '{errors.LAST_BAND}' END AS band FROM t CROSS JOIN q),
g AS (SELECT 'edu' AS "grouping", edu AS code, count(*) AS n FROM b GROUP BY edu UNION ALL SELECT 'domain', domain, count(*) FROM b GROUP BY domain
      UNION ALL SELECT 'band', band, count(*) FROM b GROUP BY band)
SELECT m.model, g."grouping", g.code, g.n, true AS sound FROM g CROSS JOIN (SELECT unnest(['linear', 'forest']) AS model) m""")
def q_model_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of the refitted models by code and by exact band of pay, over the whole test period."""
    _, fits, (_, _, test) = _refit(spark, sf)
    predictions = {n: supervise.prediction_column(n) for n in ("linear", "forest")}
    banded = errors.with_band(fits.scored, SPEC.target, errors.band_edges(test, SPEC.target, exact=True))
    rows = errors.with_bias(errors.errors_by_groupings(banded, SPEC.target, predictions, ["edu", "domain", "band"]))
    code = F.coalesce(*[F.when(F.col("grouping") == g, F.col(g)) for g in ("edu", "domain", "band")])
    sound = (F.col("mae") >= F.abs("mean_error") - 1e-9) & F.col("bias").isNotNull()
    return rows.select("model", "grouping", code.alias("code"), "n", sound.alias("sound"))


@query(f"""
WITH {PANEL_PARTS_SQL}, n AS (SELECT 'fit' AS metric, count(*) AS n FROM f UNION ALL SELECT 'validation', count(*) FROM v UNION ALL SELECT 'test', count(*) FROM t)
SELECT m.model, x.metric, true AS agrees, CASE WHEN x.metric = 'n' THEN (SELECT CAST(n AS DOUBLE) FROM n WHERE metric = 'test') END AS "rows"
FROM (SELECT unnest(['linear', 'forest']) AS model) m CROSS JOIN (SELECT unnest(['n', 'mae', 'rmse', 'r2']) AS metric) x
UNION ALL SELECT 'partition', metric, true, CAST(n AS DOUBLE) FROM n""")
def q_model_reverify(spark: SparkSession, sf: str) -> DataFrame:
    """Saved pipelines and metrics document, reloaded, rescored and compared, partition sizes included."""
    selection, fits, (fit, validation, test) = _refit(spark, sf)
    folder = new_folder(spark, "models")
    partitions = {"fit": fit, "validation": validation, "test": test}
    every = {n: e for family in _families().values() for n, e in family.items()}
    document = supervised.metrics_document(partitions, selection.chosen, selection.metrics, fits.metrics, supervised.settings(every))
    supervised.save(fits.pipelines | {f"{family}_validation": p for family, p in selection.pipelines.items()}, document, folder)
    rows = supervised.reverify(spark, folder, list(fits.pipelines), test, SPEC, partitions=partitions)
    counted = F.when((F.col("metric") == "n") | (F.col("model") == "partition"), F.col("observed"))
    return rows.select("model", "metric", "agrees", counted.alias("rows"))


@query(BASELINE_SQL)
def q_metrics_document(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics written as a nested document and read back."""
    fit, test = _year(spark, sf, 1995, 1996, 1997), _year(spark, sf, 1998)
    scored = supervise.with_constant(fit, test, PRICE)
    metrics = supervise.regression_metrics(scored, PRICE, {"mean": "prediction"})
    folder = new_folder(spark, "document")
    write_document(supervised.metrics_document({"fit": fit, "test": test}, {}, metrics, metrics), folder)
    again = read_document(spark, folder, supervised.METRICS_SCHEMA).select(F.inline("test"))
    return _rounded(again).select("mae", "rmse", "r2")


@query(f"""
WITH {CONSTANTS_SQL}, e AS (SELECT model, o_orderpriority, count(*) AS n FROM p GROUP BY model, o_orderpriority),
c AS (SELECT * FROM ({CLEAN}) x)
SELECT 'conflicting_keys' AS "check", CAST((SELECT count(*) FROM (SELECT row_id FROM c GROUP BY row_id HAVING count(DISTINCT period) > 1) k) AS BIGINT) AS faults
UNION ALL SELECT 'remaining_rows', CAST((SELECT count(*) FROM (SELECT period FROM c GROUP BY period HAVING count(*) <> count(*) FILTER (first_fail = 0) + count(*) FILTER (first_fail <> 0)) k) AS BIGINT)
UNION ALL SELECT 'group_sizes', CAST((SELECT count(*) FROM (SELECT model FROM e GROUP BY model HAVING sum(n) <> (SELECT count(*) FROM orders WHERE year(o_orderdate) = 2000)) k) AS BIGINT)
UNION ALL SELECT 'sample_size', CAST((SELECT least(count(*), 5000) FROM orders WHERE year(o_orderdate) = 2000) AS BIGINT)
UNION ALL SELECT 'split_periods', CAST((SELECT count(*) FROM (SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) < 2000 INTERSECT SELECT year(o_orderdate) FROM orders WHERE year(o_orderdate) = 2000) k) AS BIGINT)""")
def q_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """The closing checks of a run, in a fixed order; each counts its offenders."""
    rows = judged(spark, sf)
    scored = _constants(spark, sf)
    by_group = errors.errors_by_group(scored, PRICE, CONSTANTS, "o_orderpriority")
    sample = hash_sample(scored, ["o_orderkey", "o_orderstatus"], ["o_orderkey"])
    size = F.count(F.lit(1))
    years = {"fit": _year(spark, sf, *range(1990, 2000)), "test": _year(spark, sf, 2000)}
    both = union_all([f.select("year", F.lit(name).alias("split")).distinct() for name, f in years.items()])
    offenders = {
        "conflicting_keys": duplicate_audit(rows, ["row_id"], ["period"]).agg(F.sum("conflicts").alias("faults")),
        "remaining_rows": remaining_faults(rules.eligible(rows, SPEC), rules.waterfall(rows, SPEC), SPEC).agg(size.alias("faults")),
        "group_sizes": errors.uncovered(by_group, scored.agg(size), ["model"]).agg(size.alias("faults")),
        # Not an offence but a size: as many rows as there are, up to the limit.
        "sample_size": sample.agg(size.alias("faults")),
        "split_periods": both.groupBy("year").agg(size.alias("splits")).filter("splits > 1").agg(size.alias("faults")),
    }
    report = union_all([f.select(F.lit(name).alias("check"), F.col("faults").cast("long").alias("faults")) for name, f in offenders.items()])
    return report.orderBy("check")
