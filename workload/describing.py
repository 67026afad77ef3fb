"""Summaries, medians, shares, trends, correlations, samples and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.operators import describe, relate, sampling
from panelwright.operators.errors import BAND_PROBABILITIES, percentile_table
from panelwright.operators.percentiles import ACCURACY, approx_percentiles, percentiles
from panelwright.operators.reshape import to_long, to_wide, union_all
from panelwright.operators.segment import composition
from panelwright.sources.codelist import with_labels
from workload.tables import query, table

LINE_MEASURES = ["l_extendedprice", "l_quantity", "l_discount"]


def ranks_hold(frame: DataFrame, keys: list[str], value: str, picks: DataFrame) -> DataFrame:
    """(keys, place, n, within): whether each sketched value lies as near its rank as the accuracy promises.

    ``picks`` has (keys, place, p, pick); rows below and up to each pick are counted over the whole frame.
    """
    rows = frame.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    joined = rows.join(F.broadcast(picks), keys) if keys else rows.withColumn("_k", F.lit(0)).join(F.broadcast(picks.withColumn("_k", F.lit(0))), "_k")
    counted = joined.groupBy(*keys, "place", "p").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_v") < F.col("pick")).alias("below"), F.count_if(F.col("_v") <= F.col("pick")).alias("upto")
    )
    slack = F.col("n") / ACCURACY + 1
    wanted = F.col("p") * F.col("n")
    within = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return counted.select(*keys, "place", "n", within.alias("within"))


@query("""
SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 6) AS mean, round(stddev_samp(l_extendedprice), 6) AS sd,
  min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
  percentile_disc(0.25) WITHIN GROUP (ORDER BY l_extendedprice) AS p25, percentile_disc(0.5) WITHIN GROUP (ORDER BY l_extendedprice) AS p50,
  percentile_disc(0.75) WITHIN GROUP (ORDER BY l_extendedprice) AS p75, percentile_disc(0.95) WITHIN GROUP (ORDER BY l_extendedprice) AS p95
FROM lineitem""")
def q_describe(spark: SparkSession, sf: str) -> DataFrame:
    rows = describe.summary(table(spark, sf, "lineitem"), ["l_extendedprice"], exact=True)
    return rows.drop("variable").withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


def _one(column: str) -> str:
    return f"""SELECT '{column}' AS variable, count({column}) AS n, round(avg({column}), 6) AS mean, round(stddev_samp({column}), 6) AS sd,
  min({column}) AS lo, max({column}) AS hi, percentile_disc(0.25) WITHIN GROUP (ORDER BY {column}) AS p25,
  percentile_disc(0.5) WITHIN GROUP (ORDER BY {column}) AS p50, percentile_disc(0.75) WITHIN GROUP (ORDER BY {column}) AS p75,
  percentile_disc(0.95) WITHIN GROUP (ORDER BY {column}) AS p95 FROM lineitem"""


@query(" UNION ALL ".join(_one(c) for c in LINE_MEASURES))
def q_describe_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = describe.summary(table(spark, sf, "lineitem"), LINE_MEASURES, exact=True)
    return rows.withColumns({"mean": F.round("mean", 6), "sd": F.round("sd", 6)})


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, unnest([0, 1, 2, 3]) AS place, count({c}) AS n, round(avg({c}), 6) AS mean, min({c}) AS lo, max({c}) AS hi, true AS within FROM lineitem"
    for c in LINE_MEASURES))
def q_describe_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """The default mode, all measures in one pass; its percentiles held against their ranks in the table."""
    lines = table(spark, sf, "lineitem")
    rows = describe.summary(lines, LINE_MEASURES)
    cuts = F.array(*[
        F.struct(F.lit(i).alias("place"), F.lit(p).alias("p"), F.col(f"p{round(100 * p)}").alias("pick"))
        for i, p in enumerate(describe.SUMMARY_PERCENTILES)
    ])
    long = to_long(lines.select(*[F.col(c).cast("double").alias(c) for c in LINE_MEASURES]), [], LINE_MEASURES, "variable", "value")
    held = ranks_hold(long, ["variable"], "value", rows.select("variable", F.inline(cuts)))
    return rows.select("variable", F.round("mean", 6).alias("mean"), "lo", "hi").join(held, "variable")


@query("""
SELECT c_mktsegment, count(*) AS n, percentile_disc(0.5) WITHIN GROUP (ORDER BY c_acctbal) AS median_bal,
  CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS DOUBLE) AS pct
FROM customer GROUP BY c_mktsegment""")
def q_group_median(spark: SparkSession, sf: str) -> DataFrame:
    groups = describe.group_median(table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal", exact=True)
    shares = describe.with_share(groups).withColumn("pct", F.round("pct", 6))
    return shares.withColumnRenamed("median", "median_bal")


@query("""
SELECT 'o_orderstatus' AS variable, o_orderstatus AS code, count(*) AS n, true AS within FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*), true FROM orders GROUP BY o_orderpriority""")
def q_medians_by_each(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and sketched medians by several single columns from one scan, the medians held against their ranks."""
    orders, groups = table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"]
    rows = describe.medians_by_each(orders, groups, "o_totalprice")
    picks = rows.select("variable", "code", F.lit(0).alias("place"), F.lit(0.5).alias("p"), F.col("median").alias("pick"))
    long = to_long(orders.select(*groups, "o_totalprice"), ["o_totalprice"], groups, "variable", "code")
    held = ranks_hold(long, ["variable", "code"], "o_totalprice", picks).select("variable", "code", "within")
    return rows.drop("median").join(held, ["variable", "code"])


@query("""
SELECT floor(log10(o_totalprice) * 4) / 4 AS log_bin, count(*) AS n FROM orders GROUP BY floor(log10(o_totalprice) * 4) / 4""")
def q_log_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return describe.log_histogram(table(spark, sf, "orders"), "o_totalprice")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(quarter(o_orderdate) AS INTEGER) AS qtr, count(*) AS n,
  percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS median_price
FROM orders GROUP BY year(o_orderdate), quarter(o_orderdate)""")
def q_period_trend(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("yr"), F.quarter("o_orderdate").alias("qtr"), "o_totalprice"
    )
    rows = describe.group_median(orders, ["yr", "qtr"], "o_totalprice", exact=True)
    return rows.withColumnRenamed("median", "median_price")


@query("""
WITH g AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n FROM orders GROUP BY year(o_orderdate))
SELECT a.yr AS first_yr, b.yr AS last_yr, b.n - a.n AS change FROM g a CROSS JOIN g b WHERE a.yr = (SELECT min(yr) FROM g) AND b.yr = (SELECT max(yr) FROM g)""")
def q_trend_change(spark: SparkSession, sf: str) -> DataFrame:
    periods = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    return describe.trend_change(periods, "yr", ["n"]).withColumnsRenamed(
        {"first_period": "first_yr", "last_period": "last_yr", "n_change": "change"}
    )


@query("""
WITH g AS (SELECT o_orderpriority AS grp, count(*) AS n, percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS med FROM orders GROUP BY o_orderpriority)
SELECT (SELECT max(med) FROM g) AS hi, (SELECT min(med) FROM g) AS lo, (SELECT max(n) FROM g) AS top_n,
  (SELECT grp FROM g ORDER BY n DESC, grp DESC LIMIT 1) AS top_group, (SELECT grp FROM g ORDER BY med DESC, grp DESC LIMIT 1) AS hi_group,
  (SELECT grp FROM g ORDER BY med, grp LIMIT 1) AS lo_group""")
def q_group_extremes(spark: SparkSession, sf: str) -> DataFrame:
    groups = describe.group_median(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice", exact=True)
    return describe.extremes(groups, "o_orderpriority")


@query("""
SELECT round(avg(o_totalprice) - percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice), 6) AS gap FROM orders""")
def q_mean_median_gap(spark: SparkSession, sf: str) -> DataFrame:
    rows = describe.summary(table(spark, sf, "orders"), ["o_totalprice"], exact=True)
    return describe.mean_median_gap(rows).select(F.round("gap", 6).alias("gap"))


@query("""
WITH q AS (SELECT percentile_disc(0.5) WITHIN GROUP (ORDER BY o_totalprice) AS p50, percentile_disc(0.95) WITHIN GROUP (ORDER BY o_totalprice) AS p95, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT 'P50' AS name, p50 AS value FROM q UNION ALL SELECT 'P95', p95 FROM q UNION ALL SELECT 'MIN', lo FROM q UNION ALL SELECT 'MAX', hi FROM q
UNION ALL SELECT 'TAIL_ROWS', CAST(count(*) AS DOUBLE) FROM orders CROSS JOIN q WHERE o_totalprice > p95""")
def q_percentile_table(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    cuts = percentiles(orders, [], "o_totalprice", [0.5, 0.95], exact=True).select("percentiles")
    tail = orders.filter(F.col("o_totalprice") > cuts.scalar()[1])
    ends = orders.agg(F.min("o_totalprice").alias("MIN"), F.max("o_totalprice").alias("MAX"))
    return union_all([
        percentile_table(cuts, [0.5, 0.95]),
        to_long(ends, [], ["MIN", "MAX"], "name", "value"),
        tail.agg(F.lit("TAIL_ROWS").alias("name"), F.count(F.lit(1)).cast("double").alias("value")),
    ])


@query("""
SELECT o_orderpriority, unnest([0, 1, 2, 3]) AS place, count(*) AS n, true AS within FROM orders GROUP BY o_orderpriority""")
def q_percentile_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """Approximate percentiles by group in one pass, held against their ranks."""
    orders = table(spark, sf, "orders")
    rows = approx_percentiles(orders, ["o_orderpriority"], "o_totalprice", BAND_PROBABILITIES)
    named = F.arrays_zip(F.array(*[F.lit(p) for p in BAND_PROBABILITIES]).alias("p"), F.col("percentiles").alias("pick"))
    picks = rows.select("o_orderpriority", F.posexplode(named).alias("place", "x")).select("o_orderpriority", "place", "x.p", "x.pick")
    return ranks_hold(orders, ["o_orderpriority"], "o_totalprice", picks)


@query("""
SELECT round(corr(l_quantity, l_extendedprice), 8) AS r_qty_price, round(corr(l_quantity, l_discount), 8) AS r_qty_disc,
  round(corr(l_extendedprice, l_discount), 8) AS r_price_disc FROM lineitem""")
def q_correlation(spark: SparkSession, sf: str) -> DataFrame:
    matrix = relate.correlations(table(spark, sf, "lineitem"), LINE_MEASURES)
    wanted = {
        "r_qty_price": ("l_quantity", "l_extendedprice"),
        "r_qty_disc": ("l_quantity", "l_discount"),
        "r_price_disc": ("l_extendedprice", "l_discount"),
    }
    return matrix.agg(
        *[
            F.round(F.max(F.when((F.col("var_x") == x) & (F.col("var_y") == y), F.col("r"))), 8).alias(name)
            for name, (x, y) in wanted.items()
        ]
    )


@query(" UNION ALL ".join(
    f"SELECT '{x}' AS var_x, '{y}' AS var_y, round(corr({x}, {y}), 8) AS r FROM lineitem"
    for x in LINE_MEASURES for y in LINE_MEASURES
))
def q_correlation_matrix(spark: SparkSession, sf: str) -> DataFrame:
    matrix = relate.correlation_matrix(table(spark, sf, "lineitem"), LINE_MEASURES)
    return matrix.withColumn("r", F.round("r", 8))


@query("""
SELECT v, round(r, 8) AS r FROM (SELECT v, r, row_number() OVER (ORDER BY abs(r) DESC, v) AS rn FROM (
  SELECT 'l_quantity' AS v, corr(l_extendedprice, l_quantity) AS r FROM lineitem UNION ALL SELECT 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', corr(l_extendedprice, l_tax) FROM lineitem) a) b WHERE rn = 1""")
def q_strongest_corr(spark: SparkSession, sf: str) -> DataFrame:
    matrix = relate.correlations(table(spark, sf, "lineitem"), [*LINE_MEASURES, "l_tax"])
    return relate.strongest(matrix, "l_extendedprice").withColumn("r", F.round("r", 8))


@query("""
SELECT l_returnflag AS cluster, l_linestatus AS grp, count(*) AS n,
  CAST(round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY l_returnflag), 6) AS DOUBLE) AS pct FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_cluster_composition(spark: SparkSession, sf: str) -> DataFrame:
    rows = composition(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
    return rows.select(
        F.col("l_returnflag").alias("cluster"), F.col("l_linestatus").alias("grp"), "n", F.round("pct", 6).alias("pct")
    )


@query("""
SELECT l_returnflag, CAST(coalesce(sum(CASE WHEN l_linestatus = 'F' THEN 1 END), 0) AS BIGINT) AS f_rows,
  CAST(coalesce(sum(CASE WHEN l_linestatus = 'O' THEN 1 END), 0) AS BIGINT) AS o_rows FROM lineitem GROUP BY l_returnflag""")
def q_pivot(spark: SparkSession, sf: str) -> DataFrame:
    wide = to_wide(table(spark, sf, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"])
    return wide.withColumnsRenamed({"F": "f_rows", "O": "o_rows"})


@query("""
SELECT l_returnflag, 'quantity' AS feature, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT l_returnflag, 'discount', round(avg(l_discount), 6) FROM lineitem GROUP BY l_returnflag""")
def q_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    means = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.avg("l_quantity"), 6).alias("quantity"), F.round(F.avg("l_discount"), 6).alias("discount")
    )
    return to_long(means, ["l_returnflag"], ["quantity", "discount"], "feature", "mean")


@query("""
SELECT src, count(*) AS n, round(sum(bal), 2) AS total FROM (SELECT 'customer' AS src, c_acctbal AS bal FROM customer
  UNION ALL SELECT 'supplier', s_acctbal FROM supplier) u GROUP BY src""")
def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    both = union_all([
        table(spark, sf, "customer").select(F.lit("customer").alias("src"), F.col("c_acctbal").alias("bal")),
        table(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), F.lit("supplier").alias("src")),
    ])
    return both.groupBy("src").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("bal"), 2).alias("total"))


@query("""
SELECT coalesce(r.r_name, 'UNKNOWN') AS label, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) r ON n_regionkey = r.r_regionkey GROUP BY coalesce(r.r_name, 'UNKNOWN')""")
def q_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    region = table(spark, sf, "region").filter("r_regionkey < 3")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    labelled = with_labels(placed, region, {"n_regionkey": "r_regionkey"}, "r_name", "label", "UNKNOWN")
    return labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT o_orderkey, o_custkey FROM orders ORDER BY sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), coalesce(o_orderstatus, '<NULL>'))), o_orderkey LIMIT 5000""")
def q_hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    sample = sampling.hash_sample(
        table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"], ["o_orderkey"]
    )
    return sample.select("o_orderkey", "o_custkey")


@query("SELECT least(count(*), 5000) AS n, least(count(*), 5000) AS different, least(count(*), 5000) AS of_the_table FROM orders")
def q_random_sample(spark: SparkSession, sf: str) -> DataFrame:
    """A seeded sample: its size, how many different rows it has and how many of them the table holds."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return _membership(sampling.random_sample(orders), orders)


@query("SELECT least(count(*), 5) AS n, least(count(*), 5) AS different, least(count(*), 5) AS of_the_table FROM orders")
def q_preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows as they come: as many as asked for, all of them the table's."""
    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderdate", "o_totalprice"]
    return _membership(sampling.preview(orders, columns), orders.select(*columns))


def _membership(sample: DataFrame, whole: DataFrame) -> DataFrame:
    held = sample.join(whole.withColumn("_in", F.lit(1)), whole.columns, "left")
    return held.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(*whole.columns).alias("different"), F.count("_in").alias("of_the_table")
    )
