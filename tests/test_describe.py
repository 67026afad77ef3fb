import hashlib
import math
import random
import statistics
from fractions import Fraction

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from panelwright.functions.numeric import bias_label, log_bin
from panelwright.operators import describe, percentiles, relate, sampling
from panelwright.operators.percentiles import approx_percentiles, exact_percentiles
from panelwright.operators.reshape import to_long, to_wide, union_all

PROBABILITIES = [0.0, 0.25, 0.5, 0.95, 1.0]


def discrete(values, p):
    ordered = sorted(values)
    return ordered[max(math.ceil(p * len(ordered)), 1) - 1]


@settings(max_examples=10, deadline=None)
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=200))
def test_exact_percentiles_of_anything(spark, values):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_percentiles(frame, [], "v", PROBABILITIES).first()
    assert row.n == len(values)
    assert row.percentiles == [discrete(values, p) for p in PROBABILITIES]


def test_exact_percentiles_by_group_with_a_hot_group(spark):
    """One group holds a third of the rows; a coarse sketch leaves real work to the second pass."""
    generator = random.Random(7)
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", generator.choice([generator.random(), 0.5])) for i in range(30_000)]
    rows += [(None, 1.0), (None, 3.0), ("empty", None)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(8)
    found = {r.g: (r.n, r.percentiles) for r in exact_percentiles(frame, ["g"], "v", PROBABILITIES, accuracy=100).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    expected = {g: (len(v), [discrete(v, p) for p in PROBABILITIES]) for g, v in groups.items()}
    assert found == {**expected, "empty": (0, None)}


def test_percentiles_of_nothing(spark):
    frame = spark.createDataFrame([], "g string, v double")
    assert exact_percentiles(frame, [], "v", [0.5]).count() == 0
    assert exact_percentiles(frame, ["g"], "v", [0.5]).count() == 0


def test_sketch_is_close(spark):
    frame = spark.range(100_001).withColumn("v", F.col("id").cast("double"))
    row = approx_percentiles(frame, [], "v", [0.5, 0.95]).first()
    assert abs(row.percentiles[0] - 50_000) <= 20 and abs(row.percentiles[1] - 95_000) <= 20


@pytest.mark.parametrize("exact", [True, False])
def test_summary(spark, exact):
    values = [1.0, 2.0, 4.0, 8.0, 16.0, None]
    frame = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i int")
    rows = {r.variable: r for r in describe.summary(frame, ["v", "i"], exact=exact).collect()}
    v = rows["v"]
    assert (v.n, v.mean, v.lo, v.hi) == (5, 6.2, 1.0, 16.0)
    assert math.isclose(v.sd, statistics.stdev(values[:5]))
    assert (v.p25, v.p50, v.p75, v.p95) == (2.0, 4.0, 8.0, 16.0)
    assert rows["i"].n == 6
    gap = {r.variable: r.gap for r in describe.mean_median_gap(describe.summary(frame, ["v"], exact=exact)).collect()}
    assert math.isclose(gap["v"], 2.2)


def test_group_median_share_extremes(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", 5.0), ("b", 9.0), (None, 2.0)], "g string, v double")
    groups = describe.group_median(frame, ["g"], "v", exact=True)
    assert {(r.g, r.n, r.median) for r in groups.collect()} == {("a", 3, 3.0), ("b", 1, 9.0), (None, 1, 2.0)}
    assert {r.g: r.pct for r in describe.with_share(groups).collect()} == {"a": 60.0, "b": 20.0, None: 20.0}
    best = describe.extremes(groups.filter("g is not null"), "g").first()
    assert (best.top_group, best.hi_group, best.lo_group) == ("a", "b", "a")
    each = describe.medians_by_each(frame.filter("g is not null"), ["g"], "v")
    assert {(r.variable, r.code, r.n, r.median) for r in each.collect()} == {("g", "a", 3, 3.0), ("g", "b", 1, 9.0)}


def test_trend_and_histogram(spark):
    periods = spark.createDataFrame([("2025T1", 5, 10.0), ("2025T4", 9, 7.0), ("2025T2", 1, 1.0)], "p string, n int, m double")
    row = describe.trend_change(periods, "p", ["n", "m"]).first()
    assert tuple(row) == ("2025T1", "2025T4", 4, -3.0)
    bins = spark.createDataFrame([(1000.0,), (3000.0,), (9999.0,)], "v double").select(log_bin(F.col("v")).alias("b"))
    assert [r.b for r in bins.collect()] == [3.0, 3.25, 3.75]


def test_correlations_agree_with_the_library(spark):
    frame = spark.range(200).select(
        F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + F.sin("id")).alias("y"), F.cos("id").alias("z")
    )
    columns = ["x", "y", "z"]
    own = {(r.var_x, r.var_y): r.r for r in relate.correlations(frame, columns).collect()}
    library = {(r.var_x, r.var_y): r.r for r in relate.correlation_matrix(frame, columns).collect()}
    assert own.keys() == library.keys()
    assert all(math.isclose(own[k], library[k], abs_tol=1e-9) for k in own)
    assert relate.strongest(relate.correlations(frame, columns), "x").first().v == "y"


def test_bias_label(spark):
    frame = spark.createDataFrame([(1.0,), (-1.0,), (1e-12,)], "e double")
    assert [r[0] for r in frame.select(bias_label(F.col("e"), "u", "o", "n")).collect()] == ["u", "o", "n"]


def test_reshape(spark):
    frame = spark.createDataFrame([("a", 1, 2), ("b", 3, None)], "id string, x int, y int")
    long = to_long(frame, ["id"], ["x", "y"], "variable", "value")
    assert long.count() == 4
    wide = to_wide(long.filter("value is not null"), ["id"], "variable", ["x", "y"], "value")
    assert {tuple(r) for r in wide.collect()} == {("a", 1, 2), ("b", 3, 0)}
    other = spark.createDataFrame([(9, "c")], "y int, id string")
    both = union_all([frame, other], allow_missing=True).filter("id = 'c'").first()
    assert (both.id, both.x, both.y) == ("c", None, 9)


def test_hash_sample_ignores_partitioning(spark):
    frame = spark.range(5000).withColumn("v", F.col("id") % 7)
    samples = [
        sampling.hash_sample(f, ["id", "v"], ["id"], 50).collect() for f in (frame.repartition(3), frame.repartition(11))
    ]
    assert samples[0] == samples[1] and len(samples[0]) == 50
    assert sampling.random_sample(frame, limit=10).count() == 10
    assert sampling.preview(frame, ["v"], 5).count() == 5


def test_few_rows_but_the_sample_reach_the_last_task(spark):
    frame = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("d"))
    digests = sorted(hashlib.sha256(str(k).encode()).hexdigest() for k in range(20_000))
    for limit in (1, 16, 300, 5_000, 19_999, 20_000, 30_000):
        kept = sorted(r.d for r in sampling.least_hashes(frame.repartition(9), "d", limit).collect())
        assert kept == digests[: len(kept)] and min(limit, 20_000) <= len(kept) <= limit * 1.1 + 20
    assert sampling.hash_sample(frame.limit(0), ["id"], ["id"], 5).isEmpty()
    # A third of all rows are the same one, and it has the lowest hash.
    hot = min(range(100), key=lambda k: hashlib.sha256(str(k).encode()).hexdigest())
    rows = spark.range(100).unionByName(spark.range(50).select(F.lit(hot).cast("long").alias("id")))
    found = [r.id for r in sampling.hash_sample(rows, ["id"], ["id"], 60).collect()]
    plain = sorted(range(100), key=lambda k: hashlib.sha256(str(k).encode()).hexdigest())
    assert found == [hot] * 51 + plain[1:10]


def test_ranks_are_worked_out_in_decimals(spark):
    frame = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    wanted = [0.07, 0.29, 0.57, 0.58, 1.0]
    row = exact_percentiles(frame, [], "v", wanted).first()
    assert row.percentiles == [7.0, 29.0, 57.0, 58.0, 100.0] and row.n == 100


def test_brackets_are_cut_until_few_values_are_left(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "FEW", 3)
    monkeypatch.setattr(percentiles, "CELLS", 4)
    values = [float(x) for x in range(3000)] + [1e300, -1e300, float("inf"), float("-inf"), float("nan")] + [7.5] * 500
    rows = [("hot", v) for v in values] + [("small", 1.0), ("small", 2.0), ("none", None)]
    frame = spark.createDataFrame(rows, "k string, v double").repartition(5)
    cuts = [0.0, 0.001, 0.31, 0.5, 0.999, 1.0]
    found = {r.k: (r.n, r.percentiles) for r in exact_percentiles(frame, ["k"], "v", cuts, accuracy=50).collect()}
    order = sorted(values, key=lambda v: (v != v, v))
    wanted = [order[max(0, math.ceil(Fraction(str(p)) * len(order)) - 1)] for p in cuts]
    assert str(found["hot"]) == str((len(values), wanted))
    assert found["small"] == (2, [1.0, 1.0, 1.0, 1.0, 2.0, 2.0]) and found["none"] == (0, None)


def test_no_window_over_rows_that_grow(spark):
    frame = spark.range(50_000).select((F.col("id") % 3 == 0).alias("k"), F.rand(1).alias("v"))
    for keys in ([], ["k"]):
        plan = exact_percentiles(frame, keys, "v", [0.5, 0.9])._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Sort [" not in plan
