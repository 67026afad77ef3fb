import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import joins, percentiles, quality
from panelwright.operators.joins import join_aggregate


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows under one key, another lot under NULL, the rest spread thin."""
    generator = random.Random(4)
    keys = ["hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 211}" for i in range(6000)]
    return spark.createDataFrame([(k, generator.randrange(50), i) for i, k in enumerate(keys)], "k string, v int, i int").repartition(6).cache()


LIMITS = [(200_000, 50_000), (10, 3), (0, 1), (0, 1000)]


@pytest.mark.parametrize(("broadcast_rows", "hot_keys"), LIMITS)
@pytest.mark.parametrize("null_safe", [True, False])
def test_every_way_gives_the_same_rows(rows, broadcast_rows, hot_keys, null_safe):
    totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).filter("s % 2 = 0 or k = 'hot' or k is null")
    expected = {r.k: r.s for r in totals.collect() if null_safe or r.k is not None}
    found = join_aggregate(rows, totals, ["k"], "n", "inner", "test", null_safe, broadcast_rows, hot_keys).collect()
    wanted = [(r.k, r.v, r.i, expected[r.k]) for r in rows.collect() if r.k in expected]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    semi = join_aggregate(rows, totals, ["k"], "n", "left_semi", "test", null_safe, broadcast_rows, hot_keys)
    assert semi.columns == rows.columns
    assert sorted(r.i for r in semi.collect()) == sorted(w[2] for w in wanted)


def test_hot_keys_are_broadcast_and_the_rest_is_not(rows):
    totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = join_aggregate(rows, totals, ["k"], "n", "inner", "test", False, 10, 3)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert plan.count("strategy=broadcast") == 3


def test_operators_on_the_split_way(rows, monkeypatch):
    whole = {r.k: (r.n, r.percentiles) for r in percentiles.exact_percentiles(rows, ["k"], "v", [0.1, 0.5]).collect()}
    repeated = quality.rows_of_duplicated_keys(rows, ["k", "v"]).count()
    monkeypatch.setattr("panelwright.session.BROADCAST_ROWS", 5)
    monkeypatch.setattr(joins, "HOT_KEYS", 2)
    split = {r.k: (r.n, r.percentiles) for r in percentiles.exact_percentiles(rows, ["k"], "v", [0.1, 0.5]).collect()}
    assert split == whole
    assert quality.rows_of_duplicated_keys(rows, ["k", "v"]).count() == repeated
