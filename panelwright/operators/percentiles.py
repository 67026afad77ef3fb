"""Percentiles: the approximate sketch, and exact ones that never gather a whole group."""

from __future__ import annotations

import sys
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.joins import join_aggregate, same_keys
from panelwright.session import sized, stored

ACCURACY = 10_000
# Cells that a bracket is cut into, and distinct values that are put in order within one row.
CELLS, FEW = 1_024, 4_096
_MOST = sys.float_info.max


def exact_percentiles(
    frame: DataFrame,
    keys: list[str],
    value: str,
    probabilities: list[float],
    accuracy: int = ACCURACY,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Per key group: ``n`` non-null values and ``percentiles`` (discrete, as an array of doubles).

    Pass 1 sketches, per group, a narrow bracket around every wanted percentile, and takes
    along any other aggregates asked for in ``also``.
    Pass 2 counts rows: those outside all brackets collapse, map-side, into one run
    per gap between brackets; only values inside a bracket (about ``6 / accuracy`` of
    the rows) keep their identity. Brackets are cut into cells of equal width whose counts
    are added up; the cell that holds the wanted rank is cut again until it has few distinct
    values, which alone are put in order. So no group is ever gathered or ordered as a whole.
    The picked value is checked to lie inside a bracket, so the result is exact or an error.
    """
    also = also or {}
    if also and not keys:
        raise ValueError("other aggregates need a grouping")
    margin = 3.0 / accuracy
    wanted = sorted(set(probabilities))
    edges = [e for p in wanted for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    rows = frame.withColumn("_v", F.col(value).cast("double"))
    guess = F.percentile_approx("_v", F.array(*[F.lit(e) for e in edges]), F.lit(accuracy))
    # The outermost edges are the ends themselves, as a sketch need not hold a NaN or an infinity.
    ends = {0.0: F.min("_v"), 1.0: F.max("_v")}
    sketch = F.array(*[ends.get(e, F.get(guess, F.lit(i))) for i, e in enumerate(edges)]).alias("_edges")
    values = rows.select(*keys, "_v").filter(F.col("_v").isNotNull())
    if keys:
        others = [aggregate.alias(name) for name, aggregate in also.items()]
        brackets = stored(rows.groupBy(*keys).agg(sketch, F.count("_v").alias("_values"), *others), "groups")
        narrow = brackets.select(*keys, "_edges", "_values")
        bracketed = join_aggregate(values, narrow, keys, "_values", "inner", None, null_safe=True)
    else:
        bracketed = values.withColumn("_edges", rows.agg(sketch).scalar())

    low = [F.col("_edges")[2 * i] for i in range(len(wanted))]
    high = [F.col("_edges")[2 * i + 1] for i in range(len(wanted))]
    inside, passed = F.lit(False), F.lit(0)
    for lo, hi in zip(low, high, strict=True):
        inside = inside | F.col("_v").between(lo, hi)
        passed = passed + (F.col("_v") > hi).cast("int")
    by = keys or ["_all"]
    bracket = F.struct(F.get(F.array(*low), F.col("_gap")).alias("lo"), F.get(F.array(*high), F.col("_gap")).alias("hi"))
    runs = stored(
        bracketed.withColumns({"_gap": passed, "_kept": F.when(inside, F.col("_v"))} | ({} if keys else {"_all": F.lit(0)}))
        .withColumn("_cell", F.when(F.col("_kept").isNull(), -1).otherwise(_cell(F.col("_v"), bracket["lo"], bracket["hi"])))
        .groupBy(*by, "_gap", "_cell", "_kept")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_from")),
        "percentile-runs",
    )
    # The discrete percentile is the value at rank ceil(p * n), worked out in decimals.
    ranks = F.array(*[
        F.struct(F.lit(i).alias("_i"), F.ceil(F.lit(Decimal(str(p))) * F.col("_n").cast("decimal(20,0)")).cast("long").alias("_rank"))
        for i, p in enumerate(wanted)
    ])
    first = _cells(runs, by).withColumn("_r", F.explode(ranks))
    picks = stored(_picked(first, [*by, "_n"], F.col("_r._i"), F.col("_r._rank")), "percentile-cells")
    while (picks.agg(F.max("_members")).first()[0] or 0) > FEW:
        found = stored(_candidates(runs, picks, by), "percentile-values")
        # Cut at quantiles of the distinct values that are left, so that each round leaves a small part of them.
        steps = F.array(*[F.lit(k / 64) for k in range(1, 64)])
        cuts = found.groupBy(*by, "_i").agg(F.percentile_approx("_from", steps, F.lit(1_000)).alias("_cuts"))
        cuts = sized(cuts.withColumnsRenamed({k: f"_c_{k}" for k in [*by, "_i"]}), "percentile-cuts")
        placed = found.join(cuts, same_keys([*by, "_i"], "_c_", null_safe=True))
        below = F.size(F.filter("_cuts", lambda e: e < F.col("_from")))
        cut = placed.withColumns({"_cell": below, "_gap": F.lit(0)})
        again = _cells(cut, [*by, "_i"], also=["_n", "_rank"]).drop("_total")
        picks = stored(_picked(again, [*by, "_n"], F.col("_i"), F.col("_rank")), "percentile-cells")
    values = _candidates(runs, picks, by).groupBy(*by, "_i", "_n", "_rank").agg(
        F.array_sort(F.collect_list(F.struct(F.col("_from").alias("lo"), F.col("_rows").alias("rows")))).alias("_list")
    )
    found = values.select(*by, "_n", "_i", _at_rank(F.col("_list"), F.col("_rank"))["lo"].alias("_value"))
    picked = found.groupBy(*by).agg(
        F.max("_n").alias("n"), *[F.max(F.when(F.col("_i") == i, F.col("_value"))).alias(f"_p{i}") for i in range(len(wanted))]
    )
    order = [wanted.index(p) for p in probabilities]
    result = picked.select(*keys, "n", F.array(*[F.col(f"_p{i}") for i in order]).alias("percentiles"))
    if not keys:
        return result.filter(F.col("n").isNotNull())
    # Groups without any value come back from the first pass.
    found = result.withColumnsRenamed({k: f"_f_{k}" for k in keys})
    joined = brackets.join(found, same_keys(keys, "_f_", null_safe=True), "left")
    return joined.select(*keys, F.coalesce("n", F.lit(0)).cast("long").alias("n"), "percentiles", *also)


def _cell(value: Column, lo: Column, hi: Column) -> Column:
    """Number of the cell of equal width that a value between two ends lies in; infinities and NaN count as the largest."""
    def half(x: Column) -> Column:
        return F.when(F.isnan(x), F.lit(_MOST)).otherwise(F.greatest(F.least(x, F.lit(_MOST)), F.lit(-_MOST))) / 2

    place = F.floor(F.try_divide(half(value) - half(lo), half(hi) - half(lo)) * CELLS)
    return F.least(F.coalesce(place, F.lit(0)), F.lit(CELLS - 1)).cast("int")


def _cells(runs: DataFrame, by: list[str], also: list[str] | None = None) -> DataFrame:
    """Per group its cells in order, as one array: at most CELLS for each bracket and one for each gap."""
    also = also or []
    cells = runs.groupBy(*by, *also, "_gap", "_cell").agg(
        F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("members"), F.min("_from").alias("lo"), F.max("_from").alias("hi")
    )
    listed = F.array_sort(F.collect_list(F.struct("_gap", "_cell", "rows", "members", "lo", "hi")))
    return cells.groupBy(*by, *also).agg(F.sum("rows").alias("_total" if also else "_n"), listed.alias("_list"))


def _at_rank(cells: Column, rank: Column) -> Column:
    """The first element at which the running sum of rows reaches the rank, with ``rest``: the rank within it."""
    def step(state: Column, cell: Column) -> Column:
        reached = state["cell"].isNotNull()
        return F.struct(
            F.when(reached, state["sum"]).otherwise(state["sum"] + cell["rows"]).alias("sum"),
            F.when(reached, state["cell"]).when(state["sum"] + cell["rows"] >= rank, cell).alias("cell"),
        )

    none = F.get(cells, F.lit(-1))
    start = F.struct(F.lit(0).cast("long").alias("sum"), none.alias("cell"))
    return F.aggregate(cells, start, step, lambda s: s["cell"].withField("rest", rank - (s["sum"] - s["cell"]["rows"])))


def _picked(cells: DataFrame, keep: list[str], number: Column, rank: Column) -> DataFrame:
    """(keep, _i, _rank within the cell, its ends and distinct values) of the cell that holds each rank."""
    found = cells.select(*keep, number.alias("_i"), _at_rank(F.col("_list"), rank).alias("_c"))
    outside = F.raise_error(F.lit("percentile outside its bracket; raise accuracy")).cast("bigint")
    rest = F.when(F.col("_c._cell") < 0, outside).otherwise(F.col("_c.rest"))
    return found.select(
        *keep, "_i", rest.alias("_rank"), F.col("_c.lo").alias("_lo"), F.col("_c.hi").alias("_hi"), F.col("_c.members").alias("_members")
    )


def _candidates(runs: DataFrame, picks: DataFrame, by: list[str]) -> DataFrame:
    """The distinct values inside the picked cells, with the rank wanted of them."""
    wanted = sized(picks.withColumnsRenamed({k: f"_w_{k}" for k in by}), "percentile-picks")
    on = same_keys(by, "_w_", null_safe=True)
    joined = runs.filter(F.col("_kept").isNotNull()).join(wanted, on)
    return joined.filter(F.col("_from").between(F.col("_lo"), F.col("_hi"))).drop(*[f"_w_{k}" for k in by])


def approx_percentiles(
    frame: DataFrame, keys: list[str], value: str, probabilities: list[float], accuracy: int = ACCURACY
) -> DataFrame:
    """The same shape from one sketch pass; rank error at most ``n / accuracy``."""
    return frame.groupBy(*keys).agg(
        F.count(value).alias("n"),
        F.percentile_approx(
            F.col(value).cast("double"), F.array(*[F.lit(p) for p in probabilities]), F.lit(accuracy)
        ).alias("percentiles"),
    )


def percentiles(
    frame: DataFrame, keys: list[str], value: str, probabilities: list[float], exact: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    chosen = exact_percentiles if exact else approx_percentiles
    return chosen(frame, keys, value, probabilities, accuracy)
