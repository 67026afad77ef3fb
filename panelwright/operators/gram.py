"""Linear models out of sums of products: one pass over the rows serves every period, penalty and refit."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.session import stored

# Predictors, codes included, whose matrix the driver solves; more raise.
MOST_FEATURES = 2_000
STEPS, PRECISION = 100_000, 1e-13


@dataclass(frozen=True)
class Design:
    """What a row's features are: shifted numbers, then a slot per code of each category; NULL and other codes have none.

    ``shifts`` are subtracted from the numbers and the label before products are summed, so that large means
    do not eat up their digits. They are the same for all periods, so matrices of periods add up.
    """

    numeric: tuple[str, ...]
    codes: dict[str, tuple[str, ...]]
    label: str
    shifts: dict[str, float]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *[f"{c}={v}" for c, values in self.codes.items() for v in values]]

    def entries(self) -> Column:
        """The row's values that are not zero, as (place, value): the constant at 0, features from 1, the label last."""
        def entry(place: Column | int, value: Column) -> Column:
            place = F.lit(place) if isinstance(place, int) else place
            return F.struct(place.cast("int").alias("i"), value.cast("double").alias("v"))

        found = [entry(0, F.lit(1.0))]
        found += [entry(k, F.col(c) - F.lit(self.shifts[c])) for k, c in enumerate(self.numeric, 1)]
        at = 1 + len(self.numeric)
        for column, values in self.codes.items():
            if values:
                places = F.create_map(*[F.lit(x) for k, v in enumerate(values) for x in (v, at + k)])
                found.append(entry(F.element_at(places, F.col(column).cast("string")), F.lit(1.0)))
            at += len(values)
        found.append(entry(at, F.col(self.label) - F.lit(self.shifts[self.label])))
        return F.filter(F.array(*found), lambda x: x["i"].isNotNull())


def design(rows: DataFrame, numeric: tuple[str, ...], categorical: tuple[str, ...], label: str) -> Design:
    """The design of some rows: means to shift by and the codes that occur, in one aggregation; too many codes raise."""
    every = [*numeric, label]
    few = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first() if categorical else {}
    if len(numeric) + sum(few[c] for c in categorical) > 2 * MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features")
    found = rows.agg(*[F.avg(c).alias(f"m{k}") for k, c in enumerate(every)], *[F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"c{k}") for k, c in enumerate(categorical)]).first()
    made = Design(
        tuple(numeric), {c: tuple(found[f"c{k}"]) for k, c in enumerate(categorical)}, label, {c: found[f"m{k}"] or 0.0 for k, c in enumerate(every)})
    if len(made.names) > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features")
    return made


def gram(rows: DataFrame, period: str, made: Design) -> DataFrame:
    """(period, i, j, value), i <= j: sums of products of any two entries of a row, of all periods in one aggregation.

    A row adds one product per pair of its own values, however many codes there are; tasks send sums only. NULL in a
    number or in the label is an error.
    """
    missing = F.lit(False)
    for c in (*made.numeric, made.label):
        missing = missing | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    whole = F.when(missing, F.raise_error(F.lit("a number is missing")).cast("boolean")).otherwise(F.lit(True))
    held = rows.filter(whole).select(F.col(period).alias("period"), made.entries().alias("e"))
    left = held.select("period", "e", F.explode("e").alias("x"))
    pairs = left.select("period", "x", F.explode("e").alias("y")).filter("x.i <= y.i")
    return pairs.groupBy("period", F.col("x.i").alias("i"), F.col("y.i").alias("j")).agg(F.sum(F.col("x.v") * F.col("y.v")).alias("value"))


def matrix(grams: DataFrame, periods: list | None, made: Design) -> np.ndarray:
    """The sum of some periods' matrices; at most MOST_FEATURES squared entries come to the driver."""
    size = len(made.names) + 2
    wanted = grams if periods is None else grams.filter(F.col("period").isin(*periods))
    out = np.zeros((size, size))
    for r in wanted.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


@dataclass(frozen=True)
class Linear:
    """A fitted model: a coefficient per feature, in the order of the design, and the intercept over unshifted numbers."""

    design: Design
    coefficients: np.ndarray
    intercept: float

    def prediction(self) -> Column:
        """The model as an expression over raw columns."""
        value = F.lit(float(self.intercept))
        for c, b in zip(self.design.numeric, self.coefficients, strict=False):
            value = value + F.col(c) * F.lit(float(b))
        at = len(self.design.numeric)
        for column, values in self.design.codes.items():
            if values:
                effects = F.create_map(*[F.lit(x) for v, b in zip(values, self.coefficients[at : at + len(values)], strict=True) for x in (v, float(b))])
                value = value + F.coalesce(F.element_at(effects, F.col(column).cast("string")), F.lit(0.0))
            at += len(values)
        return value


def solve(sums: np.ndarray, made: Design, penalty: float = 0.0, mix: float = 0.0) -> Linear:
    """Least squares with the penalty of the library: on standardised features, divided by the label's deviation.

    Ridge and plain fits are one linear system (the least-norm one where features are dependent); with a share ``mix`` of
    absolute penalty, coordinates descend in turn over the matrix. Features or labels that do not vary have no effect.
    """
    n = sums[0, 0]
    if not n:
        raise ValueError("no rows to fit")
    means = sums[0] / n
    covariance = sums / n - np.outer(means, means)
    spread = np.sqrt(np.maximum(np.diag(covariance), 0))
    scale, label = spread[1:-1], spread[-1]
    # Rounding leaves a constant feature a little spread.
    live = scale > 1e-9 * np.sqrt(np.maximum(np.diag(sums)[1:-1] / n, 1e-300))
    slopes = np.zeros(len(scale))
    if live.any() and label > 0:
        a = covariance[1:-1, 1:-1][np.ix_(live, live)] / np.outer(scale[live], scale[live])
        b = covariance[1:-1, -1][live] / (scale[live] * label)
        ridge, lasso = penalty * (1 - mix) / label, penalty * mix / label
        if lasso == 0:
            w = np.linalg.lstsq(a + ridge * np.eye(len(b)), b, rcond=1e-11 if ridge == 0 else None)[0]
        else:
            w = _descend(a, b, ridge, lasso)
        slopes[live] = w * label / scale[live]
    shifts = np.array([*[made.shifts[c] for c in made.numeric], *[0.0] * (len(scale) - len(made.numeric))])
    intercept = made.shifts[made.label] + means[-1] - float(slopes @ (means[1:-1] + shifts))
    return Linear(made, slopes, intercept)


def _descend(a: np.ndarray, b: np.ndarray, ridge: float, lasso: float) -> np.ndarray:
    """The least of w a w / 2 - b w + ridge w² / 2 + lasso |w|, by exact steps along one coordinate after another."""
    w, pull = np.zeros(len(b)), b.copy()  # pull is b - a w
    for _ in range(STEPS):
        moved = 0.0
        for k in range(len(b)):
            free = pull[k] + a[k, k] * w[k]
            new = math.copysign(max(abs(free) - lasso, 0.0), free) / (a[k, k] + ridge)
            if new != w[k]:
                pull -= a[:, k] * (new - w[k])
                moved = max(moved, abs(new - w[k]))
                w[k] = new
        if moved < PRECISION:
            break
    return w


def scores(sums: np.ndarray, model: Linear) -> dict[str, float]:
    """Rows, RMSE and R² of a model over the rows behind a matrix, without reading them again."""
    made, n = model.design, sums[0, 0]
    if not n:
        return {"n": 0, "rmse": None, "r2": None}
    base = model.intercept - made.shifts[made.label] + sum(b * made.shifts[c] for c, b in zip(made.numeric, model.coefficients, strict=False))
    w = np.array([-base, *-model.coefficients, 1.0])
    squares, total = max(0.0, float(w @ sums @ w)), sums[-1, -1] - sums[0, -1] ** 2 / n
    return {"n": int(n), "rmse": math.sqrt(squares / n), "r2": float(1 - squares / total) if total > 0 else None}


def grid(
    rows: DataFrame, period: str, fit: list, evaluated: list, made: Design, configs: dict[str, dict[str, float]], baseline: str = "baseline"
) -> tuple[DataFrame, dict[str, Linear], DataFrame]:
    """((model, n, rmse, r2) on the evaluated periods, the models, the stored matrices by period).

    Rows are read once for all periods and configurations. A refit over more periods is ``solve`` of ``matrix``
    with those periods, and reads nothing but the matrices.
    """
    grams = stored(gram(rows, period, made), "gram")
    fitted, held = matrix(grams, fit, made), matrix(grams, evaluated, made)
    models = {name: solve(fitted, made, c.get("regParam", 0.0), c.get("elasticNetParam", 0.0)) for name, c in configs.items()}
    mean = made.shifts[made.label] + fitted[0, -1] / fitted[0, 0]
    every = {baseline: Linear(made, np.zeros(len(made.names)), mean), **models}
    found = [(name, *[s[k] for k in ("n", "rmse", "r2")]) for name, m in every.items() for s in [scores(held, m)]]
    return rows.sparkSession.createDataFrame(found, "model string, n long, rmse double, r2 double"), models, grams
