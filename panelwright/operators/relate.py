"""Pearson correlations."""

from __future__ import annotations

from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from panelwright.operators.segment import assemble


def correlations(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation matrix as labelled rows (var_x, var_y, r); one aggregation for all pairs."""
    pairs = [(x, y) for i, x in enumerate(columns) for y in columns[i:]]
    one_row = frame.agg(*[F.corr(x, y).alias(f"r_{x}__{y}") for x, y in pairs])

    def cell(x: str, y: str):
        a, b = (x, y) if (x, y) in pairs else (y, x)
        return F.struct(F.lit(x).alias("var_x"), F.lit(y).alias("var_y"), F.col(f"r_{a}__{b}").alias("r"))

    return one_row.select(F.inline(F.array(*[cell(x, y) for x in columns for y in columns])))


def correlation_matrix(frame: DataFrame, columns: list[str], method: str = "pearson") -> DataFrame:
    """The same rows through the ML library's matrix over an assembled vector."""
    vectors = assemble(columns, "corr_features").transform(frame.select(*columns)).select("corr_features")
    matrix = Correlation.corr(vectors, "corr_features", method).first()[0]
    spark = frame.sparkSession
    cells = [
        (x, y, float(matrix[i, j])) for i, x in enumerate(columns) for j, y in enumerate(columns)
    ]
    return spark.createDataFrame(cells, "var_x string, var_y string, r double")


def strongest(matrix: DataFrame, target: str) -> DataFrame:
    """The variable most correlated with the target in absolute value, ties by name."""
    others = matrix.filter((F.col("var_x") == target) & (F.col("var_y") != target))
    ordered = others.withColumn("_rank", F.struct(-F.abs("r"), F.col("var_y")))
    return ordered.agg(F.min_by(F.struct(F.col("var_y").alias("v"), F.col("r")), "_rank").alias("_best")).select(
        "_best.v", "_best.r"
    )


