"""What several operators share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.session import name_folder, stored

# Workers stay for the stages to come: what they free goes back to the system instead of being kept by each of them.
RETURNING = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576",
}


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where it is not installed; a cluster ships it by --py-files.

    A local session without a shared folder gets one.
    """
    root = str(Path(__file__).resolve().parents[2])
    name_folder(spark)
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def sharing(spark: SparkSession, batch_bytes: int) -> None:
    """For jobs of many stages in one session: workers take in ``batch_bytes`` at once and return what they free.

    Holds for what the session runs from then on, as frames run after the call that made them. What the session
    names itself in its workers' environment stays.
    """
    importable(spark)
    for name, value in RETURNING.items():
        spark.sparkContext.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) of every node of undirected edges (a, b): the least node that it is connected with.

    Alternates large-star and small-star: edges only ever get fewer or point lower, so a node with
    millions of neighbours costs one row for each, never a pair of them. Each round is stored in the
    shared folder, so lineage stays short. Edges to null and loops are ignored.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = stored(edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
                 .select(high.alias("a"), low.alias("b")).distinct(), f"{label}-edges")
    seen = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(both.filter(F.col("v") > F.col("u")).join(least, "u").filter(F.col("v") != F.col("m"))
                       .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), f"{label}-large")
        # Small star: a node's lower neighbours, and itself, go to the least of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        now = stored(large.join(down, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                                  F.col("m").alias("b")).filter("a != b").distinct(), f"{label}-small")
        # It has settled when no node is below one and above another: all edges are stars.
        sign = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if sign == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = sign
