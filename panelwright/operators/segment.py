"""Standardised k-means, its evaluation over a grid, the choice of K and cluster profiles."""

from __future__ import annotations

from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window
from pyspark.storagelevel import StorageLevel

from panelwright.functions.numeric import percent, ratio_label
from panelwright.operators.describe import with_share
from panelwright.operators.percentiles import ACCURACY
from panelwright.operators.reshape import union_all
from panelwright.session import iterated

FEATURES = "features_scaled"
# Groups a side that are matched on the driver, and fits that run at once.
MAX_ALIGNED_LABELS = 1_000
FITS_AT_ONCE = 4


def assemble(columns: list[str], output: str) -> VectorAssembler:
    """NULL or NaN in a measure is an error, never silently skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def fit_scaler(frame: DataFrame, columns: list[str]) -> tuple[VectorAssembler, StandardScalerModel]:
    """Stages that bring each measure to mean 0 and sample standard deviation 1."""
    assembler = assemble(columns, "features_raw")
    scaler = StandardScaler(inputCol="features_raw", outputCol=FEATURES, withMean=True, withStd=True)
    return assembler, scaler.fit(assembler.transform(frame.select(*columns)))


def standardized(frame: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_z`` next to each column; the two moments come from one aggregation."""
    moments = frame.agg(
        F.struct(*[m for c in columns for m in (F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}"))]).alias("m")
    )
    scaled = frame.withColumn("_m", moments.scalar())
    return scaled.withColumns(
        {f"{c}_z": (F.col(c) - F.col(f"_m.m_{c}")) / F.col(f"_m.s_{c}") for c in columns}
    ).drop("_m")


def kmeans(k: int, seed: int, max_iter: int = 100, tol: float = 1e-4, prediction: str = "prediction") -> KMeans:
    return KMeans(
        featuresCol=FEATURES, predictionCol=prediction, k=k, seed=seed, maxIter=max_iter, tol=tol
    )


def silhouettes(
    frame: DataFrame, point: Column, dimensions: int, assignments: list[str], max_clusters: int
) -> DataFrame:
    """Mean squared-Euclidean silhouette, sizes and smallest cluster of many assignments at once.

    ``point`` is an array of ``dimensions`` doubles; each assignment is a column of cluster
    numbers. Mean squared distances follow from each cluster's size, mean vector and mean
    squared norm, so two passes serve all assignments and no pair of rows is ever formed.
    The cluster statistics (one row per assignment and cluster, at most ``max_clusters`` each,
    or the query fails) ride along as one scalar and are compared in generated code.
    """
    labels = F.array(*[F.col(a).cast("int") for a in assignments])
    long = frame.select(point.alias("x"), F.posexplode(labels).alias("a", "c"))
    norm = sum((F.col("x")[j] * F.col("x")[j] for j in range(dimensions)), F.lit(0.0))
    stats = long.groupBy("a", "c").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg(norm).alias("psi"),
        *[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(dimensions)],
    )
    one_cluster = F.struct("c", "n", "psi", *[f"m{j}" for j in range(dimensions)])
    # Counted before anything is gathered: a wrong assignment column may hold a number per row.
    several = stats.groupBy("a").agg(F.count(F.lit(1)).alias("found")).agg(F.max("found"))
    few_enough = F.when(several.scalar() <= max_clusters, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"more than {max_clusters} clusters")).cast("boolean")
    )
    lookup = (
        stats.filter(few_enough).groupBy("a").agg(F.collect_list(one_cluster).alias("clusters"))
        .agg(F.map_from_entries(F.collect_list(F.struct("a", "clusters"))).alias("lookup"))
    )

    def mean_distance(s: Column) -> Column:
        dot = sum((F.col("x")[j] * s[f"m{j}"] for j in range(dimensions)), F.lit(0.0))
        return F.col("norm") + s["psi"] - F.lit(2.0) * dot

    slots = [F.get(F.col("clusters"), F.lit(i)) for i in range(max_clusters)]
    placed = long.withColumns({"norm": norm, "clusters": F.element_at(lookup.scalar(), F.col("a"))})
    measured = placed.select(
        "a", "c",
        *[s["c"].alias(f"c{i}") for i, s in enumerate(slots)],
        *[s["n"].alias(f"n{i}") for i, s in enumerate(slots)],
        *[mean_distance(s).alias(f"d{i}") for i, s in enumerate(slots)],
    )
    every = range(max_clusters)
    # Empty slots are NULL, which neither matches a cluster number nor counts in the minimum.
    own = {
        name: F.coalesce(*[F.when(F.col(f"c{i}") == F.col("c"), F.col(f"{name}{i}")) for i in every])
        for name in ("n", "d")
    }
    nearest = F.least(*[F.when(F.col(f"c{i}") != F.col("c"), F.col(f"d{i}")) for i in every], F.lit(None).cast("double"))
    scored = measured.select("a", own["n"].alias("size"), own["d"].alias("mean_own"), nearest.alias("nearest"))
    # The own mean counts a row's distance to itself; n / (n - 1) takes it out.
    within = F.try_divide(F.col("mean_own") * F.col("size"), F.col("size") - F.lit(1.0))
    scored = scored.withColumn("within", within)
    value = (
        F.when(F.col("size") == 1, F.lit(0.0))
        .when(F.col("within") < F.col("nearest"), 1 - F.col("within") / F.col("nearest"))
        .when(F.col("within") > F.col("nearest"), F.col("nearest") / F.col("within") - 1)
        .otherwise(F.lit(0.0))
    )
    names = F.array(*[F.lit(a) for a in assignments])
    means = scored.groupBy("a").agg(F.avg(value).alias("silhouette"), F.count(F.lit(1)).alias("n"))
    sizes = stats.groupBy("a").agg(
        F.min("n").cast("long").alias("min_size"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", F.col("n").cast("long"))))).alias("sizes"),
    )
    return means.join(sizes, "a").select(
        names[F.col("a")].alias("assignment"), "silhouette", "n", "min_size", "sizes"
    )


@dataclass
class Grid:
    """A k-means grid: its experiment table and the fitted stages behind each row."""

    experiments: DataFrame
    scalers: dict[str, tuple[Transformer, Transformer]] = field(default_factory=dict)
    models: dict[tuple[str, int, int], KMeansModel] = field(default_factory=dict)

    def pipeline(self, variant: str, k: int, seed: int) -> PipelineModel:
        """The whole chain of one experiment row, applicable to raw measures."""
        return PipelineModel(stages=[*self.scalers[variant], self.models[variant, k, seed]])


def kmeans_grid(
    frame: DataFrame,
    variants: dict[str, tuple[str, ...]],
    ks: tuple[int, ...],
    seeds: tuple[int, ...],
    max_iter: int = 100,
    tol: float = 1e-4,
) -> Grid:
    """Fits every (variant, K, seed) and scores all of a variant's fits together.

    The measures are stored once for all variants; per variant only the scaled vector is
    kept. Fits are distributed jobs; all assignments of a variant are columns of one
    frame, so silhouettes and sizes take two passes instead of three jobs per fit.
    """
    spark = frame.sparkSession
    grid = Grid(experiments=None)
    measures = iterated(frame.select(*dict.fromkeys(c for v in variants.values() for c in v)), "measures")
    parts = []
    for variant, columns in variants.items():
        assembler, scaler = fit_scaler(measures, columns)
        grid.scalers[variant] = (assembler, scaler)
        scaled = scaler.transform(assembler.transform(measures)).select(FEATURES)
        scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)
        assigned, rows = scaled, []
        runs = [(k, seed) for k in ks for seed in seeds]
        fit = inheritable_thread_target(spark)(lambda run: kmeans(*run, max_iter, tol).fit(scaled))
        # Independent fits share the kept vectors; some run at once, so a short job leaves no core idle.
        with ThreadPool(FITS_AT_ONCE) as pool:
            models = pool.map(fit, runs, chunksize=1)
        for (k, seed), model in zip(runs, models, strict=True):
            grid.models[variant, k, seed] = model
            name = f"k{k}_s{seed}"
            rows.append((variant, k, seed, name, float(model.summary.trainingCost)))
            assigned = model.copy().setPredictionCol(name).transform(assigned)
        assigned = assigned.persist(StorageLevel.MEMORY_AND_DISK)
        scores = silhouettes(
            assigned, vector_to_array(FEATURES), len(columns), [r[3] for r in rows], max(ks)
        )
        # One row per fit, taken before the scaled rows are released.
        scores = spark.createDataFrame(scores.collect(), scores.schema)
        assigned.unpersist()
        scaled.unpersist()
        runs = spark.createDataFrame(
            rows, "variant string, k int, seed int, assignment string, cost double"
        )
        parts.append(runs.join(scores, "assignment").drop("assignment"))
    grid.experiments = union_all(parts).select(
        "variant", "k", "seed", "silhouette", "cost", "n", "min_size", "sizes"
    )
    return grid


def silhouette_by_k(experiments: DataFrame, by: list[str]) -> DataFrame:
    """Mean, lowest and highest silhouette over the seeds, per variant and K."""
    return experiments.groupBy(*by, "k").agg(
        F.avg("silhouette").alias("mean"), F.min("silhouette").alias("lo"), F.max("silhouette").alias("hi")
    )


def choose_k(experiments: DataFrame, by: list[str], tolerance: float = 0.01) -> DataFrame:
    """The smallest K whose mean silhouette is within ``tolerance`` of the best, per variant.

    Of its runs the one with the highest silhouette is taken, ties by the lowest seed.
    """
    variant = Window.partitionBy(*(by or [F.lit(0)]))
    means = experiments.withColumn("_mean", F.avg("silhouette").over(Window.partitionBy(*by, "k")))
    close = means.withColumn("_best", F.max("_mean").over(variant)).filter(
        F.col("_best") - F.col("_mean") <= F.lit(tolerance)
    )
    ranked = close.withColumn(
        "_rank", F.row_number().over(variant.orderBy("k", F.desc("silhouette"), "seed"))
    )
    return ranked.filter("_rank = 1").select(*by, "k", "seed", "silhouette")


def profile(
    frame: DataFrame, measures: list[str], prediction: str = "prediction", accuracy: int = ACCURACY
) -> DataFrame:
    """Size, share, mean and (sketched) median of every measure per cluster."""
    rows = frame.groupBy(prediction).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"mean_{c}") for c in measures],
        *[F.percentile_approx(c, F.lit(0.5), F.lit(accuracy)).alias(f"median_{c}") for c in measures],
    )
    return with_share(rows)


def composition(frame: DataFrame, cluster: str, group: str) -> DataFrame:
    """Rows per cluster and category, with the share inside the cluster."""
    counts = frame.groupBy(cluster, group).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts, within=[cluster])


def profile_labels(
    profiles: DataFrame, cluster: str, measures: dict[str, str], high: str = "alta", low: str = "baja", mid: str = "intermedia"
) -> DataFrame:
    """Ratio of each cluster mean to the overall mean, and a text made of their labels.

    Reads the table that ``profile`` returns, a row per cluster; ``measures`` maps a measure
    to its name in the text. Measures hold no NULL, so the overall mean is the mean of
    the cluster means weighted by size.
    """
    everything = Window.partitionBy(F.lit(0))
    rows = F.sum("n").over(everything)
    ratios = {
        f"ratio_{c}": F.col(f"mean_{c}") / (F.sum(F.col(f"mean_{c}") * F.col("n")).over(everything) / rows)
        for c in measures
    }
    words = [
        F.ltrim(F.concat(F.lit(f"{name} "), ratio_label(F.col(f"ratio_{c}"), high, low, mid)))
        for c, name in measures.items()
    ]
    return (
        profiles.withColumns(ratios)
        .withColumn("label", F.concat_ws(", ", *words))
        .select(cluster, *ratios, "label")
    )


def cross_tab(
    left: DataFrame, right: DataFrame, key: list[str], a: str, b: str, labels_a: list, labels_b: list
) -> DataFrame:
    """Rows per pair of cluster numbers of two assignments, matched on the key.

    Equals the count over an inner join on the key, without joining: both sides are united
    and counted per key and label in one shuffle, and a key repeated on both sides
    contributes the product of its counts. Labels are named by the caller, as the number
    of clusters is known; another label is an error.
    """
    def counts(side: str, labels: list) -> list[Column]:
        per_label = [F.count_if(F.col(side) == label).alias(f"{side}{i}") for i, label in enumerate(labels)]
        return [*per_label, F.count(side).alias(f"{side}_all")]

    both = union_all(
        [left.select(*key, F.col(a).alias("_a")), right.select(*key, F.col(b).alias("_b"))], allow_missing=True
    ).na.drop(subset=key)
    per_key = both.groupBy(*key).agg(*counts("_a", labels_a), *counts("_b", labels_b))
    listed_a = sum((F.col(f"_a{i}") for i in range(len(labels_a))), F.lit(0))
    listed_b = sum((F.col(f"_b{j}") for j in range(len(labels_b))), F.lit(0))
    unlisted = (F.col("_a_all") != listed_a) | (F.col("_b_all") != listed_b)
    checked = per_key.filter(
        F.when(unlisted, F.raise_error(F.lit("a label that was not named")).cast("boolean"))
        .otherwise((F.col("_a_all") > 0) & (F.col("_b_all") > 0))
    )
    cells = [
        F.struct(F.lit(x).alias(a), F.lit(y).alias(b), F.sum(F.col(f"_a{i}") * F.col(f"_b{j}")).alias("n")).alias(f"c{i}_{j}")
        for i, x in enumerate(labels_a)
        for j, y in enumerate(labels_b)
    ]
    one_row = checked.agg(*cells)
    return one_row.select(F.inline(F.array(*one_row.columns))).filter("n > 0")


def agreement(crossed: DataFrame, a: str, b: str) -> DataFrame:
    """Share of rows in matching groups under the best one-to-one relabelling.

    Works on the aggregated cross-tabulation: the best matching is found by shortest
    augmenting paths over its cells, for any number of groups up to a table that fits the driver.
    """
    cells = crossed.select(a, b, "n").limit(MAX_ALIGNED_LABELS**2 + 1).collect()
    firsts = sorted({r[a] for r in cells}, key=str)
    seconds = sorted({r[b] for r in cells}, key=str)
    size = max(len(firsts), len(seconds))
    if size > MAX_ALIGNED_LABELS:
        raise ValueError(f"more than {MAX_ALIGNED_LABELS} groups to align")
    counts = {(r[a], r[b]): r["n"] for r in cells}
    table = [
        [counts.get((x, y), 0) for y in seconds + [None] * (size - len(seconds))]
        for x in firsts + [None] * (size - len(firsts))
    ]
    best = best_matching(table)
    total = sum(counts.values())
    return crossed.sparkSession.createDataFrame(
        [(best, total, best / total if total else None)], "matched long, n long, agreement double"
    )


def best_matching(table: list[list[int]]) -> int:
    """The largest sum of a square table's cells with one in each row and column."""
    size = len(table)
    of_row, of_column = [0] * (size + 1), [0] * (size + 1)  # potentials
    owner = [0] * (size + 1)  # row that holds a column, counted from 1
    for row in range(1, size + 1):
        least, back, done = [float("inf")] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        owner[0], column = row, 0
        while True:
            done[column] = True
            here, gap, following = owner[column], float("inf"), 0
            for j in range(1, size + 1):
                if not done[j]:
                    cost = -table[here - 1][j - 1] - of_row[here] - of_column[j]
                    if cost < least[j]:
                        least[j], back[j] = cost, column
                    if least[j] < gap:
                        gap, following = least[j], j
            for j in range(size + 1):
                if done[j]:
                    of_row[owner[j]] += gap
                    of_column[j] -= gap
                else:
                    least[j] -= gap
            column = following
            if not owner[column]:
                break
        while column:
            owner[column] = owner[back[column]]
            column = back[column]
    return sum(table[owner[j] - 1][j - 1] for j in range(1, size + 1))
