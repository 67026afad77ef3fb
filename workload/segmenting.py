"""Standardising, silhouettes, choice of K, profiles, agreement, k-means."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.operators import rules, segment
from panelwright.operators.reshape import to_wide, union_all
from panelwright.plans import segmentation
from panelwright.plans.checks import experiment_faults
from panelwright.session import new_folder, stored
from panelwright.sources.sinks import load_model
from panelwright.spec import SEGMENT_KS, SEGMENT_SEEDS
from workload.tables import CLEAN, SPEC, judged, query, table

VARIANTS = {"profile": ("age", "tenure", "hours"), "with_pay": ("age", "tenure", "hours", "pay")}


@query("""
SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 8) AS z FROM lineitem""")
def q_standardise(spark: SparkSession, sf: str) -> DataFrame:
    scaled = segment.standardized(table(spark, sf, "lineitem"), ["l_quantity"])
    return scaled.select("l_orderkey", "l_linenumber", F.round("l_quantity_z", 8).alias("z"))


@query("""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_tax) AS mt, stddev_samp(l_tax) AS st FROM lineitem)
SELECT l_returnflag, round(avg((l_quantity - mq) / sq), 8) AS mean_quantity, round(avg((l_tax - mt) / st), 8) AS mean_tax
FROM lineitem CROSS JOIN s GROUP BY l_returnflag""")
def q_scaler(spark: SparkSession, sf: str) -> DataFrame:
    """The library scaler on an assembled vector, averaged per group."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_tax")
    assembler, scaler = segment.fit_scaler(lines, ["l_quantity", "l_tax"])
    scaled = scaler.transform(assembler.transform(lines)).withColumn("z", vector_to_array(segment.FEATURES))
    return scaled.groupBy("l_returnflag").agg(
        F.round(F.avg(F.col("z")[0]), 8).alias("mean_quantity"), F.round(F.avg(F.col("z")[1]), 8).alias("mean_tax")
    )


@query("""
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_discount) AS md, stddev_samp(l_discount) AS sd FROM lineitem),
p AS (SELECT (l_quantity - mq) / sq AS x, (l_discount - md) / sd AS y,
        CASE WHEN l_quantity <= 15 THEN 0 WHEN l_quantity <= 35 THEN 1 ELSE 2 END AS c FROM lineitem CROSS JOIN s),
k AS (SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x*x + y*y) AS psi FROM p GROUP BY c),
d AS (SELECT p.x, p.y, p.c, k.c AS kc, k.n, (p.x*p.x + p.y*p.y) + k.psi/k.n - 2*(p.x*k.sx + p.y*k.sy)/k.n AS m FROM p CROSS JOIN k),
a AS (SELECT x, y, c, max(CASE WHEN c = kc THEN m*n/(n-1) END) AS a, min(CASE WHEN c <> kc THEN m END) AS b, count(*)/3 AS w FROM d GROUP BY x, y, c)
SELECT round(sum(w * CASE WHEN a < b THEN 1 - a/b WHEN a > b THEN b/a - 1 ELSE 0 END) / sum(w), 8) AS silhouette FROM a""")
def q_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    scaled = segment.standardized(
        table(spark, sf, "lineitem").select("l_quantity", "l_discount"), ["l_quantity", "l_discount"]
    )
    cluster = F.when(F.col("l_quantity") <= 15, 0).when(F.col("l_quantity") <= 35, 1).otherwise(2)
    rows = segment.silhouettes(
        scaled.withColumn("cluster", cluster), F.array("l_quantity_z", "l_discount_z"), 2, ["cluster"], 3
    )
    return rows.select(F.round("silhouette", 8).alias("silhouette"))


# Six fixed clusterings of the lines: K groups of equal width by quantity (seed 0) or by discount (seed 1).
FIXED_RUNS = [(k, seed) for k in (2, 3, 4) for seed in (0, 1)]


FIXED_SQL = f"""WITH s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_discount) AS md, stddev_samp(l_discount) AS sd FROM lineitem),
u AS (SELECT k, seed, (l_quantity - mq) / sq AS x, (l_discount - md) / sd AS y,
        CAST(CASE WHEN seed = 0 THEN least(floor((l_quantity - 1) * k / 50), k - 1)
             ELSE least(floor(round(l_discount * 100) * k / 11), k - 1) END AS INTEGER) AS c
      FROM lineitem CROSS JOIN s CROSS JOIN (VALUES {", ".join(map(str, FIXED_RUNS))}) AS r(k, seed)),
p AS (SELECT k, seed, x, y, c, count(*) AS w FROM u GROUP BY k, seed, x, y, c),
g AS (SELECT k, seed, c, sum(w) AS n, sum(w*x) AS sx, sum(w*y) AS sy, sum(w*(x*x + y*y)) AS psi FROM p GROUP BY k, seed, c),
d AS (SELECT p.k, p.seed, p.x, p.y, p.c, p.w, g.c AS kc, g.n, (p.x*p.x + p.y*p.y) + g.psi/g.n - 2*(p.x*g.sx + p.y*g.sy)/g.n AS m
      FROM p JOIN g ON g.k = p.k AND g.seed = p.seed),
a AS (SELECT k, seed, x, y, c, max(w) AS w, max(CASE WHEN c = kc THEN m*n/(n-1) END) AS a, min(CASE WHEN c <> kc THEN m END) AS b FROM d GROUP BY k, seed, x, y, c),
e AS (SELECT k, seed, sum(w * CASE WHEN a < b THEN 1 - a/b WHEN a > b THEN b/a - 1 ELSE 0 END) / sum(w) AS sil FROM a GROUP BY k, seed)"""


@query(f"""
{FIXED_SQL},
m AS (SELECT k, avg(sil) AS mean_sil FROM e GROUP BY k),
c AS (SELECT min(k) AS k FROM m WHERE (SELECT max(mean_sil) FROM m) - mean_sil <= 0.01),
r AS (SELECT e.k, e.seed, e.sil, row_number() OVER (ORDER BY e.sil DESC, e.seed) AS rn FROM e JOIN c ON e.k = c.k)
SELECT CAST(k AS INTEGER) AS k, CAST(seed AS INTEGER) AS seed, round(sil, 8) AS sil FROM r WHERE rn = 1""")
def q_choose_k(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouettes of six fixed clusterings in two passes, then the rule for K."""
    return segment.choose_k(_fixed_runs(spark, sf), []).select("k", "seed", F.round("silhouette", 8).alias("sil"))


@query(f"""
{FIXED_SQL}
SELECT CAST(k AS INTEGER) AS k, round(avg(sil), 8) AS mean, round(min(sil), 8) AS lo, round(max(sil), 8) AS hi FROM e GROUP BY k""")
def q_silhouette_by_k(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, lowest and highest silhouette of the fixed clusterings for each K."""
    by_k = segment.silhouette_by_k(_fixed_runs(spark, sf), [])
    return by_k.select("k", *[F.round(c, 8).alias(c) for c in ("mean", "lo", "hi")])


def _fixed_runs(spark: SparkSession, sf: str) -> DataFrame:
    """(k, seed, silhouette) of six fixed clusterings, in two passes."""
    scaled = segment.standardized(
        table(spark, sf, "lineitem").select("l_quantity", "l_discount"), ["l_quantity", "l_discount"]
    )

    def group(k: int, seed: int):
        if seed == 0:
            step = F.floor((F.col("l_quantity") - 1) * k / 50)
        else:
            step = F.floor(F.round(F.col("l_discount") * 100) * k / 11)
        return F.least(step, F.lit(k - 1)).cast("int")

    names = {f"k{k}_s{s}": (k, s) for k, s in FIXED_RUNS}
    assigned = scaled.withColumns({name: group(*run) for name, run in names.items()})
    scores = segment.silhouettes(assigned, F.array("l_quantity_z", "l_discount_z"), 2, list(names), 4)
    return scores.select(
        F.regexp_extract("assignment", r"k(\d+)_s(\d+)", 1).cast("int").alias("k"),
        F.regexp_extract("assignment", r"k(\d+)_s(\d+)", 2).cast("int").alias("seed"),
        "silhouette",
    )


@query("""
SELECT c.c_mktsegment, round(avg(c.c_acctbal) / max(o.m), 8) AS ratio,
  CASE WHEN avg(c.c_acctbal) / max(o.m) > 1.1 THEN 'high' WHEN avg(c.c_acctbal) / max(o.m) < 0.9 THEN 'low' ELSE 'mid' END AS label
FROM customer c CROSS JOIN (SELECT avg(c_acctbal) AS m FROM customer) o GROUP BY c.c_mktsegment""")
def q_profile_label(spark: SparkSession, sf: str) -> DataFrame:
    profiles = segment.profile(table(spark, sf, "customer"), ["c_acctbal"], "c_mktsegment")
    rows = segment.profile_labels(profiles, "c_mktsegment", {"c_acctbal": ""}, "high", "low", "mid")
    return rows.select("c_mktsegment", F.round("ratio_c_acctbal", 8).alias("ratio"), "label")


@query("""
WITH x AS (SELECT l_linestatus AS a, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS b, count(*) AS n FROM lineitem GROUP BY l_linestatus, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END)
SELECT round(greatest(sum(CASE WHEN (a = 'F') = (b = 0) THEN n ELSE 0 END), sum(CASE WHEN (a = 'F') <> (b = 0) THEN n ELSE 0 END)) / sum(n), 8) AS agreement FROM x""")
def q_agreement(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("a"), (F.col("l_quantity") > 25).cast("int").alias("b")
    )
    crossed = lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    return segment.agreement(crossed, "a", "b").select(F.round("agreement", 8).alias("agreement"))


@query("""
SELECT a, CAST(coalesce(sum(CASE WHEN b = 0 THEN 1 END), 0) AS BIGINT) AS b0, CAST(coalesce(sum(CASE WHEN b = 1 THEN 1 END), 0) AS BIGINT) AS b1,
  CAST(coalesce(sum(CASE WHEN b = 2 THEN 1 END), 0) AS BIGINT) AS b2
FROM (SELECT x.l_linestatus AS a, CASE WHEN y.l_quantity <= 15 THEN 0 WHEN y.l_quantity <= 35 THEN 1 ELSE 2 END AS b
      FROM lineitem x JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_linenumber = y.l_linenumber) j GROUP BY a""")
def q_cross_tab(spark: SparkSession, sf: str) -> DataFrame:
    """Two assignments matched on a key that repeats, pivoted."""
    lines = table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    left = lines.select(*key, F.col("l_linestatus").alias("a"))
    cluster = F.when(F.col("l_quantity") <= 15, 0).when(F.col("l_quantity") <= 35, 1).otherwise(2)
    crossed = segment.cross_tab(left, lines.select(*key, cluster.alias("b")), key, "a", "b", ["F", "O"], [0, 1, 2])
    return to_wide(crossed, ["a"], "b", [0, 1, 2], "n").withColumnsRenamed({"0": "b0", "1": "b1", "2": "b2"})


# Two far groups on one axis: every start ends in the same split, so SQL knows the outcome.
@query("""
WITH z AS (SELECT CASE WHEN l_linestatus = 'F' THEN l_tax ELSE l_tax + 1000 END AS x, l_quantity AS y FROM lineitem)
SELECT CAST(row_number() OVER (ORDER BY avg(x)) - 1 AS INTEGER) AS cluster, count(*) AS n, round(avg(x), 6) AS mean_x, round(avg(y), 6) AS mean_y,
  round(var_pop(x) * count(*), 4) AS cost
FROM z GROUP BY x >= 500""")
def q_kmeans_separated(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).otherwise(F.col("l_tax") + 1000).alias("x"),
        F.col("l_quantity").alias("y"),
    )
    assembler, scaler = segment.fit_scaler(points, ["x"])
    scaled = scaler.transform(assembler.transform(points))
    model = segment.kmeans(2, 42).fit(scaled)
    centres = [float(c[0]) for c in model.clusterCenters()]
    rank = F.when(F.col("prediction") == centres.index(min(centres)), 0).otherwise(1)
    return (
        model.transform(scaled)
        .groupBy(rank.alias("cluster"))
        .agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("x"), 6).alias("mean_x"), F.round(F.avg("y"), 6).alias("mean_y"),
            F.round(F.var_pop("x") * F.count(F.lit(1)), 4).alias("cost"),
        )
    )


def _eligible(spark: SparkSession, sf: str) -> DataFrame:
    kept = rules.eligible(judged(spark, sf), SPEC)
    return kept.select(*SPEC.key, "age", "tenure", "hours", "pay", "edu")


@query(f"""
SELECT variant, CAST(k AS INTEGER) AS k, CAST(seed AS INTEGER) AS seed, n, true AS sizes_add_up, true AS silhouette_in_range, true AS costs_something, CAST(0 AS BIGINT) AS faults
FROM (SELECT count(*) AS n FROM ({CLEAN}) c WHERE first_fail = 0) r CROSS JOIN (SELECT unnest(['profile', 'with_pay']) AS variant) v
CROSS JOIN (SELECT unnest([2, 3, 4, 5]) AS k) ks CROSS JOIN (SELECT unnest([42, 123, 2026]) AS seed) s""")
def q_kmeans_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Both variants for every K and seed: sizes, silhouette and cost of each of the 24 runs."""
    frame = stored(_eligible(spark, sf), "eligible")
    grid = segment.kmeans_grid(frame, VARIANTS, SEGMENT_KS, SEGMENT_SEEDS)
    rows = frame.agg(F.count(F.lit(1)))
    wrong = experiment_faults(grid.experiments, len(SEGMENT_KS) * len(SEGMENT_SEEDS), rows).agg(F.count(F.lit(1)))
    total = F.aggregate(F.map_values("sizes"), F.lit(0).cast("long"), lambda a, n: a + n)
    return grid.experiments.select(
        "variant", "k", "seed", "n", ((total == F.col("n")) & (F.size("sizes") == F.col("k"))).alias("sizes_add_up"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"), (F.col("cost") > 0).alias("costs_something"), wrong.scalar().alias("faults"),
    )


@query(f"""
SELECT CAST(count(*) AS BIGINT) AS n, CAST(2 AS BIGINT) AS clusters, true AS all_nearest, true AS shares_add_up FROM ({CLEAN}) c WHERE first_fail = 0""")
def q_kmeans_invariants(spark: SparkSession, sf: str) -> DataFrame:
    """What every fit must satisfy whatever its start: all rows assigned, each to its nearest centre."""
    frame = _eligible(spark, sf)
    assembler, scaler = segment.fit_scaler(frame, VARIANTS["profile"])
    scaled = scaler.transform(assembler.transform(frame))
    model = segment.kmeans(2, 42).fit(scaled)
    z = vector_to_array(segment.FEATURES)

    def distance(centre) -> F.Column:
        return sum(((z[j] - F.lit(float(c))) ** 2 for j, c in enumerate(centre)), F.lit(0.0))

    nearest = F.array(*[distance(c) for c in model.clusterCenters()])
    assigned = model.transform(scaled).withColumn("d", nearest)
    rows = assigned.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("n"),
        F.every(F.col("d")[F.col("prediction")] <= F.array_min("d") + 1e-9).alias("all_nearest"),
    )
    total = segment.with_share(rows).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"), F.every("all_nearest").alias("all_nearest"),
        (F.abs(F.sum("pct") - 100) < 1e-9).alias("shares_add_up"),
    )
    return total


@query(f"""
SELECT variant, n, true AS shares_add_up, true AS means_add_up, true AS medians_inside, true AS labelled, true AS agreement_in_range, round(pay, 4) AS pay
FROM (SELECT count(*) AS n, avg(pay) AS pay FROM ({CLEAN}) c WHERE first_fail = 0) r CROSS JOIN (SELECT unnest(['profile', 'with_pay']) AS variant) v""")
def q_kmeans_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The whole segmentation run, saved and reloaded: the profiles of both variants add up to the table."""
    frame = stored(_eligible(spark, sf), "eligible")
    result = segmentation.run(frame, VARIANTS)
    folder = new_folder(spark, "segmentation")
    segmentation.save(result, "profile", SPEC, f"{folder}/model", f"{folder}/assignments")
    reloaded = load_model(f"{folder}/model").transform(frame)
    measures = list(VARIANTS["with_pay"])
    whole = frame.agg(F.struct(*[F.avg(c).alias(c) for c in measures], *[F.min(c).alias(f"lo_{c}") for c in measures], *[F.max(c).alias(f"hi_{c}") for c in measures])).scalar()

    def checked(assigned: DataFrame, cluster: str, variant: str) -> DataFrame:
        names = {"age": "age", "tenure": "tenure", "hours": "hours"}
        profiles = segment.profile(assigned, measures, cluster)
        labels = segment.profile_labels(profiles, cluster, names, "high", "low", "mid").select(cluster, "label")
        rows = profiles.join(labels, cluster).withColumn("_w", whole)
        inside, near = F.lit(True), F.lit(True)
        for c in measures:
            inside = inside & F.col(f"median_{c}").between(F.col(f"_w.lo_{c}"), F.col(f"_w.hi_{c}"))
        sums = rows.agg(
            F.sum("n").alias("n"), F.sum("pct").alias("pct"), F.every(inside).alias("medians_inside"),
            F.every(F.length("label") > 0).alias("labelled"), F.max("_w").alias("_w"),
            *[(F.sum(F.col(f"mean_{c}") * F.col("n")) / F.sum("n")).alias(c) for c in measures],
        )
        for c in measures:
            near = near & (F.abs(F.col(c) - F.col(f"_w.{c}")) <= 1e-9 * F.abs(F.col(f"_w.{c}")))
        return sums.select(
            F.lit(variant).alias("variant"), "n", (F.abs(F.col("pct") - 100) < 1e-6).alias("shares_add_up"), near.alias("means_add_up"),
            "medians_inside", "labelled", F.round("pay", 4).alias("pay"),
        )

    _, agreement = segmentation.sensitivity(result, "profile", "with_pay")
    share = agreement.select(F.col("agreement").between(0, 1)).scalar()
    return union_all([
        checked(reloaded, "prediction", "profile"), checked(result.assigned, "cluster_with_pay", "with_pay"),
    ]).withColumn("agreement_in_range", share)
