import math
import random
from itertools import permutations

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from panelwright.operators import segment
from panelwright.plans import segmentation
from panelwright.plans.checks import experiment_faults
from panelwright.session import new_folder
from panelwright.sources.sinks import load_model
from panelwright.spec import labour_spec


@pytest.fixture(scope="module")
def people(spark):
    generator = random.Random(3)
    rows = []
    for i in range(600):
        old = i % 3 == 0
        rows.append((
            "2025T1", str(i), "1", generator.gauss(55 if old else 25, 3), generator.gauss(20 if old else 2, 1),
            generator.gauss(40, 5), generator.gauss(9000 if i % 2 else 3000, 200),
        ))
    columns = "periodo_archivo string, NUM_HOGAR string, NUM_PERSONA string, edad double, antiguedad double, horas_semanales double, salario_mensual double"
    return spark.createDataFrame(rows, columns).cache()


def brute_silhouette(points, labels):
    def d(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    groups = {}
    for p, c in zip(points, labels):
        groups.setdefault(c, []).append(p)
    total = 0.0
    for p, c in zip(points, labels):
        if len(groups[c]) == 1:
            continue
        a = sum(d(p, q) for q in groups[c]) / (len(groups[c]) - 1)
        b = min(sum(d(p, q) for q in g) / len(g) for k, g in groups.items() if k != c)
        total += 0 if a == b else (1 - a / b if a < b else b / a - 1)
    return total / len(points)


def test_silhouettes_against_brute_force_and_library(spark):
    generator = random.Random(5)
    points = [(generator.random(), generator.gauss(0, 2), generator.random() * 3) for _ in range(120)]
    labels = [(i % 3, i % 2, 0 if i == 0 else 1 + i % 3) for i in range(120)]
    frame = spark.createDataFrame(
        [(list(p), *c) for p, c in zip(points, labels)], "x array<double>, a int, b int, alone int"
    )
    rows = {r.assignment: r for r in segment.silhouettes(frame, F.col("x"), 3, ["a", "b", "alone"], 4).collect()}
    for i, name in enumerate(["a", "b", "alone"]):
        expected = brute_silhouette(points, [c[i] for c in labels])
        assert math.isclose(rows[name].silhouette, expected, rel_tol=1e-9)
        library = ClusteringEvaluator(featuresCol="v", predictionCol=name).evaluate(
            frame.withColumn("v", array_to_vector("x"))
        )
        assert math.isclose(rows[name].silhouette, library, rel_tol=1e-9)
        assert rows[name].n == 120 and sum(rows[name].sizes.values()) == 120
    assert rows["alone"].min_size == 1


def test_too_many_clusters_fail(spark):
    frame = spark.range(10).select(F.array(F.col("id").cast("double")).alias("x"), F.col("id").cast("int").alias("c"))
    with pytest.raises(Exception, match="more than 4 clusters"):
        segment.silhouettes(frame, F.col("x"), 1, ["c"], 4).collect()


def test_choose_k_prefers_the_smaller_within_tolerance(spark):
    runs = [("v", 2, 42, 0.40), ("v", 2, 123, 0.41), ("v", 3, 42, 0.412), ("v", 3, 123, 0.412), ("v", 4, 42, 0.30),
            ("v", 4, 123, 0.50), ("w", 2, 42, 0.1), ("w", 3, 7, 0.9), ("w", 3, 5, 0.9)]
    frame = spark.createDataFrame(runs, "variant string, k int, seed int, silhouette double")
    assert {(r.variant, r.k, r.seed) for r in segment.choose_k(frame, ["variant"]).collect()} == {("v", 2, 123), ("w", 3, 5)}
    means = {(r.variant, r.k): r.mean for r in segment.silhouette_by_k(frame, ["variant"]).collect()}
    assert math.isclose(means["v", 2], 0.405)


def test_standardized_matches_the_scaler(spark, people):
    columns = ["edad", "antiguedad"]
    assembler, scaler = segment.fit_scaler(people, columns)
    both = segment.standardized(scaler.transform(assembler.transform(people)), columns)
    z = vector_to_array(segment.FEATURES)
    worst = both.agg(F.max(F.greatest(F.abs(z[0] - F.col("edad_z")), F.abs(z[1] - F.col("antiguedad_z"))))).first()[0]
    assert worst < 1e-12


def test_null_measure_is_an_error(spark):
    frame = spark.createDataFrame([(1.0,), (None,)], "edad double")
    with pytest.raises(Exception, match="(?i)null"):
        segment.fit_scaler(frame, ["edad"])


def test_segmentation_run(spark, people):
    spec = labour_spec()
    variants = {
        "perfil_laboral": ("edad", "antiguedad", "horas_semanales"),
        "con_salario": ("edad", "antiguedad", "horas_semanales", "salario_mensual"),
    }
    result = segmentation.run(people, variants, (2, 3), (42, 123))
    experiments = result.experiments.collect()
    assert len(experiments) == 8
    rows = people.agg(F.count(F.lit(1)))
    assert experiment_faults(result.experiments, 4, rows).isEmpty()
    assert not experiment_faults(result.experiments, 5, rows).isEmpty()
    assert all(-1 <= e.silhouette <= 1 and e.cost > 0 for e in experiments)
    folder = new_folder(spark, "test-segmentation")
    assert segmentation.save(result, "perfil_laboral", spec, f"{folder}/model", f"{folder}/rows") == 600
    again = load_model(f"{folder}/model").transform(people).select(*spec.key, "prediction")
    stored = spark.read.parquet(f"{folder}/rows").withColumnRenamed("cluster_perfil_laboral", "stored")
    assert again.join(stored, list(spec.key)).filter("prediction != stored").isEmpty()

    profiles = segment.profile(result.assigned, list(variants["con_salario"]), "cluster_perfil_laboral")
    profile = profiles.collect()
    assert sum(r.n for r in profile) == 600 and math.isclose(sum(r.pct for r in profile), 100)
    crossed, agreed = segmentation.sensitivity(result, "perfil_laboral", "con_salario")
    matched = segment.cross_tab(
        result.assigned, result.assigned, list(spec.key), "cluster_perfil_laboral", "cluster_con_salario",
        list(range(3)), list(range(3)),
    )
    assert {tuple(r) for r in crossed.collect()} == {tuple(r) for r in matched.collect()}
    assert agreed.first().n == 600 and 0 < agreed.first().agreement <= 1
    composition = segment.composition(result.assigned, "cluster_perfil_laboral", "cluster_con_salario")
    shares = composition.groupBy("cluster_perfil_laboral").agg(F.sum("pct").alias("p")).collect()
    assert all(math.isclose(r.p, 100) for r in shares)
    labels = segment.profile_labels(profiles, "cluster_perfil_laboral", {"edad": "edad", "horas_semanales": "jornada"})
    assert {r.label.split(", ")[0] for r in labels.collect()} <= {"edad alta", "edad baja", "edad intermedia"}


def test_cross_tab_counts_pairs_of_repeated_keys(spark):
    generator = random.Random(1)
    rows = [("hot" if i % 3 == 0 else str(i % 40), generator.randrange(3), generator.randrange(2)) for i in range(900)]
    frame = spark.createDataFrame(rows, "k string, a int, b int")
    found = segment.cross_tab(frame.select("k", "a"), frame.select("k", "b"), ["k"], "a", "b", [0, 1, 2], [0, 1])
    expected = {}
    for k1, a, _ in rows:
        for k2, _, b in rows:
            if k1 == k2:
                expected[a, b] = expected.get((a, b), 0) + 1
    assert {(r.a, r.b): r.n for r in found.collect()} == expected
    with pytest.raises(Exception, match="not named"):
        segment.cross_tab(frame.select("k", "a"), frame.select("k", "b"), ["k"], "a", "b", [0, 1], [0, 1]).collect()


def test_cross_tab_leaves_out_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([("x", 0), ("y", 1), (None, 0), ("z", 1)], "k string, a int")
    right = spark.createDataFrame([("x", 1), ("z", 0), (None, 1), ("w", 1)], "k string, b int")
    found = segment.cross_tab(left, right, ["k"], "a", "b", [0, 1], [0, 1])
    assert {tuple(r) for r in found.collect()} == {(0, 1, 1), (1, 0, 1)}


@pytest.mark.parametrize("shape", [(2, 2), (3, 3), (3, 2), (5, 5), (8, 8)])
def test_agreement_tries_every_relabelling(spark, shape):
    generator = random.Random(sum(shape))
    counts = {(i, j): generator.randrange(1, 100) for i in range(shape[0]) for j in range(shape[1]) if (i + j) % 4 != 3}
    frame = spark.createDataFrame([(i, j, n) for (i, j), n in counts.items()], "a int, b int, n long")
    row = segment.agreement(frame, "a", "b").first()
    size = max(shape)
    best = max(sum(counts.get((i, j), 0) for i, j in enumerate(p)) for p in permutations(range(size)))
    assert row.matched == best and row.n == sum(counts.values())


def test_agreement_refuses_too_many_groups(spark, monkeypatch):
    monkeypatch.setattr(segment, "MAX_ALIGNED_LABELS", 7)
    frame = spark.createDataFrame([(i, i, 1) for i in range(8)], "a int, b int, n long")
    with pytest.raises(ValueError):
        segment.agreement(frame, "a", "b")


def test_best_matching_tries_all_relabellings():
    rnd = random.Random(4)
    for size in (1, 2, 3, 5, 8):
        for _ in range(4):
            table = [[rnd.randint(0, 50) for _ in range(size)] for _ in range(size)]
            assert segment.best_matching(table) == max(sum(table[i][j] for i, j in enumerate(p)) for p in permutations(range(size)))
