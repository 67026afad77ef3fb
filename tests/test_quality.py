import random

import pytest
from pyspark.sql import functions as F

from panelwright.functions.codes import (
    dictionary_code, is_finite, normalize_code, period_quarter, period_year, recode, stringify, to_number,
)
from panelwright.functions.hashing import fingerprint, version_hashes
from panelwright.operators import quality, rules
from panelwright.operators.reshape import union_all
from panelwright.plans import audit as audit_plan
from tests.fixtures import EDITS, SPEC, raw_rows

KEY = list(SPEC.key)


def audit(frame):
    row = quality.duplicate_audit(frame, KEY, frame.columns).first()
    return row.dup_keys, row.dup_rows, row.conflicts, row.null_keys


def test_duplicate_kinds(spark):
    unique = raw_rows(spark, EDITS)
    assert audit(unique) == (0, 0, 0, 0)
    exact = unique.unionByName(unique.filter("NUM_HOGAR = '1'"))
    assert audit(exact) == (1, 2, 0, 0)
    other = raw_rows(spark, [({"P05D01": "9999"}, 0)])
    assert audit(exact.unionByName(other)) == (1, 3, 1, 0)
    examples = quality.duplicate_examples(exact.unionByName(other), KEY, exact.columns).collect()
    assert [(r.n, r.versions) for r in examples] == [(3, 2)]


def test_duplicate_counts_against_brute_force(spark):
    generator = random.Random(9)
    rows = [(generator.choice([None, *"abcdefgh"]), generator.randrange(60), generator.choice([None, 1, 2]), generator.choice(["x", "y", None])) for _ in range(400)]
    frame = spark.createDataFrame(rows, "p string, k int, v int, w string").repartition(6)
    groups = {}
    for p, k, *rest in rows:
        groups.setdefault((p, k), []).append(tuple(rest))
    twice = {key: versions for key, versions in groups.items() if len(versions) > 1}
    expected = (
        len(twice), sum(map(len, twice.values())), sum(len(set(v)) > 1 for v in twice.values()),
        sum(None in key for key in twice),
    )
    row = quality.duplicate_audit(frame, ["p", "k"], ["v", "w"]).first()
    assert (row.dup_keys, row.dup_rows, row.conflicts, row.null_keys) == expected
    by = {r.p: (r.dup_keys, r.conflicts) for r in quality.duplicate_audit(frame, ["p", "k"], ["v", "w"], by=["p"]).collect()}
    assert by == {
        p: (sum(key[0] == p for key in twice), sum(key[0] == p and len(set(v)) > 1 for key, v in twice.items()))
        for p in {key[0] for key in groups}
    }
    examples = quality.duplicate_examples(frame.filter("p is not null"), ["p", "k"], ["v", "w"]).collect()
    ranked = sorted(((-len(set(v)), *key, len(v)) for key, v in twice.items() if key[0] is not None))[:10]
    assert [(-r.versions, r.p, r.k, r.n) for r in examples] == ranked


def test_null_keys_form_a_group(spark):
    frame = raw_rows(spark, [({"NUM_PERSONA": None, "NUM_HOGAR": "1"}, 0), ({"NUM_PERSONA": None, "NUM_HOGAR": "1"}, 0)])
    assert audit(frame) == (1, 2, 0, 1)


def test_nulls_in_other_columns_are_other_versions(spark):
    frame = spark.createDataFrame([(1, None, "a"), (1, "a", None)], "k int, x string, y string")
    assert quality.duplicate_audit(frame, ["k"], ["x", "y"]).first().conflicts == 1
    hashes = frame.select(fingerprint(["x", "y"]).alias("f"), *[h.alias(str(i)) for i, h in enumerate(version_hashes(["x", "y"]))])
    assert all(len({r[i] for r in hashes.collect()}) == 2 for i in range(3))


def test_report_before_and_after_the_rules(spark):
    rows = raw_rows(spark, EDITS)
    twice = rows.unionByName(rows.filter("NUM_HOGAR in ('1', '2')"))
    changed = raw_rows(spark, [({"DOMINIO": "1"}, 0)])  # the same code in another rendering is another version
    other = raw_rows(spark, EDITS[:1], "2025T2")
    judged = rules.judge(union_all([twice, changed, other]), SPEC)
    found = {(r.periodo_archivo, r.stage): (r.dup_keys, r.dup_rows, r.conflicts, r.null_keys) for r in audit_plan.duplicate_report(judged, SPEC).collect()}
    assert found == {
        ("2025T1", "before"): (2, 5, 1, 0), ("2025T1", "after"): (1, 3, 1, 0),
        ("2025T2", "before"): (0, 0, 0, 0), ("2025T2", "after"): (0, 0, 0, 0),
    }
    with pytest.raises(quality.CheckFailed, match="conflicting"):
        audit_plan.check_load(audit_plan.audit(judged, SPEC), audit_plan.duplicate_report(judged, SPEC), SPEC)
    clean = rules.judge(rows, SPEC)
    audit_plan.check_load(audit_plan.audit(clean, SPEC), audit_plan.duplicate_report(clean, SPEC), SPEC)


def test_audit_of_nothing(spark):
    assert audit(raw_rows(spark, EDITS).filter("false")) == (0, 0, 0, 0)


def test_hot_key_audit(spark):
    """A third of all rows under one key; the counts stay whole."""
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).alias("v")
    )
    row = quality.duplicate_audit(frame, ["k"], ["v"]).first()
    assert (row.dup_keys, row.dup_rows, row.conflicts) == (1, 10_000, 1)
    assert quality.duplicate_examples(frame, ["k"], ["v"]).first().asDict() == {"k": -1, "n": 10_000, "versions": 5}


@pytest.mark.parametrize(
    ("raw", "normal", "one"),
    [(" 2.00 ", "2", "2.00"), ("10.0.0", "10.0", "10.0"), ("", "", ""), (None, None, ""), ("1.0", "1", "1"),
     ("1.50", "1.50", "1.50"), ("x", "x", "x"), (".0", "", ""), # Cells are stripped at load; unstripped, "$" also matches before a last line break.
     ("\t3.0\n", "\t3\n", "3")],
)
def test_code_cleaners(spark, raw, normal, one):
    row = spark.createDataFrame([(raw,)], "c string").select(
        normalize_code(F.col("c")).alias("n"), dictionary_code(F.col("c")).alias("d")
    ).first()
    assert (row.n, row.d) == (normal, one)


def test_numbers_and_finiteness(spark):
    cells = ["1", " 2.5 ", "abc", "", None, "NaN", "Infinity", "-Infinity", "1e400", "12d", "7.f", " 3D "]
    frame = spark.createDataFrame([(c,) for c in cells], "c string").withColumn("v", to_number(F.col("c")))
    assert [r.v for r in frame.filter("c in ('12d', '7.f', ' 3D ')").collect()] == [None] * 3
    assert [r.f for r in frame.select(is_finite(F.col("v")).alias("f")).collect()] == [True, True] + [False] * 10


def test_stringify_strips_and_nulls(spark):
    frame = spark.createDataFrame([(float("nan"), " a ", 3), (1.0, None, None)], "x double, y string, z int")
    assert [tuple(r) for r in stringify(frame, ["z", "y", "x"]).collect()] == [("3", "a", None), (None, None, "1.0")]


def test_period_parts(spark):
    row = spark.createDataFrame([("2026T1",)], "p string").select(
        period_year(F.col("p")).alias("y"), period_quarter(F.col("p")).alias("q")
    ).first()
    assert (row.y, row.q) == (2026, 1)


def test_recode_null_blank_and_foreign(spark):
    frame = spark.createDataFrame([("0",), (None,), ("",), ("9",)], "c string")
    assert [r[0] for r in frame.select(recode(F.col("c"), ["0", "1"])).collect()] == ["0"] + ["DESCONOCIDO"] * 3


def test_domain_and_required_codes(spark):
    codes = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", None)], "p string, c string")
    assert {tuple(r) for r in quality.outside_domain(codes, "c", ["1"]).collect()} == {("2", 1), (None, 1)}
    assert [tuple(r) for r in quality.lacks_codes(codes, "c", ["1", "2"], ["p"]).collect()] == [("b", ["2"])]


def test_set_difference_and_require_empty(spark):
    left = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    right = spark.createDataFrame([(2,), (3,)], "v int")
    assert {tuple(r) for r in quality.set_difference(left, right).collect()} == {(1, "left"), (3, "right")}
    quality.require_empty(left.filter("v > 5"), "none")
    with pytest.raises(quality.CheckFailed, match="some"):
        quality.require_empty(left, "some")


def test_rows_of_duplicated_keys(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert {r.v for r in quality.rows_of_duplicated_keys(frame, ["k"]).collect()} == {"a", "b"}
