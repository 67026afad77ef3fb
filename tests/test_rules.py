from hypothesis import given, settings, strategies as st

from panelwright.functions.codes import UNKNOWN
from panelwright.operators import quality, rules
from panelwright.plans import audit as plan
from tests.fixtures import EDITS, MORE_EDITS, SPEC, raw_rows

ALLOWED = {"nivel_educativo": [str(i) for i in range(8)], "dominio": ["1", "2", "3"]}


def test_waterfall_counts_every_exclusion(spark):
    judged = rules.judge(raw_rows(spark, EDITS), SPEC)
    steps = rules.waterfall(judged, SPEC).orderBy("rule").collect()
    assert [s.excluded for s in steps] == [2, 0, 1, 1, 1, 1, 1, 2]
    assert [s.entries for s in steps] == [10, 8, 8, 7, 6, 5, 4, 3]
    assert steps[-1].remaining == 1
    assert quality.conservation(rules.waterfall(judged, SPEC), SPEC.period).filter("not holds").isEmpty()


def test_every_edit_falls_to_its_rule(spark):
    edits = EDITS + MORE_EDITS
    judged = rules.judge(raw_rows(spark, edits), SPEC)
    found = {int(r.NUM_HOGAR): r.first_fail for r in judged.collect()}
    assert found == {i: rule for i, (_, rule) in enumerate(edits, 1)}


def test_survivor_values(spark):
    kept = rules.eligible(rules.judge(raw_rows(spark, EDITS), SPEC), SPEC, ALLOWED).collect()
    assert len(kept) == 1
    row = kept[0]
    assert (row.nivel_educativo, row.categoria_ocupacional, row.dominio) == ("0", "1", "1")
    assert abs(row.antiguedad - (2 + 1 / 12)) < 1e-9
    assert row.DOMINIO_original == "1.0"


def test_recode_follows_the_filter(spark):
    kept = rules.eligible(rules.judge(raw_rows(spark, MORE_EDITS), SPEC), SPEC, ALLOWED)
    education = {int(r.NUM_HOGAR): r.nivel_educativo for r in kept.collect()}
    assert education[6] == UNKNOWN and education[7] == UNKNOWN and education[5] == "0"


def test_prepare_uses_the_list_of_the_period(spark):
    raw = raw_rows(spark, EDITS[:1]).unionByName(raw_rows(spark, EDITS[:1], "2025T2"))
    lists = spark.createDataFrame(
        [("2025T1", "P03A03A", "0"), ("2025T2", "P03A03A", "7"), ("2025T1", "DOMINIO", "1"), ("2025T2", "DOMINIO", "1")],
        "period string, variable string, code string",
    )
    rows = plan.prepare(rules.judge(raw, SPEC), SPEC, lists).collect()
    assert {r.periodo_archivo: r.nivel_educativo for r in rows} == {"2025T1": "0", "2025T2": UNKNOWN}
    assert {r.dominio for r in rows} == {"1"}


def test_audit_equals_the_single_operators(spark):
    raw = raw_rows(spark, EDITS + MORE_EDITS).unionByName(raw_rows(spark, MORE_EDITS, "2025T2"))
    judged = rules.judge(raw, SPEC)
    tables = plan.audit(judged, SPEC)
    assert sorted(tables.waterfall.collect()) == sorted(rules.waterfall(judged, SPEC).collect())
    assert sorted(tables.missing.collect()) == sorted(
        quality.missingness(raw, SPEC.period, list(SPEC.source_columns)).collect()
    )
    assert sorted(tables.invalid.collect()) == sorted(
        quality.invalid_numbers(judged, SPEC.period, SPEC.numeric).collect()
    )
    invalid = {(r.periodo_archivo, r.variable): r.invalid for r in tables.invalid.collect()}
    assert invalid["2025T2", "P05D01"] == 3  # NaN, abc and -Infinity; the blank is missing, not invalid
    assert invalid["2025T2", "P02A03"] == 1


def test_violations_of_clean_rows_are_none(spark):
    judged = rules.judge(raw_rows(spark, EDITS + MORE_EDITS), SPEC)
    kept = rules.eligible(judged, SPEC)
    assert rules.violations(kept, SPEC.rules()).isEmpty()
    everything = rules.normalize(raw_rows(spark, EDITS + MORE_EDITS), SPEC)
    assert rules.violations(everything, SPEC.rules()).count() == sum(r > 0 for _, r in EDITS + MORE_EDITS)


numbers = st.sampled_from(["", "abc", "NaN", "Infinity", "-1", "0", "1", "11", "12", "15", "40", "168", "169", "1.5", None])


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.fixed_dictionaries({
    c: numbers for c in ("P02A03", "P05C07A", "P05C07B", "P05H01A", "P05D01")
}), min_size=1, max_size=30))
def test_first_failing_rule_equals_chained_filters(spark, rows):
    """The one-pass rule number gives the same counts as filtering rule by rule."""
    raw = raw_rows(spark, [(r, None) for r in rows])
    normalized = rules.normalize(raw, SPEC).cache()
    steps = {s.rule: s for s in rules.waterfall(rules.judge(raw, SPEC), SPEC).collect()}
    left = normalized
    for number, (_, condition) in enumerate(SPEC.rules(), 1):
        before = left.count()
        left = left.filter(condition)
        assert (steps[number].entries, steps[number].remaining) == (before, left.count())
    normalized.unpersist()


def test_analytic_name_replaces_the_source_column(spark):
    columns = rules.normalize(raw_rows(spark, EDITS[:1]), SPEC).columns
    assert "dominio" in columns and "DOMINIO" not in columns and "DOMINIO_original" in columns
