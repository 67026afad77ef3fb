"""The whole preparation from landed files to a re-checked table."""

from pyspark.sql import functions as F

from panelwright.operators.rules import judge
from panelwright.plans import audit, checks
from panelwright.session import new_folder
from panelwright.sources import codelist, landing, sinks
from tests.fixtures import EDITS, MORE_EDITS, SPEC, raw_rows


def test_from_landing_to_prepared(spark):
    folder = new_folder(spark, "test-run")
    periods = {"2025T1": EDITS + MORE_EDITS, "2026T1": EDITS}
    for period, edits in periods.items():
        rows = raw_rows(spark, edits).drop("periodo_archivo")
        rows.write.option("header", True).csv(f"{folder}/{period}")
    paths = {period: f"{folder}/{period}" for period in periods}
    scanned = landing.scan_periods(spark, paths, SPEC)

    dimensions = landing.observed_dimensions(spark, paths, scanned)
    expected = spark.createDataFrame([(p, len(e), 14) for p, e in periods.items()], "periodo string, rows int, columns int")
    assert landing.dimension_faults(dimensions, expected, ["periodo"]).isEmpty()

    judged = judge(scanned, SPEC)
    tables = audit.audit(judged, SPEC)
    audit.check_load(tables, audit.duplicate_report(judged, SPEC, also=("archivo_origen",)), SPEC)
    assert {(r.periodo_archivo, r.initial_rows) for r in tables.rates.collect()} == {(p, len(e)) for p, e in periods.items()}

    sheet = [(p, *row) for p in periods for row in [
        (1, "P03A03A", None, "question"), (2, "DOMINIO", None, "question"), (3, "P03A03A", "0", "NINGUNO"),
        (4, None, "1.0", "PRIMARIA"), (5, "DOMINIO", "1", "URBANO"), (6, None, "2", "RURAL"), (7, "END", None, None),
    ]]
    sheets = spark.createDataFrame(sheet, "period string, row_no int, c0 string, c1 string, c2 string")
    lists = codelist.code_lists(sheets, ["period"], ["P03A03A", "DOMINIO"])
    assert codelist.incomplete(sheets, lists, ["period"], ["P03A03A", "DOMINIO"]).isEmpty()

    prepared = audit.prepare(judged, SPEC, lists)
    assert checks.remaining_faults(prepared, tables.waterfall, SPEC).isEmpty()
    rows = sinks.write_table(prepared, f"{folder}/prepared", SPEC.period)
    again = sinks.read_back(spark, f"{folder}/prepared", prepared, rows, SPEC.period)
    assert rows == sum(rule == 0 for e in periods.values() for _, rule in e)
    faults = checks.prepared_faults(
        again, SPEC, list(periods), {"nivel_educativo": ["0", "1"], "dominio": ["1", "2"]}
    )
    assert {r.check: r.faults for r in faults.collect()} == {
        "rule_violations": 0, "unexpected_period": 0, "absent_periods": 0, "codes_nivel_educativo": 0, "codes_dominio": 0,
    }
    fewer = again.filter(F.col("NUM_HOGAR") != "1")
    assert checks.remaining_faults(fewer, tables.waterfall, SPEC).count() == 2
    assert again.filter("nivel_educativo = 'DESCONOCIDO'").count() == 2
