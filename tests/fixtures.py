"""Raw rows of the labour panel: one good row and one edit per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.spec import labour_spec

SPEC = labour_spec()

BASE = {
    **dict.fromkeys(SPEC.source_columns),
    "ANIO": "2025", "TRIMESTRE": "2", "DOMINIO": "1.0", "NUM_HOGAR": "1", "NUM_PERSONA": "1", "FACTOR": "100",
    "P02A03": "25", "P05C07A": "2", "P05C07B": "1", "P05H01A": "40", "P03A03A": "0", "P05C16": "1.0",
    "OCUPADOS": "1.0", "P05D01": "3000",
}

# Edit, and the rule (1 to 8) that drops the row; 0 keeps it.
EDITS = [
    ({}, 0),
    ({"P02A03": "14"}, 1),
    ({"P02A03": "Infinity"}, 1),
    ({"P05C16": "9"}, 3),
    ({"P05D01": "0"}, 4),
    ({"P05C07A": "-1"}, 5),
    ({"P05C07B": "1.5"}, 6),
    ({"P05C07A": "26"}, 7),
    ({"P05H01A": "169"}, 8),
    ({"P05H01A": None}, 8),
]
MORE_EDITS = [
    ({"P05D01": "NaN"}, 4),
    ({"P05D01": "abc"}, 4),
    ({"P05D01": ""}, 4),
    ({"P05D01": "-Infinity"}, 4),
    ({"P05C16": " 1.00 "}, 0),
    ({"P03A03A": None}, 0),
    ({"P03A03A": "99"}, 0),
    ({"P05H01A": "168"}, 0),
    ({"P05C07B": "0"}, 0),
    ({"P05C07B": "11"}, 0),
    ({"P05C07B": "12"}, 6),
    ({"P05C07B": "NaN"}, 6),
    ({"P02A03": "15"}, 0),
    ({"OCUPADOS": None}, 2),
    ({"OCUPADOS": "2"}, 2),
    ({"P02A03": "NaN"}, 1),
    ({"P02A03": None}, 1),
    ({"P05C07A": None}, 5),
]


def raw_rows(spark: SparkSession, edits: list, period: str = "2025T1") -> DataFrame:
    rows = []
    for i, (edit, _) in enumerate(edits, 1):
        row = {**BASE, "NUM_HOGAR": str(i), **edit}
        rows.append(tuple(row[c] for c in SPEC.source_columns))
    return spark.createDataFrame(rows, SPEC.schema).withColumn("periodo_archivo", F.lit(period))
