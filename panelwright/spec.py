"""Settings of a panel: columns, key, numeric and code fields, ordered rules, predictors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F, types as T

from panelwright.functions.codes import UNKNOWN, is_finite, is_whole
from panelwright.functions.numeric import years_and_months

Rule = tuple[str, Column]


@dataclass(frozen=True)
class PanelSpec:
    """Everything an operator needs to know about one panel; holds no data."""

    period: str
    key: tuple[str, ...]
    source_columns: tuple[str, ...]
    numeric: dict[str, str]
    codes: dict[str, str]
    rules: Callable[[], list[Rule]]
    derived: Callable[[], dict[str, Column]] = dict
    keep_original: tuple[str, ...] = ()
    recoded: dict[str, str] = field(default_factory=dict)
    target: str = ""
    numeric_predictors: tuple[str, ...] = ()
    categorical_predictors: tuple[str, ...] = ()
    unknown: str = UNKNOWN

    @property
    def schema(self) -> T.StructType:
        """All source columns as nullable strings."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.source_columns])

    @property
    def predictors(self) -> tuple[str, ...]:
        return self.numeric_predictors + self.categorical_predictors


def wage_rules(
    labels: list[str],
    age: str,
    employed: str,
    occupation: str,
    pay: str,
    years: str,
    months: str,
    tenure: str,
    hours: str,
    occupations: tuple[str, ...] = ("1", "2", "3", "4"),
    min_age: int = 15,
    max_hours: int = 168,
) -> list[Rule]:
    """The ordered eligibility rules of a wage panel, over the named columns."""
    c = F.col
    conditions = [
        is_finite(c(age)) & (c(age) >= min_age),
        c(employed) == "1",
        c(occupation).isin(*occupations),
        is_finite(c(pay)) & (c(pay) > 0),
        is_finite(c(years)) & (c(years) >= 0),
        c(months).between(0, 11) & is_whole(c(months)),
        c(tenure) <= c(age),
        is_finite(c(hours)) & (c(hours) > 0) & (c(hours) <= max_hours),
    ]
    return list(zip(labels, conditions, strict=True))


# Source column names of the labour-force files and the step labels of the audit.
LABOUR_COLUMNS = (
    "ANIO", "TRIMESTRE", "DOMINIO", "NUM_HOGAR", "FACTOR", "NUM_PERSONA", "P02A03",
    "P05C07A", "P05C07B", "P05H01A", "P03A03A", "P05C16", "OCUPADOS", "P05D01",
)
LABOUR_STEPS = [
    "edad finita >= 15",
    "OCUPADOS = 1",
    "P05C16 asalariado 1-4",
    "salario finito > 0",
    "antiguedad_anios finita >= 0",
    "antiguedad_meses entero 0-11",
    "antiguedad <= edad",
    "horas finitas 0-168",
]


def labour_spec() -> PanelSpec:
    """The quarterly labour-force panel."""
    return PanelSpec(
        period="periodo_archivo",
        key=("periodo_archivo", "NUM_HOGAR", "NUM_PERSONA"),
        source_columns=LABOUR_COLUMNS,
        numeric={
            "P02A03": "edad",
            "P05C07A": "antiguedad_anios",
            "P05C07B": "antiguedad_meses",
            "P05H01A": "horas_semanales",
            "P05D01": "salario_mensual",
        },
        codes={
            "OCUPADOS": "ocupado",
            "P05C16": "categoria_ocupacional",
            "P03A03A": "nivel_educativo",
            "DOMINIO": "dominio",
        },
        keep_original=("DOMINIO",),
        derived=lambda: {
            "antiguedad": years_and_months(F.col("antiguedad_anios"), F.col("antiguedad_meses"))
        },
        rules=lambda: wage_rules(
            LABOUR_STEPS, "edad", "ocupado", "categoria_ocupacional", "salario_mensual",
            "antiguedad_anios", "antiguedad_meses", "antiguedad", "horas_semanales",
        ),
        recoded={"nivel_educativo": "P03A03A", "dominio": "DOMINIO"},
        target="salario_mensual",
        numeric_predictors=("edad", "antiguedad", "horas_semanales"),
        categorical_predictors=("nivel_educativo", "categoria_ocupacional", "dominio"),
    )


# The two spaces of the segmentation: the profile, and the same with pay added.
SEGMENT_VARIANTS = {
    "perfil_laboral": ("edad", "antiguedad", "horas_semanales"),
    "con_salario": ("edad", "antiguedad", "horas_semanales", "salario_mensual"),
}
SEGMENT_KS = (2, 3, 4, 5)
SEGMENT_SEEDS = (42, 123, 2026)
