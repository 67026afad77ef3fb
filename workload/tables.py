"""Registry, table reader, and the survey-like text table derived from ``orders``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelwright.functions.codes import period_label
from panelwright.functions.numeric import years_and_months
from panelwright.operators.rules import judge
from panelwright.spec import PanelSpec, wage_rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function name, with its SQL counterpart if it has one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """All-text rows with missing, blank, malformed and out-of-range cells, from every order."""
    k = F.col("o_orderkey")

    def when(divisor: int, value: str | None) -> tuple[Column, Column]:
        return k % divisor == 0, F.lit(value)

    def pick(default: Column, *cases: tuple[Column, Column]) -> Column:
        condition, value = cases[0]
        expr = F.when(condition, value)
        for condition, value in cases[1:]:
            expr = expr.when(condition, value)
        return expr.otherwise(default)

    def text(value: Column) -> Column:
        return value.cast("string")

    return table(spark, sf, "orders").select(
        k.alias("row_id"),
        period_label(F.year("o_orderdate"), F.quarter("o_orderdate")).alias("period"),
        text(F.col("o_custkey")).alias("hh"),
        text(k % 7).alias("person"),
        pick(text(10 + k % 60), when(29, "Infinity"), when(31, "abc")).alias("age_raw"),
        pick(F.lit("1.0"), when(5, " 2.0 ")).alias("employed_raw"),
        pick(
            text(k % 6), when(17, None), when(11, ""),
            (k % 13 == 0, F.concat(F.lit(" "), text(k % 6), F.lit(".0 "))),
        ).alias("class_raw"),
        pick(text(F.col("o_totalprice")), when(61, "0"), when(67, "NaN")).alias("pay_raw"),
        pick(text(k % 50), when(37, "-1"), when(41, None)).alias("tenure_y_raw"),
        pick(text(k % 12), when(43, "1.5"), when(47, "12")).alias("tenure_m_raw"),
        pick(text(8 + k % 60), when(53, "169"), when(59, None)).alias("hours_raw"),
        pick(text(k % 10), when(19, None)).alias("edu_raw"),
        text(1 + k % 4).alias("domain_raw"),
    )


STEPS = [
    "age finite and at least 15", "employed", "wage earner", "pay finite and positive",
    "tenure years not negative", "tenure months whole, 0 to 11", "tenure within age", "hours within a week",
]
EDU_CODES = ["0", "1", "2", "3", "4", "5", "6", "7"]
DOMAIN_CODES = ["1", "2", "3"]

SPEC = PanelSpec(
    period="period",
    key=("period", "hh", "person"),
    source_columns=(
        "hh", "person", "age_raw", "employed_raw", "class_raw", "pay_raw", "tenure_y_raw",
        "tenure_m_raw", "hours_raw", "edu_raw", "domain_raw",
    ),
    numeric={
        "age_raw": "age", "pay_raw": "pay", "tenure_y_raw": "tenure_y",
        "tenure_m_raw": "tenure_m", "hours_raw": "hours",
    },
    codes={"employed_raw": "employed", "class_raw": "class_code", "edu_raw": "edu", "domain_raw": "domain"},
    derived=lambda: {"tenure": years_and_months(F.col("tenure_y"), F.col("tenure_m"))},
    rules=lambda: wage_rules(
        STEPS, "age", "employed", "class_code", "pay", "tenure_y", "tenure_m", "tenure", "hours"
    ),
    recoded={"edu": "EDU"},
    target="pay",
    numeric_predictors=("age", "tenure", "hours"),
    categorical_predictors=("edu", "class_code", "domain"),
    unknown="UNKNOWN",
)
ALLOWED = {"edu": EDU_CODES, "domain": DOMAIN_CODES}


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return judge(dirty(spark, sf), SPEC)


# SQL of the same two tables.
DIRTY = """SELECT o_orderkey AS row_id,
  concat(CAST(year(o_orderdate) AS VARCHAR), 'T', CAST(quarter(o_orderdate) AS VARCHAR)) AS period,
  CAST(o_custkey AS VARCHAR) AS hh, CAST(o_orderkey % 7 AS VARCHAR) AS person,
  CASE WHEN o_orderkey % 29 = 0 THEN 'Infinity' WHEN o_orderkey % 31 = 0 THEN 'abc'
       ELSE CAST(10 + o_orderkey % 60 AS VARCHAR) END AS age_raw,
  CASE WHEN o_orderkey % 5 = 0 THEN ' 2.0 ' ELSE '1.0' END AS employed_raw,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
       WHEN o_orderkey % 13 = 0 THEN concat(' ', CAST(o_orderkey % 6 AS VARCHAR), '.0 ')
       ELSE CAST(o_orderkey % 6 AS VARCHAR) END AS class_raw,
  CASE WHEN o_orderkey % 61 = 0 THEN '0' WHEN o_orderkey % 67 = 0 THEN 'NaN'
       ELSE CAST(o_totalprice AS VARCHAR) END AS pay_raw,
  CASE WHEN o_orderkey % 37 = 0 THEN '-1' WHEN o_orderkey % 41 = 0 THEN NULL
       ELSE CAST(o_orderkey % 50 AS VARCHAR) END AS tenure_y_raw,
  CASE WHEN o_orderkey % 43 = 0 THEN '1.5' WHEN o_orderkey % 47 = 0 THEN '12'
       ELSE CAST(o_orderkey % 12 AS VARCHAR) END AS tenure_m_raw,
  CASE WHEN o_orderkey % 53 = 0 THEN '169' WHEN o_orderkey % 59 = 0 THEN NULL
       ELSE CAST(8 + o_orderkey % 60 AS VARCHAR) END AS hours_raw,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderkey % 10 AS VARCHAR) END AS edu_raw,
  CAST(1 + o_orderkey % 4 AS VARCHAR) AS domain_raw
FROM orders"""

CLEAN = rf"""SELECT t.*, CASE
  WHEN NOT coalesce(isfinite(age) AND age >= 15, false) THEN 1
  WHEN NOT coalesce(employed = '1', false) THEN 2
  WHEN NOT coalesce(class_code IN ('1','2','3','4'), false) THEN 3
  WHEN NOT coalesce(isfinite(pay) AND pay > 0, false) THEN 4
  WHEN NOT coalesce(isfinite(tenure_y) AND tenure_y >= 0, false) THEN 5
  WHEN NOT coalesce(isfinite(tenure_m) AND tenure_m = floor(tenure_m) AND tenure_m BETWEEN 0 AND 11, false) THEN 6
  WHEN NOT coalesce(tenure <= age, false) THEN 7
  WHEN NOT coalesce(isfinite(hours) AND hours > 0 AND hours <= 168, false) THEN 8
  ELSE 0 END AS first_fail
FROM (SELECT d.*, TRY_CAST(age_raw AS DOUBLE) AS age, TRY_CAST(pay_raw AS DOUBLE) AS pay,
        TRY_CAST(tenure_y_raw AS DOUBLE) AS tenure_y, TRY_CAST(tenure_m_raw AS DOUBLE) AS tenure_m,
        TRY_CAST(tenure_y_raw AS DOUBLE) + TRY_CAST(tenure_m_raw AS DOUBLE) / 12 AS tenure,
        TRY_CAST(hours_raw AS DOUBLE) AS hours,
        regexp_replace(trim(employed_raw), '\.0+$', '') AS employed,
        regexp_replace(trim(class_raw), '\.0+$', '') AS class_code,
        CASE WHEN regexp_replace(trim(edu_raw), '\.0+$', '') IN ('0','1','2','3','4','5','6','7')
             THEN regexp_replace(trim(edu_raw), '\.0+$', '') ELSE 'UNKNOWN' END AS edu,
        CASE WHEN regexp_replace(trim(domain_raw), '\.0+$', '') IN ('1','2','3')
             THEN regexp_replace(trim(domain_raw), '\.0+$', '') ELSE 'UNKNOWN' END AS domain
      FROM ({DIRTY}) d) t"""
