"""Normalisation, ordered eligibility rules and their waterfall, all in one projection."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.functions.codes import normalize_code, recode, to_number
from panelwright.spec import PanelSpec, Rule

FIRST_FAIL = "first_fail"


def normalize(frame: DataFrame, spec: PanelSpec) -> DataFrame:
    """Adds the analytic number, code and derived columns next to the raw text.

    Names resolve without regard to case, so an analytic name may take the place
    of a source column; ``keep_original`` saves the response first.

    Later filters test each parsed number several times. Were they pushed below this
    projection, every test would parse the text again; the observed row count at the end
    holds them above it, which halves the time of a filtered read. Columns are still
    pruned to the scan. A filter on the period belongs before this step, where it prunes files.
    """
    saved = {f"{c}_original": F.col(c) for c in spec.keep_original}
    numbers = {target: to_number(F.col(source)) for source, target in spec.numeric.items()}
    codes = {target: normalize_code(F.col(source)) for source, target in spec.codes.items()}
    normalized = frame.withColumns({**saved, **numbers, **codes}).withColumns(spec.derived())
    return normalized.observe(f"normalized-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def first_failing(rules: list[Rule]) -> Column:
    """Number of the first rule a row does not meet (a NULL condition fails), 0 if it meets all."""
    fails = [
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(i))
        for i, (_, condition) in enumerate(rules, 1)
    ]
    return F.coalesce(*fails, F.lit(0))


def judge(frame: DataFrame, spec: PanelSpec) -> DataFrame:
    """Normalised rows with the number of their first failing rule."""
    return normalize(frame, spec).withColumn(FIRST_FAIL, first_failing(spec.rules()))


def exclusion_counts(rules: list[Rule]) -> list[Column]:
    """Aggregates behind the waterfall: the total and one exclusion count per rule."""
    return [F.count(F.lit(1)).alias("total")] + [
        F.count_if(F.col(FIRST_FAIL) == i).alias(f"excluded_{i}") for i in range(1, len(rules) + 1)
    ]


def waterfall_steps(rules: list[Rule]) -> Column:
    """Array of step structs out of the aggregated counts; entries fall by what earlier steps took."""
    steps, entries = [], F.col("total")
    for i, (label, _) in enumerate(rules, 1):
        excluded = F.col(f"excluded_{i}")
        steps.append(
            F.struct(
                F.lit(i).alias("rule"),
                F.lit(label).alias("step"),
                entries.alias("entries"),
                excluded.alias("excluded"),
                (entries - excluded).alias("remaining"),
            )
        )
        entries = entries - excluded
    return F.array(*steps)


def waterfall(judged: DataFrame, spec: PanelSpec) -> DataFrame:
    """Entries, exclusions and remaining rows per period and rule.

    One aggregation for all periods and rules. Partial counts leave one short row
    per task and period, so a period of any size costs nothing extra.
    """
    rules = spec.rules()
    counts = judged.groupBy(spec.period).agg(*exclusion_counts(rules))
    return counts.select(spec.period, F.inline(waterfall_steps(rules)))


def eligible(judged: DataFrame, spec: PanelSpec, allowed: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows that meet every rule, with ``allowed`` code columns recoded after the filter."""
    kept = judged.filter(F.col(FIRST_FAIL) == 0).drop(FIRST_FAIL)
    return kept.withColumns(
        {c: recode(F.col(c), codes, spec.unknown) for c, codes in (allowed or {}).items()}
    )


def violations(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that fail, or cannot be judged by, the rules taken together."""
    return frame.filter(first_failing(rules) != 0)


def eligibility_rate(judged: DataFrame, spec: PanelSpec) -> DataFrame:
    """Initial rows, kept rows and their ratio per period."""
    return judged.groupBy(spec.period).agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(F.col(FIRST_FAIL) == 0).alias("kept"),
        F.avg((F.col(FIRST_FAIL) == 0).cast("double")).alias("rate"),
    )
