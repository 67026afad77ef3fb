"""Preparation of all periods: one audit pass, one duplicate pass, one read of the eligible rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from panelwright.operators import quality
from panelwright.operators.rules import FIRST_FAIL, eligible, exclusion_counts, waterfall_steps
from panelwright.session import stored
from panelwright.sources.codelist import lists_missing, recode_by_list
from panelwright.spec import PanelSpec


@dataclass
class Audit:
    """The audit tables of a load, all read from one stored aggregate row per period."""

    counts: DataFrame
    waterfall: DataFrame
    missing: DataFrame
    invalid: DataFrame
    rates: DataFrame


def audit(judged: DataFrame, spec: PanelSpec) -> Audit:
    """Waterfall, missing cells, invalid numbers and eligibility of all periods in ONE scan.

    Everything counted is a conditional count, so tasks send one short row per period
    however large the period is. The stored result (a row per period) feeds all tables.
    """
    rules = spec.rules()
    counts = stored(
        judged.groupBy(spec.period).agg(
            *exclusion_counts(rules),
            *quality.missing_counts(spec.source_columns),
            *quality.invalid_counts(spec.numeric),
        ),
        "audit",
    )
    steps = counts.select(spec.period, F.inline(waterfall_steps(rules)))
    kept = steps.groupBy(spec.period).agg(
        F.min_by("entries", "rule").alias("initial_rows"), F.max_by("remaining", "rule").alias("kept")
    )
    return Audit(
        counts=counts,
        waterfall=steps,
        missing=counts.select(spec.period, F.inline(quality.missing_rows(spec.source_columns, F.col("total")))),
        invalid=counts.select(spec.period, F.inline(quality.invalid_rows(spec.numeric))),
        rates=kept.withColumn("rate", F.try_divide(F.col("kept").cast("double"), F.col("initial_rows").cast("double"))),
    )


def prepare(
    judged: DataFrame, spec: PanelSpec, lists: DataFrame | None = None, list_period: str = "period"
) -> DataFrame:
    """Eligible rows with codes checked against the list of the row's own period, after the filter.

    A period of the table without a list for a recoded variable is an error: all its codes would be lost.
    """
    kept = eligible(judged, spec)
    if lists is not None and spec.recoded:
        quality.require_empty(
            lists_missing(judged, lists, spec.period, list_period, list(spec.recoded.values())), "periods without a code list"
        )
    for target, variable in (spec.recoded if lists is not None else {}).items():
        kept = recode_by_list(kept, lists, variable, target, {spec.period: list_period}, spec.unknown)
    return kept


def duplicate_report(judged: DataFrame, spec: PanelSpec, also: tuple[str, ...] = ()) -> DataFrame:
    """Duplicate audit per period before and after the rules, from one shuffle by key.

    Versions are told apart by the source columns as they came (and ``also``, such as the
    file of origin): every analytic column follows from them, so the same rows differ
    before and after.
    """
    source = [f"{c}_original" if c in spec.keep_original else c for c in spec.source_columns]
    stages = {"before": F.lit(True), "after": F.col(FIRST_FAIL) == 0}
    return quality.duplicate_stages(judged, list(spec.key), [*source, *also], stages, by=[spec.period])


def check_load(result: Audit, duplicates: DataFrame, spec: PanelSpec) -> None:
    """Raises if the waterfall does not add up or a key holds conflicting rows."""
    quality.require_empty(quality.conservation(result.waterfall, spec.period).filter("not holds"), "rows lost in the waterfall")
    quality.require_empty(duplicates.filter("conflicts > 0"), "conflicting rows under one key")


