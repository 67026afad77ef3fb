"""Missing and invalid values, duplicate keys, code domains and consistency checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.functions.codes import is_blank, is_invalid_number
from panelwright.functions.hashing import version_hashes
from panelwright.functions.numeric import percent
from panelwright.operators.joins import join_aggregate
from panelwright.operators.rules import Rule, first_failing


def missing_counts(columns: Iterable[str]) -> list[Column]:
    return [F.count_if(is_blank(F.col(c))).alias(f"missing_{c}") for c in columns]


def missing_rows(columns: Iterable[str], total: Column) -> Column:
    """Array of (variable, missing, pct) out of the counts and the row total."""
    return F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.col(f"missing_{c}").alias("missing"),
                F.round(percent(F.col(f"missing_{c}"), total), 3).alias("pct"),
            )
            for c in columns
        ]
    )


def missingness(frame: DataFrame, period: str, columns: list[str]) -> DataFrame:
    """NULL or blank cells per period and variable, in one aggregation over all columns."""
    counts = frame.groupBy(period).agg(F.count(F.lit(1)).alias("total"), *missing_counts(columns))
    return counts.select(period, F.inline(missing_rows(columns, F.col("total"))))


def invalid_counts(numeric: dict[str, str]) -> list[Column]:
    return [
        F.count_if(is_invalid_number(F.col(source), F.col(target))).alias(f"invalid_{source}")
        for source, target in numeric.items()
    ]


def invalid_rows(numeric: dict[str, str]) -> Column:
    return F.array(
        *[F.struct(F.lit(s).alias("variable"), F.col(f"invalid_{s}").alias("invalid")) for s in numeric]
    )


def invalid_numbers(normalized: DataFrame, period: str, numeric: dict[str, str]) -> DataFrame:
    """Cells that hold something but no finite number, per period and numeric variable."""
    counts = normalized.groupBy(period).agg(*invalid_counts(numeric))
    return counts.select(period, F.inline(invalid_rows(numeric)))


def frequency(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def key_versions(frame: DataFrame, key: list[str], columns: list[str], stages: dict[str, Column]) -> DataFrame:
    """Per key and stage: its rows and whether they differ, as ``stages`` array of structs.

    A stage is a condition on the rows (all of them, those kept by the rules). One shuffle
    by key serves all stages, on fixed-width partial aggregates: a key with any number
    of rows leaves one row per task. NULL keys form a group of their own.
    """
    first, second = version_hashes(columns)
    conditions = {name: F.coalesce(condition, F.lit(False)) for name, condition in stages.items()}
    hashed = frame.select(*key, first.alias("_h1"), second.alias("_h2"), *[c.alias(f"_in_{n}") for n, c in conditions.items()])
    aggregates, results = [], []
    for name in stages:
        ends = [f"_{name}_{e}" for e in ("n", "min1", "max1", "min2", "max2")]
        h1, h2 = F.when(F.col(f"_in_{name}"), F.col("_h1")), F.when(F.col(f"_in_{name}"), F.col("_h2"))
        values = [F.count(h1), F.min(h1), F.max(h1), F.min(h2), F.max(h2)]
        aggregates += [v.alias(e) for v, e in zip(values, ends, strict=True)]
        n, min1, max1, min2, max2 = (F.col(e) for e in ends)
        differs = F.coalesce((min1 != max1) | (min2 != max2), F.lit(False))
        results.append(F.struct(F.lit(name).alias("stage"), n.alias("n"), differs.alias("conflict")))
    return hashed.groupBy(*key).agg(*aggregates).select(*key, F.array(*results).alias("stages"))


def duplicate_stages(
    frame: DataFrame, key: list[str], columns: list[str], stages: dict[str, Column], by: list[str] | None = None
) -> DataFrame:
    """Per stage: duplicated keys, rows in them, and keys whose rows are not exact repeats.

    ``by`` names key columns (the period, say) to report separately. Duplicated keys
    holding a NULL are counted in, and once more on their own in ``null_keys``.
    """
    has_null = F.lit(False)
    for column in key:
        has_null = has_null | F.col(column).isNull()
    twice = F.col("n") > 1
    groups = key_versions(frame, key, columns, stages).select(*key, F.inline("stages"))
    return groups.groupBy(*(by or []), "stage").agg(
        F.count_if(twice).alias("dup_keys"),
        F.coalesce(F.sum(F.when(twice, F.col("n"))), F.lit(0)).cast("long").alias("dup_rows"),
        F.count_if(twice & F.col("conflict")).alias("conflicts"),
        F.count_if(twice & has_null).alias("null_keys"),
    )


def duplicate_audit(frame: DataFrame, key: list[str], columns: list[str], by: list[str] | None = None) -> DataFrame:
    """The duplicate counts of a whole frame; one row of zeros if no key repeats."""
    counts = duplicate_stages(frame, key, columns, {"all": F.lit(True)}, by).drop("stage")
    if by:
        return counts
    # An empty frame has no group; summing nothing still gives the row of zeros.
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in counts.columns])


def duplicate_examples(frame: DataFrame, key: list[str], columns: list[str], limit: int = 10) -> DataFrame:
    """The duplicated keys with most distinct versions, ties in key order."""
    first, second = version_hashes(columns)
    hashed = frame.select(*key, first.alias("_h1"), second.alias("_h2"))
    # The whole table is shuffled once, by key; only rows of repeated keys are counted by version.
    rows = rows_of_duplicated_keys(hashed, key, null_safe=True)
    versions = (
        rows.groupBy(*key, "_h1", "_h2").agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(*key).agg(F.sum("_rows").alias("n"), F.count(F.lit(1)).alias("versions"))
    )
    return versions.orderBy(F.desc("versions"), *key).limit(limit)


def rows_of_duplicated_keys(frame: DataFrame, key: list[str], null_safe: bool = False) -> DataFrame:
    """All rows whose key occurs more than once, kept as they are; keys holding a NULL match none, or each other.

    Repeated keys are few in a sound table and are then looked up without moving the rows.
    """
    repeated = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return join_aggregate(frame, repeated, key, "_n", "left_semi", "repeated-keys", null_safe)


def outside_domain(frame: DataFrame, code: str, allowed: list[str]) -> DataFrame:
    """Codes that are not in the list (NULL included) and how many rows hold them."""
    return frequency(frame.filter(~F.coalesce(F.col(code).isin(*allowed), F.lit(False))), code)


def lacks_codes(codes: DataFrame, code: str, required: list[str], by: list[str]) -> DataFrame:
    """Groups whose code list does not hold every required code."""
    needed = F.array(*[F.lit(r) for r in required])
    found = F.collect_set(F.when(F.col(code).isin(*required), F.col(code)))
    missing = F.array_sort(F.array_except(needed, found))
    return codes.groupBy(*by).agg(missing.alias("missing")).filter(F.size("missing") > 0)


def rule_counts(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows and rule violations of a prepared table, in one aggregation."""
    return frame.agg(
        F.count_if(first_failing(rules) != 0).alias("violations"), F.count(F.lit(1)).alias("n")
    )


def conservation(steps: DataFrame, period: str) -> DataFrame:
    """Per period: whether exclusions plus the last remaining rows give back the first entries."""
    sums = steps.groupBy(period).agg(
        F.min_by("entries", "rule").alias("initial"),
        F.sum("excluded").alias("excluded"),
        F.max_by("remaining", "rule").alias("remaining"),
    )
    return sums.withColumn("holds", F.col("initial") == F.col("excluded") + F.col("remaining"))


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows present on one side only; empty when both hold the same set."""
    return (
        left.distinct().withColumn("side", F.lit("left"))
        .unionByName(right.distinct().withColumn("side", F.lit("right")))
        .groupBy(*left.columns)
        .agg(F.min("side").alias("first_side"), F.max("side").alias("last_side"))
        .filter(F.col("first_side") == F.col("last_side"))
        .select(*left.columns, F.col("first_side").alias("only_in"))
    )


class CheckFailed(ValueError):
    """A consistency check found offending rows."""


def require_empty(offending: DataFrame, message: str, show: int = 5) -> None:
    """Raise with the first few offending rows, if there are any."""
    rows = offending.limit(show).collect()
    if rows:
        raise CheckFailed(f"{message}: {[r.asDict() for r in rows]}")
