"""Normalisation, rules, missing and invalid values, duplicates, domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions.codes import dictionary_code, normalize_code
from panelwright.operators import quality, rules
from panelwright.operators.reshape import to_wide, union_all
from panelwright.plans.audit import audit, duplicate_report
from panelwright.plans.checks import prepared_faults, remaining_faults
from workload.tables import ALLOWED, CLEAN, DIRTY, EDU_CODES, SPEC, dirty, judged, query, table

def _per_column(columns, count: str) -> str:
    """SQL with a row per period and column; ``count`` counts cells of {c} and its parsed number {n}."""
    return " UNION ALL ".join(
        f"SELECT period, '{c}' AS variable, CAST(sum(CASE WHEN {count.format(c=c, n=SPEC.numeric.get(c))} THEN 1 ELSE 0 END) AS BIGINT) AS n, count(*) AS total"
        f" FROM ({CLEAN}) c GROUP BY period" for c in columns
    )


MISSING_SQL = _per_column(SPEC.source_columns, "{c} IS NULL OR trim({c}) = ''")
INVALID_SQL = _per_column(SPEC.numeric, "{c} IS NOT NULL AND trim({c}) <> '' AND NOT coalesce(isfinite({n}), false)")


@query(f"""
SELECT period, variable, n AS missing, CAST(round(100.0 * n / total, 3) AS DOUBLE) AS pct FROM ({MISSING_SQL}) u""")
def q_missingness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missingness(dirty(spark, sf), SPEC.period, list(SPEC.source_columns))


@query(f"""
PIVOT (SELECT period, 'bad_' || replace(variable, '_raw', '') AS variable, n FROM ({INVALID_SQL}) u)
ON variable IN ({", ".join(repr("bad_" + c.replace("_raw", "")) for c in SPEC.numeric)}) USING sum(n)::BIGINT GROUP BY period""")
def q_invalid_numeric(spark: SparkSession, sf: str) -> DataFrame:
    counts = quality.invalid_numbers(rules.normalize(dirty(spark, sf), SPEC), SPEC.period, SPEC.numeric)
    wide = to_wide(counts, [SPEC.period], "variable", list(SPEC.numeric), "invalid")
    return wide.withColumnsRenamed({c: "bad_" + c.replace("_raw", "") for c in SPEC.numeric})


WATERFALL = f"""
WITH f AS (SELECT period, first_fail, count(*) AS n FROM ({CLEAN}) c GROUP BY period, first_fail),
g AS (SELECT p.period, r.rule, coalesce(f.n, 0) AS excluded, t.total
      FROM (SELECT DISTINCT period FROM f) p
      CROSS JOIN (SELECT unnest([1,2,3,4,5,6,7,8]) AS rule) r
      JOIN (SELECT period, sum(n) AS total FROM f GROUP BY period) t ON t.period = p.period
      LEFT JOIN f ON f.period = p.period AND f.first_fail = r.rule)
SELECT period, CAST(rule AS INTEGER) AS rule,
  CAST(total - coalesce(sum(excluded) OVER (PARTITION BY period ORDER BY rule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS entries,
  CAST(excluded AS BIGINT) AS excluded,
  CAST(total - sum(excluded) OVER (PARTITION BY period ORDER BY rule ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS remaining
FROM g"""


@query(WATERFALL)
def q_rule_waterfall(spark: SparkSession, sf: str) -> DataFrame:
    return rules.waterfall(judged(spark, sf), SPEC).drop("step")


@query(f"""
WITH w AS ({WATERFALL})
SELECT period, CAST(max(entries) AS BIGINT) AS initial, CAST(sum(excluded) AS BIGINT) AS excluded,
  CAST(min(remaining) AS BIGINT) AS remaining, max(entries) = sum(excluded) + min(remaining) AS holds
FROM w GROUP BY period""")
def q_conservation(spark: SparkSession, sf: str) -> DataFrame:
    return quality.conservation(rules.waterfall(judged(spark, sf), SPEC), SPEC.period)


@query(f"""
WITH w AS ({WATERFALL})
SELECT period, 'excluded' AS kind, CAST(rule AS VARCHAR) AS item, excluded AS n FROM w
UNION ALL SELECT period, 'missing', variable, n FROM ({MISSING_SQL}) u
UNION ALL SELECT period, 'invalid', variable, n FROM ({INVALID_SQL}) u
UNION ALL SELECT period, 'kept', 'rows', CAST(sum(CASE WHEN first_fail = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM ({CLEAN}) c GROUP BY period""")
def q_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Everything the load audit counts, from one scan of the raw table."""
    tables = audit(judged(spark, sf), SPEC)

    def rows(frame: DataFrame, kind: str, item, n: str) -> DataFrame:
        return frame.select("period", F.lit(kind).alias("kind"), item.cast("string").alias("item"), F.col(n).alias("n"))

    return union_all([
        rows(tables.waterfall, "excluded", F.col("rule"), "excluded"),
        rows(tables.missing, "missing", F.col("variable"), "missing"),
        rows(tables.invalid, "invalid", F.col("variable"), "invalid"),
        rows(tables.rates, "kept", F.lit("rows"), "kept"),
    ])


@query(f"""
SELECT edu, domain, class_code, count(*) AS n FROM ({CLEAN}) c WHERE first_fail = 0 GROUP BY edu, domain, class_code""")
def q_recode(spark: SparkSession, sf: str) -> DataFrame:
    kept = rules.eligible(judged(spark, sf), SPEC, ALLOWED)
    return quality.frequency(kept, "edu", "domain", "class_code")


@query("""
SELECT count(*) AS dup_keys, CAST(sum(n) AS BIGINT) AS dup_rows, CAST(sum(CASE WHEN versions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS conflicts
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), l_returnflag, l_linestatus)) AS versions
      FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) k""")
def q_duplicate_audit(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
    return quality.duplicate_audit(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], columns).drop("null_keys")


@query("""
SELECT count(*) AS dup_keys, CAST(sum(n) AS BIGINT) AS dup_rows, CAST(sum(CASE WHEN versions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS conflicts
FROM (SELECT o_orderkey, count(*) AS n, count(DISTINCT concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority)) AS versions
      FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 100 = 0) u GROUP BY o_orderkey HAVING count(*) > 1) k""")
def q_duplicate_exact(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    repeated = union_all([orders, orders.filter("o_orderkey % 100 = 0")])
    return quality.duplicate_audit(
        repeated, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_orderpriority"]
    ).drop("null_keys")


@query(f"""
WITH k AS (SELECT period, class_raw, edu_raw, count(*) AS n, count(DISTINCT domain_raw) AS versions
  FROM ({DIRTY}) d GROUP BY period, class_raw, edu_raw HAVING count(*) > 1)
SELECT period, count(*) AS dup_keys, CAST(sum(n) AS BIGINT) AS dup_rows, CAST(sum(CASE WHEN versions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS conflicts,
  CAST(sum(CASE WHEN class_raw IS NULL OR edu_raw IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_keys FROM k GROUP BY period""")
def q_duplicates_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """A key that may be NULL in part, reported per period."""
    return quality.duplicate_audit(
        dirty(spark, sf), ["period", "class_raw", "edu_raw"], ["domain_raw"], by=["period"]
    )


@query(f"""
WITH k AS (SELECT period, hh, person, count(*) AS n, count(DISTINCT concat_ws('|', row_id)) AS versions,
    sum(CASE WHEN first_fail = 0 THEN 1 ELSE 0 END) AS n_after, count(DISTINCT CASE WHEN first_fail = 0 THEN row_id END) AS versions_after
  FROM ({CLEAN}) c GROUP BY period, hh, person)
SELECT period, 'before' AS stage, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS dup_keys, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS dup_rows,
  CAST(sum(CASE WHEN versions > 1 THEN 1 ELSE 0 END) AS BIGINT) AS conflicts, CAST(0 AS BIGINT) AS null_keys FROM k GROUP BY period
UNION ALL SELECT period, 'after', CAST(sum(CASE WHEN n_after > 1 THEN 1 ELSE 0 END) AS BIGINT), CAST(sum(CASE WHEN n_after > 1 THEN n_after ELSE 0 END) AS BIGINT),
  CAST(sum(CASE WHEN versions_after > 1 THEN 1 ELSE 0 END) AS BIGINT), CAST(0 AS BIGINT) FROM k GROUP BY period""")
def q_duplicate_report(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicate keys before and after the rules, per period, zeros included."""
    return duplicate_report(judged(spark, sf), SPEC, also=("row_id",))


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT concat_ws('|', CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))) AS versions
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
ORDER BY versions DESC, l_orderkey, l_linenumber LIMIT 10""")
def q_duplicate_examples(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_examples(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    )


@query("""
SELECT l.l_returnflag, count(*) AS n FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) k
  ON k.l_orderkey = l.l_orderkey AND k.l_linenumber = l.l_linenumber GROUP BY l.l_returnflag""")
def q_duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.rows_of_duplicated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return quality.frequency(rows, "l_returnflag")


@query(f"SELECT period, class_raw, count(*) AS n FROM ({DIRTY}) d GROUP BY period, class_raw")
def q_raw_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return quality.frequency(dirty(spark, sf), "period", "class_raw")


@query(f"""
SELECT CAST(sum(CASE WHEN first_fail = 0 THEN 0 ELSE 1 END) AS BIGINT) AS violations, count(*) AS n FROM ({CLEAN}) c""")
def q_rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.rule_counts(rules.normalize(dirty(spark, sf), SPEC), SPEC.rules())


@query(f"""
SELECT period, count(*) AS initial_rows, CAST(sum(CASE WHEN first_fail = 0 THEN 1 ELSE 0 END) AS BIGINT) AS kept,
  round(CAST(sum(CASE WHEN first_fail = 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS rate FROM ({CLEAN}) c GROUP BY period""")
def q_eligibility_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rules.eligibility_rate(judged(spark, sf), SPEC).withColumn("rate", F.round("rate", 6))


@query(f"""
SELECT d.edu_raw AS code, count(*) AS n FROM ({DIRTY}) d
LEFT JOIN (SELECT * FROM (VALUES ('0'),('1'),('2'),('3'),('4'),('5'),('6'),('7')) AS t(code)) l ON l.code = d.edu_raw
WHERE l.code IS NULL GROUP BY d.edu_raw""")
def q_domain_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.outside_domain(dirty(spark, sf).withColumnRenamed("edu_raw", "code"), "code", EDU_CODES)


@query(f"""
SELECT p.period, r.code FROM (SELECT DISTINCT period FROM ({DIRTY}) d) p
CROSS JOIN (SELECT unnest(['0','1','2','3','4','5','6','7','8','9','10']) AS code) r
LEFT JOIN (SELECT DISTINCT period, edu_raw FROM ({DIRTY}) d) h ON h.period = p.period AND h.edu_raw = r.code
WHERE h.edu_raw IS NULL""")
def q_required_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of a required list that a period does not hold ('10' never occurs)."""
    required = [*EDU_CODES, "8", "9", "10"]
    lacking = quality.lacks_codes(dirty(spark, sf), "edu_raw", required, ["period"])
    return lacking.select("period", F.explode("missing").alias("code"))


@query(f"""
SELECT coalesce(a.edu, b.edu) AS edu, CASE WHEN b.edu IS NULL THEN 'left' ELSE 'right' END AS only_in
FROM (SELECT DISTINCT edu FROM ({CLEAN}) c WHERE first_fail = 0) a
FULL JOIN (SELECT DISTINCT edu_raw AS edu FROM ({DIRTY}) d WHERE edu_raw IS NOT NULL) b ON a.edu = b.edu
WHERE a.edu IS NULL OR b.edu IS NULL""")
def q_set_equality(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values that only the recoded or only the raw column holds."""
    recoded = rules.eligible(judged(spark, sf), SPEC, ALLOWED).select("edu")
    raw = dirty(spark, sf).filter("edu_raw is not null").select(F.col("edu_raw").alias("edu"))
    return quality.set_difference(recoded, raw)


@query(f"""
SELECT period, CAST(sum(CASE WHEN first_fail = 0 THEN 1 ELSE 0 END) AS BIGINT) AS remaining,
  CAST(sum(CASE WHEN first_fail = 0 AND class_code <> '4' THEN 1 ELSE 0 END) AS BIGINT) AS "rows"
FROM ({CLEAN}) c GROUP BY period HAVING sum(CASE WHEN first_fail = 0 AND class_code = '4' THEN 1 ELSE 0 END) > 0""")
def q_remaining_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Periods whose prepared rows miss some that the waterfall left; one class is dropped on purpose."""
    rows = judged(spark, sf)
    kept = rules.eligible(rows, SPEC).filter("class_code <> '4'")
    return remaining_faults(kept, rules.waterfall(rows, SPEC), SPEC)


@query(f"""
SELECT "check", CAST(faults AS BIGINT) AS faults FROM (
  SELECT 'rule_violations' AS "check", sum(CASE WHEN first_fail = 0 THEN 0 ELSE 1 END) AS faults FROM ({CLEAN}) c
  UNION ALL SELECT 'unexpected_period', sum(CASE WHEN period IN ('1996T1', '1996T2', '1890T1') THEN 0 ELSE 1 END) FROM ({DIRTY}) d
  UNION ALL SELECT 'absent_periods', 3 - count(DISTINCT period) FROM ({DIRTY}) d WHERE period IN ('1996T1', '1996T2', '1890T1')
  UNION ALL SELECT 'codes_edu', sum(CASE WHEN edu_raw IN ('0','1','2','3','4','5','6','7') THEN 0 ELSE 1 END) FROM ({DIRTY}) d
  UNION ALL SELECT 'codes_domain', sum(CASE WHEN domain_raw IN ('1','2','3') THEN 0 ELSE 1 END) FROM ({DIRTY}) d) u""")
def q_prepared_recheck(spark: SparkSession, sf: str) -> DataFrame:
    """The re-check of a prepared table, run on unfiltered rows so that every check finds faults."""
    return prepared_faults(rules.normalize(dirty(spark, sf), SPEC), SPEC, ["1996T1", "1996T2", "1890T1"], ALLOWED)


@query(r"""
SELECT raw, regexp_replace(trim(coalesce(raw, '')), '\.0$', '') AS one_strip, regexp_replace(trim(raw), '\.0+$', '') AS all_strip, count(*) AS n
FROM (SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 7 = 0 THEN concat(' ', CAST(l_quantity AS VARCHAR), '0 ')
  WHEN l_orderkey % 5 = 0 THEN concat(CAST(l_quantity AS VARCHAR), '.0') WHEN l_orderkey % 3 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
  ELSE CAST(l_quantity AS VARCHAR) END AS raw FROM lineitem) s GROUP BY raw""")
def q_code_cleaner(spark: SparkSession, sf: str) -> DataFrame:
    """One trailing '.0' against any number of zeros, over quantities rendered in many ways."""
    k, quantity = F.col("l_orderkey"), F.col("l_quantity").cast("string")
    raw = (
        F.when(k % 11 == 0, F.lit(None))
        .when(k % 7 == 0, F.concat(F.lit(" "), quantity, F.lit("0 ")))
        .when(k % 5 == 0, F.concat(quantity, F.lit(".0")))
        .when(k % 3 == 0, F.col("l_quantity").cast("long").cast("string"))
        .otherwise(quantity)
    )
    values = quality.frequency(table(spark, sf, "lineitem").select(raw.alias("raw")), "raw")
    return values.select(
        "raw", dictionary_code(F.col("raw")).alias("one_strip"), normalize_code(F.col("raw")).alias("all_strip"), "n"
    )
