"""Landed files, provenance, manifests, code lists, sinks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions.hashing import content_sums, fingerprint
from panelwright.operators import rules
from panelwright.plans.audit import prepare
from panelwright.session import new_folder
from panelwright.sources import codelist, landing, manifest
from panelwright.sources.sinks import read_back, write_checked, write_table
from workload.tables import ALLOWED, CLEAN, DIRTY, SPEC, dirty, judged, query, table


def _land(spark: SparkSession, sf: str) -> str:
    """The raw text table as CSV files, a folder per period."""
    folder = new_folder(spark, "landing")
    rows = dirty(spark, sf).withColumn("periodo", F.col("period"))
    rows.hint("rebalance", "periodo").write.partitionBy("periodo").option("header", True).csv(folder)
    return folder


@query(f"""
SELECT period AS periodo_archivo, CAST(substr(period, 1, 4) AS INTEGER) AS anio_archivo, CAST(right(period, 1) AS INTEGER) AS trimestre_calendario,
  count(*) AS n, CAST(sum(CASE WHEN class_raw IS NULL OR trim(class_raw) = '' THEN 1 ELSE 0 END) AS BIGINT) AS no_class, true AS file_named
FROM ({DIRTY}) d GROUP BY period""")
def q_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """One scan over all landed files; period, year and quarter come from the path."""
    reader = spark.read.schema(dirty(spark, sf).schema).options(header=True, recursiveFileLookup=True)
    tagged = landing.with_provenance(reader.csv(_land(spark, sf)))
    return tagged.groupBy("periodo_archivo", "anio_archivo", "trimestre_calendario").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("class_raw").isNull() | (F.trim("class_raw") == "")).alias("no_class"),
        F.every(F.col("archivo_origen").isNotNull()).alias("file_named"),
    )


@query(f"""
SELECT concat(substr(period, 1, 4), 'T1') AS periodo_archivo, count(*) AS initial_rows, count(class_raw) - CAST(sum(CASE WHEN class_raw = '' THEN 1 ELSE 0 END) AS BIGINT) AS with_class,
  CAST(sum(CAST(hh AS BIGINT)) AS BIGINT) AS hh_sum
FROM ({DIRTY}) d GROUP BY substr(period, 1, 4)""")
def q_union_layouts(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly files of two widths and column orders, scanned by name and united."""
    scanned = landing.scan_periods(spark, _land_years(spark, sf), SPEC)
    return scanned.groupBy("periodo_archivo").agg(
        F.count(F.lit(1)).alias("initial_rows"),
        F.count_if(F.col("class_raw") != "").alias("with_class"),
        F.sum(F.col("hh").cast("long")).alias("hh_sum"),
    )


def _land_years(spark: SparkSession, sf: str) -> dict[str, str]:
    """Every year's rows as files, odd years two columns wider and in another order; a path per period."""
    rows = dirty(spark, sf).withColumn("_year", F.substring("period", 1, 4).cast("int"))
    wide = rows.withColumns({"extra_1": F.lit("x"), "extra_2": F.col("hh")})
    paths = {}
    for odd, frame in ((1, wide.select(*sorted(wide.columns, reverse=True))), (0, rows)):
        folder = new_folder(spark, f"years-{odd}")
        frame.filter(F.col("_year") % 2 == odd).write.partitionBy("_year").option("header", True).csv(folder)
        found = rows.select("_year").distinct().filter(F.col("_year") % 2 == odd).collect()  # a row per year
        paths |= {f"{r[0]}T1": f"{folder}/_year={r[0]}" for r in found}
    return paths


@query(f"""
WITH y AS (SELECT CAST(substr(period, 1, 4) AS INTEGER) AS yr, count(*) AS n FROM ({DIRTY}) d GROUP BY substr(period, 1, 4))
SELECT concat(CAST(yr AS VARCHAR), 'T1') AS periodo, n AS initial_rows, CASE WHEN yr % 2 = 1 THEN 15 ELSE 13 END AS "columns",
  CASE WHEN yr = 1997 THEN n + 1 ELSE n END AS announced_rows, CASE WHEN yr = 1998 THEN 14 WHEN yr % 2 = 1 THEN 15 ELSE 13 END AS announced_columns,
  yr NOT IN (1997, 1998) AS agrees FROM y""")
def q_load_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns of the landed years, read from their files, next to what was announced (two years are wrong on purpose)."""
    paths = _land_years(spark, sf)
    scanned = landing.scan_periods(spark, paths, SPEC)
    observed = landing.observed_dimensions(spark, paths, scanned)
    return landing.announced_summary(observed, _announced(spark, sf), ["periodo"])


def _announced(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions of the landed years; the rows of 1997 and the width of 1998 are wrong on purpose."""
    year = F.substring("period", 1, 4).cast("int")
    return dirty(spark, sf).groupBy(year.alias("y")).agg(F.count(F.lit(1)).alias("n")).select(
        F.concat("y", F.lit("T1")).alias("periodo"),
        (F.col("n") + (F.col("y") == 1997).cast("int")).alias("rows"),
        F.when(F.col("y") == 1998, 14).when(F.col("y") % 2 == 1, 15).otherwise(13).alias("columns"),
    )


@query(f"""
WITH y AS (SELECT CAST(substr(period, 1, 4) AS INTEGER) AS yr, count(*) AS n FROM ({DIRTY}) d GROUP BY substr(period, 1, 4))
SELECT concat(CAST(yr AS VARCHAR), 'T1') AS periodo, CASE WHEN yr = 1997 THEN n + 1 ELSE n END AS "rows", CASE WHEN yr = 1998 THEN 14 ELSE 15 END AS "columns",
  n AS observed_rows, CASE WHEN yr % 2 = 1 THEN 15 ELSE 13 END AS observed_columns FROM y WHERE yr IN (1997, 1998)""")
def q_dimension_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Landed years whose rows or widths, read from their files, are not the announced ones (one of each is wrong on purpose)."""
    paths = _land_years(spark, sf)
    observed = landing.observed_dimensions(spark, paths, landing.scan_periods(spark, paths, SPEC))
    return landing.dimension_faults(observed, _announced(spark, sf), ["periodo"])


@query(f"""
SELECT period AS periodo, count(*) AS "rows", CAST(12 AS INTEGER) AS "columns", CAST(sum(CASE WHEN row_id % 997 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS observed_rows,
  CASE WHEN right(period, 1) = '3' THEN 13 ELSE 12 END AS observed_columns,
  count(*) = sum(CASE WHEN row_id % 997 = 0 THEN 0 ELSE 1 END) AND right(period, 1) <> '3' AS consistent FROM ({DIRTY}) d GROUP BY period""")
def q_manifest_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest document of all periods, written, scanned and checked against itself (third quarters have a wrong width on purpose)."""
    counts = dirty(spark, sf).groupBy("period").agg(
        F.count(F.lit(1)).alias("announced"), F.count_if(F.col("row_id") % 997 != 0).alias("seen")
    )
    dimensions = F.struct(F.col("announced").alias("filas"), F.lit(12).alias("columnas"))
    record = F.struct(
        F.col("period").alias("periodo"), F.lit("personas").alias("tipo"),
        F.concat(F.col("period"), F.lit("_personas.csv")).alias("archivo"),
        F.sha2("period", 256).alias("sha256"), F.col("seen").alias("filas_observadas"),
        F.when(F.col("period").endswith("3"), 13).otherwise(12).alias("columnas_observadas"),
    )
    document = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("period", dimensions))).alias("esperado"),
        F.collect_list(record).alias("archivos"),
    )
    folder = new_folder(spark, "manifest")
    document.write.json(folder)
    return manifest.self_consistency(manifest.read_manifest(spark, folder))


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS periodo, o_orderstatus AS tipo,
  CASE WHEN o_orderkey % 3 = 0 THEN sha256(concat(CAST(o_custkey AS VARCHAR), 'new')) ELSE sha256(CAST(o_custkey AS VARCHAR)) END AS sha256,
  CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 THEN 'later' ELSE concat('earlier ', o_orderpriority) END AS fecha_descarga_utc
FROM orders""")
def q_manifest_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A file record per order: every third changed its digest, every fifth is new."""
    k = F.col("o_orderkey")
    key = [k.cast("string").alias("periodo"), F.col("o_orderstatus").alias("tipo")]
    customer = F.col("o_custkey").cast("string")
    orders = table(spark, sf, "orders")
    earlier = orders.filter(k % 5 != 0).select(
        *key, F.sha2(customer, 256).alias("sha256"),
        F.concat(F.lit("earlier "), F.col("o_orderpriority")).alias("fecha_descarga_utc"),
    )
    digest = F.sha2(F.when(k % 3 == 0, F.concat(customer, F.lit("new"))).otherwise(customer), 256)
    fresh = orders.select(*key, digest.alias("sha256"), F.lit("later").alias("fecha_descarga_utc"))
    return manifest.merge_records(fresh, earlier, ["periodo", "tipo"], "sha256", "fecha_descarga_utc")


FILES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query(" UNION ALL ".join(f"SELECT '{f}.parquet' AS file, 64 AS digits, true AS sized, false AS is_zip" for f in FILES))
def q_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Digest, size and signature of the table files themselves."""
    files = manifest.fingerprints(spark, f"{sf}/*.parquet")
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.length("sha256").alias("digits"), (F.col("bytes") > 0).alias("sized"), "is_zip"
    )


@query("""
WITH l AS (SELECT c_mktsegment, c_custkey, concat(CASE WHEN c_mktsegment = 'BUILDING' THEN concat('PK', chr(3), chr(4)) ELSE '' END, c_custkey, ';', c_name, chr(10)) AS line FROM customer),
f AS (SELECT c_mktsegment AS segment, string_agg(line, '' ORDER BY c_custkey) AS content FROM l GROUP BY c_mktsegment)
SELECT segment, CAST(strlen(content) AS BIGINT) AS bytes, sha256(content) AS sha256, segment = 'BUILDING' AS is_zip FROM f""")
def q_known_digests(spark: SparkSession, sf: str) -> DataFrame:
    """Files of customers by segment, one of them with the signature of an archive: digests of bytes that SQL knows."""
    magic = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("PK\x03\x04")).otherwise("")
    lines = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", F.concat(magic, F.col("c_custkey").cast("string"), F.lit(";"), "c_name").alias("line"))
    folder = new_folder(spark, "digests")
    ordered = lines.repartition("c_mktsegment").sortWithinPartitions("c_mktsegment", "c_custkey").drop("c_custkey")
    ordered.write.partitionBy("c_mktsegment").text(folder)
    return manifest.fingerprints(spark, folder).select(
        F.regexp_extract("path", "c_mktsegment=([^/]+)", 1).alias("segment"), "bytes", "sha256", "is_zip")


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR))) AS versions,
  CAST(64 AS INTEGER) AS digits FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_row_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("f", fingerprint(["l_orderkey", "l_linenumber", "l_partkey"]))
    return lines.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("f").alias("versions"), F.max(F.length("f")).alias("digits")
    )


# A dictionary sheet per year, with an order as a row: which variable it opens, a code and a label.
SHEET_SQL = """SELECT year(o_orderdate) AS sheet, o_orderkey AS row_no,
  CASE WHEN o_orderkey % 97 = 0 THEN ' EDU ' WHEN o_orderkey % 89 = 0 THEN 'DOM.0' WHEN o_orderkey % 83 = 0 THEN 'OTHER' END AS c0,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN concat(CAST(o_orderkey % 9 AS VARCHAR), '.0') ELSE CAST(o_orderkey % 9 AS VARCHAR) END AS c1,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat(' ', o_orderpriority, ' ') END AS c2 FROM orders"""

LISTS_SQL = rf"""w AS (SELECT s.*, regexp_replace(trim(coalesce(c0, '')), '\.0$', '') AS var, sum(CASE WHEN c0 IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sheet ORDER BY row_no) AS blk FROM ({SHEET_SQL}) s),
h AS (SELECT sheet, var AS variable, max(blk) AS blk FROM w WHERE var IN ('EDU', 'DOM') GROUP BY sheet, var HAVING count(*) >= 2),
lists AS (SELECT w.sheet, h.variable, regexp_replace(trim(c1), '\.0$', '') AS code, arg_max(trim(c2), row_no) AS label
  FROM w JOIN h ON h.sheet = w.sheet AND h.blk = w.blk WHERE c1 IS NOT NULL AND c2 IS NOT NULL GROUP BY w.sheet, h.variable, regexp_replace(trim(c1), '\.0$', ''))"""


def _sheets(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    code = (k % 9).cast("string")
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("sheet"),
        k.alias("row_no"),
        F.when(k % 97 == 0, " EDU ").when(k % 89 == 0, "DOM.0").when(k % 83 == 0, "OTHER").alias("c0"),
        F.when(k % 13 == 0, F.lit(None)).when(k % 2 == 0, F.concat(code, F.lit(".0"))).otherwise(code).alias("c1"),
        F.when(k % 7 != 0, F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" "))).alias("c2"),
    )


@query(f"WITH {LISTS_SQL} SELECT CAST(sheet AS INTEGER) AS sheet, variable, code, label FROM lists")
def q_codelist_extract(spark: SparkSession, sf: str) -> DataFrame:
    return codelist.code_lists(_sheets(spark, sf), ["sheet"], ["EDU", "DOM"])


@query(f"""
WITH {LISTS_SQL}
SELECT CAST(s.sheet AS INTEGER) AS sheet, v.variable, coalesce(t.starts, 0) AS starts, coalesce(c.codes, 0) AS codes
FROM (SELECT DISTINCT sheet FROM w) s CROSS JOIN (VALUES ('EDU'), ('MISSING')) v(variable)
LEFT JOIN (SELECT sheet, var, count(*) AS starts FROM w GROUP BY sheet, var) t ON t.sheet = s.sheet AND t.var = v.variable
LEFT JOIN (SELECT sheet, variable, count(*) AS codes FROM lists GROUP BY sheet, variable) c ON c.sheet = s.sheet AND c.variable = v.variable
WHERE coalesce(t.starts, 0) < 2 OR coalesce(c.codes, 0) = 0""")
def q_codelist_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets that lack a variable (one is asked for that none has)."""
    sheets = _sheets(spark, sf)
    wanted = ["EDU", "MISSING"]
    return codelist.incomplete(sheets, codelist.code_lists(sheets, ["sheet"], wanted), ["sheet"], wanted)


@query(rf"""
WITH {LISTS_SQL}
SELECT CAST(c.period AS VARCHAR) AS period, coalesce(l.code, 'UNKNOWN') AS edu, count(*) AS n
FROM (SELECT *, CAST(substr(period, 1, 4) AS INTEGER) AS yr, regexp_replace(trim(edu_raw), '\.0+$', '') AS edu_code FROM ({CLEAN}) x WHERE first_fail = 0) c
LEFT JOIN (SELECT DISTINCT sheet, code FROM lists WHERE variable = 'EDU') l ON l.sheet = c.yr AND l.code = c.edu_code
GROUP BY c.period, coalesce(l.code, 'UNKNOWN')""")
def q_recode_by_list(spark: SparkSession, sf: str) -> DataFrame:
    """Eligible rows, their education code checked against the list of their own year."""
    lists = codelist.code_lists(_sheets(spark, sf), ["sheet"], ["EDU"])
    rows = judged(spark, sf).withColumn("year", F.substring("period", 1, 4).cast("int"))
    kept = rules.eligible(rows, SPEC)
    recoded = codelist.recode_by_list(kept, lists, "EDU", "edu", {"year": "sheet"}, SPEC.unknown)
    return recoded.groupBy("period", "edu").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
SELECT period, count(*) AS n, round(sum(pay), 2) AS pay, CAST(min(row_id) AS BIGINT) AS first_row FROM ({CLEAN}) c WHERE first_fail = 0 GROUP BY period""")
def q_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared rows written by period, read back with schema and count checked."""
    prepared = rules.eligible(judged(spark, sf), SPEC, ALLOWED)
    folder = new_folder(spark, "prepared")
    rows = write_table(prepared, folder, SPEC.period, mixed=True)
    again = read_back(spark, folder, prepared, rows, SPEC.period)
    return again.groupBy("period").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("pay"), 2).alias("pay"), F.min("row_id").alias("first_row")
    )


CONTENT_SQL = """WITH h AS (SELECT o_orderstatus AS part, sha256(concat('{"o_orderkey":', o_orderkey, ',"o_custkey":', o_custkey, ',"o_orderstatus":"', o_orderstatus, '"}')) AS h FROM orders),
s AS (SELECT part, CAST('0x' || substr(h, 1, 15) AS BIGINT) AS a, CAST('0x' || substr(h, 16, 15) AS BIGINT) AS b FROM h)"""


@query(rf"""
SELECT regexp_replace(trim(class_raw), '\.0+$', '') AS class_raw, class_raw AS class_raw_original, count(*) AS n FROM ({DIRTY}) d GROUP BY ALL""")
def q_kept_original(spark: SparkSession, sf: str) -> DataFrame:
    """Codes that take the place of their source column, next to the response as it was given."""
    spec = replace(SPEC, codes={"class_raw": "class_raw"}, keep_original=("class_raw",), derived=dict)
    return rules.normalize(dirty(spark, sf), spec).groupBy("class_raw", "class_raw_original").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
{CONTENT_SQL}
SELECT part, count(*) AS n, CAST(sum(a) AS VARCHAR) AS sum_0, CAST(sum(b) AS VARCHAR) AS sum_1 FROM s GROUP BY part
UNION ALL SELECT 'all' AS part, count(*) AS n, CAST(sum(a) AS VARCHAR) AS sum_0, CAST(sum(b) AS VARCHAR) AS sum_1 FROM s""")
def q_content_sums(spark: SparkSession, sf: str) -> DataFrame:
    """Content of orders as summed by the write, re-read and checked cell by cell, and that of each part, which add up to it."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    folder = new_folder(spark, "content")
    written = write_checked(orders, folder, "o_orderstatus", mixed=True)
    again = read_back(spark, folder, orders, written, "o_orderstatus")
    sums = [F.col(f"sum_{k}").cast("string").alias(f"sum_{k}") for k in range(2)]
    parts = again.groupBy(F.col("o_orderstatus").alias("part")).agg(F.count(F.lit(1)).alias("n"), *content_sums(orders.columns))
    whole = spark.createDataFrame([("all", written.rows, *map(str, written.sums))], "part string, n long, sum_0 string, sum_1 string")
    return parts.select("part", "n", *sums).unionByName(whole)


@query(f"""
SELECT edu, domain, count(*) AS n FROM (
  SELECT CASE WHEN regexp_matches(edu_code, '^[0-7]$') THEN edu_code ELSE 'UNKNOWN' END AS edu, domain
  FROM (SELECT domain, regexp_replace(trim(edu_raw), '\\.0+$', '') AS edu_code FROM ({CLEAN}) x WHERE first_fail = 0) y) z GROUP BY edu, domain""")
def q_prepare(spark: SparkSession, sf: str) -> DataFrame:
    """The whole preparation: rules, then codes checked against the list of the row's period."""
    raw = judged(spark, sf)
    codes = F.explode(F.array(*[F.lit(c) for c in ALLOWED["edu"]]))
    lists = raw.select("period").distinct().select("period", F.lit("EDU").alias("variable"), codes.alias("code"))
    kept = prepare(raw, SPEC, lists)
    return kept.groupBy(
        "edu", F.when(F.col("domain").isin(*ALLOWED["domain"]), F.col("domain")).otherwise("UNKNOWN").alias("domain")
    ).agg(F.count(F.lit(1)).alias("n"))
