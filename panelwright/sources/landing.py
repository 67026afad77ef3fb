"""Landed period files: text scans by column name, provenance and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.functions.codes import period_quarter, period_year, stringify
from panelwright.operators.reshape import union_all
from panelwright.spec import PanelSpec

PERIOD_PATTERN = r"(\d{4}T[1-4])"


def require_columns(found: list[str], required: list[str] | tuple[str, ...], where: str) -> None:
    missing = sorted(set(required) - set(found))
    if missing:
        raise ValueError(f"missing columns in {where}: {missing}")


def read_path(spark: SparkSession, path: str, file_format: str = "csv", **options) -> DataFrame:
    """One landed file or folder. CSV stays text; a header that differs inside the folder is an error."""
    reader = spark.read.options(**options)
    if file_format != "csv":
        return reader.format(file_format).load(path)
    header = reader.option("header", True).csv(path).schema
    return reader.option("header", True).option("enforceSchema", False).schema(header).csv(path)


def scan_period(
    spark: SparkSession, path: str, period: str, spec: PanelSpec, file_format: str = "csv", **options
) -> DataFrame:
    """The panel's columns of one period, by name and in fixed order, as stripped text, with provenance."""
    raw = read_path(spark, path, file_format, **options)
    require_columns(raw.columns, spec.source_columns, path)
    # Codes may land as numbers in one file and as text in the next: all become text here.
    named = raw.select(*spec.source_columns, F.col("_metadata.file_name").alias("archivo_origen"))
    text = stringify(named, [*spec.source_columns, "archivo_origen"])
    label = F.lit(period)
    return text.withColumns(
        {
            "periodo_archivo": label,
            "anio_archivo": period_year(label),
            "trimestre_calendario": period_quarter(label),
        }
    )


def scan_periods(
    spark: SparkSession, paths: dict[str, str], spec: PanelSpec, file_format: str = "csv", **options
) -> DataFrame:
    """All periods united by name; files may differ in width and column order.

    Only metadata is read per path here; the rows are one lazy scan.
    """
    return union_all(
        [scan_period(spark, path, period, spec, file_format, **options) for period, path in paths.items()]
    )


def with_provenance(frame: DataFrame, pattern: str = PERIOD_PATTERN) -> DataFrame:
    """Period, year and quarter taken from the path of the file each row came from.

    For many-file scans whose files share one layout; a path without a period label
    gives NULLs, which ``unlabelled_files`` reports.
    """
    path = F.col("_metadata.file_path")
    label = F.regexp_extract(path, pattern, 1)
    label = F.when(label != "", label)
    return frame.select(
        "*",
        F.col("_metadata.file_name").alias("archivo_origen"),
        label.alias("periodo_archivo"),
        period_year(label).alias("anio_archivo"),
        period_quarter(label).alias("trimestre_calendario"),
    )


def load_summary(scanned: DataFrame) -> DataFrame:
    """Rows per period and file."""
    return scanned.groupBy("periodo_archivo", "archivo_origen").agg(F.count(F.lit(1)).alias("initial_rows"))


def mixed_files(scanned: DataFrame) -> DataFrame:
    """Files without a period, or with more than one."""
    files = scanned.groupBy("archivo_origen").agg(
        F.min("periodo_archivo").alias("first"), F.max("periodo_archivo").alias("last")
    )
    return files.filter(F.col("first").isNull() | (F.col("first") != F.col("last")))


def width_of(spark: SparkSession, path: str, file_format: str = "csv", **options) -> int:
    """Number of columns of a landed file, from its header or footer."""
    return len(read_path(spark, path, file_format, **options).columns)


def observed_dimensions(
    spark: SparkSession, paths: dict[str, str], scanned: DataFrame, file_format: str = "csv", **options
) -> DataFrame:
    """(periodo, rows, columns) of the landed periods: widths from headers, rows from the scan."""
    widths = spark.createDataFrame(
        [(period, width_of(spark, path, file_format, **options)) for period, path in paths.items()],
        "periodo string, columns int",
    )
    rows = scanned.groupBy(F.col("periodo_archivo").alias("periodo")).agg(F.count(F.lit(1)).alias("rows"))
    counted = widths.join(rows, "periodo", "left")
    return counted.select("periodo", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), "columns")


def announced_summary(observed: DataFrame, expected: DataFrame, by: list[str]) -> DataFrame:
    """Initial rows and columns of every landed period next to the announced ones, and whether they agree."""
    said = expected.select(*by, F.col("rows").alias("announced_rows"), F.col("columns").alias("announced_columns"))
    agrees = (F.col("initial_rows") == F.col("announced_rows")) & (F.col("columns") == F.col("announced_columns"))
    return observed.withColumnRenamed("rows", "initial_rows").join(said, by, "left").withColumn(
        "agrees", F.coalesce(agrees, F.lit(False))
    )


def dimension_faults(observed: DataFrame, expected: DataFrame, by: list[str]) -> DataFrame:
    """Expected (rows, columns) entries that the observed table lacks or contradicts."""
    seen = observed.select(*by, F.col("rows").alias("_rows"), F.col("columns").alias("_columns"))
    joined = expected.join(seen, by, "left")
    agrees = (F.col("rows") == F.col("_rows")) & (F.col("columns") == F.col("_columns"))
    return joined.filter(~F.coalesce(agrees, F.lit(False))).withColumnsRenamed(
        {"_rows": "observed_rows", "_columns": "observed_columns"}
    )
