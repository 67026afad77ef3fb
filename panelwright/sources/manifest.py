"""File manifest: fingerprints, document scan, self-consistency and merge of timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ZIP_SIGNATURE = "504B0304"

MANIFEST_SCHEMA = (
    "esperado map<string, struct<filas: bigint, columnas: int>>,"
    " archivos array<struct<periodo: string, tipo: string, archivo: string, url: string,"
    " fecha_descarga_utc: string, sha256: string, bytes: bigint, filas_observadas: bigint,"
    " columnas_observadas: int, hoja: string, encabezado_inicial: string>>"
)


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Files of zero bytes under a path or pattern, which Spark's file sources pass over."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(pattern) or []:
        for file in system.listStatus(status.getPath()) if status.isDirectory() else [status]:
            if file.isFile() and file.getLen() == 0 and file.getPath().getName()[0] not in "_.":
                found.append(file.getPath().toString())
    return found


def _streamed(spark: SparkSession) -> tuple[Column, Column]:
    """(SHA-256, first four bytes) of the file that column ``path`` names, as binary.

    No reader of Spark hands out a file in pieces, and Python workers do not reach its stores. So the task's own JVM opens the
    file with the session's Hadoop settings and passes it through the digest a buffer at a time; streams close at their end.
    Opening counts as not deterministic, else both columns would be given the same stream.
    """
    jvm = spark._jvm
    expressions, types = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.types
    columns, binary = jvm.org.apache.spark.sql.classic.ExpressionUtils, types.DataTypes.BinaryType

    def seq(items):
        return jvm.org.apache.spark.api.python.PythonUtils.toSeq(list(items))

    def kind(name):
        return types.ObjectType(jvm.java.lang.Class.forName(name))

    def held(value, name):
        return expressions.Literal(value, kind(name))

    def new(name, *given):
        return expressions.objects.NewInstance(kind(name).cls(), seq(given), seq(()), True, kind(name), jvm.scala.Option.empty())

    def call(target, method, returns, *given, repeatable=True):
        return expressions.objects.Invoke(target, method, returns, seq(given), seq(()), True, True, repeatable)

    hadoop, io = "org.apache.hadoop.fs", "org.apache.commons.io.input"
    settings = jvm.org.apache.spark.util.SerializableConfiguration(spark._jsparkSession.sessionState().newHadoopConf())
    conf = call(held(settings, "org.apache.spark.util.SerializableConfiguration"), "value", kind("org.apache.hadoop.conf.Configuration"))
    name = call(columns.expression(F.col("path")._jc), "toString", kind("java.lang.String"))
    path = new(f"{hadoop}.Path", name)
    system = call(path, "getFileSystem", kind(f"{hadoop}.FileSystem"), conf)
    opened = call(system, "open", kind(f"{hadoop}.FSDataInputStream"), path, repeatable=False)
    sha256 = new("org.apache.commons.codec.digest.DigestUtils", held("SHA-256", "java.lang.String"))
    digest = call(sha256, "digest", binary, new(f"{io}.AutoCloseInputStream", opened))
    start = new(f"{io}.BoundedInputStream", opened, columns.expression(F.lit(4).cast("long")._jc))
    first = call(new(f"{io}.AutoCloseInputStream", start), "readAllBytes", binary)
    return Column(columns.column(digest)), Column(columns.column(first))


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256, size and ZIP signature of every file under a path, empty ones included.

    Spark's binary source lists the files and deals them to tasks, which read them as streams: a file may have any size and is
    never held whole. A digest follows from all bytes before, so one file is one task's work.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))
    digest, first = _streamed(spark)
    held = files.select("path", "bytes", F.lower(F.hex(digest)).alias("sha256"), (F.hex(first) == ZIP_SIGNATURE).alias("is_zip"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    empty = spark.createDataFrame([(p,) for p in empty_files(spark, path)], "path string").select(
        "path", F.lit(0).cast("long").alias("bytes"), nothing.alias("sha256"), F.lit(False).alias("is_zip")
    )
    return held.unionByName(empty)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True)


def file_records(manifest: DataFrame) -> DataFrame:
    """One row per recorded file."""
    return manifest.select(F.inline("archivos"))


def expected_dimensions(manifest: DataFrame) -> DataFrame:
    """(periodo, rows, columns) as announced."""
    return manifest.select(F.explode("esperado").alias("periodo", "d")).select(
        "periodo", F.col("d.filas").alias("rows"), F.col("d.columnas").alias("columns")
    )


def record_of(records: DataFrame, period: str, kind: str) -> DataFrame:
    return records.filter((F.col("periodo") == period) & (F.col("tipo") == kind))


def self_consistency(manifest: DataFrame, kind: str = "personas") -> DataFrame:
    """Per announced period: announced and recorded dimensions and whether they agree."""
    recorded = file_records(manifest).filter(F.col("tipo") == kind).select(
        "periodo",
        F.col("filas_observadas").alias("observed_rows"),
        F.col("columnas_observadas").alias("observed_columns"),
    )
    agrees = (F.col("rows") == F.col("observed_rows")) & (F.col("columns") == F.col("observed_columns"))
    return expected_dimensions(manifest).join(recorded, "periodo", "left").withColumn(
        "consistent", F.coalesce(agrees, F.lit(False))
    )


def merge_records(fresh: DataFrame, earlier: DataFrame, key: list[str], digest: str, stamp: str) -> DataFrame:
    """Fresh file records by key, keeping the earlier timestamp where the digest did not change.

    Of several earlier records of a key the one with the last timestamp counts.
    """
    last = F.max(F.struct(F.col(stamp).alias("_stamp"), F.col(digest).alias("_digest"))).alias("_last")
    before = earlier.groupBy(*key).agg(last)
    unchanged = F.col(digest) == F.col("_last._digest")
    merged = fresh.join(before, key, "left").withColumn(
        stamp, F.when(unchanged, F.col("_last._stamp")).otherwise(F.col(stamp))
    )
    return merged.drop("_last").orderBy(*key)
