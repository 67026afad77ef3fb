"""Indexes of labels of any number: ranges of labels are numbered where they lie and looked up by a split join."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasInputCols, HasOutputCol, HasOutputCols, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.operators.joins import lookup
from panelwright.session import MOST_PARTS, stored

# Rows of a range that are sorted together.
RANGE_ROWS = 500_000
_OFFSET = 33  # monotonically_increasing_id keeps the partition above this bit, the place in it below


def dense_numbers(rows: DataFrame, order: list[str], output: str, label: str) -> DataFrame:
    """``rows`` and their place, from 0, in the order of the columns ``order``, which no two rows may share.

    Rows are dealt by ranges and sorted within them; the first number of a range is the count of all rows in the
    ranges before. Only one count per range (at most MOST_PARTS) reaches the driver.
    """
    kept = stored(rows, label)
    ranges = min(MOST_PARTS, max(1, math.ceil(kept.count() / RANGE_ROWS)))
    at = F.monotonically_increasing_id()
    placed = kept.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", at)
    # The place is worked out once and stored: another scan might cut its ranges elsewhere.
    placed = stored(placed, f"{label}-placed")
    part = F.shiftright("_at", _OFFSET)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, total = {}, 0
    for row in sorted(sizes, key=lambda r: r["part"]):
        before[row["part"]], total = total, total + row["n"]
    firsts = rows.sparkSession.createDataFrame(list(before.items()), "_part long, _first long")
    within = F.col("_at").bitwiseAND(F.lit((1 << _OFFSET) - 1))
    return (
        placed.withColumn("_part", part).join(F.broadcast(firsts), "_part")
        .withColumn(output, F.col("_first") + within).drop("_part", "_first", "_at")
    )


def label_index(rows: DataFrame, column: str, label: str = "labels") -> DataFrame:
    """(label, idx, n): every value of a column as text, its place in byte order, and its rows. NULL has none."""
    counts = rows.select(F.col(column).cast("string").alias("label")).na.drop().groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return stored(dense_numbers(counts, ["label"], "idx", label).select("label", "idx", "n"), f"{label}-index")


def with_index(rows: DataFrame, index: DataFrame, size: int, column: str, output: str, unseen: str = "keep") -> DataFrame:
    """Looks up each value's place, as a double; NULL and unseen values get ``size`` (keep), go (skip) or raise (error).

    A value that a third of the rows share is looked up without moving those rows, whether the index knows it or not.
    """
    if unseen not in ("keep", "skip", "error"):
        raise ValueError(f"unknown way with unseen labels: {unseen}")
    places = index.select(F.col("label").alias("_label"), F.col("idx").cast("double").alias("_idx"))
    found = lookup(rows.withColumn("_value", F.col(column).cast("string")), places, {"_value": "_label"}, "label-places")
    if unseen == "skip":
        found = found.filter(F.col("_idx").isNotNull())
    missing = F.raise_error(F.lit(f"unseen label in {column}")).cast("double") if unseen == "error" else F.lit(float(size))
    meta = {"ml_attr": {"type": "nominal", "name": output, "num_vals": size + (unseen == "keep")}}
    return found.withColumn(output, F.coalesce("_idx", missing)).drop("_value", "_idx").withMetadata(output, meta)


class _Columns(HasInputCols, HasOutputCols, HasInputCol, HasOutputCol, HasHandleInvalid):
    sizes = Param(Params._dummy(), "sizes", "labels per column", typeConverter=TypeConverters.toListInt)


class LabelIndex(Estimator, _Columns):
    """Indexes columns of any number of values in byte order; the index is a stored table, never gathered.

    Takes the place of the library's string indexer where a column holds more codes than a driver should.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, handleInvalid="keep"):
        super().__init__()
        self._setDefault(handleInvalid="keep")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, rows: DataFrame) -> LabelIndexModel:
        # One scan of the rows finds the labels of all columns.
        names = self.getInputCols()
        values = F.array(*[F.struct(F.lit(k).alias("c"), F.col(n).cast("string").alias("label")) for k, n in enumerate(names)])
        counts = (
            rows.select(F.inline(values)).filter(F.col("label").isNotNull())
            .groupBy("c", "label").agg(F.count(F.lit(1)).alias("n"))
        )
        placed = dense_numbers(counts, ["c", "label"], "place", "labels")
        sizes = {r["c"]: (r["first"], r["n"]) for r in placed.groupBy("c").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
        first = F.create_map(*[F.lit(x) for c, (at, _) in sizes.items() for x in (c, at)]) if sizes else F.lit(None).cast("map<int, bigint>")
        table = stored(placed.select("c", "label", (F.col("place") - first[F.col("c")]).alias("idx"), "n"), "label-index")
        model = LabelIndexModel(table)
        model._set(
            inputCols=names, outputCols=self.getOutputCols(), handleInvalid=self.getHandleInvalid(),
            sizes=[sizes.get(c, (0, 0))[1] for c in range(len(names))],
        )
        return model


class LabelIndexModel(Model, _Columns, MLWritable, MLReadable):
    """Columns with their label's place; ``labels`` is the stored table (c, label, idx, n)."""

    def __init__(self, labels: DataFrame | None = None):
        super().__init__()
        self._setDefault(handleInvalid="keep")
        self.labels = labels

    def copy(self, extra=None) -> LabelIndexModel:
        return self._copyValues(LabelIndexModel(self.labels), extra)

    def _transform(self, rows: DataFrame) -> DataFrame:
        sizes = self.getOrDefault(self.sizes)
        for c, (column, output) in enumerate(zip(self.getInputCols(), self.getOutputCols(), strict=True)):
            own = self.labels.filter(F.col("c") == c)
            rows = with_index(rows, own, sizes[c], column, output, self.getHandleInvalid())
        return rows

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LabelIndexModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.labels.write.parquet(f"{path}/labels")


class _Reader(MLReader):
    def load(self, path: str) -> LabelIndexModel:
        spark: SparkSession = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = LabelIndexModel(spark.read.parquet(f"{path}/labels"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
