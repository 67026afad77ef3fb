"""Session helpers: a local session for tests, and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, functions as F

# A small side may be hinted as a broadcast only when its counted rows and stored bytes stay under these.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 * 1024 * 1024
# Rows of a part that iterative fits read, up to so many parts; rows of a part beyond them, and the most parts there are.
PART_ROWS, SMALL_PARTS, FULL_ROWS, MOST_PARTS = 10_000, 64, 200_000, 4_096
_RUN = f"run-{uuid.uuid4().hex[:12]}"
_folder: list[str] = []
# Folders written on the way to a result, while one is made.
_way: ContextVar[list[str] | None] = ContextVar("way", default=None)


def local_session(name: str = "panelwright", cpus: str = "8", memory: str = "12g", folder: str | None = None) -> SparkSession:
    """Local session used by the tests and the bench; a cluster brings its own, and its own shared folder."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", folder or tempfile.mkdtemp(prefix="panelwright-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``; unnamed is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or (_folder[0] if _folder else None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def name_folder(spark: SparkSession, folder: str | None = None) -> None:
    """Names a folder where the session has none: the given one, or a new one if driver and executors are one process."""
    if spark.conf.get("spark.checkpoint.dir", None) or _folder:
        return
    alone = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if folder or alone:
        _folder.append(folder or tempfile.mkdtemp(prefix="panelwright-"))


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name in this run's part of the shared folder; nothing is ever reused."""
    return f"{shared_folder(spark)}/panelwright/{_RUN}/{label}-{uuid.uuid4().hex[:12]}"


def remove_run(spark: SparkSession) -> None:
    """Removes what this run stored; frames that read it are lost."""
    _remove(spark, f"{shared_folder(spark)}/panelwright/{_RUN}")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(frame: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends, sizes become known."""
    spark = frame.sparkSession
    folder = new_folder(spark, label)
    frame.write.mode("overwrite").parquet(folder, compression=compression)
    if (way := _way.get()) is not None:
        way.append(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def result_of(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The frame that ``make`` gives, stored; all that was stored on the way to it is removed.

    ``make`` must not hand out other frames that read what it stored. What was stored before stays.
    """
    way: list[str] = []
    token = _way.set(way)
    try:
        out = stored(make(), label)
    finally:
        _way.reset(token)
    for folder in way[:-1]:
        _remove(spark, folder)
    if (outer := _way.get()) is not None:
        outer.append(way[-1])
    return out


def numbered(frame: DataFrame, label: str) -> DataFrame:
    """(_place, _row): the frame's rows with a number each, stored.

    Passes that tell rows apart must read the number here. Worked out anew in another scan it may differ, as the
    splits of a scan follow the executors of the moment. The copy holds whole rows and stays until the run ends, so
    it is written in the smaller codec.
    """
    return stored(frame.select(F.monotonically_increasing_id().alias("_place"), F.struct("*").alias("_row")), label, "zstd")


def is_small(kept: DataFrame, max_rows: int | None = None) -> bool:
    """Whether a stored table may be broadcast, by its files' bytes and its counted rows."""
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    in_files = int(str(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return in_files <= BROADCAST_BYTES and kept.limit(max_rows + 1).count() <= max_rows


def sized(small: DataFrame, label: str, max_rows: int | None = None) -> DataFrame:
    """Store an aggregated side and hint a broadcast only if it is proven small.

    Beyond the limits the stored side is returned without a hint, so the join
    shuffles both sides and adaptive execution splits skewed partitions.
    """
    small = stored(small, label)
    return F.broadcast(small) if is_small(small, max_rows) else small


def iterated(frame: DataFrame, label: str) -> DataFrame:
    """A narrow frame that many passes will read: stored, and read in even parts.

    How many parts follows from the rows alone, so that fits whose result depends on the layout
    are the same on any number of cores. Losing an executor costs a re-read of its part, not a
    replay of everything before it. Every part of every pass reports to the driver, so beyond
    SMALL_PARTS parts get larger first.
    """
    kept = stored(frame.hint("rebalance"), label)
    return kept.repartition(iterated_parts(kept.count()))


def iterated_parts(rows: int) -> int:
    """The parts of so many rows: a part for every PART_ROWS up to SMALL_PARTS, then for every FULL_ROWS."""
    small, full = math.ceil(rows / PART_ROWS), math.ceil(rows / FULL_ROWS)
    return min(MOST_PARTS, max(1, min(small, SMALL_PARTS), full))
