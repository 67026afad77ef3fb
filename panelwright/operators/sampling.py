"""Small samples for charts and previews; the only data meant to leave the cluster as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.functions.hashing import ordering_hash

SAMPLE_LIMIT = 5000


def preview(frame: DataFrame, columns: list[str], rows: int = 5) -> DataFrame:
    return frame.select(*columns).limit(rows)


def random_sample(frame: DataFrame, seed: int = 42, limit: int = SAMPLE_LIMIT) -> DataFrame:
    """Seeded random rows. Which rows depends on the partitioning; ``hash_sample`` does not."""
    return frame.orderBy(F.rand(seed)).limit(limit)


def least_hashes(frame: DataFrame, digest: str, limit: int) -> DataFrame:
    """The rows of the ``limit`` lowest digests and hardly any others, whatever the number of tasks.

    Rows are counted by the start of their digest, two digits behind its zeros: a few hundred counts for any table, finer the
    lower a digest is. The first start by which there are enough rows is where the others are cut off, about a sixteenth
    of the limit above it at most; rows of equal digests stay together.
    """
    zeros = F.length(digest) - F.length(F.ltrim(digest, F.lit("0")))
    counts = frame.groupBy(F.substring(digest, F.lit(1), zeros + 2).alias("start")).agg(F.count(F.lit(1)).alias("n"))
    seen = 0
    for row in sorted(counts.collect()):
        seen += row["n"]
        if seen >= limit:
            return frame.filter(F.substring(digest, 1, len(row["start"])) <= row["start"])
    return frame


def hash_sample(frame: DataFrame, columns: list[str], tie_break: list[str], limit: int = SAMPLE_LIMIT) -> DataFrame:
    """The same rows on any partitioning: lowest ordering hashes first, ties by key.

    One aggregation finds where to cut, so that not each task's lowest rows meet in one, but about ``limit`` rows in all;
    they are then taken as a top-k, not by a global sort.
    """
    named = frame.withColumn("_digest", ordering_hash(columns))
    return least_hashes(named, "_digest", limit).orderBy("_digest", *tie_break).limit(limit).drop("_digest")
