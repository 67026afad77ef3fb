"""Quality rules: simple counts of each text, and lines that too many documents of a host share."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.llm.bpe import slices
from panelwright.operators.joins import join_aggregate
from panelwright.session import numbered, result_of, stored

MIN_WORDS, MAX_REPEATED = 50, 50
# A line is above the limit when more distinct documents of its host hold it than both of these.
MIN_DOCUMENTS, MAX_SHARE = 10, 0.05
# A document is depleted when less than this share of its words is left.
MIN_LEFT = 0.3

SYMBOLS = b"#*$%&|<>"
_SPACES, _DIGITS = b" \t\n\x0b\x0c\r", re.compile(rb"[0-9]+")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that the text holds at least twice."""
    n = len(words) - 2
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(known) + ids[1:], return_inverse=True)[1]
    _, window, counts = np.unique(pairs[:-1] * len(known) + ids[2:], return_inverse=True, return_counts=True)
    often = counts[window] >= 2
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + n] |= often
    return int(covered.sum())


def line_key(line: bytes) -> int:
    """Hash of a normalised line: A-Z lower-cased, white space collapsed, runs of digits as one 0."""
    plain = _DIGITS.sub(b"0", b" ".join(line.lower().split()))
    return int(hashlib.md5(plain).hexdigest()[:15], 16)


def counts_of(text: str) -> tuple[int, int, int, int, int, dict[int, int]]:
    """(words, characters in words, symbols, repeated lines, words in repeated windows, words by line hash)."""
    data = text.encode("utf-8")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip(_SPACES)]
    by_line: dict[int, int] = {}
    for line in lines:
        k = line_key(line)
        by_line[k] = by_line.get(k, 0) + len(line.split())
    return (
        len(words), len(text) - sum(map(data.count, (bytes([s]) for s in _SPACES))), sum(data.count(bytes([s])) for s in SYMBOLS),
        len(lines) - len(set(lines)), repeated_words(words), by_line,
    )


def profile(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(_place, key, host, the counts, lines array of (h, w)): one row per document, in one pass over the texts."""
    return _profiled(docs.select(F.monotonically_increasing_id().alias("_place"), F.col(key), F.col(host).alias("_host"), F.col(text)), text)


def _profiled(base: DataFrame, text: str) -> DataFrame:
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kinds = "array<struct<h: bigint, w: bigint>>"
    schema = base.drop(text).select("*", *[F.lit(0).cast("long").alias(n) for n in numbers], F.lit(None).cast(kinds).alias("_lines")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.struct([("h", pa.int64()), ("w", pa.int64())])
        for batch in batches:
            for part in slices(batch):
                rows = [counts_of(t or "") for t in part.column(3).to_pylist()]
                columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
                lines = pa.array([[{"h": h, "w": w} for h, w in r[5].items()] for r in rows], pa.list_(pair))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *columns, lines], schema.names)

    return base.mapInArrow(run, schema)


def common_lines(profiled: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    """(_host, h, _rows) of the lines that more distinct documents of a host hold than its limit.

    Copies of a document are one document here: a document is known by a hash of all its different lines. So a
    text copied a thousand times does not make its own lines common. The limit is the larger of ``min_documents``
    and ``max_share`` of the host's distinct documents. A null host is a host.
    """
    hashes = F.transform("_lines", lambda x: x["h"])
    known = profiled.select("_host", F.xxhash64(F.array_sort(hashes)).alias("_id"), hashes.alias("_hashes"))
    limits = known.groupBy("_host", "_id").agg(F.lit(1).alias("_x")).groupBy("_host").agg(
        F.greatest(F.lit(float(min_documents)), max_share * F.count("*")).alias("_limit"))
    named = known.select("_host", "_id", F.explode("_hashes").alias("h"))
    counted = named.groupBy("_host", "h", "_id").agg(F.count("*").alias("_n")).groupBy("_host", "h").agg(
        F.count("*").alias("_documents"), F.sum("_n").alias("_rows"))
    limits = limits.withColumnRenamed("_host", "_h")
    return counted.filter(F.col("_documents") > min_documents).join(
        limits, F.col("_host").eqNullSafe(F.col("_h"))).filter(F.col("_documents") > F.col("_limit")).select("_host", "h", "_rows")


def judged(profiled: DataFrame, common: DataFrame) -> DataFrame:
    """Adds (words_left, _drop array of line hashes, base_failed, depleted, kept) to stored profiles."""
    lines = profiled.select("_place", "_host", F.explode("_lines").alias("_l")).select(
        "_place", "_host", F.col("_l.h").alias("h"), F.col("_l.w").alias("w"))
    hit = join_aggregate(lines, common, ["_host", "h"], "_rows", "inner", None, null_safe=True)
    lost = hit.groupBy("_place").agg(F.sum("w").alias("_lost"), F.collect_list("h").alias("_drop"))
    whole = profiled.drop("_lines").join(lost, "_place", "left")
    left = F.col("n_words") - F.coalesce("_lost", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (
        whole.withColumn("words_left", left).withColumn("base_failed", failed)
        .withColumn("depleted", F.col("words_left") < MIN_LEFT * F.col("n_words"))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    )


def rules(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    """One row per document with its counts and verdicts; null texts have no words and fail the base rules.

    Only hashes of lines are shuffled, never texts. Null hosts and keys and repeated rows count like any
    other; an empty table gives no rows.
    """
    return _verdicts(profile(docs, key, text, host), min_documents, max_share)


def _verdicts(profiles: DataFrame, min_documents: int = MIN_DOCUMENTS, max_share: float = MAX_SHARE) -> DataFrame:
    profiled = stored(profiles, "profiles")
    return judged(profiled, stored(common_lines(profiled, min_documents, max_share), "common-lines"))


def clean(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, all their columns, without the lines above the limit."""
    placed = numbered(docs, "numbered")
    row = F.col("_row")
    base = placed.select("_place", row[key].alias(key), row[host].alias("_host"), row[text].alias(text))
    verdicts = result_of(docs.sparkSession, lambda: _verdicts(_profiled(base, text)).filter("kept").select("_place", "_drop"), "verdicts")

    @F.pandas_udf("string")
    def without(texts, drops):
        import pandas as pd

        out = []
        for t, drop in zip(texts, drops, strict=True):
            if t is not None and drop is not None and len(drop):
                bad = set(drop.tolist())
                t = "\n".join(x for x in t.split("\n") if not x.strip(" \t\x0b\x0c\r") or line_key(x.encode()) not in bad)
            out.append(t)
        return pd.Series(out, dtype=object)

    # As many verdicts as documents: texts are dealt by place at every size, and pass by the verdicts unsorted.
    kept = placed.join(verdicts.hint("shuffle_hash"), "_place")
    old = F.col("_row")[text]
    changed = F.when(F.col("_drop").isNull(), old).otherwise(without(old, "_drop"))
    return kept.select(F.col("_row").withField(text, changed).alias("_row")).select("_row.*")
