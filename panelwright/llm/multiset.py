"""Fingerprints of documents as homomorphic multiset hashes: sums of wide vectors, lane by lane modulo 2**16."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

# Lanes that hold uniform 16-bit sums of paragraphs, and lanes that hold sums of signs of their phrases.
EXACT, SIGNS = 64, 192
# Words of a phrase; phrases start with each sentence, so an edit changes those up to the next sentence only.
PHRASE = 4
LANES = EXACT + SIGNS
# Rows between two bounds, on average; at most MOST_BUCKETS bounds are worked out on the driver.
BUCKET_ROWS, MOST_BUCKETS = 2_000, 65_536
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def _paragraphs(text: str) -> list[str]:
    return [p for p in text.split("\n") if p]


def _phrases(paragraph: str) -> list[str]:
    cut = [s.split() for s in _SENTENCE.split(paragraph)]
    return [" ".join(words[k : k + PHRASE]) for words in cut for k in range(0, len(words), PHRASE)]


def vector(text: str) -> np.ndarray:
    """The sum over a text's paragraphs (its lines that are not empty).

    Each paragraph adds a uniform vector hashed from it to the exact lanes; each of its phrases adds a
    vector of plus and minus one to the sign lanes. Sums do not depend on the order of paragraphs, and the vector of
    a paragraph that is taken out or put in is simply subtracted or added.
    """
    out = np.zeros(LANES, np.uint16)
    parts = _paragraphs(text)
    if parts:
        wide = b"".join([hashlib.shake_128(b"p" + p.encode()).digest(2 * EXACT) for p in parts])
        out[:EXACT] = np.frombuffer(wide, "<u2").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64).astype(np.uint16)
        phrases = [s for p in parts for s in _phrases(p)]
        bits = b"".join([hashlib.blake2b(s.encode(), digest_size=SIGNS // 8).digest() for s in phrases])
        ones = np.zeros(SIGNS, np.int64)
        flat = np.frombuffer(bits, np.uint8).reshape(-1, SIGNS // 8)
        for first in range(0, len(flat), 8192):
            ones += np.unpackbits(flat[first : first + 8192], axis=1).sum(axis=0, dtype=np.int64)
        out[EXACT:] = (2 * ones - len(phrases)).astype(np.uint16)
    return out


def replaced(of: np.ndarray, text: str, new: str, same: int) -> np.ndarray:
    """The vector of ``new`` out of that of ``text``, which agree up to ``same`` characters.

    Only the paragraphs from there on are deleted and inserted.
    """
    start = text.rfind("\n", 0, same) + 1
    return of - vector(text[start:]) + vector(new[start:])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common phrases, 0 to 1, estimated from two vectors; exactly 1 for equal ones.

    The squared length of a difference of sign sums estimates how many phrases are in one only.
    """
    if np.array_equal(a, b):
        return 1.0
    x, y, d = (v[EXACT:].view(np.int16).astype(np.int64) for v in (a, b, a - b))
    norm = int((x * x).sum() + (y * y).sum())
    return max(0.0, 1.0 - int((d * d).sum()) / norm) if norm else 0.0


def edited(text: str, following: str) -> tuple[str, int]:
    """A text whose last quarter gives way to as much of the following one, and up to where it is as before."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut], len(text) - cut


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next key, after the last the first; null keys come first, rows of one key in the
    order of the MD5 of their texts, so repeated rows follow one another. Rows are dealt by ranges of the key, sorted, and read as
    a stream with one row held back; the first row of each range is also sent, once, to the range before. Keys must be numbers.
    """
    spark = docs.sparkSession
    if not isinstance(docs.schema[key].dataType, NumericType):
        raise ValueError(f"the key {key} is no number")
    content = F.coalesce(F.col(text), F.lit(""))
    # Rows are told apart by what they hold: a place in the table would differ in another scan.
    rows = docs.select(F.col(key).alias("_key"), F.md5(content.cast("binary")).alias("_h"), content.alias("_text"))
    total = rows.count()
    buckets = min(MOST_BUCKETS, max(1, math.ceil(total / BUCKET_ROWS)))
    at = [k / buckets for k in range(1, buckets)]
    bounds = np.unique(docs.select(key).na.drop().approxQuantile(key, at, 1 / (4 * buckets)) if at and total else [])
    schema_key = docs.select(F.col(key)).schema[0].dataType.simpleString()

    @F.pandas_udf("int")
    def bucket_of(keys: pd.Series) -> pd.Series:
        numbers = np.searchsorted(bounds, keys.fillna(-np.inf).to_numpy(float), side="right")
        return pd.Series(np.where(keys.isna(), -1, numbers))

    dealt = rows.withColumn("_bucket", bucket_of("_key"))
    heads = dealt.groupBy("_bucket").agg(F.min(F.struct("_key", "_h")).alias("h")).select("_bucket", "h.*").collect()
    heads = sorted(heads, key=lambda r: r["_bucket"])  # one short row for each bucket
    before = [(r["_key"], r["_h"], heads[k - 1]["_bucket"]) for k, r in enumerate(heads)]
    ahead = F.broadcast(spark.createDataFrame(before, f"_hk {schema_key}, _hh string, _to int"))
    is_head = F.col("_key").eqNullSafe(F.col("_hk")) & (F.col("_h") == F.col("_hh"))
    # Of equal rows any one is as good.
    sent = rows.join(ahead, is_head).select(
        F.col("_to").alias("_bucket"), F.lit(1).alias("_sent"), "_key", "_h", "_text").dropDuplicates(["_bucket"])
    ordered = (
        dealt.select("_bucket", F.lit(0).alias("_sent"), "_key", "_h", "_text").unionByName(sent)
        .repartition("_bucket").sortWithinPartitions("_bucket", "_sent", "_key", "_h")
    )
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [schema_key, "long", "string", "string", "string", "double", "double"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out: list[list] = [[] for _ in names]
            keys = pa.array([], batch.column(1).type)
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                for sent, own, content in zip(*[part.column(c).to_pylist() for c in (0, 1, 2)], strict=True):
                    now = vector(content)
                    if held is not None:
                        past, words, of = held
                        new, same = edited(words, content)
                        changed = replaced(of, words, new, same)
                        row = (past, len(words), hashlib.sha256(new.encode("utf-8")).hexdigest(), of.tobytes().hex(),
                               changed.tobytes().hex(), likeness(of, changed), likeness(of, now))
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                    held = None if sent else (own, content, now)
            types = [keys.type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)

    return ordered.select("_sent", "_key", "_text").mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True)))
