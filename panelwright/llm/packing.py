"""Best-fit packing by linear grouping: few rounded sizes, optimised configurations, actual pieces, small ones last."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from panelwright.llm import bpe, pretokens
from panelwright.session import sized, stored

# Sizes that large lengths are rounded up to, and rows that a bucket of one length has on average.
GROUPS = 96
BUCKET_ROWS = 2_000


@cache
def _library(path: str):
    """Encodes lists of words with the tokenizers library; what it said of a word is kept, within bounds."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer, known, code = Tokenizer.from_file(path), {}, bpe.coder(path)
    widths = np.array([len(code.pieces.get(i, b"")) for i in range(max(code.pieces) + 1)])

    def joined(words: list[str]) -> list[bytes]:
        """Words that start with a space and end without are split off one another wherever they meet."""
        ids = np.array(tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(w.encode("utf-8")) for w in words])
        at = [0, *(np.searchsorted(np.cumsum(widths[ids]), ends) + 1).tolist()]
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:])]

    def encode(words: list[str]) -> list[bytes]:
        if len(known) >= bpe.KEPT_WORDS:
            known.clear()
        fresh = [w for w in words if w not in known]
        plain = [w for w in fresh if w[0] == " " and len(w) > 1 and not w[1].isspace() and not w[-1].isspace()]
        for first in range(0, len(plain), 2_000):
            some = plain[first : first + 2_000]
            known.update(zip(some, joined(some)))
        fresh = [w for w in fresh if w not in known]
        for first in range(0, len(fresh), 20_000):
            some = fresh[first : first + 20_000]
            found = tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(some, found))
        return [known[w] for w in words]

    return encode


def pieces(
    docs: DataFrame, path: str, size: int = 2048, end: int = 0, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every text's ids and the end id.

    Texts of more than ``size`` ids are cut into pieces of that size, of which the first may be
    shorter. A null or empty text is one piece that holds the end id alone.
    """
    packed = pretokens.character_classes(path)
    columns = {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}
    if with_ids:
        columns["ids"] = "array<int>"
    schema = docs.select(F.col(key), *[F.lit(None).cast(kind).alias(c) for c, kind in columns.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, encode = bpe.coder(path), _library(path)
        for batch in batches:
            for part in bpe.slices(batch):
                rows: list[list] = [[], [], [], [], []]
                owners = []
                for number, ids in enumerate(bpe.encode_texts(part.column(1).to_pylist(), code, packed, encode)):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    first = len(ids) % size or size
                    starts = [0, *range(first, len(ids), size)]
                    for k, a in enumerate(starts):
                        own = ids[a : first if k == 0 else a + size]
                        owners.append(number)
                        for column, value in zip(rows, (k, a, len(own), zlib.crc32(own.tobytes()), own.astype(np.int32)), strict=True):
                            column.append(value)
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                arrays = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)][: len(columns)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(owners, pa.int64())), *arrays], [key, *columns])

    return docs.select(key, text).mapInArrow(run, schema)


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """How often to use which multiset of sizes: the linear programme over all configurations, rounded down.

    Columns are generated by a knapsack over the duals; there are as many rows as sizes.
    """
    k = len(sizes)
    need = np.array(counts, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    most = capacity // min(sizes)
    for _ in range(60 * k):
        duals = np.linalg.solve(basis.T, np.ones(k))
        best = [np.zeros(capacity + 1)]
        picks = []
        for _ in range(most):
            value, pick = best[-1].copy(), np.full(capacity + 1, -1)
            for g, s in enumerate(sizes):
                if duals[g] > 0:
                    with_it = best[-1][: capacity + 1 - s] + duals[g]
                    better = with_it > value[s:] + 1e-12
                    value[s:][better], pick[s:][better] = with_it[better], g
            best.append(value)
            picks.append(pick)
        if best[-1][capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(k), capacity
        for pick in reversed(picks):
            if pick[room] >= 0:
                column[pick[room]] += 1
                room -= sizes[pick[room]]
        solution, change = np.linalg.solve(basis, need), np.linalg.solve(basis, column)
        ratios = np.where(change > 1e-9, np.maximum(solution, 0) / np.where(change > 1e-9, change, 1), np.inf)
        leaving = int(np.argmin(ratios))
        if not np.isfinite(ratios[leaving]):
            break
        basis[:, leaving] = column
    solution = np.linalg.solve(basis, need)
    return [([int(v) for v in basis[:, j]], int(math.floor(solution[j] + 1e-6))) for j in np.argsort(-solution) if solution[j] >= 1]


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Intervals (length, first rank, ranks, first sequence, offset), and the number of sequences.

    The piece of a length with rank first + i goes to sequence first + i at the offset. Works on
    counts by length, so its size depends on the capacity alone, however many pieces there are.
    """
    left = {s: n for s, n in histogram.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    intervals: list[tuple[int, int, int, int, int]] = []
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room left: (first sequence, sequences)
    used = 0

    def put(length: int, first: int, many: int, room: int) -> None:
        intervals.append((length, taken[length], many, first, capacity - room))
        taken[length] += many
        left[length] -= many

    if whole := left.get(capacity, 0):
        put(capacity, 0, whole, capacity)
        used = whole
    large = [s for s in sorted(left, reverse=True) if capacity // 8 < s < capacity]
    total = sum(left[s] for s in large)
    if total:
        # Groups of equal cardinality, in falling order of length, each as large as its largest.
        per = max(1, math.ceil(total / groups))
        queues: list[list[list[int]]] = [[]]
        room = per
        for s in large:
            n = left[s]
            while n:
                take = min(n, room)
                queues[-1].append([s, take])
                n, room = n - take, room - take
                if not room:
                    queues.append([])
                    room = per
        queues = [q for q in queues if q]
        merged: dict[int, list[list[int]]] = {}
        for q in queues:  # groups of one rounded size are one size
            merged.setdefault(q[0][0], []).extend(q)
        sizes = list(merged)
        counts = [sum(n for _, n in merged[s]) for s in sizes]
        for column, times in configurations(sizes, counts, capacity):
            stack = [s for s, n in zip(sizes, column, strict=True) for _ in range(n)]
            times = min([times, *(sum(n for _, n in merged[s]) // stack.count(s) for s in set(stack))])
            if not times:
                continue
            batches = [(used, times, capacity)]
            used += times
            for s in stack:
                after = []
                for first, many, room in batches:
                    while many:
                        length, n = merged[s][0]
                        take = min(n, many)
                        put(length, first, take, room)
                        after.append((first, take, room - length))
                        merged[s][0][1] -= take
                        if not merged[s][0][1]:
                            merged[s].pop(0)
                        first, many = first + take, many - take
                batches = after
            for first, many, room in batches:
                free[room].append((first, many))
    # What is left, falling: best fit is the least room that holds the piece.
    for length in sorted((s for s in left if left[s]), reverse=True):
        room = length
        while left[length]:
            while room < capacity and not free[room]:
                room += 1
            if free[room]:
                first, many = free[room].pop()
            else:
                first, many = used, -(-left[length] // (capacity // length))
                used += many
            fit = room // length
            full = min(many, left[length] // fit)
            if full:
                for j in range(fit):
                    put(length, first, full, room - j * length)
                free[room - fit * length].append((first, full))
            if full < many and left[length] and left[length] < fit:
                rest = left[length]
                for j in range(rest):
                    put(length, first + full, 1, room - j * length)
                free[room - rest * length].append((first + full, 1))
                full += 1
            if full < many:
                free[room].append((first + full, many - full))
    return intervals, used


def pack(parts: DataFrame, size: int = 2048, order: tuple[str, ...] = ("doc_id", "piece", "start", "ids_crc32")) -> DataFrame:
    """Adds (sequence_id, offset) to pieces of up to ``size`` tokens, by column ``length``.

    Only counts by length reach the driver. Pieces are numbered within their length by buckets that
    grow in number with the table; equal rows are interchangeable. An empty table stays empty; columns of
    the names that are added are replaced.
    """
    spark = parts.sparkSession
    kept = stored(parts.drop("sequence_id", "offset"), "pieces")
    histogram = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}
    intervals, _ = plan(histogram, size)
    slots = spark.createDataFrame(
        intervals, "_length long, _from long, _many long, _sequence long, _offset long"
    )
    buckets = max(1, math.ceil(sum(histogram.values()) / BUCKET_ROWS))
    own = kept.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = own.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")
    bases = sized(counts.select("length", "_bucket", before.alias("_base")), "bases")
    ranked = own.withColumn("_row", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*order)))
    ranked = ranked.join(bases, ["length", "_bucket"]).withColumn("_rank", F.col("_base") + F.col("_row") - 1)
    inside = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (
        F.col("_rank") < F.col("_from") + F.col("_many")
    )
    placed = ranked.join(F.broadcast(slots), inside)  # at most a few thousand rows, by the capacity
    return placed.select(
        *[F.col(f"`{c}`") for c in kept.columns],
        (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )
