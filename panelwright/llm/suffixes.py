"""Exact removal of repeated byte strings, by refinement of q-gram buckets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.operators.joins import join_aggregate
from panelwright.session import numbered, result_of, sized, stored

_BASE = 0xD6E8FEB86659FD93
# Bytes of a text that are scanned at once, and of the texts whose equal runs a task sees as one.
SCAN, PART = 1 << 20, 8 << 20
# Keys that may be looked up without moving their rows. Joins are split like that at every size, so that what is
# shuffled is in proportion to the input.
HOT = 1_000
GRAM = 64
# A bucket of up to so many different strings is finished in one task; a larger one is split further.
FINISHED = 64
# Starts of a block that a large bucket is split by, counted from the anchor.
BLOCK = 8


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` or more powers of the base and of its inverse; only the largest table is kept."""
    if not _TABLES or len(_TABLES[0][0]) < n:
        with np.errstate(over="ignore"):
            up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            _TABLES[:] = [(np.multiply.accumulate(up), np.multiply.accumulate(down))]
    return _TABLES[0]


def gram_names(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit name of the q-gram at every byte: equal q-grams have equal names."""
    up, down = _powers(1 << int(len(data) + 1).bit_length())
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        names = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
        names ^= names >> np.uint64(32)
        names *= np.uint64(0xD6E8FEB86659FD93)
        names ^= names >> np.uint64(29)
        names *= np.uint64(0xBF58476D1CE4E5B9)
        return names ^ (names >> np.uint64(32))


def window_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of every window of ``width`` keys."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def runs_of(data: bytes, length: int, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, first start, last start, anchor) of runs of starts whose strings have one anchor.

    The anchor of a string of ``length`` bytes is its q-gram of the least name, the first of equal ones. It is
    chosen by what is inside the string, so equal strings have equal anchors at equal distances.
    """
    width = length - gram + 1
    whole = np.frombuffer(data, np.uint8)
    for base in range(0, max(0, len(whole) - length + 1), SCAN):
        part = whole[base : base + SCAN + length - 1]
        if len(part) < length:
            break
        names = gram_names(part, gram)
        mask = np.uint64((1 << 24) - 1)
        least = window_least((names & ~mask) | np.arange(len(names), dtype=np.uint64), width)
        anchors = (least & mask).astype(np.int64)
        firsts = np.append(0, np.flatnonzero(np.diff(anchors)) + 1)
        lasts = np.append(firsts[1:], len(anchors)) - 1
        at = anchors[firsts]
        yield names[at], firsts + base, lasts + base, at + base


def _digest(data: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(data)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def scan(texts: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """(m, h, n, _place, s, e, a): runs of starts, by anchor q-gram m and whole string h.

    Of the n equal strings that PART bytes of a task hold one stands for all; what the others cover is
    repeated for certain and comes as rows (null m, _place, s, e) of byte intervals.
    """
    def settled(found: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        m, h, place, s, e, a = map(np.concatenate, found)
        order = np.lexsort((np.arange(len(m)), h, m))
        new = np.append(True, (np.diff(m[order]) != 0) | (np.diff(h[order]) != 0))
        which = np.empty(len(m), np.int64)
        which[order] = np.cumsum(new) - 1
        first, n = order[new], np.bincount(which)
        out = [_signed(m[first]), _signed(h[first]), n, place[first], s[first], e[first], a[first]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)
        twice = np.flatnonzero(n[which] > 1)
        if len(twice):
            cut = np.append(True, (place[twice[1:]] != place[twice[:-1]]) | (s[twice[1:]] != e[twice[:-1]] + 1))
            starts = twice[cut]
            ends = twice[np.append(np.flatnonzero(cut)[1:] - 1, len(twice) - 1)]
            none = pa.nulls(len(starts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, *[pa.array(x) for x in (place[starts], s[starts], e[ends] + length)], none], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[np.ndarray]] = [[] for _ in range(6)]
        size = 0
        for batch in batches:
            places = batch.column(0).to_numpy()
            for k in range(batch.num_rows):
                data = batch.column(1)[k].as_py()
                size += len(data)
                for m, s, e, a in runs_of(data, length, gram):
                    h = np.array([_digest(data[i : j + length]) for i, j in zip(s.tolist(), e.tolist(), strict=True)], np.uint64)
                    for column, value in zip(found, (m, h, np.full(len(m), places[k]), s, e, a), strict=True):
                        column.append(value)
                if found[0] and size > PART:
                    yield from settled(found)
                    found, size = [[] for _ in range(6)], 0
        if found[0]:
            yield from settled(found)

    names = ["m", "h", "n", "_place", "s", "e", "a"]
    return texts.mapInArrow(run, ", ".join(f"{x} long" for x in names))


def _strings(texts: DataFrame, members: DataFrame, run, schema: str) -> DataFrame:
    """Runs ``run`` over (place, text, members of the place); only texts with members are moved."""
    lists = members.groupBy("_place").agg(F.collect_list(F.struct("m", "n", "s", "e", "a")).alias("_members"))
    lists = stored(lists, "members")
    some = texts.join(sized(lists.select("_place"), "member-places"), "_place", "left_semi")
    return some.join(lists, "_place").select("_place", "_data", "_members").mapInArrow(run, schema)


def finished(texts: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """(_place, s, e) of repeated bytes in small buckets: each bucket's strings meet in one task.

    Members are different strings with an anchor in common; of those that stand for several (n > 1) all bytes
    are known to be repeated, they are only compared with.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, place = batch.column(1)[k].as_py(), batch.column(0)[k].as_py()
                rows = batch.column(2)[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], pa.int64()) for c in ("m", "n")] + [pa.array([place] * len(rows), pa.int64()),
                     pa.array([r["s"] for r in rows], pa.int64()), pa.array([data[r["s"] : r["e"] + length] for r in rows], pa.binary())],
                    ["m", "n", "_place", "s", "_bytes"])

    strings = _strings(texts, members, cut, "m long, n long, _place long, s long, _bytes binary")
    buckets = strings.groupBy("m").agg(F.collect_list(F.struct("n", "_place", "s", "_bytes")).alias("_rows"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for k in range(batch.num_rows):
                out += repeated_in(batch.column(0)[k].as_py(), length)
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_place", "s", "e"])

    return buckets.select("_rows").mapInArrow(compare, "_place long, s long, e long")


def repeated_in(rows: list[dict], length: int) -> list[tuple[int, int, int]]:
    """(place, from, to) of the bytes of single strings that occur in another string of the bucket."""
    names = [gram_names(np.frombuffer(r["_bytes"], np.uint8), length) for r in rows]
    _, which, counts = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
    often = counts[which] > 1
    # Equal names are checked by their bytes, as a name is a hash.
    exact: dict[bytes, int] = {}
    ends = np.cumsum([len(n) for n in names])
    parts = []
    for r, end, own in zip(rows, ends, names, strict=True):
        starts = np.flatnonzero(often[end - len(own) : end])
        keys = [r["_bytes"][i : i + length] for i in starts.tolist()]
        for key in keys:
            exact[key] = exact.get(key, 0) + 1
        parts.append((starts, keys))
    out = []
    for r, (starts, keys) in zip(rows, parts, strict=True):
        if r["n"] == 1:
            starts = starts[[exact[key] > 1 for key in keys]] if len(starts) else starts
            cut = np.flatnonzero(np.append(True, np.diff(starts) != 1)) if len(starts) else []
            for a, b in zip(cut, [*cut[1:], len(starts)]):
                out.append((r["_place"], r["s"] + int(starts[a]), r["s"] + int(starts[b - 1]) + length))
    return out


def split(texts: DataFrame, members: DataFrame, length: int) -> DataFrame:
    """(_place, s, e) of repeated bytes in large buckets, which are refined until nothing is left to tell apart.

    A bucket is split by blocks of starts at one distance from the anchor, and by the name of the string
    that all starts of a block share. Members alone in their bucket are done, members whose whole block is
    equal to another's are repeated. The rest is refined by single starts, whose name is their string. Only names
    are grouped and counted, so no group of any size meets in one task.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, place = batch.column(1)[k].as_py(), batch.column(0)[k].as_py()
                out: list[tuple] = []
                for r in batch.column(2)[k].as_py():
                    for b in range((r["a"] - r["e"]) // BLOCK, (r["a"] - r["s"]) // BLOCK + 1):
                        first = r["a"] - b * BLOCK - BLOCK + 1  # of the block's starts
                        low, high = max(r["s"], first), min(r["e"], first + BLOCK - 1)
                        shared = b"%d:" % b + data[first + BLOCK - 1 : first + length]
                        whole = b"%d:" % (low - first) + data[low : high + length]
                        out.append((r["m"], _digest(shared), _digest(whole), r["n"], place, low, high))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), _signed(columns[1]), _signed(columns[2]), *[pa.array(c, pa.int64()) for c in columns[3:]]],
                    ["m", "c", "f", "n", "_place", "s", "e"])

    first = stored(_strings(texts, members, blocks, "m long, c long, f long, n long, _place long, s long, e long"), "blocks")
    wholes = first.groupBy("m", "c", "f").agg(F.count("*").alias("_same"), F.min("n").alias("_n"))
    groups = wholes.groupBy("m", "c").agg(F.sum("_same").alias("_rows"), F.sum(F.when((F.col("_same") == 1) & (F.col("_n") == 1), 1).otherwise(0)).alias("_open"))
    shared = join_aggregate(first, groups.filter("_rows > 1"), ["m", "c"], "_rows", "inner", "shared-blocks", broadcast_rows=0, hot_keys=HOT)
    equal = wholes.filter("_same > 1").select("m", "c", "f", F.col("_same").alias("_rows"))
    done = join_aggregate(first.filter("n = 1"), equal, ["m", "c", "f"], "_rows", "inner", "equal-blocks", broadcast_rows=0, hot_keys=HOT).select(
        "_place", "s", (F.col("e") + length).alias("e"))

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, place = batch.column(1)[k].as_py(), batch.column(0)[k].as_py()
                rows = [(r["m"], _digest(data[i : i + length]), r["n"], place, i) for r in batch.column(2)[k].as_py() for i in range(r["s"], r["e"] + 1)]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), _signed(columns[1]), *[pa.array(c, pa.int64()) for c in columns[2:]]], ["m", "g", "n", "_place", "s"])

    left = shared.filter("_open > 0").select("m", "n", "_place", "s", "e", F.lit(0).cast("long").alias("a"))
    each = stored(_strings(texts, left, starts, "m long, g long, n long, _place long, s long"), "starts")
    twice = each.groupBy("m", "g").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    hit = join_aggregate(each.filter("n = 1"), twice, ["m", "g"], "_rows", "inner", "equal-starts", broadcast_rows=0, hot_keys=HOT)
    return done.unionByName(hit.select("_place", "s", (F.col("s") + length).alias("e")))


def repeated(texts: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """(_place, s, e): intervals of bytes covered by a string of ``length`` bytes that starts elsewhere too.

    Initial buckets are q-grams, of which every string of that length has one as its anchor. Buckets are
    refined by names of what follows and precedes the anchor: first of whole runs of strings, then, where some but not all
    are equal, of ever shorter parts. What is alone in its bucket is done at once, which is most of a corpus.
    """
    runs = stored(scan(texts, length, gram), "runs")
    sampled = runs.filter("m IS NOT NULL")
    buckets = sampled.groupBy("m").agg(F.sum("n").alias("_n"), F.count("*").alias("_rows")).filter("_n > 1").select("m", "_rows")
    inside = stored(join_aggregate(sampled, buckets, ["m"], "_rows", "left_semi", "buckets", broadcast_rows=0, hot_keys=HOT), "in-buckets")
    different = stored(inside.groupBy("m", "h").agg(
        F.sum("n").alias("n"), F.count("*").alias("_rows"), F.min(F.struct("_place", "s", "e", "a")).alias("_one")), "different")
    equal = join_aggregate(inside, different.filter("n > 1").select("m", "h", "_rows"), ["m", "h"], "_rows", "left_semi", "equal-runs", broadcast_rows=0, hot_keys=HOT)
    sizes = different.groupBy("m").agg(F.count("*").alias("_size"), F.min("n").alias("_least"), F.count("*").alias("_rows"))
    open_buckets = sizes.filter("_size > 1 AND _least = 1").select("m", "_size", "_rows")
    members = stored(join_aggregate(different.drop("_rows"), open_buckets, ["m"], "_rows", "inner", "open-buckets", broadcast_rows=0, hot_keys=HOT).select(
        "m", "n", "_one.*", "_size"), "open")
    parts = [
        runs.filter("m IS NULL").select("_place", "s", "e"),
        equal.select("_place", "s", (F.col("e") + length).alias("e")),
        finished(texts, members.filter(F.col("_size") <= FINISHED).drop("_size"), length),
    ]
    large = members.filter(F.col("_size") > FINISHED).drop("_size")
    if not large.isEmpty():
        parts.append(split(texts, large, length))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching intervals as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _texts(placed: DataFrame, text: str, *more: str) -> DataFrame:
    """(_place, _data, more columns) of numbered rows."""
    data = F.coalesce(F.col("_row")[text], F.lit("")).cast("binary")
    return placed.select("_place", *[F.col("_row")[c].alias(c) for c in more], data.alias("_data"))


def _spans(texts: DataFrame, length: int) -> DataFrame:
    def pairs() -> DataFrame:
        return repeated(texts, length).groupBy("_place").agg(F.collect_list(F.struct("s", "e")).alias("_spans"))

    # Runs, buckets and blocks are dead once the spans are stored.
    return result_of(texts.sparkSession, pairs, "spans")


def removed(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every document without its repeated bytes.

    All places of a repeated string are removed, judged on the texts as they come; matches do not cross
    documents. Null and empty texts and texts under ``length`` bytes keep all. Null keys and repeated rows are rows
    like any other.
    """
    placed = numbered(docs.select(key, text), "numbered")
    spans = _spans(_texts(placed, text), length)
    whole = _texts(placed, text, key)
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    places = sized(spans.select("_place"), "span-places")
    kept = whole.join(places, "_place", "left_anti").select(
        key, F.length("_data").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("_data", 256).alias("kept_sha256"))
    cut = whole.join(places, "_place", "left_semi").join(spans, "_place").select(key, "_data", "_spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, found in zip(batch.column(1), batch.column(2), strict=True):
                data, gone = data.as_py(), merged([(x["s"], x["e"]) for x in found.as_py()])
                rest = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(data)], strict=True))
                rows.append((len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest()))
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]], names)

    return kept.unionByName(cut.mapInArrow(run, kept.schema))


def without_repeats(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """``docs`` without repeated bytes in the text, all rows and columns; a null text stays null.

    Where a cut would split a character, the character goes as a whole.
    """
    placed = numbered(docs, "numbered")
    spans = _spans(_texts(placed, text), length)
    places = sized(spans.select("_place"), "span-places")

    @F.pandas_udf("string")
    def rest(texts, spans):
        import pandas as pd

        out = []
        for value, found in zip(texts, spans, strict=True):
            data, gone = value.encode("utf-8"), merged([(int(x["s"]), int(x["e"])) for x in found])
            parts = (data[a:b] for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(data)], strict=True))
            out.append("".join(p.decode("utf-8", "ignore") for p in parts))
        return pd.Series(out, dtype=object)

    cut = placed.join(places, "_place", "left_semi").join(spans, "_place").select(
        F.col("_row").withField(text, rest(F.col("_row")[text], "_spans")).alias("_row"))
    return placed.join(places, "_place", "left_anti").select("_row").unionByName(cut).select("_row.*")
