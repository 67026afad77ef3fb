"""SimHash near-dedup: tiles of fingerprints, compared whole by exclusive-or and bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.llm.bpe import slices
from panelwright.llm.common import components
from panelwright.operators.joins import join_aggregate
from panelwright.session import numbered, result_of, stored

# Fingerprints of a tile; a pair of tiles takes TILE * TILE comparisons.
TILE = 8192
# Rows of a tile that are compared with the other at once, so that the matrix stays in cache.
ROWS = 32
QUARTERS = 4


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """The unsigned SimHash of one text; see ``fingerprints``."""
    import xxhash

    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    if n <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    spans = zip(starts[: n - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 4096):
        some = hashes[first : first + 4096].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp) of every whole text, fp as a signed long.

    A-Z are lower-cased, words are runs of anything but ASCII white space, shingles of ``words`` words
    count as often as they occur; a text of fewer words is one shingle, a null or empty one has fingerprint 0.
    """
    schema = docs.select(F.col(key), F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                values = [fingerprint(t, words, seed) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(values, np.uint64).view(np.int64))], [key, "fp"])

    return docs.select(key, text).mapInArrow(run, schema)


def _quarter(k: int) -> Column:
    return F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF)))


def tiles(distinct: DataFrame, radius: int, size: int = TILE) -> DataFrame:
    """(tile, low, high, lows, highs, fps): fingerprints by their population counts, in tiles of about ``size``.

    Counts per 16-bit quarter are at most 17 to the 4th rows, whatever the table's size: those are laid out on
    the driver, neighbours together; a combination with more than a tile's rows is dealt over tiles by hash.
    """
    spark = distinct.sparkSession
    quarters = [f"q{k}" for k in range(QUARTERS)]
    counted = distinct.select("fp", *[_quarter(k).alias(q) for k, q in enumerate(quarters)])
    groups = counted.groupBy(*quarters).agg(F.count("*").alias("n")).collect()
    rows, tile, held = [], 0, 0
    for g in sorted(groups, key=lambda g: (sum(g[q] for q in quarters), *[g[q] for q in quarters])):
        parts = -(-g["n"] // size)
        if held and held + g["n"] > size:
            tile, held = tile + 1, 0
        rows.append((*[g[q] for q in quarters], tile, parts))
        tile, held = (tile + parts, 0) if parts > 1 else (tile, held + g["n"])
    kinds = ", ".join(f"{q} int" for q in quarters)
    layout = spark.createDataFrame(rows, f"{kinds}, first long, parts long")
    placed = counted.join(F.broadcast(layout), quarters).withColumn(
        "tile", F.col("first") + F.pmod(F.xxhash64("fp"), F.col("parts"))
    )
    total = sum(F.col(q) for q in quarters)
    return placed.groupBy("tile").agg(
        F.min(total).alias("low"), F.max(total).alias("high"),
        F.array(*[F.min(q) for q in quarters]).alias("lows"), F.array(*[F.max(q) for q in quarters]).alias("highs"),
        F.collect_list("fp").alias("fps"),
    )


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links between two tiles (or within one) that span all their connections, however many there are.

    Compares every row of one with every row of the other; a link that joins what is joined already
    is left out, so there are fewer links than rows.
    """
    both = a if same else np.concatenate([a, b])
    group = np.arange(len(both))
    shift = 0 if same else len(a)
    links = []
    for first in range(0, len(a), ROWS):
        start = first if same else 0
        near = np.bitwise_count(a[first : first + ROWS, None] ^ b[None, start:]) <= radius
        hit = near.any(axis=1) if not same else near.sum(axis=1) > 1
        for i in np.flatnonzero(hit):
            met = np.flatnonzero(near[i]) + start + shift
            groups = np.unique(group[met])
            own = group[first + i]
            others = groups[groups != own]
            if len(others):
                mine = both[first + i]
                for g in others:
                    links.append((int(mine), int(both[met[group[met] == g][0]])))
                group[np.isin(group, others)] = own
    return links


def links(tiled: DataFrame, radius: int) -> DataFrame:
    """(a, b) fingerprints within ``radius`` bits of each other, as a forest within each pair of tiles.

    A pair is left out if the tiles' population counts, in whole or summed over quarters, differ by more
    than the radius, as no two of their fingerprints can then be that near.
    """
    facts = tiled.select("tile", "low", "high", "lows", "highs")
    left = facts.select(F.col("tile").alias("a"), F.col("lows").alias("al"), F.col("highs").alias("ah"), F.col("low").alias("alow"),
                        F.explode(F.sequence("low", F.col("high") + radius)).alias("band"))
    right = facts.select(F.col("tile").alias("b"), F.col("lows").alias("bl"), F.col("highs").alias("bh"), F.col("low").alias("band"))
    apart = sum(
        F.greatest(F.lit(0), F.col("bl")[k] - F.col("ah")[k], F.col("al")[k] - F.col("bh")[k]) for k in range(QUARTERS)
    )
    ordered = (F.col("alow") < F.col("band")) | (F.col("alow") == F.col("band")) & (F.col("a") <= F.col("b"))
    pairs = left.join(right, "band").filter(ordered & (apart <= radius)).select("a", "b")
    work = pairs.join(tiled.select(F.col("tile").alias("b"), F.col("fps").alias("y")), "b").join(
        tiled.select(F.col("tile").alias("a"), F.col("fps").alias("x")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].values.to_numpy().view(np.uint64) for c in (2, 3))
                found = np.array(forest(a, b, radius, batch.column(0)[k] == batch.column(1)[k]), np.uint64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, c].view(np.int64)) for c in (0, 1)], ["a", "b"])

    return work.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, words: int = 4, radius: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text", tile: int = TILE) -> DataFrame:
    """(key, fingerprint, component_id): the least key that is reachable over links of at most ``radius`` bits.

    Texts are reduced to distinct fingerprints first, so a text with millions of copies is compared once.
    Rows with a null key are linked like any other; a component of null keys only has a null id. An
    empty table gives no rows; other columns are left out.
    """
    kept = stored(fingerprints(docs, words, seed, key, text), "fingerprints")
    distinct = stored(kept.groupBy("fp").agg(F.min(key).alias("_first"), F.count("*").alias("_rows")), "distinct")
    found = components(links(stored(tiles(distinct, radius, tile), "tiles"), radius), "simhash")
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "_first", "_rows", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    by_print = rooted.join(least, "root").select("fp", "component_id", "_rows")
    return join_aggregate(kept, by_print, ["fp"], "_rows", "inner", "components").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, words: int = 4, radius: int = 4, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that come first in their component, by key and then by place; all their columns."""
    placed = numbered(docs, "numbered")
    own = F.col("_row")[key]
    ranked = placed.select(F.struct(own.isNull().alias("missing"), own.alias("key"), "_place").alias("_key"), F.col("_row")[text].alias("_text"))

    def firsts() -> DataFrame:
        found = groups(ranked, words, radius, seed, "_key", "_text")
        return found.filter(F.col("_key") == F.col("component_id")).select(F.col("_key._place").alias("_place"))

    chosen = result_of(docs.sparkSession, firsts, "chosen")
    # As many places as groups: texts are dealt by place at every size, and pass by the places unsorted.
    return placed.join(chosen.hint("shuffle_hash"), "_place", "left_semi").select("_row.*")
