"""Joins of many rows to one aggregated row per key, safe for hot keys of any size."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.session import is_small, stored

HOT_KEYS = 50_000
# Keys that the sketch of a frame reports as heavy, and those that it keeps track of: a key with more than two in
# HEAVY_KEYS rows is always reported, as the sketch errs by a tenth of that.
HEAVY_KEYS, TRACKED = 4_096, 65_536


def same_keys(keys: list[str], prefix: str, null_safe: bool) -> list[Column]:
    """Equality of each key with its prefixed copy."""
    pairs = [(F.col(k), F.col(f"{prefix}{k}")) for k in keys]
    return [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]


def join_aggregate(
    frame: DataFrame,
    aggregate: DataFrame,
    keys: list[str],
    rows: str,
    how: str,
    label: str | None,
    null_safe: bool = False,
    broadcast_rows: int | None = None,
    hot_keys: int | None = None,
) -> DataFrame:
    """Joins (``inner`` or ``left_semi``) every row to the aggregate of its key.

    ``rows`` is the aggregate's column that says how many rows of ``frame`` a key has. The
    aggregate is stored (unless ``label`` is None: it already is) and counted. Small, it is broadcast and the rows do not move. Large,
    it is split: the ``hot_keys`` heaviest keys are broadcast, and only rows of the others are
    shuffled. No key left to the shuffle can hold more than one in ``hot_keys`` rows, as the heavy ones are
    those above that share of all rows: there cannot be more of them, and none has to be ranked.
    """
    hot_keys = HOT_KEYS if hot_keys is None else hot_keys
    kept = aggregate if label is None else stored(aggregate, label)
    kept = kept.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = same_keys(keys, "_k_", null_safe)
    copies = [f"_k_{k}" for k in keys]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, on, how).drop(*copies, rows)

    if is_small(kept, broadcast_rows):
        return joined(frame, F.broadcast(kept))
    share = kept.agg(F.sum(F.col(rows) / F.lit(float(hot_keys)))).scalar()
    hot = stored(kept.filter(F.col(rows) > share), "hot-keys")
    heavy = F.broadcast(hot.select(*[F.col(c).alias(f"_h{c}") for c in copies]))
    cold = kept.join(heavy, same_keys(copies, "_h", null_safe), "left_anti")
    others = frame.join(F.broadcast(hot.select(*copies)), on, "left_anti")
    return joined(frame, F.broadcast(hot)).unionByName(joined(others, cold))


def heavy_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    """(h): hashes of the keys that hold most rows of a frame, out of a sketch that tasks fill and that merges.

    At most HEAVY_KEYS rows, whatever the frame holds; every key with more than two in HEAVY_KEYS rows is among them.
    """
    sketch = F.expr(f"approx_top_k(h, {HEAVY_KEYS}, {TRACKED})")
    found = frame.select(F.xxhash64(*keys).alias("h")).agg(sketch.alias("top"))
    return found.select(F.inline("top")).select(F.col("item").alias("h"))


def lookup(frame: DataFrame, table: DataFrame, keys: dict[str, str], label: str, broadcast_rows: int | None = None) -> DataFrame:
    """All rows of ``frame`` with the other columns of the row of ``table`` that has their key, NULL where none has.

    ``keys`` maps columns of the frame to those of the table, which has one row a key and no other column that the
    frame has. The table is stored; small, it is broadcast. Large, rows of the frame's heavy keys (known to the
    table or not) stay where they are and meet the broadcast rows of those keys, rows with a NULL in their key match
    nothing and stay as well, and only the others are shuffled.
    """
    kept, mine, theirs = stored(table, label), list(keys), list(keys.values())
    on = [F.col(a) == F.col(b) for a, b in keys.items()]
    if is_small(kept, broadcast_rows):
        return frame.join(F.broadcast(kept), on, "left").drop(*theirs)
    whole = reduce(and_, [F.col(c).isNotNull() for c in mine])
    heavy = F.broadcast(stored(heavy_keys(frame.filter(whole), mine), f"{label}-heavy"))
    is_heavy = F.xxhash64(*mine) == F.col("h")
    known = F.broadcast(stored(kept.join(heavy, F.xxhash64(*theirs) == F.col("h"), "left_semi"), f"{label}-heavy-rows"))
    full = frame.filter(whole)
    empty = frame.filter(~whole).select("*", *[F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in kept.columns if c not in theirs])
    staying = full.join(heavy, is_heavy, "left_semi").join(known, on, "left").drop(*theirs)
    moving = full.join(heavy, is_heavy, "left_anti").join(kept, on, "left").drop(*theirs)
    return staying.unionByName(moving).unionByName(empty)
