"""Near duplicates by bottom-k sketches: one hash function, inverted lists of what the sketches keep, exact checks of what is left."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.llm.common import components
from panelwright.operators.joins import join_aggregate
from panelwright.session import stored

# Hashes that a sketch keeps. A link may be missed with this chance at most.
KEEP, CHANCE = 64, 1e-9
# Members of an inverted list that are paired with each other at once; members of a tile of texts with longer lists.
SHORT, TILE = 32, 512
# Members of a longer list that all others are compared with first.
CENTRES = 3
# Pairs of a text that share one copy of it in a join.
PAIRS = 512
# Rounds in which each text is checked against its likeliest partner only.
ROUNDS = 1
# Tasks over which rows of one key are spread at least.
SALTS = 8
# Bytes of text that a batch of results comes from.
BYTES = 4 << 20


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the different shingles of a text; a text of fewer words is one, of no words none."""
    import xxhash

    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined, n = b" ".join(parts), len(parts)
    if n <= words:
        return np.array([xxhash.xxh3_64_intdigest(joined)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    digest = xxhash.xxh3_64_intdigest
    spans = zip(starts[: n - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    return np.unique(np.array([digest(joined[a:b]) for a, b in spans], np.uint64))


def set_id(hashes: np.ndarray) -> bytes:
    """Names a set by 128 bits of its hashes, so that equal sets are one."""
    import xxhash

    return xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes())


def least_shared(keep: int, percent: int, chance: float = CHANCE) -> int:
    """The most hashes t for which two sets of at least that likeness share under t of ``keep`` with at most this chance.

    Of the least hashes of the union each is common with the probability of the likeness.
    """
    share, total = percent / 100, 0.0
    for t in range(keep + 1):
        total += math.comb(keep, t) * share**t * (1 - share) ** (keep - t)
        if total > chance:
            return max(1, t)
    return keep


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.append(0, np.cumsum([len(a) for a in arrays]))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *arrays]).view(np.int64)))


def _hashed(rows: DataFrame, words: int, keep: int | None, schema: str, names: list[str]) -> DataFrame:
    """(key, n, set, hashes) of (key, data): the ``keep`` least hashes, all where that is None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, size, done = 0, 0, []
            for k in range(batch.num_rows):
                data = batch.column(1)[k].as_py()
                hashes = shingles(data, words)
                done.append((len(hashes), set_id(hashes), hashes if keep is None else hashes[:keep].copy()))
                size += len(data)
                if size > BYTES or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(first, len(done)), pa.array([d[0] for d in done], pa.int64()),
                        pa.array([d[1] for d in done], pa.binary()), _lists([d[2] for d in done])], names)
                    first, size, done = k + 1, 0, []

    return rows.mapInArrow(run, schema)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_data"))


def sketches(docs: DataFrame, words: int, keep: int, key: str, text: str) -> DataFrame:
    """(_key, n, set, sketch) of every row; stored."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"_key {kind}, n long, set binary, sketch array<bigint>"
    return stored(_hashed(_texts(docs, key, text), words, keep, schema, ["_key", "n", "set", "sketch"]), "sketches")


def prefixes(distinct: DataFrame, keep: int, percent: int) -> DataFrame:
    """(v, node, n): the rarest hashes of every sketch, as many as it takes for two like sets to have one in common.

    Two sketches that share t hashes have one in common among their first size - t + 1, in any order of all hashes; the order here is
    by how many sketches keep a hash, so frequent passages are hardly ever listed. Hashes that one sketch alone keeps have no partner.
    """
    exact = keep * percent // 100  # a set of at most so many hashes, and all its partners, are sketched whole
    floor = least_shared(keep, percent)
    size = F.least(F.col("n"), F.lit(keep))
    t = F.when(F.col("n") <= exact, F.ceil(F.col("n") * percent / 100)).otherwise(F.lit(floor))
    each = distinct.select("node", "n", F.explode("sketch").alias("v"))
    counts = each.groupBy("v").agg(F.count(F.lit(1)).alias("_f")).filter("_f > 1")
    shared = join_aggregate(each, counts.withColumn("f", F.col("_f")), ["v"], "_f", "inner", "shared-hashes")
    listed = shared.groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("f", "v"))).alias("_known"))
    # Hashes without a partner come first in the order and use up their share of the places.
    places = F.greatest(F.lit(0), (size - t + 1 - (size - F.size("_known"))).cast("int"))
    return listed.select("node", "n", F.explode(F.slice("_known", 1, places)).alias("_x")).select(F.col("_x.v").alias("v"), "node", "n")


def _likely_sizes(percent: int) -> Column:
    return (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (F.col("node") != F.col("node2"))


def _pairs(both: DataFrame, percent: int) -> DataFrame:
    """Different pairs (a, b), a < b, of sets whose sizes allow a link."""
    return both.filter(_likely_sizes(percent)).select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def first_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs within short lists; in long ones every member with the list's few centres.

    Centres are the members of least hash, so that lists with the same members have the same ones.
    """
    order = F.struct(F.xxhash64(F.col("node"), F.lit(7)).alias("h"), F.col("node").alias("node2"), F.col("n").alias("n2"))
    facts = entries.groupBy("v").agg(F.count(F.lit(1)).alias("_m"), F.min(order).alias("_c0"), F.max(order).alias("_c1"), F.min(
        F.struct(F.xxhash64(F.col("node"), F.lit(8)).alias("h"), F.col("node").alias("node2"), F.col("n").alias("n2"))).alias("_c2")).filter("_m > 1")
    facts = stored(facts, "lists")
    short = join_aggregate(entries, facts.filter(F.col("_m") <= SHORT).select("v", "_m"), ["v"], "_m", "left_semi", "short-lists")
    members = short.groupBy("v").agg(F.collect_list(F.struct("node", "n")).alias("_all"))
    one = members.select(F.explode("_all").alias("_x"), "_all").select("_x.*", F.explode("_all").alias("_y"))
    near = one.select("node", "n", F.col("_y.node").alias("node2"), F.col("_y.n").alias("n2")).filter("node < node2")
    centres = facts.filter(F.col("_m") > SHORT).select("v", F.col("_m").alias("_rows"), F.array(*[f"_c{k}" for k in range(CENTRES)]).alias("_centres"))
    far = join_aggregate(entries, centres, ["v"], "_rows", "inner", "centres").select("node", "n", F.inline("_centres").alias("_h", "node2", "n2"))
    return _pairs(near.unionByName(far.drop("_h")), percent)


def with_rows(pairs: DataFrame, side: str, rows: DataFrame, column: str, output: str) -> DataFrame:
    """Adds a column of the row of ``side``; a node's row is copied once for every PAIRS of its pairs, so no task gets all of them."""
    copies = pairs.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / PAIRS).alias("_copies"))
    copies = stored(copies, "copies")
    counted = pairs.join(copies.hint("merge"), side)
    dealt = counted.withColumn("_copy", F.pmod(F.xxhash64("a", "b"), F.col("_copies"))).drop("_copies")
    spread = rows.select(F.col("node").alias(side), F.col(column).alias(output)).join(copies.hint("merge"), side).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))).drop("_copies")
    return dealt.join(spread.hint("merge"), [side, "_copy"]).drop("_copy")


def estimate(x: np.ndarray, y: np.ndarray, keep: int) -> tuple[int, int]:
    """(shared, size) of the sketch of the union of two sets, out of their sketches."""
    union = np.union1d(x, y)
    if len(x) >= keep or len(y) >= keep:
        union = union[:keep]
    return len(np.intersect1d(np.intersect1d(union, x, True), y, True)), len(union)


def likely(pairs: DataFrame, distinct: DataFrame, keep: int, percent: int) -> DataFrame:
    """(a, b, score): pairs whose union sketch allows a link, with the likeness that it tells."""
    floor = least_shared(keep, percent)
    both = with_rows(with_rows(pairs, "a", distinct, "sketch", "x"), "b", distinct, "sketch", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c) for c in (2, 3))
            found = [estimate(x[k].values.to_numpy().view(np.uint64), y[k].values.to_numpy().view(np.uint64), keep) for k in range(batch.num_rows)]
            shared, size = np.array(found, np.int64).reshape(-1, 2).T
            # A union of fewer hashes than a sketch keeps is known whole; of a larger one enough must be shared.
            passed = np.where(size < keep, 100 * shared >= percent * size, shared >= floor)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared / np.maximum(size, 1))], ["a", "b", "score"])
            yield out.filter(pa.array(passed))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, score double")


def confirmed(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs whose whole sets are linked."""
    both = with_rows(with_rows(pairs, "a", whole, "hashes", "x"), "b", whole, "hashes", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(c) for c in (2, 3))
            linked = []
            for k in range(batch.num_rows):
                one, two = (c[k].values.to_numpy() for c in (x, y))
                shared = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def whole_sets(docs: DataFrame, nodes: DataFrame, distinct: DataFrame, words: int, key: str, text: str) -> DataFrame:
    """(node, hashes) of the whole sets of some nodes; the texts are looked up by the key of their first row; stored.

    A row is taken for what its set says it is, so null and repeated keys do no harm.
    """
    wanted = stored(distinct.select("node", "set", "_key").join(nodes.hint("merge"), "node"), "wanted-sets")
    # Rows of one key, null above all, are spread over as many tasks as it has salts.
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    keys = wanted.groupBy("_key").agg(F.lit(1).alias("_x")).select(F.col("_key").alias("_wanted"), F.explode(salts).alias("_s"))
    texts = _texts(docs, key, text).withColumn("_salt", F.pmod(F.xxhash64("_data"), F.lit(SALTS)))
    some = texts.join(keys.hint("merge"), F.col("_key").eqNullSafe(F.col("_wanted")) & (F.col("_salt") == F.col("_s")), "left_semi").drop("_salt")
    schema = f"_key {docs.schema[key].dataType.simpleString()}, n long, set binary, hashes array<bigint>"
    hashed = _hashed(some, words, None, schema, ["_key", "n", "set", "hashes"])
    found = hashed.join(wanted.select("node", "set").hint("merge"), "set").groupBy("set").agg(F.first("node").alias("node"), F.first("hashes").alias("hashes"))
    return stored(found.select("node", "hashes"), "whole-sets")


def rooted(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) of all nodes under the links; stored."""
    found = components(links, "sketches")
    return stored(nodes.join(found.hint("merge"), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose nodes have different roots so far."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    return pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").filter("_ra <> _rb").drop("_ra", "_rb")


def linked(candidates: DataFrame, links: DataFrame | None, nodes: DataFrame, whole: DataFrame, percent: int) -> tuple[DataFrame | None, DataFrame]:
    """(links, roots) after all candidates have been checked, but for those whose texts are connected by then.

    At first each text is checked against its likeliest partner only, which connects most of a group; the last round checks all that is left.
    """
    roots, done = nodes.withColumn("root", F.col("node")) if links is None else rooted(nodes, links), None
    for turn in range(ROUNDS + 1):
        left = _apart(candidates, roots)
        if done is not None:
            left = left.join(done.hint("merge"), ["a", "b"], "left_anti")
        left = stored(left, "unchecked")
        if left.isEmpty():
            break
        chosen = left.select("a", "b")
        if turn < ROUNDS:
            best = F.max_by(F.struct("a", "b"), F.struct("score", F.xxhash64("a", "b"))).alias("p")
            sides = left.select(F.col("a").alias("node"), "a", "b", "score").unionByName(left.select(F.col("b").alias("node"), "a", "b", "score"))
            chosen = sides.groupBy("node").agg(best).select("p.*").distinct()
        chosen = stored(chosen, "checked")
        sure = confirmed(chosen, whole, percent)
        links = stored(sure if links is None else links.unionByName(sure), "links")
        done = chosen if done is None else done.unionByName(chosen)
        roots = rooted(nodes, links)
    return links, roots


def clusters(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root, cluster): texts that share long lists with others of another root, as many lists as it takes; stored.

    Pairs of such a list are not all candidates yet, so any two texts of a cluster that are not connected are still to be compared.
    """
    own = entries.join(roots.hint("merge"), "node")
    lists = own.groupBy("v").agg(F.count(F.lit(1)).alias("_rows"), F.min("root").alias("_low"), F.max("root").alias("_high"), F.min("node").alias("_hub"))
    mixed = lists.filter((F.col("_rows") > SHORT) & (F.col("_low") < F.col("_high"))).select("v", "_rows", "_hub")
    spokes = join_aggregate(own, mixed, ["v"], "_rows", "inner", "mixed-lists").select(F.col("node").alias("a"), F.col("_hub").alias("b"))
    found = components(spokes, "clusters").withColumnRenamed("root", "cluster")
    return stored(found.join(roots.hint("merge"), "node"), "clustered")


def shared_with(rows: np.ndarray, values: np.ndarray, sought: np.ndarray, size: int) -> np.ndarray:
    """How many of ``sought`` each of ``size`` rows holds, whose values are sorted in one array next to their row."""
    low, high = np.searchsorted(values, sought, "left"), np.searchsorted(values, sought, "right")
    lengths = high - low
    at = np.repeat(low - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
    return np.bincount(rows[at], minlength=size)


def remaining_links(clustered: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between texts of a cluster that are not connected, one for each two roots that a task joins.

    Clusters are dealt into tiles of whole sets, members of the largest root in tiles of their own. Two tiles meet in a task unless
    both are of that root; a pair is compared once, by its sets, and only links leave the task.
    """
    parts = clustered.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("_c"))
    facts = parts.groupBy("cluster").agg(F.sum("_c").alias("_m"), F.max("_c").alias("_most"), F.max_by("root", F.struct("_c", "root")).alias("_main"))
    facts = facts.select("cluster", "_main", F.ceil(F.col("_most") / TILE).alias("_big"), F.ceil((F.col("_m") - F.col("_most")) / TILE).alias("_small"))
    dealt = clustered.join(stored(facts, "cluster-facts").hint("merge"), "cluster")
    # Tiles of the largest root are numbered below zero.
    tile = F.when(F.col("root") == F.col("_main"), -1 - F.pmod(F.xxhash64("node"), F.col("_big"))).otherwise(F.pmod(F.xxhash64("node"), F.col("_small")))
    others = F.when(F.col("tile") < 0, F.sequence(F.lit(0).cast("long"), F.col("_small") - 1)).otherwise(F.sequence(-F.col("_big"), F.col("_small") - 1))
    met = dealt.withColumn("tile", tile).withColumn("_other", F.explode(others)).select(
        "cluster", F.least("tile", "_other").alias("one"), F.greatest("tile", "_other").alias("two"), "tile", "node", "root")
    rows = met.join(whole.hint("merge"), "node")

    def run(table: pa.Table) -> pa.Table:
        first, second = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        tile, node, root = (table.column(c).to_numpy() for c in ("tile", "node", "root"))
        sets = [table.column("hashes")[k].values.to_numpy() for k in range(table.num_rows)]
        sizes = np.array([len(x) for x in sets])
        right = np.flatnonzero(tile == second)
        values, owner = np.concatenate([sets[j] for j in right]), np.repeat(np.arange(len(right)), sizes[right])
        order = np.argsort(values)
        values, owner = values[order], owner[order]
        out, joined = [], set()
        for i in np.flatnonzero(tile == first):
            shared = shared_with(owner, values, sets[i], len(right))
            near = (root[right] != root[i]) & (100 * shared >= percent * (sizes[right] + sizes[i] - shared))
            for j in right[near]:
                pair = (min(root[i], root[j]), max(root[i], root[j]))
                if pair not in joined:
                    joined.add(pair)
                    out.append((node[i], node[j]))
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("cluster", "one", "two").applyInArrow(run, "a long, b long")


def groups(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text", keep: int = KEEP
) -> DataFrame:
    """(key, n_shingles, component_id, kept): each document's class under links of at least ``percent`` likeness of shingle sets.

    A-Z are lower-cased, words are runs of anything but ASCII white space, a set holds each shingle of ``words`` words once; a text of fewer
    words is one shingle, a null or empty one, or one of white space, has none and is linked with nothing. The class id is the least key
    that is reachable; ``kept`` says that it is the row's own. Equal sets are one set from the start, so copies cost one row each.
    Rows with a null key are linked like others; a class of null keys alone has a null id. Repeated rows are rows like any other; an
    empty table gives no rows; other columns are not read. Links are exact; a pair of large sets just at the limit is missed with a chance
    of about CHANCE.
    """
    rows = sketches(docs, words, keep, key, text)
    found = rows.filter("n > 0").groupBy("set").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min("_key").alias("_key"), F.count(F.lit(1)).alias("_rows"))
    # Numbered once and stored: the number would differ in another run of the same plan.
    distinct = stored(found.select(F.monotonically_increasing_id().alias("node"), "*"), "distinct-sets")
    entries = stored(prefixes(distinct, keep, percent), "inverted-lists")
    pairs = stored(first_pairs(entries, percent), "pairs")
    candidates = stored(likely(pairs, distinct, keep, percent), "candidates")
    nodes = stored(entries.select("node").distinct(), "listed-sets")
    either = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    whole = whole_sets(docs, either, distinct, words, key, text)
    links, roots = linked(candidates, None, nodes, whole, percent)
    clustered = clusters(entries, roots)
    if not clustered.isEmpty():
        others = clustered.select("node").join(whole.select("node").hint("merge"), "node", "left_anti")
        whole = whole.unionByName(whole_sets(docs, others, distinct, words, key, text))
        more = stored(remaining_links(clustered, whole, percent), "more-links")
        roots = rooted(nodes, more if links is None else links.unionByName(more))
    of_set = distinct.select("node", "set", "_key", "_rows").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    of_set = stored(of_set, "rooted-sets")
    least = of_set.groupBy("root").agg(F.min("_key").alias("component_id"))
    by_set = of_set.join(least.hint("merge"), "root").select("set", "component_id", "_rows")
    filled = join_aggregate(rows.filter("n > 0").select("_key", "n", "set"), by_set, ["set"], "_rows", "inner", "classes")
    alone = rows.filter("n = 0").select("_key", "n", F.col("_key").alias("component_id"))
    return filled.select("_key", "n", "component_id").unionByName(alone).select(
        F.col("_key").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"))
