"""Audit of how sources of a language differ in their words, recounted by minimal acyclic transducers of the kept terms."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from panelwright.operators.joins import lookup
from panelwright.operators.labels import dense_numbers
from panelwright.session import MOST_PARTS, stored

# Terms of one transducer; bytes of transducers that tasks hold in one pass over the texts.
TERMS, WAVE = 200_000, 64 << 20
# Bytes of text that are walked at once, and counts that a task holds before it passes them on.
BUFFER, HELD = 4 << 20, 1_000_000
# Sources and terms of a block whose differences are summed in one piece.
TILE, BLOCK = 128, 4_096
UNIT, PRIOR = 1_000_000_000, 5

_LETTERS = bytes((b | 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_CODES = np.frombuffer(_LETTERS, np.uint8)


class Transducer:
    """A minimal acyclic automaton of sorted terms whose transitions carry how many terms they pass by.

    The sum along a term's path is its place in byte order. A state's transitions lie next to each other,
    by byte; four words of 64 bits say which bytes it has, so that the transition is found by counting bits.
    """

    def __init__(self, bits: np.ndarray, before: np.ndarray, targets: np.ndarray, steps: np.ndarray, finals: np.ndarray) -> None:
        self.bits, self.before, self.targets, self.steps, self.finals = bits, before, targets, steps, finals

    @classmethod
    def build(cls, terms: list[bytes]) -> Transducer:
        """From different terms in byte order: what a term shares with the one before is open, the rest is settled.

        Settled states are looked up by what they are, (final, transitions), so that equal ones are one. State 0 is the first.
        """
        known: dict[tuple, int] = {}
        states: list[tuple] = []
        sizes: list[int] = []

        def settle(final: bool, arcs: list) -> int:
            state = (final, tuple(arcs))
            number = known.get(state)
            if number is None:
                number = known[state] = len(states)
                states.append(state)
                sizes.append(final + sum(sizes[t] for _, t in arcs))
            return number

        # Open states along the last term: [final, transitions, byte that leads to the next].
        path: list[list] = [[False, [], None]]
        last = b""
        for term in terms:
            shared = 0
            for a, b in zip(last, term):
                if a != b:
                    break
                shared += 1
            while len(path) > shared + 1:
                final, arcs, _ = path.pop()
                path[-1][1].append((path[-1][2], settle(final, arcs)))
            for byte in term[shared:]:
                path[-1][2] = byte
                path.append([False, [], None])
            path[-1][0] = True
            last = term
        while len(path) > 1:
            final, arcs, _ = path.pop()
            path[-1][1].append((path[-1][2], settle(final, arcs)))
        settle(path[0][0], path[0][1])

        # No other state has terms as long as the first one's, so it is the last settled: numbered backwards it is 0.
        top = len(states) - 1
        bits, before = np.zeros((len(states), 4), np.uint64), np.zeros((len(states), 4), np.int64)
        finals = np.zeros(len(states), bool)
        targets, steps = [], []
        for k, (final, arcs) in enumerate(reversed(states)):
            finals[k], passed = final, int(final)
            words = [0, 0, 0, 0]
            starts = [len(targets)] * 4
            for byte, target in arcs:
                words[byte >> 6] |= 1 << (byte & 63)
                for w in range((byte >> 6) + 1, 4):
                    starts[w] += 1
                targets.append(top - target)
                steps.append(passed)
                passed += sizes[target]
            bits[k], before[k] = words, starts
        return cls(bits.ravel(), before.ravel(), np.array(targets, np.int32), np.array(steps, np.int64), finals)

    def packed(self) -> bytes:
        parts = (self.bits, self.before.astype(np.int32), self.targets, self.steps.astype(np.int32), self.finals)
        sizes = np.array([len(self.finals), len(self.targets)], np.int64)
        return b"".join(x.tobytes() for x in (sizes, *parts))

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        states, arcs = np.frombuffer(data, np.int64, 2).tolist()
        out, at = [], 16
        for kind, n in ((np.uint64, 4 * states), (np.int32, 4 * states), (np.int32, arcs), (np.int32, arcs), (np.bool_, states)):
            out.append(np.frombuffer(data, kind, n, at))
            at += out[-1].nbytes
        return cls(*out)

    def places(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The place of each string data[start : start + size], -1 for one that is no term; all walk a byte at a time."""
        found = np.full(len(starts), -1, np.int64)
        open_, state, passed = np.arange(len(starts)), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        one, depth = np.uint64(1), 0
        while len(open_):
            ended = sizes[open_] == depth
            if ended.any():
                done = ended & self.finals[state]
                found[open_[done]] = passed[done]
                open_, state, passed = open_[~ended], state[~ended], passed[~ended]
            byte = data[starts[open_] + depth]
            word = 4 * state + (byte >> 6)
            bits, bit = self.bits[word], one << (byte & np.uint8(63)).astype(np.uint64)
            has = (bits & bit) != 0
            arc = (self.before[word] + np.bitwise_count(bits & (bit - one)))[has]
            open_, state, passed = open_[has], self.targets[arc].astype(np.int64), passed[has] + self.steps[arc]
            depth += 1
        return found

    def term(self, place: int) -> bytes:
        """The term of a place."""
        state, out = 0, bytearray()
        while place or not self.finals[state]:
            bytes_ = [b for b in range(256) if int(self.bits[4 * state + (b >> 6)]) >> (b & 63) & 1]
            first = int(self.before[4 * state])
            # The last transition that passes no more terms than are left.
            k = int(np.searchsorted(self.steps[first : first + len(bytes_)], place, side="right")) - 1
            out.append(bytes_[k])
            place -= int(self.steps[first + k])
            state = int(self.targets[first + k])
        return bytes(out)


def _read(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    none = F.lit("")
    return docs.select(
        F.coalesce(F.col(lang), none).alias("lang"), F.coalesce(F.col(source), none).alias("source"), F.coalesce(F.col(text), none).cast("binary").alias("data"))


def kept_terms(read: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms that at least ``least`` documents of a language hold; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, bytes]] = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(held)
            columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", "term", "n"])

        for batch in batches:
            for k, name in enumerate(batch.column(0).to_pylist()):
                held.update((name, t) for t in set(batch.column(1)[k].as_py().translate(_LETTERS).split()))
                if len(held) > HELD:
                    yield flush()
        yield flush()

    counted = read.select("lang", "data").mapInArrow(run, "lang string, term binary, n long")
    return stored(counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("lang", "term"), "kept-terms")


def transducers(terms: DataFrame) -> DataFrame:
    """(lang, first, n, data): transducers of up to TERMS neighbouring terms each, built where ranges of sorted terms lie; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def built() -> pa.RecordBatch:
            data = Transducer.build(held).packed()
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([held[0]], pa.binary()), pa.array([len(held)], pa.int64()), pa.array([data], pa.binary())], ["lang", "first", "n", "data"])

        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (lang != name or len(held) == TERMS):
                    yield built()
                    held.clear()
                name = lang
                held.append(term)
        if held:
            yield built()

    ranges = min(MOST_PARTS, max(1, math.ceil(terms.count() / TERMS)))
    ordered = terms.repartitionByRange(ranges, "lang", "term").sortWithinPartitions("lang", "term")
    return stored(ordered.mapInArrow(run, "lang string, first binary, n long, data binary"), "transducers")


# A transducer's language, first term, first place and number of terms.
Part = tuple[str, bytes, int, int]


def waves(built: DataFrame) -> list[list[Part]]:
    """All transducers, as many at a time as WAVE bytes hold; a short row of each comes to the driver."""
    rows = built.select("lang", "first", "n", F.length("data").alias("size")).collect()
    out: list[list[Part]] = []
    size, passed = 0, Counter()
    for row in sorted(rows, key=lambda r: (r["lang"], bytes(r["first"]))):
        if not out or size + row["size"] > WAVE:
            out.append([])
            size = 0
        out[-1].append((row["lang"], bytes(row["first"]), passed[row["lang"]], row["n"]))
        size += row["size"]
        passed[row["lang"]] += row["n"]
    return out


def _sent(built: DataFrame, wave: list[Part]):
    """{lang: [(first place, transducer)]} of one wave, broadcast: WAVE bytes, or one transducer."""
    spark = built.sparkSession
    names = spark.createDataFrame([(p[0], bytearray(p[1])) for p in wave], "lang string, first binary")
    data = {(r["lang"], bytes(r["first"])): bytes(r["data"]) for r in built.join(F.broadcast(names), ["lang", "first"]).collect()}
    out: dict[str, list[tuple[int, bytes]]] = {}
    for lang, first, at, _ in wave:
        out.setdefault(lang, []).append((at, data[lang, first]))
    return spark.sparkContext.broadcast(out)


def recount(read: DataFrame, built: DataFrame, wave: list[Part]) -> DataFrame:
    """(lang, source, place, n): occurrences of a wave's terms, found by walking the texts through its transducers."""
    sent = _sent(built, wave)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = {lang: [(at, Transducer.unpacked(data)) for at, data in parts] for lang, parts in sent.value.items()}
        groups: dict[tuple[str, str], int] = {}
        buffers: dict[str, list[tuple[int, bytes]]] = {}
        totals: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = held = 0

        def walk(lang: str, texts: list[tuple[int, bytes]]) -> None:
            data = _CODES[np.frombuffer(b" ".join([b"", *[t for _, t in texts], b""]), np.uint8)]
            inside = data != 32
            edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            starts, sizes = edges[::2], edges[1::2] - edges[::2]
            ends = np.cumsum([1 + len(t) for _, t in texts])
            group = np.array([g for g, _ in texts])[np.searchsorted(ends, starts, side="left")]
            for at, machine in machines[lang]:
                places = machine.places(data, starts, sizes)
                hit = places >= 0
                totals.append(summed(group[hit], places[hit] + at, np.ones(int(hit.sum()), np.int64)))
                starts, sizes, group = starts[~hit], sizes[~hit], group[~hit]

        def summed(group: np.ndarray, place: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            order = np.lexsort((place, group))
            group, place, n = group[order], place[order], n[order]
            first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (place[1:] != place[:-1]))) if len(n) else np.zeros(0, np.int64)
            return group[first], place[first], np.add.reduceat(n, first) if len(n) else n

        def flush() -> pa.RecordBatch:
            whole = summed(*[np.concatenate(x) for x in zip(*totals, strict=True)]) if totals else (np.zeros(0, np.int64),) * 3
            names = list(groups)
            columns = [pa.array([n[c] for n in names], pa.string()).take(pa.array(whole[0])) for c in (0, 1)]
            totals.clear()
            groups.clear()
            return pa.RecordBatch.from_arrays([*columns, pa.array(whole[1]), pa.array(whole[2])], ["lang", "source", "place", "n"])

        for batch in batches:
            for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if key[0] in machines:
                    text = batch.column(2)[k].as_py()
                    buffers.setdefault(key[0], []).append((groups.setdefault(key, len(groups)), text))
                    size += len(text)
                if size > BUFFER:
                    for lang, texts in buffers.items():
                        walk(lang, texts)
                    buffers.clear()
                    size, held = 0, sum(len(t[2]) for t in totals)
                    if held > HELD:
                        yield flush()
        for lang, texts in buffers.items():
            walk(lang, texts)
        yield flush()

    return read.mapInArrow(run, "lang string, source string, place long, n long")


def decoded(rows: DataFrame, built: DataFrame, wave: list[Part]) -> DataFrame:
    """Rows (lang, place, ...) of a wave's terms with the ``term`` of their place."""
    sent = _sent(built, wave)
    schema = rows.select("*", F.lit("").alias("term")).schema
    at, name = rows.columns.index("place"), rows.columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machines = {lang: [(first, Transducer.unpacked(data)) for first, data in parts] for lang, parts in sent.value.items()}
        ends = {lang: [a for a, _ in parts[1:]] for lang, parts in machines.items()}
        for batch in batches:
            terms = []
            for lang, place in zip(batch.column(name).to_pylist(), batch.column(at).to_pylist(), strict=True):
                first, machine = machines[lang][int(np.searchsorted(ends[lang], place, side="right"))]
                terms.append(machine.term(place - first).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(terms, pa.string())], schema.names)

    ranges = {lang: (min(p[2] for p in wave if p[0] == lang), max(p[2] + p[3] for p in wave if p[0] == lang)) for lang in {p[0] for p in wave}}
    inside = F.lit(False)
    for lang, (low, high) in ranges.items():
        inside = inside | (F.col("lang") == lang) & (F.col("place") >= low) & (F.col("place") < high)
    return rows.filter(inside).mapInArrow(run, schema)


def _share(n: str, whole: str, terms: str) -> Column:
    """1 + floor(UNIT (n + PRIOR) / (whole + PRIOR terms)), exactly; null where there is no term."""
    top = f"CAST({n} + {PRIOR} AS DECIMAL(20,0)) * CAST({UNIT} AS DECIMAL(10,0))"
    return F.expr(f"CASE WHEN {terms} > 0 THEN 1 + ({top}) DIV CAST({whole} + {PRIOR} * {terms} AS DECIMAL(20,0)) END")


def pair_sums(entries: DataFrame, roster: DataFrame) -> DataFrame:
    """(a, b, value): sums over all terms of the differences between any two sources of a language.

    ``entries`` is (sid, place, p) of the terms that a source holds, ``roster`` (sid, lang, at, sources, terms, p0) of all sources, at
    their place within the language. Sources are tiled and terms are cut into blocks; a task has two tiles' shares of one block.
    """
    tiles = F.ceil(F.col("sources") / TILE)
    known = roster.select("sid", "lang", F.expr(f"at DIV {TILE}").alias("tile"), tiles.alias("tiles"), F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).alias("blocks"), "terms", "p0")
    of_terms = lookup(entries, known.select(F.col("sid").alias("_sid"), "lang", "tile", "tiles", "terms"), {"sid": "_sid"}, "tiles-of-entries").select(
        "lang", "tile", "tiles", "terms", F.expr(f"place DIV {BLOCK}").alias("block"), "sid", F.expr(f"place % {BLOCK}").alias("place"), "p")
    of_sources = known.select(
        "lang", "tile", "tiles", "terms", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "sid", F.lit(-1).cast("long").alias("place"), F.col("p0").alias("p"))
    rows = of_terms.unionByName(of_sources).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = rows.select(
        "lang", "block", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "tile", "terms", "sid", "place", "p")

    def run(table: pa.Table) -> pa.Table:
        tile, sid, place, p = (table.column(c).to_numpy() for c in ("tile", "sid", "place", "p"))
        block, one, two, terms = (table.column(c)[0].as_py() for c in ("block", "one", "two", "terms"))
        width = max(0, min(BLOCK, terms - block * BLOCK))
        matrices = []
        for t in sorted({one, two}):
            own = tile == t
            listed = own & (place < 0)
            ids, base = sid[listed], p[listed]
            order = np.argsort(ids)
            ids, base = ids[order], base[order]
            shares = np.repeat(base.astype(np.int64)[:, None], width, axis=1) if width else np.zeros((len(ids), 0), np.int64)
            held = own & (place >= 0)
            shares[np.searchsorted(ids, sid[held]), place[held]] = p[held]
            matrices.append((ids, shares))
        (ids, left), (others, right) = matrices[0], matrices[-1]
        sums = np.array([np.abs(right - row).sum(axis=1) for row in left], np.int64).reshape(len(ids), len(others))
        a, b = np.repeat(ids, len(others)), np.tile(others, len(ids))
        a, b, value = (np.concatenate(x) for x in ((a, b), (b, a), (sums.ravel(), sums.ravel()))) if one != two else (a, b, sums.ravel())
        apart = a != b
        return pa.table({"a": pa.array(a[apart]), "b": pa.array(b[apart]), "value": pa.array(value[apart])})

    parts = dealt.groupBy("lang", "block", "one", "two").applyInArrow(run, "a long, b long, value long")
    return parts.groupBy("a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, least: int = 30, most: int = 50, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """(lang, source, part, item, value, rank): for every source of a language its distance to each other one, and the terms it overuses.

    Terms are runs of letters and of all that is not ASCII, A-Z lower-cased; a language keeps those that at least ``least`` of its documents
    hold. A kept term's share is 1 + floor(10^9 (n + 5) / (N + 5 V)) of its n occurrences. Part ``pair`` sums the differences of shares
    over all kept terms, part ``term`` has up to ``most`` terms whose share is above the language's. Ties go to the lesser item in byte
    order, which for terms is that of their places. Null texts, languages and sources are empty ones, also as groups; repeated rows
    count as often as they occur; an empty table gives no rows; other columns are not read. Each wave of transducers reads the texts once.
    """
    read = _read(docs, text, lang, source)
    terms = kept_terms(read, least)
    built = transducers(terms)
    passes = waves(built)
    groups = dense_numbers(read.select("lang", "source").distinct(), ["lang", "source"], "sid", "groups")
    empty = read.sparkSession.createDataFrame([], "lang string, source string, place long, n long")
    counts = empty
    for wave in passes:
        counts = counts.unionByName(stored(recount(read, built, wave).groupBy("lang", "source", "place").agg(F.sum("n").alias("n")), "recounted"))
    kept = terms.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("terms"))
    whole = counts.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(F.sum("n").alias("own"))
    of_lang = groups.groupBy(F.col("lang").alias("_lang")).agg(F.min("sid").alias("_first"), F.count(F.lit(1)).alias("sources"))
    roster = lookup(lookup(lookup(groups, of_lang, {"lang": "_lang"}, "sources"), kept, {"lang": "_lang"}, "terms"), whole, {"lang": "_lang", "source": "_source"}, "wholes")
    roster = stored(roster.na.fill(0, ["terms", "own"]).withColumn("at", F.col("sid") - F.col("_first")).withColumn("_none", F.lit(0)).withColumn(
        "p0", _share("_none", "own", "terms")).select("sid", "lang", "source", "at", "sources", "terms", "own", "p0"), "roster")

    facts = roster.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "sid", "terms", "own")
    entries = stored(lookup(counts, facts, {"lang": "_lang", "source": "_source"}, "facts").withColumn("p", _share("n", "own", "terms")), "shares")
    sums = pair_sums(entries.select("sid", "place", "p"), roster.drop("source", "own"))
    names = roster.select(F.col("sid").alias("_sid"), "lang", "source")
    named = lookup(lookup(sums, names, {"a": "_sid"}, "names-a"), names.select("_sid", F.col("source").alias("item")), {"b": "_sid"}, "names-b")
    group = Window.partitionBy("lang", "source")
    pairs = named.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item"))).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")

    of_lang = roster.groupBy(F.col("lang").alias("_lang")).agg(F.sum("own").alias("all"))
    overall = lookup(entries.groupBy("lang", "place").agg(F.sum("n").alias("n"), F.max("terms").alias("terms")), of_lang, {"lang": "_lang"}, "all")
    overall = overall.select(F.col("lang").alias("_lang"), F.col("place").alias("_place"), _share("n", "all", "terms").alias("q"))
    above = lookup(entries, overall, {"lang": "_lang", "place": "_place"}, "overall").filter(F.col("p") > F.col("q"))
    above = above.select("lang", "source", "place", (F.col("p") - F.col("q")).alias("value"))
    top = above.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "place"))).filter(F.col("rank") <= most)
    top, out = stored(top, "top-terms"), pairs
    for wave in passes:
        out = out.unionByName(decoded(top, built, wave).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))
    return out
