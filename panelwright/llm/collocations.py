"""Phrase collocations: word n-grams counted losslessly in sorted counting quotient filters that merge across shards."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from panelwright.operators.joins import join_aggregate, lookup
from panelwright.operators.labels import dense_numbers
from panelwright.session import stored

# Bytes of text that are coded under one local list of words.
CHUNK = 24 << 20
# Word numbers of a chunk that lie in one row, and words that are handed over at once: no row and no batch is as large as a chunk.
PART = 1 << 15
# Entries that a task sorts at once, and that a shard should end up with.
ROOM = 2_000_000
# Words that are looked up without moving their rows. Large lookups are split like that at every size, so that what
# is shuffled is in proportion to the input.
HOT = 1_000
# Shards that one pass splits entries into, as a power of two, and bits that a quotient has at least where there are so many.
FAN, QUOTIENT = 10, 24
ROUNDS = 4

_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 10 + b" abcdefghijklmnopqrstuvwxyz")


class _Codes(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _chunk(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, their counts, the texts as numbers of these words, from 2 on, with 0 between pieces and two more at the end)."""
    codes = _Codes({b"\n": 0, b"": 1})
    parts = []
    for text in texts:
        words = text.translate(_BREAKS).replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(codes.__getitem__, words), np.uint32, len(words))
        parts += [found[found != 1], np.zeros(1, np.uint32)]
    flat = np.concatenate([*parts, np.zeros(2, np.uint32)])
    counts = np.bincount(flat, minlength=len(codes))
    return pa.array(list(codes)[2:], pa.binary()).cast(pa.string()), counts[2:], flat


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text in parts of about CHUNK bytes, cut behind a sign that ends a piece."""
    start = 0
    while len(text) - start > CHUNK:
        cut = next((i for i in range(start + CHUNK, len(text)) if text[i] in b".,;:!?\n\x0b\x0c\r"), len(text) - 1) + 1
        yield text[start:cut]
        start = cut
    yield text[start:]


def chunks(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(_chunk, _lang, _word, _at, _n, _codes): texts of one language as numbers of their own words; stored.

    A chunk has a row for each of its words, with its number and its occurrences, and one without a word for every
    PART numbers of its texts, with the two numbers that follow them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size, number = 0, TaskContext.get().partitionId() << 33

        def rows(n: int, lang: str, word: pa.Array, at: pa.Array, count: pa.Array, codes: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.repeat(number, n), pa.repeat(lang, n), word, at, count, codes], names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            for name, texts in held.items():
                words, counts, flat = _chunk(texts)
                if not len(words):
                    continue
                for first in range(0, len(words), PART):
                    some = words[first : first + PART]
                    n = len(some)
                    yield rows(n, name, some, pa.array(np.arange(first + 2, first + 2 + n)), pa.array(counts[first : first + n], pa.int64()), pa.nulls(n, pa.binary()))
                for first in range(0, len(flat) - 2, PART):
                    codes = pa.array([flat[first : first + PART + 2].tobytes()], pa.binary())
                    yield rows(1, name, pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), codes)
                number += 1
            held.clear()

        for batch in batches:
            texts = batch.column(1)
            for k, name in enumerate(batch.column(0).to_pylist()):
                for part in _pieces(texts[k].as_py()):
                    held.setdefault(name, []).append(part)
                    size += len(part)
                    if size > CHUNK:
                        yield from flush()
                        size = 0
        yield from flush()

    names = ["_chunk", "_lang", "_word", "_at", "_n", "_codes"]
    schema = "_chunk long, _lang string, _word string, _at long, _n long, _codes binary"
    read = docs.select(F.coalesce(F.col(lang), F.lit("und")), F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return stored(read.mapInArrow(run, schema), "chunks")


# ---- the filter: n-grams as permuted numbers, sorted, each with its whole remainder and its count


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _round(x: np.ndarray, number: int, mask: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(0x9E3779B97F4A7C15 * (number + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0x94D049BB133111EB) >> np.uint64(7)) & mask


class Layout:
    """How n-grams of up to three word numbers of ``bits`` bits (even, so that halves are whole) become quotient and remainder.

    The packed number is permuted by a Feistel network, so that every n-gram has a number of its own and the numbers
    are spread evenly. Its top bits are the quotient, all others the remainder: nothing is lost.
    """

    def __init__(self, bits: int, quotient: int = QUOTIENT) -> None:
        self.bits = bits + bits % 2
        self.half = 3 * self.bits // 2
        self.quotient = min(self.half, max(quotient, 2 * self.half - 64))
        self.rest = 2 * self.half - self.quotient
        self.width = -(-self.rest // 8)

    def split(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(quotients, remainders) of rows of three word numbers."""
        b, h, mask = np.uint64(self.bits), np.uint64(self.half), _mask(self.half)
        first, second, third = grams.T.astype(np.uint64)
        half = b // np.uint64(2)
        left = first << half | second >> half
        right = (second & _mask(self.bits // 2)) << b | third
        for k in range(ROUNDS):
            left, right = right, left ^ _round(right, k, mask)
        low = h - np.uint64(self.quotient)
        return left >> low, (left & _mask(self.half - self.quotient)) << h | right

    def join(self, quotients: np.ndarray, rests: np.ndarray) -> np.ndarray:
        """The rows of word numbers behind quotients and remainders."""
        b, h, mask = np.uint64(self.bits), np.uint64(self.half), _mask(self.half)
        left = quotients << (h - np.uint64(self.quotient)) | rests >> h
        right = rests & mask
        for k in reversed(range(ROUNDS)):
            left, right = right ^ _round(left, k, mask), left
        half = b // np.uint64(2)
        second = (left & _mask(self.bits // 2)) << half | right >> b
        return np.stack([left >> half, second, right & _mask(self.bits)], axis=1).astype(np.int64)

    def merged(self, quotients: np.ndarray, rests: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same entries in order, equal ones as one with the sum of their counts."""
        if not len(counts):
            return quotients, rests, counts
        if self.quotient + self.rest <= 64:
            # One number instead of two, so that less lies there while all are put in order.
            keys = quotients << np.uint64(self.rest) | rests
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            del order
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            keys = keys[first]
            return keys >> np.uint64(self.rest), keys & _mask(self.rest), np.add.reduceat(counts, first)
        order = np.lexsort((rests, quotients))
        quotients, rests, counts = quotients[order], rests[order], counts[order]
        first = np.flatnonzero(np.append(True, (quotients[1:] != quotients[:-1]) | (rests[1:] != rests[:-1])))
        return quotients[first], rests[first], np.add.reduceat(counts, first)

    def packed(self, quotients: np.ndarray, rests: np.ndarray, counts: np.ndarray) -> bytes:
        """A sorted filter as bytes: steps between quotients, counts, remainders."""
        steps = np.diff(quotients, prepend=np.uint64(0))
        wide = rests.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.width]
        return _small(steps) + _small(counts.astype(np.uint64)) + wide.tobytes()

    def unpacked(self, data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        steps, at = _unsmall(data, n, 0)
        counts, at = _unsmall(data, n, at)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, : self.width] = np.frombuffer(data, np.uint8, n * self.width, at).reshape(n, self.width)
        return np.cumsum(steps, dtype=np.uint64), wide.view("<u8").ravel(), counts.astype(np.int64)


def _small(values: np.ndarray) -> bytes:
    """Numbers as a byte each; those of 255 and more follow in full."""
    return np.minimum(values, 255).astype(np.uint8).tobytes() + values[values >= 255].astype("<u8").tobytes()


def _unsmall(data: bytes, n: int, at: int) -> tuple[np.ndarray, int]:
    values = np.frombuffer(data, np.uint8, n, at).astype(np.uint64)
    large = np.flatnonzero(values == 255)
    values[large] = np.frombuffer(data, "<u8", len(large), at + n)
    return values, at + n + 8 * len(large)


class _Room:
    """Entries that are merged whenever they take up twice the room of what is left of them."""

    def __init__(self, layout: Layout) -> None:
        self.layout, self.parts, self.size, self.limit = layout, [], 0, ROOM

    def add(self, quotients: np.ndarray, rests: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((quotients, rests, counts))
        self.size += len(counts)
        if self.size > self.limit:
            self.limit = max(ROOM, 2 * len(self.settle()[2]))

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.parts:
            columns = [list(x) for x in zip(*self.parts, strict=True)]
            self.parts = []
            # Each column's parts go as soon as they are one.
            whole = self.layout.merged(*[np.concatenate(columns.pop(0)) for _ in range(3)])
            self.parts, self.size = [whole], len(whole[2])
            return whole
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def filters(self, bits: int) -> Iterator[pa.RecordBatch]:
        """(shard, n, data) of what is held, split by the top ``bits`` of the quotients; the room is then empty."""
        quotients, rests, counts = self.settle()
        self.parts, self.size, self.limit = [], 0, ROOM
        shards = quotients >> np.uint64(self.layout.quotient - bits)
        firsts = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])) if len(shards) else []
        for a, b in zip(firsts, [*firsts[1:], len(shards)], strict=False):
            data = self.layout.packed(quotients[a:b], rests[a:b], counts[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shards[a])], pa.int64()), pa.array([int(b - a)], pa.int64()), pa.array([data], pa.binary())], ["shard", "n", "data"])


FILTERS = "shard long, n long, data binary"


def _names(listed: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The number of every word of a chunk by its place there; 0 where it has none."""
    at, ids = (np.concatenate(x) for x in zip((np.zeros(1, np.int64),) * 2, *listed, strict=True))
    names = np.zeros(int(at.max()) + 1, np.int64)
    names[at] = ids
    return names


def _grams(codes: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The pairs and triples of words that start at all ``codes`` but the last two; words without a name are breaks."""
    found = names[np.where(codes < len(names), codes, 0)]
    one, two, three = found[:-2], found[1:-1], found[2:]
    pairs = (one > 0) & (two > 0)
    triples = pairs & (three > 0)
    return np.concatenate([
        np.stack([one[pairs], two[pairs], np.zeros(pairs.sum(), np.int64)], axis=1),
        np.stack([one[triples], two[triples], three[triples]], axis=1),
    ])


def filters(known: DataFrame, layout: Layout, bits: int) -> DataFrame:
    """(shard, n, data) of all pairs and triples of neighbouring words in rows (_chunk, _at, id, _codes).

    Rows of a chunk say which number a word has (_at, id) or hold a part of its texts (_codes); words without a number count as breaks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, held, listed, names = _Room(layout), None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            chunk, at, ids = (batch.column(c).fill_null(0).to_numpy() for c in range(3))
            texts = batch.column(3)
            is_text = texts.is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.append(True, (chunk[1:] != chunk[:-1]) | (is_text[1:] != is_text[:-1])))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(chunk)], strict=True):
                if chunk[a] != held:
                    held, listed, names = chunk[a], [], None
                if not is_text[a]:
                    listed.append((at[a:b], ids[a:b]))
                    continue
                if names is None:
                    names = _names(listed)
                for k in range(a, b):
                    grams = _grams(np.frombuffer(texts[k].as_buffer(), np.uint32), names)
                    room.add(*layout.merged(*layout.split(grams), np.ones(len(grams), np.int64)))
                    if room.size > ROOM:
                        yield from room.filters(bits)
        yield from room.filters(bits)

    # The words of a chunk come before its texts.
    together = known.repartition("_chunk").sortWithinPartitions("_chunk", F.col("_codes").isNotNull())
    return together.select("_chunk", "_at", "id", "_codes").mapInArrow(run, FILTERS)


def finer(sharded: DataFrame, layout: Layout, bits: int) -> DataFrame:
    """The same filters with ``bits`` bits of shard: neighbours are merged in groups of bounded size, then split further."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, held = _Room(layout), None
        for batch in batches:
            for shard, n, data in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                if held is not None and (shard != held or room.size > ROOM):
                    yield from room.filters(bits)
                room.add(*layout.unpacked(data, n))
                held = shard
        yield from room.filters(bits)

    salt = F.pmod(F.xxhash64("data"), F.lit(64))
    return sharded.repartition("shard", salt).sortWithinPartitions("shard").mapInArrow(run, FILTERS)


def frequent(sharded: DataFrame, layout: Layout, least: int) -> DataFrame:
    """(i, j, k, a): n-grams that all filters together count at least ``least`` times; k is 0 for pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(room: _Room) -> pa.RecordBatch:
            quotients, rests, counts = room.settle()
            often = counts >= least
            grams = layout.join(quotients[often], rests[often])
            return pa.RecordBatch.from_arrays([*[pa.array(grams[:, c]) for c in range(3)], pa.array(counts[often])], ["i", "j", "k", "a"])

        room, held = _Room(layout), None
        for batch in batches:
            for shard, n, data in zip(*[batch.column(c).to_pylist() for c in range(3)], strict=True):
                if held is not None and shard != held:
                    yield settled(room)
                    room = _Room(layout)
                room.add(*layout.unpacked(data, n))
                held = shard
        yield settled(room)

    return sharded.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "i long, j long, k long, a long")


def words_and_phrases(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (lang, n), (id, lang, word, f) of words with at least ``least`` occurrences, and (i, j, k, a) of such phrases."""
    coded = chunks(docs, text, lang)
    listed = coded.filter(F.col("_word").isNotNull()).select("_chunk", F.col("_lang").alias("lang"), F.col("_word").alias("word"), "_at", "_n")
    sizes = stored(listed.groupBy("lang").agg(F.sum("_n").alias("n")), "languages")
    counts = listed.groupBy("lang", "word").agg(F.sum("_n").alias("f"), F.count(F.lit(1)).alias("_chunks")).filter(F.col("f") >= least)
    # Numbers count from 1, so that 0 can stand for no word.
    words = stored(dense_numbers(counts, ["lang", "word"], "place", "words").withColumn("id", F.col("place") + 1).drop("place"), "word-ids")
    total, tokens = words.count(), sizes.agg(F.sum("n")).first()[0] or 0
    layout = Layout(max(2, total.bit_length()))
    bits = min(layout.quotient, max(0, math.ceil(math.log2(max(1, 2 * tokens / ROOM)))))

    # Each chunk learns the numbers of its own words only, so no task needs the whole list.
    named = join_aggregate(
        listed.drop("_n"), words.select("lang", "word", "id", "_chunks"), ["lang", "word"], "_chunks", "inner", "named-words", broadcast_rows=0, hot_keys=HOT)
    none = F.lit(None).cast("long")
    texts = coded.filter(F.col("_word").isNull()).select("_chunk", none.alias("_at"), none.alias("id"), "_codes")
    known = named.select("_chunk", "_at", "id", F.lit(None).cast("binary").alias("_codes")).unionByName(texts)
    step = min(bits, FAN)
    sharded = filters(known, layout, step)
    while step < bits:
        step = min(bits, step + FAN)
        sharded = finer(stored(sharded, "filters"), layout, step)
    return sizes, words.drop("_chunks"), stored(frequent(sharded, layout, least), "phrases")


def _score(left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)); exact, as products are decimals of 38 digits."""
    a, left, right = (f"CAST({x} AS DECIMAL(15,0))" for x in ("a", left, right))
    return F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * ({a} * {a})) DIV ({left} * {right})")


def mine(
    docs: DataFrame, least: int = 10, inside: int = 50, most: int = 2000, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of two or three words of each language.

    A-Z are lower-cased, pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. A phrase occurs ``a >= least`` times
    within pieces; its score is that of its worst cut into a left and a right part. A pair is left out when a
    triple that contains it holds at least ``inside`` percent of its occurrences. Null texts are empty, a null
    language is ``und``; repeated rows count as often as they occur; an empty table gives no rows; other columns,
    whatever their names, are not read.
    """
    sizes, words, phrases = words_and_phrases(docs, least, text, lang)
    named = phrases
    for column, extra in (("i", ["lang"]), ("j", []), ("k", [])):
        facts = words.select(F.col("id").alias("_id"), F.col("f").alias(f"f_{column}"), *extra)
        # Stored each time, as a split lookup has three branches, which would multiply.
        named = stored(lookup(named, facts, {column: "_id"}, f"counts-{column}"), f"with-{column}")
    pairs, triples = phrases.filter("k = 0"), phrases.filter("k > 0")
    for first, second in ("ij", "jk"):
        facts = pairs.select(F.col("i").alias("_i"), F.col("j").alias("_j"), F.col("a").alias(f"f_{first}{second}"))
        named = stored(lookup(named, facts, {first: "_i", second: "_j"}, "pairs", broadcast_rows=0), f"with-{first}{second}")
    around = triples.select("i", "j", "a").union(triples.select("j", "k", "a")).groupBy(F.col("i").alias("_i"), F.col("j").alias("_j")).agg(F.max("a").alias("_longest"))
    named = stored(lookup(named, around, {"i": "_i", "j": "_j"}, "longer", broadcast_rows=0), "named-phrases")
    kept = named.filter((F.col("k") > 0) | F.col("_longest").isNull() | (100 * F.col("_longest") < inside * F.col("a")))

    def cut(left: str, right: str) -> Column:
        return F.struct(_score(left, right).alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))

    one, two = cut("f_i", "f_jk"), cut("f_ij", "f_k")
    lowest = F.when(F.col("k") == 0, cut("f_i", "f_j")).when(two["score"] < one["score"], two).otherwise(one)
    scored = kept.select("lang", "a", "i", "j", "k", lowest.alias("_cut")).select("lang", "a", "i", "j", "k", "_cut.*")
    # Only phrases that can be among the best need their words; ties stay until those tell them apart.
    counted = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    top = stored(scored.withColumn("_place", F.rank().over(counted)).filter(F.col("_place") <= most).drop("_place"), "best-phrases")
    for column in "ijk":
        top = stored(lookup(top, words.select(F.col("id").alias("_id"), F.col("word").alias(f"word_{column}")), {column: "_id"}, "words"), "worded")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = top.withColumn("phrase", F.concat_ws(" ", "word_i", "word_j", "word_k")).withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= most)
    found = lookup(top, sizes.withColumnRenamed("lang", "_lang"), {"lang": "_lang"}, "sizes")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
