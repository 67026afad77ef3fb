import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import collocations
from panelwright.llm.collocations import Layout


@pytest.mark.parametrize("bits", [2, 7, 16, 20, 21, 32, 40])
def test_permutation_loses_nothing(bits):
    layout, random = Layout(bits), np.random.default_rng(bits)
    grams = random.integers(0, 1 << bits, (5000, 3))
    grams[:2] = [[0, 0, 0], [(1 << bits) - 1] * 3]
    quotients, rests = layout.split(grams)
    assert (layout.join(quotients, rests) == grams).all()
    assert int(quotients.max()) < 1 << layout.quotient
    counts = random.integers(1, 1000, 5000)
    merged = layout.merged(*(np.concatenate([x, x[:700]]) for x in (quotients, rests, counts)))
    wanted = Counter()
    for gram, n in zip([*map(tuple, grams.tolist()), *map(tuple, grams[:700].tolist())], [*counts.tolist(), *counts[:700].tolist()], strict=True):
        wanted[gram] += n
    again = layout.unpacked(layout.packed(*merged), len(merged[2]))
    assert all((a == b).all() for a, b in zip(merged, again, strict=True))
    assert dict(zip(map(tuple, layout.join(again[0], again[1]).tolist()), again[2].tolist(), strict=True)) == wanted


def test_filters_of_one_entry_and_none():
    layout = Layout(20)
    empty = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64))
    assert layout.packed(*layout.merged(*empty)) == b""
    assert len(layout.unpacked(b"", 0)[2]) == 0
    one = (*layout.split(np.array([[5, 6, 0]])), np.array([1 << 40]))
    assert layout.unpacked(layout.packed(*one), 1)[2].tolist() == [1 << 40]


def test_settling_a_room_takes_little_more_than_its_entries():
    layout, random, n = Layout(18), np.random.default_rng(3), 600_000
    room = collocations._Room(layout)
    for _ in range(10):
        grams = random.integers(1, 1 << 18, (n // 10, 3))
        room.add(*layout.split(grams), np.ones(len(grams), np.int64))
    tracemalloc.start()
    quotients, rests, counts = room.settle()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int(counts.sum()) == n and room.size == len(quotients) == len(rests)
    # Besides the entries as they come: 88 bytes each before columns and keys were freed in between.
    assert peak < 80 * n


def plainly(rows, least, inside, most):
    """Brute force over (text, lang) rows: {(lang, rank, phrase, a, l, r, n, score)}."""
    counts: dict[str, list[Counter]] = {}
    for text, lang in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        own = counts.setdefault("und" if lang is None else lang, [Counter(), Counter(), Counter(), Counter()])
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            for size in (1, 2, 3):
                own[size].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = set()
    for lang, (_, one, two, three) in counts.items():
        f = {1: one, 2: two, 3: three}
        scored = []
        for size in (2, 3):
            for words, a in f[size].items():
                if a < least:
                    continue
                if size == 2 and any(100 * b >= inside * a for t, b in three.items() if b >= least and words in (t[:2], t[1:])):
                    continue
                cuts = [(1_000_000 * a * a // (f[k][words[:k]] * f[size - k][words[k:]]), k) for k in range(1, size)]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(words).encode(), f[k][words[:k]], f[size - k][words[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sum(one.values()), -score))
    return out


def found(docs, **settings):
    return {tuple(r) for r in collocations.mine(docs, **settings).collect()}


def test_edge_rows(edge_docs, edge_rows):
    wanted = plainly([(r[1], r[2]) for r in edge_rows], 3, 50, 40)
    assert wanted and found(edge_docs, least=3, inside=50, most=40) == wanted


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = plainly([(r.text, r.lang) for r in docs.collect()], 5, 50, 300)
    assert found(docs, least=5, inside=50, most=300) == wanted


def test_many_shards_chunks_and_passes(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    whole = found(docs, least=4, inside=50, most=500)
    monkeypatch.setattr(collocations, "CHUNK", 20_000)
    monkeypatch.setattr(collocations, "ROOM", 900)
    monkeypatch.setattr(collocations, "FAN", 4)
    assert found(docs, least=4, inside=50, most=500) == whole


def test_long_text_is_cut_between_pieces(spark, monkeypatch):
    text = "the red house. " * 500 + "Red, house the red" + " \t" * 50
    docs = spark.createDataFrame([(text, None), (None, "en"), ("", "en")], "text string, lang string")
    monkeypatch.setattr(collocations, "CHUNK", 64)
    assert found(docs, least=10, inside=50, most=5) == plainly([(text, None)], 10, 50, 5)


def test_no_row_is_as_large_as_a_chunk(spark):
    text = " ".join(f"w{k * k % 5003} and" + "." * (k % 50 == 0) for k in range(100_000))
    docs = spark.createDataFrame([(text, "en")], "text string, lang string")
    rows = collocations.chunks(docs).filter("_codes IS NOT NULL").collect()
    assert max(len(r["_codes"]) for r in rows) < 200_000
    assert found(docs, least=10, inside=50, most=200) == plainly([(text, "en")], 10, 50, 200)


def test_phrases_across_rows_of_a_chunk(spark, monkeypatch):
    texts = [("the red house of the red king, the red house", "en"), ("a red house", None), (None, "en"), ("x", "de"), ("the red house of the", "en")] * 4
    docs = spark.createDataFrame(texts, "text string, lang string").coalesce(1)
    monkeypatch.setattr(collocations, "PART", 2)
    assert found(docs, least=3, inside=50, most=40) == plainly(texts, 3, 50, 40)


def test_empty_table(no_docs):
    assert collocations.mine(no_docs).collect() == []


def test_hot_language_and_word(spark):
    docs = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, "en").otherwise(F.concat(F.lit("l"), F.col("id") % 5)).alias("lang"),
        F.concat(F.lit("the common words of "), (F.col("id") % 7).cast("string"), F.lit(" and the common end")).alias("text"))
    wanted = plainly([(r.text, r.lang) for r in docs.collect()], 10, 50, 20)
    assert found(docs, least=10, inside=50, most=20) == wanted
