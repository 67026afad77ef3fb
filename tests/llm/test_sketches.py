import random

import numpy as np
import pytest

from panelwright.llm import sketches


def shingle_set(text, words):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    parts = [w for w in text.split(" ") if w]
    return frozenset(tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))) if parts else frozenset()


def plainly(rows, words, percent):
    """Brute force over (key, text) rows: {(key, n, component)} as a sorted list."""
    sets = [shingle_set(t, words) for _, t in rows]
    different = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    root = list(range(len(different)))

    def top(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(len(different)):
        for b in range(a):
            small, large = sorted((len(different[a]), len(different[b])))
            if 100 * small >= percent * large:
                shared = len(different[a] & different[b])
                if 100 * shared >= percent * (small + large - shared):
                    root[top(a)] = top(b)
    place = {s: k for k, s in enumerate(different)}
    least = {}
    for (key, _), s in zip(rows, sets, strict=True):
        if s and key is not None:
            r = top(place[s])
            least[r] = min(least.get(r, key), key)
    return sorted(((key, len(s), least.get(top(place[s])) if s else key) for (key, _), s in zip(rows, sets, strict=True)), key=str)


def found(docs, **settings):
    rows = sketches.groups(docs, **settings).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.fixture
def small_parts(monkeypatch):
    for name, value in {"SHORT": 3, "TILE": 4, "PAIRS": 5, "BYTES": 500}.items():
        monkeypatch.setattr(sketches, name, value)


def test_chance_bound():
    from math import comb

    t = sketches.least_shared(64, 85)
    assert sum(comb(64, k) * 0.85**k * 0.15 ** (64 - k) for k in range(t)) <= sketches.CHANCE
    assert 30 < t < 40
    assert sketches.least_shared(1, 85) == 1


def test_estimate_is_exact_for_small_sets():
    x, y = np.array([1, 2, 3, 5], np.uint64), np.array([2, 3, 5, 9], np.uint64)
    assert sketches.estimate(x, y, 64) == (3, 5)
    assert sketches.estimate(x, y, 4) == (3, 4)


def test_edge_rows(edge_docs, edge_rows):
    wanted = plainly([(r[0], r[1]) for r in edge_rows], 3, 85)
    assert found(edge_docs, words=3, percent=85) == wanted


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = plainly([(r.doc_id, r.text) for r in docs.collect()], 3, 85)
    assert len({w[2] for w in wanted}) < len(wanted)
    assert found(docs, words=3, percent=85) == wanted


def groups_of_copies():
    """A hot group whose copies are near one another, a chain that only neighbours link, a template that nothing links, and short texts."""
    generator = random.Random(5)
    word = lambda: "".join(generator.choices("abcdefgh", k=5))
    base, rows = [word() for _ in range(150)], []
    for _ in range(90):
        text = list(base)
        for _ in range(generator.choice([0, 1, 2, 2, 3, 4, 6, 9])):
            text[generator.randrange(150)] = word()
        rows.append(" ".join(text))
    chain = [word() for _ in range(120)]
    for _ in range(30):
        chain[generator.randrange(120)] = word()
        chain[generator.randrange(120)] = word()
        rows.append(" ".join(chain))
    common = [word() for _ in range(60)]
    rows += [" ".join(common + [word() for _ in range(60)]) for _ in range(25)]
    rows += [" ".join(common[: k % 9]) for k in range(30)] + [" ".join(base[:60] + [word()]) for _ in range(6)]
    generator.shuffle(rows)
    return [(None if k % 17 == 0 else k, text) for k, text in enumerate(rows)] + [(3, rows[3]), (5, "other text"), (5, None)]


def test_hot_groups_in_small_parts(spark, small_parts):
    rows = groups_of_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    wanted = plainly(rows, 3, 85)
    assert found(docs, words=3, percent=85) == wanted


def test_text_keys_and_other_columns(spark):
    rows = [("b", "one two three four five six", 1), ("a", "One two three\tfour five  SIX", 2), (None, "x", 3), ("c", "", 4)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, node long")
    assert found(docs, words=3, percent=85) == plainly([r[:2] for r in rows], 3, 85)


def test_empty_table(no_docs):
    assert sketches.groups(no_docs).collect() == []
