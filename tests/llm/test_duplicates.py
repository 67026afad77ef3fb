"""SimHash groups, repeated byte strings and multiset fingerprints against brute force."""

import hashlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from panelwright.llm import common, multiset, queries, simhash, suffixes


def simple_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def simple_groups(rows):
    prints = [simple_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and find(a) != find(b):
                root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return sorted(str((doc, f"{prints[k]:016x}", least.get(find(k)))) for k, (doc, _) in enumerate(rows))


def test_simhash(spark, sf, edge_docs, no_docs):
    docs = queries.table(spark, sf, "documents")
    found = queries.QUERIES["op3_simhash"](spark, sf).collect()
    assert sorted(str(tuple(r)) for r in found) == simple_groups([(r.doc_id, r.text) for r in docs.collect()])
    found = simhash.groups(edge_docs, tile=4).collect()
    assert sorted(str(tuple(r)) for r in found) == simple_groups([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert simhash.groups(no_docs).isEmpty()


def test_first_of_each_group_stays(edge_docs):
    kept = simhash.first_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    prints = [simple_print(t) for _, t in rows]
    left = [simple_print(r.text) for r in kept.collect()]
    assert not any((a ^ b).bit_count() <= 4 for k, a in enumerate(left) for b in left[:k])
    assert all(any((a ^ b).bit_count() <= 4 for b in prints) for a in left) and len(left) >= 7
    assert [r.doc_id for r in kept.filter("text like 'word0%' and text not like '%more'").collect()] == [3]


def test_tile_pairs_lose_no_link():
    rnd = np.random.default_rng(1)
    near = rnd.integers(0, 1 << 63, 1, np.uint64) ^ (np.uint64(1) << rnd.integers(0, 64, 400).astype(np.uint64))
    far = np.unique(np.concatenate([near, rnd.integers(0, 1 << 63, 300, np.uint64)]))
    joined = simhash.forest(far, far, 4, True)
    assert len(joined) == len(np.unique(near)) - 1 and all((a ^ b).bit_count() <= 4 for a, b in joined)
    half = len(far) // 2
    across = simhash.forest(far[:half], far[half:], 4, False)
    assert len(across) < len(far) and {a in set(far[:half].tolist()) for a, _ in across} <= {True, False}


def test_components_of_chains_stars_and_cliques(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(a, b) for a in range(200, 210) for b in range(200, a)]
    edges += [(7, 7), (None, 3), (301, 300), (300, 301)]
    found = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    wanted = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {k: 200 for k in range(200, 210)} | {300: 300, 301: 300}
    assert found == wanted
    assert common.components(spark.createDataFrame([], "a long, b long"), "test").isEmpty()


def simple_removed(rows, length):
    """(document, bytes, removed, spans, digest) by counting every string of the length."""
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        rest = bytes(np.frombuffer(t, np.uint8)[~gone[1:-1]])
        out.append(str((doc, len(t), len(t) - len(rest), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(rest).hexdigest())))
    return sorted(out)


def test_repeats(spark, sf, no_docs, monkeypatch):
    docs = queries.table(spark, sf, "documents")
    wanted = simple_removed([(r.doc_id, r.text) for r in docs.collect()], 400)
    assert sorted(str(tuple(r)) for r in queries.QUERIES["op5_repeats"](spark, sf).collect()) == wanted
    monkeypatch.setattr(suffixes, "FINISHED", 1)  # every bucket is split further
    assert sorted(str(tuple(r)) for r in suffixes.removed(docs, 400).collect()) == wanted
    assert suffixes.removed(no_docs).isEmpty() and suffixes.without_repeats(no_docs).isEmpty()


def test_repeats_at_the_edges(spark, edge_docs, monkeypatch):
    short = edge_docs.filter("doc_id is null or doc_id <> 4")
    rows = [(r.doc_id, r.text) for r in short.collect()]
    for length in (100, 400):
        assert sorted(str(tuple(r)) for r in suffixes.removed(short, length).collect()) == simple_removed(rows, length)
    kept = suffixes.without_repeats(edge_docs, 400)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()
    assert kept.filter("text is null").count() == 1 and kept.filter("doc_id = 5").first().text == ""
    monkeypatch.setattr(suffixes, "SCAN", 700)  # texts are scanned in several parts
    assert sorted(str(tuple(r)) for r in suffixes.removed(short, 400).collect()) == simple_removed(rows, 400)


def test_multiset_hash_is_homomorphic():
    parts = [f"Paragraph {k}. It has two sentences." for k in range(9)]
    whole = multiset.vector("\n".join(parts))
    assert np.array_equal(whole, multiset.vector("\n".join(reversed(parts))))
    assert np.array_equal(whole, multiset.vector("\n".join(parts[:5])) + multiset.vector("\n".join(parts[5:])))
    assert np.array_equal(whole - multiset.vector(parts[3]), multiset.vector("\n".join(parts[:3] + parts[4:])))
    assert not np.array_equal(whole, multiset.vector("\n".join(parts + parts[:1])))
    old, new = "\n".join(parts), "\n".join(parts)[:200] + " changed\nnew"
    assert np.array_equal(multiset.replaced(multiset.vector(old), old, new, 200), multiset.vector(new))


def test_multiset_query(spark, sf, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(multiset, "BUCKET_ROWS", 37)
    for docs in (queries.table(spark, sf, "documents"), edge_docs):
        found = multiset.compare_with_next(docs).collect()
        rows = docs.select("doc_id", "text").collect()
        rows.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest()))
        wanted, nears = [], {}
        for k, r in enumerate(rows):
            text, after = r.text or "", rows[(k + 1) % len(rows)].text or ""
            cut = len(text) // 4
            new = text[: len(text) - cut] + after[:cut]
            a, b, c = map(multiset.vector, (text, new, after))
            wanted.append(str((r.doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(),
                               multiset.likeness(a, b), multiset.likeness(a, c))))
        assert sorted(str(tuple(r)) for r in found) == sorted(wanted)
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
        large = [r for r in found if r.n_chars > 2000 and r.near_next < 1 and docs is not edge_docs]
        assert not large or np.mean([r.near_edited > r.near_next for r in large]) > 0.9
    assert multiset.compare_with_next(no_docs).isEmpty()
