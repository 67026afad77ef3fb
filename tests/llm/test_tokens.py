"""Packing, BPE and token counts against the tokenizers library and brute force."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelwright.llm import bpe, packing, pretokens, queries, trie

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_random_texts_encode_as_in_the_library(library):
    rnd = random.Random(5)
    signs = [*" \n\t'sdltrevmaéñ1²½!?.-<|>’\u00a0\u3000\u0085\x1c​日👍", "'s", "'ll", "<|endoftext|>", "  ", "a" * 70, "ab" * 60]
    packed, code, words = pretokens.character_classes(PATH), bpe.coder(PATH), packing._library(PATH)
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for encode in (None, words):
        for text, ids in zip(texts, bpe.encode_texts(texts, code, packed, encode), strict=True):
            assert ids.tolist() == ids_of(library, text), text
    assert all(code.decode(ids_of(library, t)) == library.decode(ids_of(library, t), skip_special_tokens=False) for t in texts)


def test_long_words_merge_as_short_ones(library):
    code, rnd = bpe.coder(PATH), random.Random(1)
    for _ in range(60):
        word = "".join(rnd.choice("abethinos") for _ in range(rnd.randint(49, 300)))
        assert code._long(word.encode()) == code._short(word.encode()) == ids_of(library, word)


def test_texts_over_a_block(library):
    text = " ".join(f"w{k * 7919}" for k in range(120_000))
    (ids,) = bpe.encode_texts([text], bpe.coder(PATH), pretokens.character_classes(PATH))
    assert ids.tolist() == ids_of(library, text)


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_round_trip(spark, sf, edge_docs, library, which):
    docs = edge_docs if which == "edge" else queries.table(spark, sf, "documents")
    found = bpe.round_trip(docs, PATH).collect() if which == "edge" else queries.QUERIES["op2_bpe"](spark, sf).collect()
    wanted = []
    for r in docs.collect():
        ids = ids_of(library, r.text)
        wanted.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))


def test_encode_then_decode(edge_docs, no_docs):
    texts = sorted(r.text or "" for r in edge_docs.collect())
    assert sorted(r.text for r in bpe.decode(bpe.encode(edge_docs, PATH), PATH).collect()) == texts
    assert bpe.encode(no_docs, PATH).isEmpty() and bpe.round_trip(no_docs, PATH).isEmpty()


def check_packing(rows, docs, library, size=2048):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    wanted = {}
    for r in docs:
        ids = ids_of(library, r.text) + [0]
        first = len(ids) % size or size
        starts = [0, *range(first, len(ids), size)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted.setdefault(r.doc_id, []).append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in wanted.items()}
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    return len(by_sequence), math.ceil(sum(r.length for r in rows) / size)


def test_packing(spark, sf, edge_docs, no_docs, library):
    docs = queries.table(spark, sf, "documents")
    used, least = check_packing(queries.QUERIES["op1_pack"](spark, sf).collect(), docs.collect(), library)
    assert used <= 1.05 * least + 2
    check_packing(packing.pack(packing.pieces(edge_docs, PATH)).collect(), edge_docs.collect(), library)
    assert packing.pack(packing.pieces(no_docs, PATH)).isEmpty()


def test_pieces_carry_their_ids(edge_docs, library):
    rows = packing.pieces(edge_docs.filter("doc_id = 4"), PATH, size=512, with_ids=True).collect()
    joined = [i for r in sorted(rows, key=lambda r: r.piece) for i in r.ids]
    assert joined == ids_of(library, edge_docs.filter("doc_id = 4").first().text) + [0]


def test_plan_places_every_piece_once():
    rnd = random.Random(3)
    for size in (8, 64, 2048):
        for _ in range(12):
            counts = {rnd.randint(1, size): rnd.randint(1, 400) for _ in range(rnd.randint(1, 60))}
            intervals, used = packing.plan(dict(counts), size, groups=8)
            ranks, filled = {s: [] for s in counts}, {}
            for length, first, many, sequence, offset in intervals:
                ranks[length] += range(first, first + many)
                for i in range(many):
                    filled.setdefault(sequence + i, []).append((offset, length))
            assert all(sorted(v) == list(range(counts[s])) for s, v in ranks.items())
            assert sorted(filled) == list(range(used))
            for places in filled.values():
                end = 0
                for offset, length in sorted(places):
                    assert offset == end
                    end += length
                assert end <= size


def best_way(word, score):
    """Score and tokens of the best segmentation, each end on its own."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = [(best[a][0] + score[word[a:end]], -(best[a][1] + 1)) for a in range(end) if word[a:end] in score]
        top = max(ways)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_token_counts(spark, sf, edge_docs, no_docs):
    code = bpe.coder(PATH)
    made = trie._trie(PATH)
    classes = pretokens.character_classes(PATH)
    docs = queries.table(spark, sf, "documents").filter("length(text) < 2000").union(edge_docs.filter("doc_id <> 4").select("doc_id", "text", "lang", "source", "n_chars"))
    found = sorted(map(str, map(tuple, trie.token_counts(docs, PATH).collect())))
    wanted = []
    for r in docs.collect():
        counted = [0, 0]
        for words, order, _ in pretokens.words_of([r.text or ""], classes):
            ways = [best_way(w.encode(), made.score) for w in words]
            counted = [counted[0] + len(order), counted[1] + sum(ways[i] for i in order)]
        wanted.append(str((r.doc_id, *counted)))
    assert found == sorted(wanted)
    assert trie.token_counts(no_docs, PATH).isEmpty()
    assert queries.QUERIES["op7_token_counts"](spark, sf).count() == queries.table(spark, sf, "documents").count()
    assert 50256 in code.pieces


def test_a_trie_that_starts_afresh_counts_the_same():
    words = [w.encode() for w in "the then there they these those thousand 一二三 aaaaaaa".split()]
    large, small = trie.Trie({b"th": 0, b"the": 1, b"re": 2, b"ous": 3, b"aa": 4}), trie.Trie({b"th": 0, b"the": 1, b"re": 2, b"ous": 3, b"aa": 4}, kept=3)
    assert [large.tokens(w) for w in words] == [small.tokens(w) for w in words] == [best_way(w, large.score) for w in words]
