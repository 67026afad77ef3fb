import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelwright.llm import divergence
from panelwright.llm.divergence import Transducer


def placed(machine, terms):
    data = np.frombuffer(b" ".join([b"", *terms, b""]), np.uint8)
    sizes = np.array([len(t) for t in terms])
    starts = np.cumsum([1, *(sizes[:-1] + 1)]) if len(terms) else np.zeros(0, int)
    return machine.places(data, starts, sizes).tolist()


def states_of(terms):
    """How many different sets of endings the prefixes of some terms have: the states of the least automaton."""
    endings = defaultdict(set)
    for t in terms:
        for k in range(len(t) + 1):
            endings[t[:k]].add(t[k:])
    return len({frozenset(e) for e in endings.values()})


@pytest.mark.parametrize("seed", range(6))
def test_transducer_is_minimal_and_ordinal(seed):
    generator = random.Random(seed)
    letters = "abcé日\U0001f44d"[: 2 + seed]
    terms = sorted({"".join(generator.choices(letters, k=generator.randrange(1, 7))).encode() for _ in range(200)})
    machine = Transducer.unpacked(Transducer.build(terms).packed())
    assert len(machine.finals) == states_of(terms)
    assert placed(machine, terms) == list(range(len(terms)))
    assert [machine.term(k) for k in range(len(terms))] == terms
    others = {"".join(generator.choices(letters + "z", k=generator.randrange(1, 9))).encode() for _ in range(300)} - set(terms)
    assert set(placed(machine, sorted(others))) <= {-1}


def test_transducer_of_one_term_and_of_prefixes():
    assert placed(Transducer.build([b"a"]), [b"a", b"b", b"aa"]) == [0, -1, -1]
    terms = [b"a", b"ab", b"abc", b"b"]
    assert placed(Transducer.build(terms), terms) == [0, 1, 2, 3]


def plainly(rows, least, most):
    """Brute force over (text, lang, source) rows."""
    of_doc = [(lang or "", source or "", [
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    ]) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in of_doc}:
        own = [d for d in of_doc if d[0] == lang]
        held = Counter(w for d in own for w in set(d[2]))
        kept = [w for w, n in held.items() if n >= least]
        counts = defaultdict(Counter)
        for _, source, words in own:
            counts[source].update(w for w in words if held[w] >= least)
        everything = sum(counts.values(), Counter())

        def share(of):
            total = sum(of.values())
            return {w: 1 + 1_000_000_000 * (of[w] + 5) // (total + 5 * len(kept)) for w in kept}

        q, p = share(everything), {s: share(c) for s, c in counts.items()}
        for s in counts:
            pairs = sorted((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in counts if o != s)
            out |= {(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(pairs, 1)}
            terms = sorted((q[w] - p[s][w], w.encode()) for w in kept if counts[s][w] and p[s][w] > q[w])
            out |= {(lang, s, "term", w.decode(), -v, k) for k, (v, w) in enumerate(terms[:most], 1)}
    return out


def found(docs, least, most):
    rows = [tuple(r) for r in divergence.audit(docs, least, most).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_edge_rows(edge_docs, edge_rows):
    wanted = plainly([(r[1], r[2], r[3]) for r in edge_rows], 2, 7)
    assert wanted and found(edge_docs, 2, 7) == wanted


def test_whole_table_in_many_waves_tiles_and_blocks(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wanted = plainly([(r.text, r.lang, r.source) for r in docs.collect()], 10, 50)
    assert found(docs, 10, 50) == wanted
    for name, value in {"TERMS": 60, "WAVE": 9_000, "TILE": 3, "BLOCK": 50, "BUFFER": 5_000, "HELD": 100}.items():
        monkeypatch.setattr(divergence, name, value)
    terms = divergence.kept_terms(divergence._read(docs, "text", "lang", "source"), 10)
    assert len(divergence.waves(divergence.transducers(terms))) > 2
    assert found(docs, 10, 50) == wanted


def test_no_kept_terms_and_no_rows(spark, no_docs):
    assert divergence.audit(no_docs).collect() == []
    docs = spark.createDataFrame([("a b", "x", "s"), (None, "x", "t"), ("1 2", None, None)], "text string, lang string, source string")
    assert found(docs, 30, 50) == {("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)}
