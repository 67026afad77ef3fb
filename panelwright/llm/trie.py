"""Token counts of a unigram model, by dynamic programming over a trie of distinct pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.llm import bpe, pretokens

# Trie nodes that a task keeps; it starts afresh beyond, so that its memory is bounded.
KEPT_NODES = 1_500_000


class Trie:
    """Pre-tokens byte by byte; a node knows the best score of its prefix and the tokens on that way.

    The score of a token is a Zipf log-probability of its rank, -ln(rank + 2): ranks come from the
    vocabulary file, nothing is fitted. Of ways with equal scores the one with fewer tokens counts. Every
    single byte is a token, so each prefix has a way.
    """

    def __init__(self, tokens: dict[bytes, int], kept: int = KEPT_NODES) -> None:
        self.score = {token: -math.log(rank + 2) for token, rank in tokens.items()}
        missing = min(self.score.values(), default=0.0) * 2
        for byte in range(256):
            self.score.setdefault(bytes([byte]), missing)
        # A prefix is only extended backwards while some token ends that way.
        self.endings = {token[k:] for token in self.score for k in range(len(token))}
        self.kept = kept
        self.clear()

    def clear(self) -> None:
        self.next: dict[int, int] = {}  # node << 8 | byte -> node
        self.best, self.count = [0.0], [0]

    def tokens(self, word: bytes) -> int:
        """Tokens on the best way through a word; prefixes met before are not scored again."""
        if len(self.best) > self.kept:
            self.clear()
        follow, best, count, score, endings = self.next, self.best, self.count, self.score, self.endings
        node, way = 0, [0]
        for at, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = follow.get(key)
            if node is None:
                top, least = -math.inf, 0
                for first in range(at - 1, -1, -1):
                    part = word[first:at]
                    if part not in endings:
                        break
                    own = score.get(part)
                    if own is not None:
                        total, n = best[way[first]] + own, count[way[first]] + 1
                        if total > top or total == top and n < least:
                            top, least = total, n
                node = follow[key] = len(best)
                best.append(top)
                count.append(least)
            way.append(node)
        return count[node]


@cache
def _trie(path: str) -> Trie:
    code = bpe.coder(path)
    special = set(code.special.values())
    return Trie({token: i for i, token in code.pieces.items() if i not in special})


def count_texts(texts: list[str | None], trie: Trie, packed: bytes) -> Iterator[tuple[int, int]]:
    """(pre-tokens, tokens) of each text."""
    pre, total = [0] * len(texts), [0] * len(texts)
    for words, order, ranges in pretokens.words_of([t or "" for t in texts], packed):
        at = np.append(0, np.cumsum(np.array([trie.tokens(w.encode("utf-8")) for w in words], np.int64)[order]))
        for number, first, last in ranges:
            pre[number] += last - first
            total[number] += int(at[last] - at[first])
    yield from zip(pre, total)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_pretokens, n_tokens) of every whole text under the unigram model of a vocabulary file.

    Null and empty texts have none; special tokens that a text spells out are text. Nothing is shuffled:
    each task inserts its own distinct pre-tokens. Repeated rows and null keys count like any other.
    """
    packed = pretokens.character_classes(path)
    schema = docs.select(F.col(key), *[F.lit(0).cast("long").alias(c) for c in ("n_pretokens", "n_tokens")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        for batch in batches:
            for part in bpe.slices(batch):
                pre, total = zip(*count_texts(part.column(1).to_pylist(), trie, packed), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(pre, pa.int64()), pa.array(total, pa.int64())], [key, "n_pretokens", "n_tokens"]
                )

    return docs.select(key, text).mapInArrow(run, schema)
