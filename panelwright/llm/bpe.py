"""BPE encoding and decoding by contiguous rank arrays."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from panelwright.llm import pretokens

# Distinct words whose ids a task keeps; it starts afresh beyond, so that its memory is bounded.
KEPT_WORDS = 600_000
# Words of more bytes are merged a rank at a time with arrays instead of a pair at a time.
SHORT = 48
NO_RANK = 1 << 40


@cache
def _byte_signs() -> dict[str, int]:
    """The printable sign that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    return signs | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


class Coder:
    """Encodes single words, and turns ids back to bytes, for a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        signs = _byte_signs()
        vocabulary = file["model"]["vocab"]
        self.pieces = {i: bytes(signs[c] for c in token) for token, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.pieces |= {i: token.encode() for token, i in self.special.items()}
        self.of_byte = [0] * 256
        for token, i in vocabulary.items():
            if len(token) == 1:
                self.of_byte[signs[token]] = i
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, merge in enumerate(file["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[vocabulary[left] << 20 | vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        self.decimal = [str(i) for i in range(max(self.pieces) + 1)]
        self.known: dict[str, bytes] = {}

    def merge(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        return self._short(data) if len(data) <= SHORT else self._long(data)

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word as unsigned 32-bit numbers; what was encoded before is looked up."""
        known = self.known
        if len(known) >= KEPT_WORDS:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = np.array(self.merge(word), "<u4").tobytes()
        return [known[word] for word in words]

    def _short(self, data: bytes) -> list[int]:
        """Parts between boundaries, and the rank of each boundary's pair, in two lists side by side."""
        rank_of, merged = self.ranks.get, self.merged
        parts = [self.of_byte[b] for b in data]
        ranks = [rank_of(a << 20 | b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NO_RANK:
                break
            at = ranks.index(rank)
            parts[at] = part = merged[rank]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank_of(part << 20 | parts[at + 1], NO_RANK)
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] << 20 | part, NO_RANK)
        return parts

    @property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_sorted"):
            keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
            order = np.argsort(keys)
            self._sorted = keys[order], np.fromiter(self.ranks.values(), np.int64, len(self.ranks))[order]
        return self._sorted

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, ranks = self._table
        wanted = left << 20 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, ranks[at], NO_RANK)

    def _long(self, data: bytes) -> list[int]:
        """The same arrays in numpy: a scan for the minimum deletes all boundaries of that rank at once.

        A merge makes no pair of a lower rank than its own, so one after the other gives the same parts.
        """
        parts = np.array(self.of_byte, np.int64)[np.frombuffer(data, np.uint8)]
        ranks = self._ranks_of(parts[:-1], parts[1:])
        while len(ranks) and (rank := int(ranks.min())) != NO_RANK:
            at = np.flatnonzero(ranks == rank)
            if len(at) > 1:  # of boundaries side by side, every second one from the left is free
                run = np.cumsum(np.append(True, np.diff(at) != 1))
                first = np.searchsorted(run, run)
                at = at[(np.arange(len(at)) - first) % 2 == 0]
            parts[at] = self.merged[rank]
            parts, ranks = np.delete(parts, at + 1), np.delete(ranks, at)
            now = at - np.arange(len(at))
            near = np.unique(np.concatenate([now, now - 1]))
            near = near[(near >= 0) & (near < len(ranks))]
            ranks[near] = self._ranks_of(parts[near], parts[near + 1])
        return parts.tolist()

    def decode(self, ids: list[int]) -> str:
        pieces = self.pieces
        return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")


@cache
def coder(path: str) -> Coder:
    return Coder(path)


def segments(text: str, special: dict[str, int]) -> list[str | int]:
    """A text cut at the special tokens it spells out; those come as ids."""
    out: list[str | int] = [text]
    for token, number in special.items():
        if token in text:
            cut: list[str | int] = []
            for part in out:
                if isinstance(part, int):
                    cut.append(part)
                    continue
                for k, piece in enumerate(part.split(token)):
                    cut += [number] * (k > 0) + [piece] * bool(piece)
            out = cut
    return out


def encode_texts(texts: list[str | None], code: Coder, packed: bytes, encode_words=None) -> Iterator[np.ndarray]:
    """The ids of each text, in order. ``encode_words`` turns a list of words into their packed ids."""
    encode_words = encode_words or code.encode
    owners, pieces, fixed = [], [], {}
    for number, text in enumerate(texts):
        for part in segments(text or "", code.special):
            if isinstance(part, int):
                fixed[len(pieces)] = part
                part = ""
            owners.append(number)
            pieces.append(part)
    done, held = 0, []

    for words, order, ranges in pretokens.words_of(pieces, packed):
        packs = encode_words(words)
        offsets = np.zeros(len(packs) + 1, np.int64)
        np.cumsum([len(x) // 4 for x in packs], out=offsets[1:])
        flat = np.frombuffer(b"".join(packs), "<u4")
        ids, at = pretokens.spread(flat, offsets, order)
        for piece, first, last in ranges:
            while done < owners[piece]:
                yield np.concatenate(held) if held else np.zeros(0, np.uint32)
                done, held = done + 1, []
            held.append(np.array([fixed[piece]], np.uint32) if piece in fixed else ids[at[first] : at[last]])
    while done < len(texts):
        yield np.concatenate(held) if held else np.zeros(0, np.uint32)
        done, held = done + 1, []


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every whole text, as the tokenizers library encodes it without added tokens.

    Null and empty texts have no ids. Repeated rows and null keys are encoded like any other; other
    columns are left out. Nothing is shuffled.
    """
    packed = pretokens.character_classes(path)
    schema = docs.select(F.col(key), F.lit(None).cast("array<int>").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            for part in slices(batch):
                rows = list(encode_texts(part.column(1).to_pylist(), code, packed))
                ids = pa.array([r.astype(np.int32) for r in rows], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [key, "ids"])

    return docs.select(key, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of id arrays, special tokens kept; a null array decodes to an empty text."""
    schema = encoded.select(F.col(key), F.lit("").cast("string").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            texts = [code.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of their decoded text.

    Encodes and decodes within one pass, so that no id array leaves its task. Null texts count as empty.
    """
    packed = pretokens.character_classes(path)
    schema = docs.select(
        F.col(key), F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in batches:
            for part in slices(batch):
                n, of_ids, of_text = [], [], []
                for row in encode_texts(part.column(1).to_pylist(), code, packed):
                    ids = row.tolist()
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([code.decimal[i] for i in ids]).encode()).hexdigest())
                    of_text.append(hashlib.sha256(code.decode(ids).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(key, text).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Small parts of a batch, so that only some texts are Python objects at a time."""
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)
