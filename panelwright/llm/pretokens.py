"""Splits texts into pre-tokens with arrays, so that each distinct pre-token is handled once.

The split is the one of byte-level tokenizers: contractions, runs of letters, digits or other
signs with one space before them, and runs of white space that leave their last space to the word
after. Which class a character has is asked of the tokenizer itself, as Unicode versions differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd

LETTER, NUMBER, SPACE, OTHER = range(4)
# Code points that are handled at once; memory per task is some dozens of bytes for each.
BLOCK = 400_000
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_CODES = 0x110000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@cache
def character_classes(path: str) -> bytes:
    """The class of every code point, run-length coded, as the tokenizer file's splitter sees it."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    classes = np.full(_CODES, OTHER, np.uint8)
    for first in range(0, _CODES, 256):
        codes = [c for c in range(first, first + 256) if not 0xD800 <= c < 0xE000]
        if not codes:
            continue
        run = "".join(map(chr, codes))
        alike = not any(map(str.isspace, run)) and len(split(run)) == 1
        # Of "a", the character, "1": a letter stays with the one before, a digit with the one after.
        starts = {a for _, (a, _) in split("".join(f"a{c}1!" for c in (run[:1] if alike else run)))}
        for k, code in enumerate(codes):
            at = 0 if alike else 4 * k
            if at + 1 not in starts:
                classes[code] = LETTER
            elif at + 2 not in starts:
                classes[code] = NUMBER
    for code in np.flatnonzero(classes[:0x10000] == OTHER):
        if chr(code).isspace() or code in (0x85, 0x180E, 0x200B, 0xFEFF):
            if len(split(f"!{chr(code)}")) == 2:
                classes[code] = SPACE
    classes[ord(" ")] = SPACE
    edges = np.flatnonzero(np.diff(classes)) + 1
    return np.concatenate([[0], edges]).astype("<u4").tobytes() + b"|" + classes[np.concatenate([[0], edges])].tobytes()


@cache
def class_table(packed: bytes) -> np.ndarray:
    n = (len(packed) - 1) // 5
    edges, kinds = np.frombuffer(packed[: 4 * n], "<u4"), np.frombuffer(packed[4 * n + 1 :], np.uint8)
    return np.repeat(kinds, np.diff(np.append(edges, _CODES)))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(n, _BASE), np.full(n, inverse)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def starts_of(codes: np.ndarray, firsts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, in texts laid end to end; ``firsts`` holds where each text starts."""
    n = len(codes)
    kind = table[codes]
    begins = np.ones(n + 1, bool)  # a text starts here
    begins[:n] = False
    begins[firsts] = True
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new |= begins[:n]
    space = kind == SPACE
    # The last white space before a word starts a pre-token of its own; a plain one takes the word in.
    last = space & np.append(~space[1:], True) & ~begins[1:]
    new |= last
    joined = np.flatnonzero(last & (codes == 32)) + 1
    new[joined] = False
    for at in np.flatnonzero((codes == 39) & new):
        if at and not begins[at] and kind[at - 1] not in (LETTER, NUMBER) and codes[at - 1] == 32:
            continue
        for ending in CONTRACTIONS:
            end = at + 1 + len(ending)
            if end <= n and not begins[at + 1 : end].any() and "".join(map(chr, codes[at + 1 : end])) == ending:
                new[at + 1 : end] = False
                new[end : end + 1] = True
                break
    return np.flatnonzero(new)


def _parts(text: str) -> Iterator[str]:
    """A text in parts of about BLOCK characters, cut where a space starts a word in any case."""
    start = 0
    while len(text) - start > BLOCK:
        cut = start + BLOCK
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text) or not text:
        yield text[start:]


def words_of(texts: list[str], packed: bytes) -> Iterator[tuple[list[str], np.ndarray, list[tuple[int, int, int]]]]:
    """Blocks of (distinct pre-tokens, their sequence as indices, [(text number, from, to)] of the sequence).

    A text longer than a block comes in several ranges, in order.
    """
    table = class_table(packed)
    held: list[tuple[int, str]] = []
    size = 0

    def block() -> tuple[list[str], np.ndarray, list[tuple[int, int, int]]]:
        joined = "".join(t for _, t in held)
        lengths = np.array([len(t) for _, t in held])
        firsts = np.cumsum(lengths) - lengths
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        if not len(codes):
            return [], np.zeros(0, np.int64), [(k, 0, 0) for k, _ in held]
        starts = starts_of(codes, firsts[lengths > 0], table)
        ends = np.append(starts[1:], len(codes))
        up, down = _powers(1 << int(len(codes)).bit_length())
        with np.errstate(over="ignore"):
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(_mixed(codes.astype(np.uint64)) * up[: len(codes)], out=sums[1:])
            names = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        order, distinct = pd.factorize(names)
        where = np.empty(len(distinct), np.int64)
        where[order[::-1]] = np.arange(len(order))[::-1]
        words = [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        bounds = np.searchsorted(starts, np.append(firsts, len(codes))).tolist()
        return words, order, [(k, bounds[i], bounds[i + 1]) for i, (k, _) in enumerate(held)]

    for number, text in enumerate(texts):
        for part in _parts(text):
            held.append((number, part))
            size += len(part)
            if size >= BLOCK:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def spread(flat: np.ndarray, offsets: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a sequence of words laid end to end, and where each word's ids start among them."""
    lengths = (offsets[1:] - offsets[:-1])[order]
    ends = np.cumsum(lengths)
    at = ends - lengths
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(offsets[order] - at, lengths) + np.arange(total)]
    return ids, np.append(at, total)
