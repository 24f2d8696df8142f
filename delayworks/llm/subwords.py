"""Hashed words, word pairs and character n-grams of texts, whole batches of characters at a time."""

from collections.abc import Iterator, Sequence

import numpy as np

CHARACTERS_AT_ONCE = 1 << 20
_SPACES = np.array([9, 10, 11, 12, 13, 32], np.uint32)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_SIZES = (3, 4, 5)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _bucket(hashes: np.ndarray, kind: int, bits: int) -> np.ndarray:
    x = (hashes ^ np.uint64(kind * 0xC2B2AE3D27D4EB4F % 2**64)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def pieces(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Groups of (row numbers, texts) of bounded size; a text beyond it comes in several pieces, cut at spaces."""
    rows: list[int] = []
    held: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        while text or not rows or rows[-1] != row:
            cut = len(text)
            if cut > CHARACTERS_AT_ONCE:
                cut = text.rfind(" ", 1, CHARACTERS_AT_ONCE) + 1 or CHARACTERS_AT_ONCE
            if held and size + cut > CHARACTERS_AT_ONCE:
                yield np.array(rows), held
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(text[:cut])
            size += cut
            text = text[cut:]
            if not text:
                break
    if held:
        yield np.array(rows), held


def features(texts: Sequence[str], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: (text number, bucket) of every occurrence, texts in order.

    An n-gram may have a space at its ends, which marks the border of a word, and none inside.
    A word that follows itself makes one and the same pair, whatever the word.
    """
    joined = " " + " ".join(texts) + " "
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    owner = np.repeat(np.arange(len(texts)), lengths)
    space = np.isin(chars, _SPACES)
    code = np.where(space, np.uint32(32), chars).astype(np.uint64)
    inner = ~space
    rolled = code[:-1] * np.uint64(_BASE) + code[1:] * np.uint64(_BASE * 3 % 2**64)
    valid = np.ones(len(rolled), bool)
    for n in range(3, max(_SIZES) + 1):
        rolled = rolled[:-1] + code[n - 1 :] * np.uint64(_BASE * (2 * n - 1) % 2**64)
        valid = valid[:-1] & inner[n - 2 : -1] if n > 2 else valid
        if n in _SIZES:
            at = np.flatnonzero(valid)
            yield owner[np.minimum(at, len(owner) - 1)], _bucket(rolled[at], n, bits)
    starts = np.flatnonzero(inner & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(inner & np.concatenate([space[1:], [True]])) + 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * _powers(_BASE, len(code)), dtype=np.uint64)])
    words = (total[ends] - total[starts]) * _powers(_INVERSE, len(code))[starts]
    of = owner[starts - 1]
    yield of, _bucket(words, 1, bits)
    same = of[1:] == of[:-1]
    pairs = np.where(words[:-1] == words[1:], np.uint64(0), words[:-1] * np.uint64(_BASE) + words[1:])
    yield of[1:][same], _bucket(pairs[same], 2, bits)


def counts(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each occurs."""
    found = [bucket for _, held in pieces([text]) for _, bucket in features(held, bits)]
    return np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)


def sums(texts: Sequence[str], weights: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its features' weights, and their number."""
    total, number = np.zeros(len(texts)), np.zeros(len(texts))
    for rows, held in pieces(texts):
        for of, bucket in features(held, bits):
            np.add.at(total, rows, np.bincount(of, weights[bucket], len(held)))
            np.add.at(number, rows, np.bincount(of, minlength=len(held)))
    return total, number
