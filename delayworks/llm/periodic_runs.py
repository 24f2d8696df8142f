"""Periodic runs of words: stretches that repeat one short sequence over and over.

A run is a maximal stretch with smallest period q that is at least ``min_length`` words and
``min_exponent`` periods long. Suffixes of a text that begin with the same words form classes, and the
classes that share l words are joined from those that share l + 1, so they are united by decreasing
longest common prefix (LCP), with union-find over ordered sets of positions. A pair i < j that becomes
adjacent in its set at LCP l is a repetition of the words i.. at distance d = j - i that holds for exactly l words:
with l >= (min_exponent - 1) * d it seeds the run i .. j + l. A smaller period would have put a
position of the same class between the two, so d is the smallest one, and each run is found once,
from its first word.

No run shows in an LCP below ``least_lcp``, so edges below it are left out, and texts in which no stretch
of that many words occurs twice have no run and are not sorted.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.tables import ship

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
MIN_LENGTH = 24
MIN_EXPONENT = 3
#: Texts of more bytes are never held as a list of words.
LONG = 1 << 22
WORDS_AT_ONCE = 1 << 16


def least_lcp(min_length: int, min_exponent: int) -> int:
    """The least LCP at which a run of any period shows between its first word and the one a period on."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def numbered(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word's form, and the forms by number."""
    forms: dict[bytes, int] = {}
    words = text.split() if len(text) <= LONG else (m.group() for m in WORD.finditer(text))
    ids = np.fromiter((forms.setdefault(w, len(forms)) for w in words), np.int64)
    return ids, list(forms)


def repeats(ids: np.ndarray, size: int) -> bool:
    """Whether some stretch of ``size`` words may occur twice; never wrongly False."""
    if len(ids) <= size:
        return False
    width, block = 1, (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    while 2 * width <= size:
        block = (block[:-width] * np.uint64(0xBF58476D1CE4E5B9)) ^ (block[width:] + (block[width:] >> np.uint64(29)))
        width *= 2
    block.sort()
    return bool((block[1:] == block[:-1]).any())


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the LCP of each suffix with the next one, by prefix doubling."""
    n = len(ids)
    ranks = [np.unique(ids, return_inverse=True)[1] + 1]
    while ranks[-1].max(initial=0) < n:
        rank, width = ranks[-1], 1 << (len(ranks) - 1)
        after = np.zeros(n, np.int64)  # 0: behind the end
        after[:-width] = rank[width:]
        ranks.append(np.unique(rank * (n + 1) + after, return_inverse=True)[1] + 1)
    order = np.argsort(ranks[-1])
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(max(n - 1, 0), np.int64)
    for level in reversed(range(len(ranks))):
        rank, inside = ranks[level], np.flatnonzero((a < n) & (b < n))
        same = inside[rank[a[inside]] == rank[b[inside]]]  # two different suffixes never end within equal blocks
        for at in (a, b, lcp):
            at[same] += 1 << level
    return order, lcp


class _Classes:
    """Sets of positions, each in order, that are united."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}
        self.members: dict[int, list[int]] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        if x not in parent:
            parent[x], self.members[x] = x, [x]
            return x
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def unite(self, a: int, b: int) -> list[tuple[int, int]]:
        """The pairs that become adjacent; the smaller set goes into the larger one."""
        a, b = self.find(a), self.find(b)
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        large, small = self.members[a], self.members.pop(b)
        self.parent[b] = a
        pairs, places = [], [bisect_left(large, x) for x in small]
        for k, (x, at) in enumerate(zip(small, places)):
            if at and (not k or places[k - 1] < at):
                pairs.append((large[at - 1], x))
            if at < len(large) and (k + 1 == len(small) or places[k + 1] > at):
                pairs.append((x, large[at]))
        for shift, (x, at) in enumerate(zip(small, places)):
            large.insert(at + shift, x)
        return pairs

    def adjacent(self, i: int, j: int) -> bool:
        held = self.members[self.find(i)]
        at = bisect_left(held, i) + 1
        return at < len(held) and held[at] == j


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs of a sequence, as (start, length, period), by start and then period."""
    least = least_lcp(min_length, min_exponent)
    if not repeats(ids, least):
        return []
    order, lcp = suffixes(ids)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    words, classes, found = ids.tolist(), _Classes(), []
    near: list[tuple[int, int]] = []
    level = 0

    def close() -> None:
        """Take the seeds of a level once all its classes are united."""
        for i, j in near:
            if classes.adjacent(i, j) and (not i or words[i - 1] != words[j - 1]):
                found.append((i, level + j - i, j - i))
        near.clear()

    for a, b, common in zip(order[edges].tolist(), order[edges + 1].tolist(), lcp[edges].tolist()):
        if common != level:
            close()
            level = common
        for i, j in classes.unite(a, b):
            if (min_exponent - 1) * (j - i) <= common and common + j - i >= min_length:
                near.append((i, j))
    close()
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words are in no run behind that run's first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _collapsed(text: bytes, min_length: int, min_exponent: int) -> tuple[list[tuple[int, int, int]], str]:
    ids, forms = numbered(text)
    runs = runs_of(ids, min_length, min_exponent)
    kept = ids[kept_words(len(ids), runs)] if runs else ids
    parts = (b" ".join([forms[i] for i in kept[at : at + WORDS_AT_ONCE].tolist()]) for at in range(0, len(kept), WORDS_AT_ONCE))
    return runs, b" ".join(parts).decode()


def periodic_runs(
    df: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: (id, runs, collapsed).

    ``runs`` is an array of (start, length, period) in words, by start and then period; ``collapsed`` has the
    words that no run drops, joined by one space: a run keeps its first period. Words are what stands between ASCII
    white space. A NULL or empty text has no runs and collapses to nothing; ids may be NULL or repeat,
    each row is judged by itself. Other columns are left out, so their names can't clash. No shuffle: a
    task holds one batch of texts and the suffixes of one of them.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    ship(df.sparkSession)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_collapsed((t or "").encode(), min_length, min_exponent) for t in batch["text"]]
            runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in found]
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "runs": runs, "collapsed": [c for _, c in found]})

    schema = "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInPandas(of_batches, schema)
