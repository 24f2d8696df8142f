"""Byte-level BPE with contiguous rank arrays.

A short word holds its parts in one array and the ranks of adjacent parts in another. The array is
scanned for the least rank, the boundary there is deleted, and the two ranks beside it are looked up
anew, until no rank is left. Many words of a length are done at once, one scan a step for all of
them. Words beyond ``SHORT`` bytes keep the least rank in a heap, as scans would take quadratic time.
"""

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.tables import ship

SHORT = 64
WORDS_AT_ONCE = 20_000
CHARACTERS_AT_ONCE = 1 << 18
ROWS_AT_ONCE = 256
CACHED_WORDS = 100_000
NONE = np.int64(1 << 40)

# Fixed value: the split of the byte-level tokenizer into words.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, the others as characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in printable)
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizer:
    """Ranks and parts of a vocabulary; made on the driver, used on the executors."""

    bytes_of: list[bytes]
    base: np.ndarray
    pairs: np.ndarray
    ranks: np.ndarray
    merged: np.ndarray
    special: dict[str, int]
    _known: dict[str, tuple[str, bytes]] = field(default_factory=dict)
    _old: dict[str, tuple[str, bytes]] = field(default_factory=dict)

    def __post_init__(self):
        self.number_text = [f"{i}," for i in range(len(self.bytes_of))]

    @classmethod
    def load(cls, path: str) -> "Tokenizer":
        """From a tokenizer file in JSON with a byte-level BPE model, whose path the driver can open."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        byte_of = _byte_of_character()
        bytes_of = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, number in vocab.items():
            bytes_of[number] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, number in special.items():
            bytes_of[number] = token.encode()
        base = np.zeros(256, np.int64)
        for character, byte in byte_of.items():
            base[byte] = vocab[character]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        return cls(bytes_of, base, pairs[order], order.astype(np.int64), merged[order], special)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair and what it merges to; ``NONE`` where it doesn't."""
        pair = (left << 20) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        there = self.pairs[at] == pair
        return np.where(there, self.ranks[at], NONE), self.merged[at]

    def _short(self, words: Sequence[bytes]) -> list[list[int]]:
        width = max(map(len, words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(len(words), width)
        out: list[list[int]] = [[]] * len(words)
        which, parts = np.arange(len(words)), self.base[raw]
        ranks, merged = self._look_up(parts[:, :-1], parts[:, 1:])
        ranks[np.arange(1, width)[None, :] >= size[:, None]] = NONE
        while True:
            if parts.shape[1] > 1:
                least = ranks.argmin(axis=1)
                live = ranks[np.arange(len(ranks)), least] < NONE
            else:
                live = np.zeros(len(parts), bool)
            done = ~live
            for i, row, n in zip(which[done].tolist(), parts[done].tolist(), size[done].tolist()):
                out[i] = row[:n]
            if not live.any():
                return out
            which, parts, ranks, merged, size, least = (x[live] for x in (which, parts, ranks, merged, size, least))
            row = np.arange(len(parts))
            parts[row, least] = merged[row, least]
            keep = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, keep + (keep > least[:, None]), axis=1)
            keep = keep[:-1]
            shift = keep + (keep >= least[:, None])
            ranks, merged = np.take_along_axis(ranks, shift, axis=1), np.take_along_axis(merged, shift, axis=1)
            size = size - 1
            for at in (least - 1, least):
                ok = (at >= 0) & (at < size - 1)
                r, a = row[ok], at[ok]
                ranks[r, a], merged[r, a] = self._look_up(parts[r, a], parts[r, a + 1])

    def _long(self, word: bytes) -> list[int]:
        parts = self.base[np.frombuffer(word, np.uint8)]
        ranks, merged = self._look_up(parts[:-1], parts[1:])
        ids, n = parts.tolist(), len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(int(r), i, ids[i], ids[i + 1], int(m)) for i, (r, m) in enumerate(zip(ranks, merged)) if r < NONE]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0:
                    rank, into = self._look_up(np.array([ids[a]]), np.array([ids[b]]))
                    if rank[0] < NONE:
                        heapq.heappush(heap, (int(rank[0]), a, ids[a], ids[b], int(into[0])))
        return [i for i in ids if i >= 0]

    def words(self, words: Sequence[bytes]) -> list[list[int]]:
        """The ids of each word."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= SHORT), key=lambda i: len(words[i]))
        for at in range(0, len(order), WORDS_AT_ONCE):
            group = order[at : at + WORDS_AT_ONCE]
            for i, ids in zip(group, self._short([words[i] for i in group])):
                out[i] = ids
        for i, word in enumerate(words):
            if len(word) > SHORT:
                out[i] = self._long(word)
        return out

    def split(self, text: str) -> list[str]:
        """The words of a text, special tokens among them."""
        if not any(mark in text for mark in self.special):
            return _WORDS.findall(text)
        out: list[str] = []
        at = 0
        for mark in regex.finditer("|".join(map(regex.escape, self.special)), text):
            out += [*_WORDS.findall(text[at : mark.start()]), mark.group()]
            at = mark.end()
        return out + _WORDS.findall(text[at:])

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words that aren't known yet. What a worker keeps is bounded: beyond
        ``CACHED_WORDS`` the known words become the old ones, of which those in use are taken over."""
        if len(self._known) > CACHED_WORDS:
            self._old, self._known = self._known, {}
        new = []
        for word in set(words).difference(self._known):
            if word in self._old:
                self._known[word] = self._old[word]
            else:
                new.append(word)
        number_text, bytes_of = self.number_text, self.bytes_of
        for word, ids in zip(new, self.words([w.encode("utf-8", "surrogatepass") for w in new])):
            if word in self.special:
                ids = [self.special[word]]
            self._known[word] = "".join([number_text[i] for i in ids]), b"".join([bytes_of[i] for i in ids])

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[str, bytes]]:
        """Of each text: its ids in decimal, a comma after each, and the bytes that they decode to."""
        held: list[list[str]] = []
        size = 0

        def flush() -> Iterator[tuple[str, bytes]]:
            self.learn(chain.from_iterable(held))
            for words in held:
                known = list(map(self._known.__getitem__, words))
                yield "".join([k[0] for k in known]), b"".join([k[1] for k in known])
            held.clear()

        for text in texts:
            held.append(self.split(text))
            size += len(text)
            if size > CHARACTERS_AT_ONCE:
                yield from flush()
                size = 0
        yield from flush()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


_WORDS = regex.compile(WORDS)


def encoded(
    df: DataFrame, tokenizer: Tokenizer, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Per row: id, n_tokens, ids (unless left out), and the SHA-256 of the ids and of the decoded text.

    NULL texts count as empty; an empty text has no ids. Rows keep their ids, repeated or NULL.
    """
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(tokenizer)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = shared.value
        for batch in (b[at : at + ROWS_AT_ONCE] for b in batches for at in range(0, len(b), ROWS_AT_ONCE)):
            rows = []
            for ids, raw in bpe.encode(batch["text"]):
                decoded = raw.decode("utf-8", "replace").encode()
                row = [ids.count(","), hashlib.sha256(ids[:-1].encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()]
                rows.append([*row, np.fromstring(ids, np.int32, sep=",")] if with_ids else row)
            columns = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]
            yield pd.concat([batch[["id"]], pd.DataFrame(rows, columns=columns, index=batch.index)], axis=1)

    texts = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = f"id {texts.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts.mapInPandas(of_batches, schema + (", ids array<int>" if with_ids else ""))


def decoded(df: DataFrame, tokenizer: Tokenizer, ids_col: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the text of their ids; NULL for NULL."""
    shared = df.sparkSession.sparkContext.broadcast(tokenizer)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else shared.value.decode(x))

    return df.withColumn("decoded", text(ids_col))
