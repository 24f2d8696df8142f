"""Ranked lexical search through bit-sliced Bloom signatures.

The index holds blocks of documents of like length. Each term of a document sets a few bits of its
Bloom signature, and again for every doubling of its count; the signatures of a block lie bit by bit, one slice of
documents per bit. The slices of a term, taken together, show the documents that may hold it so
often and never miss one, so the weights of a query's slices, summed, bound every document's score from above.

Three steps over all documents: those that look best are scored exactly, which gives each query a score
that the last of its best reaches at least; documents bounded below it are excluded for certain; all
others are scored exactly.
"""

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import floor, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delayworks.llm.bloom_cascade import split_by
from delayworks.llm.tables import ship, stored

#: Letters and digits of ASCII, lower-cased, and all that isn't ASCII; everything else parts terms.
TERM_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
HASHES = 6
BITS_PER_TERM = 24
LEAST_BITS, MOST_BITS = 7, 24
DOCS_PER_BLOCK = 512
BITS_PER_BLOCK = 1 << 24
#: A reader decodes up to one file's blocks at once.
BLOCKS_PER_FILE = 64
QUERIES_AT_ONCE = 1000
HASHES_KEPT = 1 << 17
SALTS = 32
#: Documents that are scored for a query's least score, and those that a task proposes for it, as multiples of
#: the number wanted. Their choice decides how many documents are excluded, not which are found.
SEEDS, SEEDS_OF_TASK = 4, 2


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


class _Hashes(dict):
    """Hashes of terms; begun anew when there are too many."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= HASHES_KEPT:
            self.clear()
        self[term] = out = xxhash.xxh64_intdigest(term)
        return out


def places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """The bits of each hash for a count of 2 ** ``level`` or more, one row per hash function."""
    x = hashes + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return np.stack([(x + np.uint64(k) * step) & np.uint64((1 << bits) - 1) for k in range(HASHES)]).astype(np.int64)


def signature_bits(distinct: int) -> int:
    """The binary logarithm of the signature's size for so many terms."""
    return min(MOST_BITS, max(LEAST_BITS, (BITS_PER_TERM * distinct - 1).bit_length()))


def block_of(docs: Sequence[tuple[int, int, np.ndarray, np.ndarray]], bits: int) -> dict:
    """A row of the index for documents (id, number of terms, hashes, counts)."""
    table = np.zeros((1 << bits, len(docs)), bool)
    doc = np.repeat(np.arange(len(docs)), [len(d[2]) for d in docs])
    hashes, counts = np.concatenate([d[2] for d in docs]), np.concatenate([d[3] for d in docs])
    level = 0
    while len(hashes):
        for place in places(hashes, level, bits):
            table[place, doc] = True
        level += 1
        more = counts >= 1 << level
        doc, hashes, counts = doc[more], hashes[more], counts[more]
    slices = np.packbits(table, axis=1).tobytes()
    return {"ids": [d[0] for d in docs], "sizes": [d[1] for d in docs], "bits": bits, "slices": slices}


def signatures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index: one row per block, (ids, sizes, bits, slices); a task holds one open block per length."""
    ship(df.sparkSession)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, open_blocks = _Hashes(), {}
        for batch in batches:
            for doc_id, text in zip(batch["id"], batch["text"]):
                counts = Counter(terms(text))
                if not counts:
                    continue
                bits = signature_bits(len(counts))
                hashes = np.fromiter(map(known.__getitem__, counts), np.uint64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                docs = open_blocks.setdefault(bits, [])
                docs.append((doc_id, int(times.sum()), hashes, times))
                if len(docs) >= min(DOCS_PER_BLOCK, max(8, BITS_PER_BLOCK >> bits)):
                    yield pd.DataFrame([block_of(open_blocks.pop(bits), bits)])
        for bits in list(open_blocks):
            yield pd.DataFrame([block_of(open_blocks.pop(bits), bits)])

    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.where("id is not null").mapInPandas(of_batches, "ids array<long>, sizes array<long>, bits int, slices binary")


@dataclass(frozen=True)
class Query:
    """Terms of a block of items, their weights, by item the numbers of its terms, the documents that hold
    each, and N and L of the corpus."""

    numbers: dict[bytes, int]
    weights: np.ndarray
    items: list[np.ndarray]
    holding: np.ndarray
    documents: int
    length: int

    def norm(self, size: int) -> int:
        return 50 + 50 * size * self.documents // self.length

    def shares(self, counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """What a term so often in a document adds per unit of its weight."""
        return 1_000_000_000 * counts // (1000 * counts + 20 * norms)

    def _adds(self, block: dict) -> np.ndarray:
        """By term and document of a block, the most that the term can add to the document's score."""
        sizes, bits = np.asarray(block["sizes"], np.int64), int(block["bits"])
        slices = np.frombuffer(block["slices"], np.uint8).reshape(1 << bits, -1)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.numbers), np.uint64, len(self.numbers))
        norms = np.array([self.norm(n) for n in sizes.tolist()], np.int64)
        adds = np.zeros((len(hashes), len(sizes)), np.int64)
        rows, held, level = np.arange(len(hashes)), None, 0
        while len(rows):
            for place in places(hashes[rows], level, bits):
                held = slices[place] if held is None else held & slices[place]
            some = held.any(axis=1)
            rows, held = rows[some], held[some]
            at, doc = np.nonzero(np.unpackbits(held, axis=1, count=len(sizes)))
            most = np.minimum((2 << level) - 1, sizes[doc])
            adds[rows[at], doc] = self.weights[rows[at]] * self.shares(most, norms[doc])
            level += 1
        return adds

    def bounds(self, block: dict) -> np.ndarray:
        """By item and document of a block, a score that the document can't exceed."""
        adds = self._adds(block)
        return np.stack([adds[at].sum(axis=0) for at in self.items])

    def guesses(self, block: dict) -> np.ndarray:
        """By item and document of a block, a likely score: slices of rare terms are met by chance more often than by the term."""
        slices = np.frombuffer(block["slices"], np.uint8)
        chance = (np.bitwise_count(slices).sum() / (len(block["ids"]) << int(block["bits"]))) ** HASHES
        share = self.holding / self.documents
        adds = self._adds(block) * (share / (share + chance + 1e-12))[:, None]
        return np.stack([adds[at].sum(axis=0) for at in self.items])

    def scores(self, text: str, items: Sequence[int]) -> list[int]:
        """Exact scores of a document for some items."""
        words = terms(text)
        found = [(self.numbers[t], n) for t, n in Counter(words).items() if t in self.numbers]
        adds = np.zeros(len(self.weights), np.int64)
        if found:
            at, counts = np.array(found, np.int64).T
            adds[at] = self.weights[at] * self.shares(counts, np.int64(self.norm(len(words))))
        return [int(adds[self.items[i]].sum()) for i in items]


def query_of(items: Sequence[str | None], df: DataFrame, text_col: str = "text") -> Query | None:
    """The items' terms with weights from all documents; None if no document has a term."""
    wanted = [sorted(set(terms(t))) for t in items]
    numbers = {t: i for i, t in enumerate(sorted({t for ts in wanted for t in ts}))}
    ship(df.sparkSession)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        holding, documents, length = np.zeros(len(numbers), np.int64), 0, 0
        for batch in batches:
            for text in batch["text"]:
                words = terms(text)
                documents, length = documents + bool(words), length + len(words)
                holding[[numbers[t] for t in set(words) if t in numbers]] += 1
        some = np.flatnonzero(holding)
        yield pd.DataFrame({"term": [-1, -2, *some.tolist()], "n": [documents, length, *holding[some].tolist()]})

    texts = df.select(F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInPandas(of_batches, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in counted.collect()}  # two numbers, and one per term of the items
    documents, length = counts.get(-1, 0), counts.get(-2, 0)
    if not documents:
        return None
    weights = [floor(1000 * log((2 * documents + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(numbers))]
    own = [np.array([numbers[t] for t in ts], np.int64) for ts in wanted]
    holding = np.array([counts.get(i, 0) for i in range(len(numbers))], np.int64)
    return Query(numbers, np.array(weights, np.int64), own, holding, documents, length)


def _top(rows: DataFrame, by: str, most: int) -> DataFrame:
    """The first rows of each item by (``by`` descending, id), with ``rank``; in two steps, so no item is one task's work."""
    order = [F.col(by).desc(), F.col("id")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order)))
    few = first.where(F.col("rank") <= most).drop("rank", "salt")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= most)


def most_likely(index: DataFrame, query: Query, most: int) -> DataFrame:
    """(item, id, guess) of about ``SEEDS`` * ``most`` documents per item with the highest likely scores."""
    kept_most = SEEDS_OF_TASK * most

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        guess = np.zeros((len(query.items), 0))
        ids = np.zeros((len(query.items), 0), np.int64)
        for batch in batches:
            for block in batch.to_dict("records"):
                new = query.guesses(block)
                guess = np.concatenate([guess, new], axis=1)
                ids = np.concatenate([ids, np.broadcast_to(np.asarray(block["ids"], np.int64), new.shape)], axis=1)
                if guess.shape[1] > kept_most:
                    kept = np.argpartition(-guess, kept_most - 1, axis=1)[:, :kept_most]
                    guess, ids = np.take_along_axis(guess, kept, 1), np.take_along_axis(ids, kept, 1)
        item, at = np.nonzero(guess)
        yield pd.DataFrame({"item": item.astype(np.int32), "id": ids[item, at], "guess": guess[item, at]})

    return _top(index.mapInPandas(of_batches, "item int, id long, guess double"), "guess", SEEDS * most)


def not_excluded(index: DataFrame, query: Query, least: np.ndarray) -> DataFrame:
    """(item, id) of all documents whose bound reaches the item's least score."""

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.to_dict("records"):
                item, at = np.nonzero(query.bounds(block) >= least[:, None])
                yield pd.DataFrame({"item": item.astype(np.int32), "id": np.asarray(block["ids"], np.int64)[at]})

    return index.mapInPandas(of_batches, "item int, id long")


def scored(df: DataFrame, query: Query, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, id, score) of the documents of pairs (item, id), scored exactly by their whole texts."""
    wanted = stored(pairs.groupBy("id").agg(F.collect_set("item").alias("items")), "wanted")  # at most one block's items each
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = split_by(texts.where("id is not null"), "id", wanted)[0].join(wanted, "id")

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [query.scores(t, i) for t, i in zip(batch["text"], batch["items"])]
            sizes = [len(s) for s in scores]
            yield pd.DataFrame(
                {
                    "item": np.concatenate([*batch["items"], np.zeros(0, np.int32)]).astype(np.int32),
                    "id": np.repeat(batch["id"].to_numpy(np.int64), sizes),
                    "score": np.array([s for of_doc in scores for s in of_doc], np.int64),
                }
            )

    return found.mapInPandas(of_batches, "item int, id long, score long").where("score > 0")


def search(
    df: DataFrame,
    items: DataFrame,
    most: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Each item's ``most`` best documents with a score above 0: (item_id, rank, id, score).

    Equal scores come by ascending id. Every row of ``items`` is a query of its own, also one that repeats; its
    id may be NULL. Items come to the driver, ``QUERIES_AT_ONCE`` at a time. Texts without terms, NULL too, are found
    by nothing. A document with a NULL id counts in the statistics and can't be found; rows with one id
    are scored each by itself. Other columns are left out.
    """
    spark = df.sparkSession
    index = stored(signatures(df, id_col, text_col), "signatures", maxRecordsPerFile=BLOCKS_PER_FILE)
    out = spark.createDataFrame([], "item_id long, rank int, id long, score long")
    wanted = items.select(F.col(item_id_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    rows = wanted.toLocalIterator()
    while block := [r for _, r in zip(range(QUERIES_AT_ONCE), rows)]:
        query = query_of([r["text"] for r in block], df, text_col)
        if query is None:
            break
        seeds = scored(df, query, most_likely(index, query, most), id_col, text_col)
        lasts = _top(seeds, "score", most).groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        least = np.ones(len(block), np.int64)
        for row in lasts.where(F.col("n") == most).collect():  # a number per item of the block
            least[row["item"]] = row["least"]
        best = _top(scored(df, query, not_excluded(index, query, least), id_col, text_col), "score", most)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], "item int, item_id long")
        out = out.union(best.join(names, "item").select("item_id", "rank", "id", "score"))
    return out
