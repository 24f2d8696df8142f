"""SimHash near-duplicates through an index of fingerprints in Gray order.

A document's fingerprint has a bit set where over half the hashes of its shingles have it.
Near fingerprints agree in some band of bits. Rows (band, fingerprint) are sorted by band
value and Gray rank and dealt by range, so no task holds more than its share. Inside a task
eight neighbours at a time are factored into an upper node, which keeps the bits that all its
members share; a pair of nodes is descended only while the shared bits that differ are within
the radius. Nodes whose members are one class already are not compared again.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.bloom_cascade import split_by
from delayworks.llm.components import components, merge_labels
from delayworks.llm.tables import ship, stored

SEED = 42
FAN = 8
CHUNK = 1 << 14
SHINGLES_AT_ONCE = 1 << 15
ROWS_PER_TASK = 100_000

# A band is a tuple of pieces (word of the fingerprint, shift, bits), side by side.
Band = tuple[tuple[int, int, int], ...]
BLOCKS: tuple[Band, ...] = tuple(((0, 16 * i, 16),) for i in range(4))


def shingle_hashes(text: str | None, words: int, repeats: bool = True) -> np.ndarray:
    """XXH64 of each shingle of ``words`` words; fewer words make one shingle, none make none."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    starts = range(max(1, len(found) - words + 1))
    hashes = (xxhash.xxh64_intdigest(b" ".join(found[i : i + words]), SEED) for i in starts)
    out = np.fromiter(hashes, np.uint64, len(starts))
    return out if repeats else np.unique(out)


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """A further 64 bits of each hash; lane 0 is the hash itself."""
    if not lane:
        return hashes
    x = hashes + np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray, lanes: int = 1) -> np.ndarray:
    """``lanes`` words of 64 bits; zero without hashes."""
    out = np.zeros(lanes, np.uint64)
    for lane in range(lanes):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), SHINGLES_AT_ONCE):
            part = _mixed(hashes[at : at + SHINGLES_AT_ONCE], lane).astype("<u8")
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        set_bits = np.packbits(2 * counts > len(hashes), bitorder="little")
        out[lane] = set_bits.view("<u8")[0]
    return out


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Position of each word in the reflected Gray code, as a signed long in the same order."""
    rank = words.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return (rank ^ np.uint64(1 << 63)).view(np.int64)


def _lanes(lanes: int) -> list[str]:
    return [f"f{i}" for i in range(lanes)]


def fingerprints(
    df: DataFrame, words: int = 3, lanes: int = 1, repeats: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: (id, f0.., rank). NULL and empty texts get the fingerprint zero."""
    ship(df.sparkSession)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t, words, repeats), lanes) for t in batch["text"]]
            f = np.array(prints, np.uint64).reshape(-1, lanes)
            out = {name: f[:, i].view(np.int64) for i, name in enumerate(_lanes(lanes))}
            yield pd.DataFrame({"id": batch["id"].astype("Int64")} | out | {"rank": gray_rank(f[:, 0])})

    schema = ", ".join(f"{c} long" for c in ("id", *_lanes(lanes), "rank"))
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInPandas(of_batches, schema)


def band_key(number: int, band: Band) -> Column:
    key = F.lit(number).cast("long")
    for word, shift, bits in band:
        piece = F.shiftrightunsigned(f"f{word}", shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        key = F.shiftleft(key, bits).bitwiseOR(piece)
    return key


def _levels(keys: np.ndarray, prints: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """From the rows up: (all members' common ones, any member's ones, least key, greatest key)."""
    levels = [(prints, prints, keys, keys)]
    while len(levels[-1][0]) > FAN:
        every, some, low, high = levels[-1]
        at = np.arange(0, len(every), FAN)
        levels.append(
            (
                np.bitwise_and.reduceat(every, at),
                np.bitwise_or.reduceat(some, at),
                np.minimum.reduceat(low, at),
                np.maximum.reduceat(high, at),
            )
        )
    return levels


def _within(level: tuple[np.ndarray, ...], i: np.ndarray, j: np.ndarray, radius: int) -> np.ndarray:
    """Which pairs i <= j can hold rows of one key that differ in ``radius`` bits at most."""
    every, some, low, high = level
    may = high[i] >= low[j]
    i, j = i[may], j[may]
    shared = ~(some[i] ^ every[i]) & ~(some[j] ^ every[j])
    differ = np.bitwise_count((every[i] ^ every[j]) & shared).sum(axis=1)
    may[may] = differ <= radius
    return may


def search(keys: np.ndarray, prints: np.ndarray, ids: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the ids whose fingerprints lie within the radius under one key, by chains of such links."""
    if len(keys) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((*(gray_rank(prints[:, i]) for i in reversed(range(prints.shape[1]))), keys))
    keys, prints = keys[order], prints[order]
    own, vertex = np.unique(ids[order], return_inverse=True)
    labels = np.arange(len(own))
    levels = _levels(keys, prints)
    spans: list[tuple[np.ndarray, np.ndarray]] = []

    def span() -> None:
        low = high = labels[vertex]
        spans[:] = [(low, high)]
        for level in levels[1:]:
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            spans.append((low, high))

    span()
    top = len(levels) - 1
    i, j = np.triu_indices(len(levels[top][0]), k=0 if top else 1)
    near = _within(levels[top], i, j, radius)
    stack = [(top, i[near], j[near])]
    child = np.arange(FAN)
    while stack:
        level, i, j = stack.pop()
        if len(i) > CHUNK:
            stack.append((level, i[CHUNK:], j[CHUNK:]))
            i, j = i[:CHUNK], j[:CHUNK]
        if not level:
            merge_labels(labels, vertex[i], vertex[j])
            span()
            continue
        low, high = spans[level]
        apart = (np.minimum(low[i], low[j]) != np.maximum(high[i], high[j]))
        i, j = i[apart], j[apart]
        size = len(levels[level - 1][0])
        left = np.repeat(i[:, None] * FAN + child, FAN, axis=1).ravel()
        right = np.tile(j[:, None] * FAN + child, (1, FAN)).ravel()
        real = (right < size) & (left < size) & ((left <= right) if level > 1 else (left < right))
        left, right = left[real], right[real]
        near = _within(levels[level - 1], left, right, radius)
        if near.any():
            stack.append((level - 1, left[near], right[near]))
    rest = labels != np.arange(len(own))
    return own[rest], own[labels[rest]]


def _words_of(batch: pd.DataFrame, lanes: int) -> np.ndarray:
    return batch[_lanes(lanes)].to_numpy(np.int64).view(np.uint64)


def links(prints: DataFrame, bands: Sequence[Band] = BLOCKS, radius: int = 3, lanes: int = 1) -> DataFrame:
    """Links (a, b) that join the ids of distinct fingerprints (id, f0.., rank) within the radius.

    With ``BLOCKS`` and a radius of 3 nothing is missed: three bits cannot touch all four blocks.
    A band value that spans several tasks is compared again between them: its rows in each task
    are a node, and pairs of nodes are kept while their shared bits differ within the radius.
    """
    spark = prints.sparkSession
    ship(spark)
    names = _lanes(lanes)
    keyed = prints.select("id", *names, "rank", F.explode(F.array(*(band_key(n, b) for n, b in enumerate(bands)))).alias("key"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), prints.count() * len(bands) // ROWS_PER_TASK)
    dealt = keyed.repartitionByRange(tasks, "key", "rank").withColumn("task", F.spark_partition_id())

    def of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        if not len(rows):
            return
        key = rows["key"].to_numpy()
        a, b = search(key, _words_of(rows, lanes), rows["id"].to_numpy(), radius)
        yield pd.DataFrame({"a": a, "b": b}).reindex(columns=["a", "b", *rows.columns]).astype("Int64")
        edge = rows[(key == key.min()) | (key == key.max())].assign(a=None, b=None)
        yield edge[["a", "b", *rows.columns]].astype("Int64")

    def of_pair(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = search(rows["key"].to_numpy(), _words_of(rows, lanes), rows["id"].to_numpy(), radius)
        return pd.DataFrame({"a": a, "b": b})

    columns = ["a", "b", *dealt.columns]
    found = stored(dealt.mapInPandas(of_task, ", ".join(f"{c} long" for c in columns)), "gray_tasks")
    edge = found.where("key is not null").drop("a", "b")
    masks = [f(n).alias(f"{p}{n}") for n in names for f, p in ((F.bit_and, "all_"), (F.bit_or, "any_"))]
    nodes = edge.groupBy("key", "task").agg(*masks)
    other = nodes.select(*(F.col(c).alias(f"{c}_") if c != "key" else "key" for c in nodes.columns))
    differ = sum(
        F.bit_count(F.expr(f"(all_{n} ^ all_{n}_) & ~(all_{n} ^ any_{n}) & ~(all_{n}_ ^ any_{n}_)")) for n in names
    )
    pairs = nodes.join(other, "key").where("task < task_").where(differ <= radius)
    sides = pairs.select("key", F.col("task").alias("low"), F.col("task_").alias("high"), F.explode(F.array("task", "task_")).alias("task"))
    across = edge.join(sides, ["key", "task"]).groupBy("key", "low", "high").applyInPandas(of_pair, "a long, b long")
    return found.where("a is not null").select("a", "b").union(across)


def near_groups(
    df: DataFrame,
    words: int = 3,
    radius: int = 3,
    lanes: int = 1,
    bands: Sequence[Band] = BLOCKS,
    repeats: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: (id, f0.., rank, component), the smallest id reachable by links.

    Rows with one fingerprint are represented by their smallest id, so copies cost nothing.
    Equal ids stay as many rows. A row with a NULL id is linked with nothing of its own: its
    component is that of rows with the same fingerprint and an id, or NULL.
    """
    names = [*_lanes(lanes), "rank"]
    prints = stored(fingerprints(df, words, lanes, repeats, id_col, text_col), "fingerprints")
    distinct = stored(prints.groupBy(*names).agg(F.min("id").alias("id")).where("id is not null"), "distinct")
    linked = components(links(distinct, bands, radius, lanes))
    classes = distinct.join(linked, "id", "left").select(*names, F.coalesce("component", "id").alias("component"))
    return prints.join(classes, names, "left").select("id", *names, "component")


def drop_near_copies(
    df: DataFrame, words: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group of ``near_groups``, all columns: the one with the smallest id.

    Groups are chains of fingerprints over shingles of ``words`` words that differ in ``radius`` bits at
    most (three, for ``BLOCKS`` to miss none). Texts without words share the fingerprint zero. Rows
    with a NULL id stay. Of rows with one id, one stays.
    """
    groups = near_groups(df.select(id_col, text_col), words, radius, id_col=id_col, text_col=text_col)
    ids = groups.where("id is not null").groupBy("id").agg(F.count("*").alias("n"), F.min("component").alias("root"))
    rows = stored(ids.where("root <> id or n > 1"), "copies")
    repeated = stored(rows.where("root = id").select(F.col("id").alias(id_col)), "repeated")
    maybe, kept = split_by(df, id_col, rows)
    kept = kept.union(maybe.join(rows.select(F.col("id").alias(id_col)), id_col, "left_anti").select(df.columns))
    if repeated.isEmpty():
        return kept
    once = maybe.join(repeated, id_col, "left_semi").dropDuplicates([id_col])
    return kept.union(once.select(df.columns))
