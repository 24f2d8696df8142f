"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits at the median of a random direction, again and again; vectors within a margin of
the split go to both sides. Vectors are compared within leaves only, found pairs are verified by
their cosine in double precision, and links are united. The trees come from a bounded sample; every
vector goes down all of them. A leaf that holds many vectors is compared tile by tile, so no task
holds more than two tiles. A pair that shares several leaves counts in the first of them only.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.components import components, forest, merge_labels
from delayworks.llm.tables import drawn, ship, stored

TREES = 5
MARGIN = 0.02
SAMPLE = 20_000
LEAF = 600
LEAST_SAMPLE = 24
TILE = 2_000
AT_ONCE = 512


@dataclass(frozen=True)
class Tree:
    """Inner nodes by number; children of node i are 2i+1 and 2i+2, others are leaves."""

    directions: dict[int, np.ndarray]
    splits: dict[int, float]

    def leaves(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that a row of unit vectors falls into."""
        rows, found = [], []
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if node not in self.splits:
                rows.append(at)
                found.append(np.full(len(at), node, np.int64))
                continue
            side = x[at] @ self.directions[node] - self.splits[node]
            todo.append((2 * node + 1, at[side <= margin]))
            todo.append((2 * node + 2, at[side >= -margin]))
        return np.concatenate(rows), np.concatenate(found)


def grow(x: np.ndarray, scale: float, seed: int, leaf: int, margin: float) -> Tree:
    """A tree over sampled unit vectors, each of which stands for ``scale`` vectors.

    A node of more than half its vectors within the margin isn't split: both sides would be the node.
    """
    rng = np.random.default_rng(seed)
    tree = Tree({}, {})
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        direction = rng.normal(size=x.shape[1])
        if len(at) * scale <= leaf or len(at) < 2 * LEAST_SAMPLE or node > 1 << 60:
            continue
        direction /= np.linalg.norm(direction)
        side = x[at] @ direction
        split = float(np.median(side))
        side = side - split
        if (np.abs(side) <= margin).mean() > 0.5:
            continue
        tree.directions[node], tree.splits[node] = direction, split
        todo += [(2 * node + 1, at[side <= margin]), (2 * node + 2, at[side >= -margin])]
    return tree


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid(vector: str) -> Column:
    """Vectors that can link: not NULL, without NULL or non-finite components, not zero."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda v: v != 0), F.lit(False))


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least leaf in both rows of two tables of leaves, padded with different negative numbers."""
    same = a[:, :, None] == b[:, None, :]
    return np.where(same.any(axis=2), a, np.int64(2**62)).min(axis=1)


def compare(rows: pd.DataFrame, leaf: int, low: int, high: int, least: float) -> pd.DataFrame:
    """Linked weight of each vector, and a forest of links, among a tile's rows or between two tiles.

    Only pairs whose first common leaf is this one.
    """
    x, ids, weight = _unit(rows["vector"]), rows["id"].to_numpy(), rows["n"].to_numpy()
    tile = rows["tile"].to_numpy()
    width = max(map(len, rows["leaves"]))
    leaves = np.array([np.pad(v, (0, width - len(v)), constant_values=-1) for v in rows["leaves"]])
    others = np.where(leaves < 0, -2, leaves)
    labels, total = np.arange(len(x)), np.zeros(len(x), np.int64)
    a_rows = np.flatnonzero(tile == low)
    b_rows = np.flatnonzero(tile == high)
    for at in range(0, len(a_rows), AT_ONCE):
        block = a_rows[at : at + AT_ONCE]
        a, b = np.nonzero(x[block] @ x[b_rows].T >= least)
        a, b = block[a], b_rows[b]
        if low == high:
            a, b = a[a < b], b[a < b]
        for k in range(0, len(a), 1 << 16):
            i, j = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
            here = _first_common(leaves[i], others[j]) == leaf
            i, j = i[here], j[here]
            total += np.bincount(i, weight[j], len(x)).astype(np.int64) + np.bincount(j, weight[i], len(x)).astype(np.int64)
            merge_labels(labels, i, j)
    linked = np.flatnonzero(total)
    a, b = forest(ids, ids[labels])
    counts = pd.DataFrame({"id": ids[linked], "links": total[linked], "to": None})
    return pd.concat([counts, pd.DataFrame({"id": a, "links": None, "to": b})]).astype("Int64")


def near_vectors(
    df: DataFrame,
    least: float = 0.95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    margin: float = MARGIN,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    tile: int = TILE,
    seed: int = 42,
) -> DataFrame:
    """Per row: id, n_links (other rows linked directly), component (smallest id reachable).

    Equal vectors are compared once and weighed by their number. Vectors of different length never
    link. Rows that cannot link have 0 links and their own component; a NULL id links with nothing
    and has a NULL component.
    """
    spark = df.sparkSession
    ship(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    able = rows.where(valid("vector") & F.col("id").isNotNull())
    distinct = stored(able.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("n")), "vectors")
    total = distinct.count()
    chosen = drawn(distinct, sample, "id").select("id", "vector").toPandas().sort_values("id", ignore_index=True)["vector"]
    sizes = chosen.map(len)
    grown = {
        int(size): [
            grow(_unit(chosen[sizes == size]), total / len(chosen), seed + number, leaf, margin) for number in range(trees)
        ]
        for size in sizes.unique()
    }
    shared = spark.sparkContext.broadcast(grown)

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["vector"].map(len)):
                x, row, found = _unit(part["vector"]), [], []
                for number, tree in enumerate(shared.value.get(size, [Tree({}, {})])):
                    r, node = tree.leaves(x, margin)
                    row.append(r)
                    found.append((node * trees + number) * (1 << 16) + size)
                row, found = np.concatenate(row), np.concatenate(found)
                order = np.lexsort((found, row))
                bounds = np.searchsorted(row[order], np.arange(1, len(x)))
                yield part.assign(leaves=np.split(found[order], bounds))

    placed = distinct.mapInPandas(descend, "vector array<double>, id long, n long, leaves array<long>")
    placed = stored(placed, "placed")
    counts = stored(placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count(), "leaves")
    tiles = counts.where("count > 1").select("leaf", F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    dealt = placed.withColumn("leaf", F.explode("leaves")).join(tiles, "leaf")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    cells = dealt.withColumn("other", other).withColumns(
        {"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}
    )

    def of_cell(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return compare(part, int(key[0]), int(key[1]), int(key[2]), least)

    columns = ("leaf", "low", "high", "tile", "id", "n", "vector", "leaves")
    found = cells.select(*columns).groupBy("leaf", "low", "high").applyInPandas(of_cell, "id long, links long, to long")
    found = stored(found, "found")
    linked = components(found.where("to is not null").select(F.col("id").alias("a"), F.col("to").alias("b")))
    number = found.where("links is not null").groupBy("id").agg(F.sum("links").alias("links"))
    classes = (
        distinct.join(number, "id", "left")
        .join(linked, "id", "left")
        .select(
            F.col("vector").alias("of"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    joined = rows.withColumn("of", F.when(valid("vector") & F.col("id").isNotNull(), F.col("vector"))).join(
        stored(classes, "classes"), "of", "left"
    )
    return joined.select(
        "id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component")
    )
