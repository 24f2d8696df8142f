"""Connected components of a link table, without gathering it anywhere."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.tables import ship, stored


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i], in place; a class is labelled by its smallest member."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        la, lb = la[apart], lb[apart]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := labels[labels], labels):
            labels[:] = up


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same ids: each id to the smallest of its class."""
    ids, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    labels = np.arange(len(ids))
    merge_labels(labels, where[: len(a)], where[len(a) :])
    rest = labels != np.arange(len(ids))
    return ids[rest], ids[labels[rest]]


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        a, b = forest(batch["a"].to_numpy(), batch["b"].to_numpy())
        yield pd.DataFrame({"a": a, "b": b})


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """For links (a, b) of long ids, one row per linked id: (id, component), the smallest id reachable.

    Links of an id with itself and links with NULL are left out. Each batch of links is first
    reduced to a forest; then large and small stars alternate until nothing changes, which takes
    a number of rounds logarithmic in the longest chain. Minima are stored before they are
    joined, so that Spark can split the join of an id with many links.
    """
    ship(links.sparkSession)
    schema = "a long, b long"
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stored(links.mapInPandas(_forests, schema).distinct(), "links")
    state = _state(links)
    while state[0]:
        both = links.union(links.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(large.where("a <> b").distinct(), "large")
        least = stored(links.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
