"""URL filters by a cascade of Bloom filters over the corpus's keys.

The first level encodes the listed keys, the second those keys of the corpus that pass the first
though they are not listed, the third the listed keys that pass the second, and so on until none
passes. For every key of the corpus the first level that it fails tells whether it is listed, with
no error and no join.
"""

from collections.abc import Iterator, Mapping
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.tables import free_name, ship, stored

MAX_BITS = 1 << 29
BASE = ("h1", "h2")


def base_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _mix(x: np.ndarray, number: int) -> np.ndarray:
    x = x + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


class Level:
    """One filter; its positions depend on its number, so one level's errors are not the next one's."""

    def __init__(self, number: int, keys: DataFrame, rate: float):
        n = keys.count()
        self.number, self.size = number, max(64, ceil(-n * log(rate) / log(2) ** 2))
        self.hashes = max(1, round(-log(rate) / log(2)))
        if self.size > MAX_BITS:
            raise ValueError(f"{n} keys need {self.size} bits; the bound is {MAX_BITS}")
        self.bits = np.zeros(self.size // 64 + 1, np.uint64)
        positions = self.positions

        def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                at = positions(batch["h1"].to_numpy(), batch["h2"].to_numpy()).ravel()
                word, where = np.unique(at >> np.uint64(6), return_inverse=True)
                bits = np.zeros(len(word), np.uint64)
                np.bitwise_or.at(bits, where, np.uint64(1) << (at & np.uint64(63)))
                yield pd.DataFrame({"word": word.astype(np.int64), "bits": bits.view(np.int64)})

        made = keys.select(*BASE).mapInPandas(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        for row in made.toLocalIterator():
            self.bits[row["word"]] = np.uint64(row["bits"] % 2**64)

    @property
    def positions(self):
        number, size, hashes = self.number, self.size, self.hashes

        def of(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
            a, b = _mix(h1.view(np.uint64), number), _mix(h2.view(np.uint64), number) | np.uint64(1)
            return (a[:, None] + np.arange(hashes, dtype=np.uint64) * b[:, None]) % np.uint64(size)

        return of

    def passes(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.positions(h1, h2)
        return ((self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


class Cascade:
    """Exact membership in ``listed`` for the keys of ``universe`` (both frames have a column ``key``).

    Its size grows with the listed keys that the corpus has, and is bounded by ``MAX_BITS`` a
    level; more raise an error. NULL keys are no keys; an empty list has no members.
    """

    def __init__(self, universe: DataFrame, listed: DataFrame, rate: float = 0.1):
        ship(universe.sparkSession)
        hashed = universe.where("key is not null").select("key", *base_hashes(F.col("key")))
        listed = listed.select("key").distinct()
        inside = stored(hashed.join(listed, "key", "left_semi"), "listed")
        outside = stored(hashed.join(listed, "key", "left_anti"), "unlisted")
        self.levels: list[Level] = []
        while not inside.isEmpty():
            level = Level(len(self.levels), inside, rate)
            self.levels.append(level)
            inside, outside = stored(outside.where(_passing(level)(*BASE)), "passing"), inside

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """For hashes of keys of the universe: which keys are listed."""
        found = np.full(len(h1), len(self.levels) % 2 == 1)
        rest = np.arange(len(h1))
        for level in self.levels:
            passes = level.passes(h1[rest], h2[rest])
            found[rest[~passes]] = level.number % 2 == 1
            rest = rest[passes]
        return found


def _passing(level: Level):
    @F.pandas_udf("boolean")
    def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(level.passes(h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return passes


def split_by(df: DataFrame, column: str, keys: DataFrame, key: str = "id", rate: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """The rows whose value may be among the keys, and those whose value surely isn't.

    Only the first need to be joined, so wide rows outside of a small key set aren't shuffled. With
    more keys than a filter holds, all rows may be.
    """
    ship(df.sparkSession)
    if keys.count() * -log(rate) / log(2) ** 2 >= MAX_BITS:
        return df, df.limit(0)
    filled = _passing(Level(0, keys.select(*base_hashes(F.col(key).cast("string"))), rate))
    passes = F.coalesce(filled(*base_hashes(F.col(column).cast("string"))), F.lit(False))
    return df.where(passes), df.where(~passes)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every key under which a rule could list the url, longest first: a host of up to ``labels`` last
    labels and the path's first characters, as many as some rule has (0: a rule without a path)."""
    parts = F.transform(F.slice(F.split(F.reverse(host), r"\.", labels + 1), 1, labels), F.reverse)
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.reverse(F.slice(parts, 1, n)), ".")
    )
    keys = F.flatten(
        F.transform(
            hosts,
            lambda h: F.filter(
                F.array(*(F.when(F.length(path) >= n, F.concat(h, F.substring(path, 1, n))) for n in lengths)),
                lambda k: k.isNotNull(),
            ),
        )
    )
    return F.sort_array(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key"))), asc=False)["key"]


def judge(
    pages: DataFrame, lists: Mapping[str, list[str]], url_col: str = "url", rate: float = 0.1
) -> DataFrame:
    """The rows with ``host``, ``path``, ``rule`` (the longest listed key, or NULL) and ``list`` (its list's name).

    A key is a host, or a host and the start of a path. It lists the host and its subdomains. Where
    two lists hold one key, the first counts. A NULL url has no keys.
    """
    spark = pages.sparkSession
    every = [k for keys in lists.values() for k in keys]
    labels = max((k.split("/")[0].count(".") + 1 for k in every), default=1)
    lengths = sorted({len(k) - len(k.split("/")[0]) for k in every}) or [0]
    columns = {"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))}
    held, hit = free_name(pages, "url_keys"), free_name(pages, "url_hit")
    judged = pages.withColumns(columns).withColumn(held, rule_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = stored(judged.select(F.explode(held).alias("key")).distinct(), "keys")
    cascades = {name: Cascade(universe, spark.createDataFrame([(k,) for k in keys], "key string"), rate) for name, keys in lists.items()}

    @F.pandas_udf("struct<at int, list string>")
    def first(h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        sizes = h1.map(len).to_numpy()
        row, at = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([*map(np.arange, sizes), np.zeros(0, int)])
        a, b = (np.concatenate([*h, np.zeros(0, np.int64)]).astype(np.int64) for h in (h1, h2))
        best, which = np.full(len(sizes), len(a) + 1), np.full(len(sizes), None, object)
        for name, cascade in cascades.items():
            hit = np.flatnonzero(cascade.contains(a, b))
            least = np.full(len(sizes), len(a) + 1)
            np.minimum.at(least, row[hit], at[hit])
            nearer = least < best
            best[nearer], which[nearer] = least[nearer], name
        return pd.DataFrame({"at": np.where(best > len(a), -1, best).astype(np.int32), "list": which})

    hashes = [F.transform(held, lambda k: base_hashes(k)[0]), F.transform(held, lambda k: base_hashes(k)[1])]
    found = judged.withColumn(hit, first(*hashes))
    rule = F.get(held, F.when(F.col(hit)["at"] >= 0, F.col(hit)["at"]))
    return found.withColumns({"rule": rule, "list": F.col(hit)["list"]}).drop(held, hit)
