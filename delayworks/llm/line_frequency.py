"""Quality rules: counts of a text, and removal of lines that many documents of a host share.

Lines are normalised (lower case, digits as 0, other characters but letters as one space) and
hashed. A line is boilerplate where it stands in more documents of one host than the limit, whatever the
host's size. Each document counts, also one that is a copy: a page copied all over a host is boilerplate
there. Boilerplate lines are removed, and a document is rejected if less than half of its words are left.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayworks.llm.bloom_cascade import split_by
from delayworks.llm.tables import free_name, ship, stored

SYMBOLS = "#*$%&|<>"
MOST_DOCUMENTS = 20
_DIGITS, _OTHER = re.compile(r"\d"), re.compile(r"[\W_]+")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes]) -> int:
    """Words in a 3-word window that is found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[window] > 1)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[at + k] = True
    return int(covered.sum())


def line_hash(line: str) -> int | None:
    """The hash of a normalised line, None if nothing is left of it."""
    plain = _OTHER.sub(" ", _DIGITS.sub("0", line.lower())).strip()
    return xxhash.xxh64_intdigest(plain) - 2**63 if plain else None


def measures(text: str) -> tuple[tuple[int, ...], dict[int, int]]:
    """The counts of a text, and the words on the lines of each hash."""
    words = text.encode().split()
    seen: set[str] = set()
    repeated = 0
    lines: dict[int, int] = {}
    for line in text.split("\n"):
        size = len(line.encode().split())
        if size:
            repeated += line in seen
            seen.add(line)
            if (key := line_hash(line)) is not None:
                lines[key] = lines.get(key, 0) + size
    counts = (
        len(words),
        len(b"".join(words).decode()),
        sum(map(text.count, SYMBOLS)),
        repeated,
        repeat_words(words),
    )
    return counts, lines


def measured(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, host, text_hash, the counts, and its lines as (hash, words). NULL texts count as empty."""
    ship(df.sparkSession)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [measures(text) for text in batch.pop("text")]
            counts = pd.DataFrame([c for c, _ in rows], columns=_COUNTS, index=batch.index, dtype="int64")
            lines = [[{"hash": k, "words": n} for k, n in found.items()] for _, found in rows]
            yield pd.concat([batch, counts], axis=1).assign(lines=lines)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    kept = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "text")
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return rows.mapInPandas(of_batches, f"{kept}, {counts}, lines array<struct<hash: long, words: long>>")


def _lost(rows: DataFrame, most_documents: int) -> DataFrame:
    """From measured rows: (host, text_hash, n_words, hashes, lost), what texts with boilerplate lose of it."""
    lines = rows.select("host", F.inline("lines"))
    counted = lines.groupBy("host", "hash").agg(F.count("*").alias("documents"))
    over = counted.where(F.col("documents") > most_documents).select(F.col("host").alias("b_host"), F.col("hash").alias("b_hash"))
    over = stored(over, "boilerplate")
    own = rows.select("host", "text_hash", "n_words", F.inline("lines")).distinct()  # copies of a text lose the same
    marked = own.join(over, F.col("host").eqNullSafe(F.col("b_host")) & (F.col("hash") == F.col("b_hash")))
    lost = marked.groupBy("host", "text_hash", "n_words").agg(F.collect_set("hash").alias("hashes"), F.sum("words").alias("lost"))
    return stored(lost, "lost")


def verdicts(
    df: DataFrame,
    most_documents: int = MOST_DOCUMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Per row: id, host, the counts, ``boilerplate_words`` and ``depleted``.

    A NULL host is a host of its own. Empty texts are not depleted. The limit covers all rows.
    """
    rows = stored(measured(df, id_col, text_col, host_col), "measured")
    lost = _lost(rows, most_documents).select(F.col("host").alias("l_host"), F.col("text_hash").alias("l_hash"), "lost")
    joined = rows.join(lost, rows["host"].eqNullSafe(F.col("l_host")) & (F.col("text_hash") == F.col("l_hash")), "left")
    gone = F.coalesce("lost", F.lit(0))
    return joined.select("id", rows["host"], *_COUNTS, gone.alias("boilerplate_words"), (2 * gone > F.col("n_words")).alias("depleted"))


def without_lines(
    df: DataFrame,
    most_documents: int = MOST_DOCUMENTS,
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """The documents without their boilerplate lines, and without those that are depleted by it; all columns.

    NULL and empty texts stay as they are. Only documents with boilerplate are moved.
    """
    rows = stored(measured(df, host_col, text_col, host_col), "measured")
    key, gone, lost = (free_name(df, c) for c in ("host_and_text", "boilerplate_hashes", "boilerplate_lost"))
    keyed = lambda host, text_hash: F.xxhash64(host.isNull(), host, text_hash)
    losses = _lost(rows, most_documents).select(
        keyed(F.col("host"), F.col("text_hash")).alias(key),
        F.col("hashes").alias(gone),
        (2 * F.col("lost") > F.col("n_words")).alias(lost),
    )
    losses = stored(losses, "losses")
    text = F.col(text_col).cast("string")
    hashed = df.withColumn(key, keyed(F.col(host_col).cast("string"), F.xxhash64(F.coalesce(text, F.lit("")))))
    maybe, rest = split_by(hashed, key, losses, key)

    @F.pandas_udf("string")
    def left(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([without_boilerplate(t, set(h.tolist())) for t, h in zip(texts, hashes)], dtype=object)

    held = maybe.join(losses, key, "left")
    whole = held.where(F.col(lost).isNull())
    cut = held.where(~F.col(lost)).withColumn(text_col, left(text, F.col(gone)))
    return rest.select(df.columns).union(whole.select(df.columns)).union(cut.select(df.columns))


def without_boilerplate(text: str, boilerplate: set[int]) -> str:
    """The text without the lines whose hashes are listed."""
    return "\n".join(line for line in text.split("\n") if line_hash(line) not in boilerplate)
