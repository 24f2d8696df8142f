"""Quality classifier of supervised subword embeddings.

Words, word pairs and character n-grams are hashed to buckets that have learned vectors. A text is
the mean of its features' vectors, and a softmax layer scores the classes. Vectors and layer are
trained by stochastic gradient descent in numpy, on a bounded sample of labelled rows. As the layer
is linear in the mean, a trained bucket comes down to one number, the difference of the two logits,
and scoring a text is a mean of these.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm.subwords import counts, sums
from delayworks.llm.tables import drawn, ship

BITS = 18
DIMENSIONS = 8
EPOCHS = 4
RATE = 0.5
SAMPLE = 5_000


@dataclass(frozen=True)
class Model:
    """One logit a bucket, and the logit of a text without features."""

    logits: np.ndarray
    base: float
    bits: int

    def scores(self, texts: list[str]) -> np.ndarray:
        total, number = sums(texts, self.logits, self.bits)
        return 1 / (1 + np.exp(-(self.base + total / np.maximum(number, 1))))


def train(
    texts: list[str], labels: list[int], bits: int = BITS, dimensions: int = DIMENSIONS,
    epochs: int = EPOCHS, rate: float = RATE, seed: int = 42,
) -> Model:
    """Without texts, or with one label only, every text scores the share of label 1 (0.5 without texts)."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.int64)
    rows = [(b, (n / n.sum()).astype(np.float32)) for b, n in (counts(t, bits) for t in texts)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    vectors = rng.uniform(-1, 1, (1 << bits, dimensions)).astype(np.float32) / dimensions
    layer = np.zeros((2, dimensions), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps = epochs * len(rows) if len(set(labels)) > 1 else 0
    order = np.concatenate([rng.permutation(len(rows)) for _ in range(epochs)]) if steps else []
    for step, i in enumerate(order):
        bucket, weight = rows[i]
        if not len(bucket):
            continue
        hidden = weight @ vectors[bucket]
        logit = layer @ hidden + bias
        p = np.exp(logit - logit.max())
        error = p / p.sum()
        error[y[i]] -= 1
        now = rate * (1 - step / steps)
        back = error @ layer
        layer -= now * np.outer(error, hidden)
        bias -= now * error
        # normalised step: the text's mean moves by the step, however many features it has
        vectors[bucket] -= now * np.outer(weight / (weight @ weight), back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float64), float(bias[1] - bias[0]), bits)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are not learned from: the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label_col: str, size: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> pd.DataFrame:
    """About ``size`` labelled rows that are not held out, by the hash of their id: (id, text, label)."""
    known = labels.where(~held_out(id_col)).where(F.col(label_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null")
    chosen = drawn(known.distinct(), size, "id")
    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # the sample is bounded by its size
    found = texts.join(F.broadcast(chosen), "id").select("id", "text", "label").toPandas()
    return found.sort_values(["id", "label", "text"], ignore_index=True)


def scored(documents: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row (id, score); NULL texts count as empty. ``model`` has ``scores(texts)``."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": shared.value.scores(list(batch["text"]))})

    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInPandas(of_batches, f"id {rows.schema['id'].dataType.simpleString()}, score double")
