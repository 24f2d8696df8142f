"""Documents to token ids: toxicity, near copies, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept.
"""

import tempfile
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from delayworks.llm.bpe import Tokenizer, encoded
from delayworks.llm.simhash import drop_near_copies
from delayworks.llm.surrogates import pseudonymised
from delayworks.llm.tables import stored, table
from delayworks.llm.water_filling import mixed
from delayworks.llm.weak_toxicity import fit, without_toxic
from delayworks.scratch import set_scratch

SURROGATE_KEY = "surrogate-key"
TOKENIZER = "byte_bpe_50k.json"

#: SQL can express neither the classifier nor the fingerprints.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier scores below 0.3."""
    return without_toxic(docs, fit(docs, table(spark, sf_dir, "labels")), 0.3)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: three-word shingles, three bits at most."""
    return drop_near_copies(docs, words=3, radius=3)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates in place of personal data."""
    return pseudonymised(docs, SURROGATE_KEY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by water-filling; a document comes as often as the mix takes it."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the mix its ids, their number, and digests of ids and decoded text."""
    bpe = Tokenizer.load(public_tokenizers.path(TOKENIZER))
    return encoded(docs, bpe).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mix", mix),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again as the next one's input."""
    if spark.sparkContext.master.startswith("local["):
        set_scratch(spark, tempfile.gettempdir())
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
