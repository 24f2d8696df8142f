"""One query per operator, over the whole of its table."""

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayworks.llm import subword_classifier, weak_toxicity
from delayworks.llm.bloom_cascade import judge
from delayworks.llm.bpe import Tokenizer, encoded
from delayworks.llm.exact_stream import decisions, take
from delayworks.llm.line_frequency import verdicts
from delayworks.llm.main_text import labelled_pages, learn, main_text
from delayworks.llm.periodic_runs import periodic_runs
from delayworks.llm.rp_forest import near_vectors
from delayworks.llm.signature_search import search
from delayworks.llm.simhash import near_groups
from delayworks.llm.subword_classifier import held_out, labelled_sample, scored
from delayworks.llm.surrogates import pseudonymised
from delayworks.llm.tables import table
from delayworks.llm.water_filling import repetitions, word_count
from delayworks.scratch import scratch_dir

URL_RULES = {"block": ["net/", "example.com/de/"], "allow": ["example.net/en/", "org/fr/"]}
#: Hosts that the method blocks where no rule fits: the known spam names under each domain.
SPAM_HOSTS = [
    f"{name}.example.{top}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
]


def op1_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_vectors(table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(False))
    return rows.select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept")
    )


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = verdicts(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~F.col("depleted")).alias("kept"),
        "boilerplate_words",
    )


def op3_surrogates(spark: SparkSession, sf_dir: str, key: str = "surrogate-key") -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymised(documents, key, count_col="n_entities")


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = main_text(pages, learn(labelled_pages(pages)))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op6_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled = judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    ruled = ruled.withColumnsRenamed({"rule": "fits", "list": "ruling"})
    listed = judge(ruled, {"block": SPAM_HOSTS})
    verdict = F.coalesce("ruling", "list", F.lit("allow"))
    return listed.select("page_id", "host", "path", F.col("fits").alias("rule"), verdict.alias("verdict"))


def _judged(spark: SparkSession, sf_dir: str, model, threshold: float) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), model).select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op7_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality")
    return _judged(spark, sf_dir, subword_classifier.train(list(rows["text"]), list(rows["label"])), 0.7)


def op8_bpe(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    bpe = Tokenizer.load(public_tokenizers.path(tokenizer))
    rows = encoded(table(spark, sf_dir, "documents"), bpe, with_ids=False)
    return rows.withColumnRenamed("id", "doc_id")


def op9_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = weak_toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _judged(spark, sf_dir, model, 0.3)


def op10_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("words"))
    mixed = repetitions(documents, F.col("words"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_times")).alias("taken"),
    )


def with_periodic_ends(documents: DataFrame) -> DataFrame:
    """Texts as words joined by a space where crc32 of the id is a multiple of ten: from some word on, the
    first words that follow are repeated to the end."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    rows = documents.select("doc_id", "text", crc.alias("h"), F.when(crc % 10 == 0, words).alias("words"))
    rows = rows.withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    whole = """slice(concat(slice(words, 1, cast(a AS int)), flatten(array_repeat(
        slice(words, cast(a + 1 AS int), cast(p AS int)), cast((n - a) div p + 1 AS int)))), 1, n)"""
    text = F.when(F.col("words").isNotNull() & (F.col("n") > 0), F.array_join(F.expr(whole), " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_ends(table(spark, sf_dir, "documents")))
    longer = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, run: F.when(longer(best, run), run).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_signature_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op13_exact_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "exact")
    # as a pattern, the path may name a file or a folder of files
    take(spark, f"{sf_dir}/documents.parque[t]", folder, table(spark, sf_dir, "documents").schema)
    return decisions(spark, folder).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_projection_forest": op1_projection_forest,
    "op2_line_frequency": op2_line_frequency,
    "op3_surrogates": op3_surrogates,
    "op4_main_text": op4_main_text,
    "op5_simhash": op5_simhash,
    "op6_bloom_cascade": op6_bloom_cascade,
    "op7_subword_quality": op7_subword_quality,
    "op8_bpe": op8_bpe,
    "op9_weak_toxicity": op9_weak_toxicity,
    "op10_water_filling": op10_water_filling,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_signature_search": op12_signature_search,
    "op13_exact_stream": op13_exact_stream,
    "pipeline": corpus_pipeline.run,
}
