"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

A source's target is proportional to its weight, and at most ``max_epochs`` times its size; what
a clamped source cannot take is shared again among the others by weight, until none is above.
Whole repetitions of a target go to all documents of the source. The fraction goes to those with
the lowest seeded hashes: sizes are summed by source and hash bucket, and buckets are taken up to
the one whose end is nearest to the fraction. A source's words miss its target by half a bucket
(1/4096 of it) or half a document, whichever is more.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayworks.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
HASH_DIGITS = 3
BUCKETS = 16**HASH_DIGITS
BROADCAST_SOURCES = 50_000


def word_count(text: str = "text") -> Column:
    """Runs of characters other than space and \\t to \\r; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def hash_bucket(id_col: str, seed: int) -> Column:
    """A bucket from 0 to 4095, by the seeded MD5 of the id; all NULL ids have one."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("int")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """(source, source_size, weight) with ``target``: ``share`` of all sizes, by weight, under the caps.

    Round by round, the level is what the clamped sources leave over the weights of the others, and
    sources whose cap is below it are clamped, until none is. A round is one aggregate, which gives two numbers.
    Weights that are NULL, zero or negative take nothing.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0.0)).cast("double"), F.lit(0.0))
    caps = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    caps = stored(caps, "caps")
    budget = (caps.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level, before = 0.0, None
    while before is None or level > before:
        clamped = F.col("cap") <= F.col("weight") * F.lit(level)
        left = F.sum(F.when(~clamped, F.col("weight"))).alias("open")
        row = caps.where("weight > 0").agg(F.sum(F.when(clamped, F.col("cap"))).alias("clamped"), left).first()
        if not row["open"]:
            level = float("inf")
            break
        before, level = level, max(level, (budget - (row["clamped"] or 0.0)) / row["open"])
    filled = F.when(F.col("weight") > 0, F.least(F.col("cap"), F.col("weight") * F.lit(level))).otherwise(F.lit(0.0))
    return caps.select("source", "source_size", "weight", F.greatest(filled, F.lit(0.0)).alias("target"))


def numbered(sources: DataFrame) -> DataFrame:
    """The rows with ``number``, from 0 in the order of ``source``, NULL last.

    Sorted by ranges, each on its own; only the ranges' sizes come together.
    """
    ranges = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("source").asc_nulls_last()
    dealt = sources.repartitionByRange(ranges, order).sortWithinPartitions(order)
    dealt = stored(dealt.withColumn("place", F.monotonically_increasing_id()), "ranges")
    held = F.shiftrightunsigned("place", 33).alias("held")
    sizes = dealt.groupBy(held).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("held").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("held", F.coalesce(before, F.lit(0)).alias("start"))  # a row per range
    placed = dealt.withColumn("held", held).join(F.broadcast(starts), "held")
    number = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*sources.columns, number.alias("number"))


def plan(
    sizes: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, max_epochs: float = 2.0
) -> DataFrame:
    """From (source, bucket, size): per source its size, target, whole repetitions and buckets of one more.

    Sources take the weights in turn, by code point, NULL last.
    """
    sums = stored(sizes.groupBy("source", "bucket").agg(F.sum("size").alias("size")), "buckets")
    totals = sums.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    weighed = numbered(totals).withColumn("weight", F.get(cycle, (F.col("number") % len(weights)).cast("int"))).drop("number")
    targets = stored(water_fill(weighed, share, max_epochs), "targets")
    epochs = F.coalesce(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(epochs)).withColumn(
        "fraction", F.col("target") - F.col("whole") * F.col("source_size")
    )
    joined = sums.join(targets, sums["source"].eqNullSafe(targets["source"])).select(sums["*"], "fraction")
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    taken = joined.withColumn("middle", upto - F.col("size") / 2).where("middle < fraction")
    extra = taken.groupBy("source").agg((F.max("bucket") + 1).alias("extra"))
    return targets.join(extra, targets["source"].eqNullSafe(extra["source"]), "left").select(
        targets["*"], F.coalesce("extra", F.lit(0)).alias("extra")
    )


def repetitions(df: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", seed: int = 42, **how) -> DataFrame:
    """The rows with ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_times``, which replace columns of these names.

    Rows with one id are taken or left together. Sources are broadcast while they are few enough;
    beyond that they are joined by a shuffle, which Spark splits at hot sources.
    """
    key = F.col(source_col).cast("string")
    rows = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        key.alias("source"),
        hash_bucket(id_col, seed).alias("bucket"),
        size.alias("size"),
    )
    sources = stored(plan(rows.select("source", "bucket", "size"), **how), "plan")
    named = sources.withColumnRenamed("source", "of")
    if sources.count() <= BROADCAST_SOURCES:
        named = F.broadcast(named)
    times = F.col("whole") + F.when(F.col("bucket") < F.col("extra"), 1).otherwise(0)
    made = {
        "mix_size": F.col("size"),
        "mix_source_size": F.col("source_size"),
        "mix_target": F.col("target"),
        "mix_times": times.cast("long"),
    }
    joined = rows.join(named, F.col("source").eqNullSafe(F.col("of")))
    kept = [F.col("row").getField(c).alias(c) for c in df.columns if c not in made]
    return joined.select(*kept, *(column.alias(name) for name, column in made.items()))


def mixed(df: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents of the mix, as often as it takes them; same columns."""
    packed = df.select(
        F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"),
        F.col(how.pop("id_col", "doc_id")).alias("id"),
        F.col(how.pop("source_col", "source")).alias("source"),
        word_count(text_col).alias("size"),
    )
    counted = repetitions(packed, F.col("size"), id_col="id", source_col="source", **how)
    copies = F.array_repeat(F.lit(1), F.col("mix_times").cast("int"))
    return counted.select("row", F.explode(copies)).select("row.*")
