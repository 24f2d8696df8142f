"""Bloom filters of keys as tables of bitmaps; built, united and asked with native functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter, in bitmaps of 4 kB: 2 MB at most, however many keys.
FILTER_BITS = 1 << 24
_BUCKET, _POSITION, _BITS = "__bucket", "__position", "__bits"
FILTER_SCHEMA = f"{_BUCKET} long, {_BITS} binary"


def _bit(key: Column, bits: int) -> tuple[Column, Column]:
    """The bitmap of a key, and its place there."""
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)


def key_filter(df: DataFrame, key: Column, bits: int = FILTER_BITS) -> DataFrame:
    """One row per bitmap that has a bit set: ``bits`` / 32,768 rows at most."""
    bucket, position = _bit(key, bits)
    return df.groupBy(bucket.alias(_BUCKET)).agg(F.bitmap_construct_agg(position).alias(_BITS))


def united(filters: DataFrame) -> DataFrame:
    """The filter of all keys of several filters of one size."""
    return filters.groupBy(_BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))


def maybe_known(df: DataFrame, key: Column, known: DataFrame, name: str, bits: int = FILTER_BITS) -> DataFrame:
    """The frame with a boolean: False for rows whose key is surely in none of the united filters.

    The filter's size is bounded by ``bits``, so it is broadcast.
    """
    bucket, position = _bit(key, bits)
    placed = df.withColumns({_BUCKET: bucket, _POSITION: position}).join(F.broadcast(known), _BUCKET, "left")
    byte = F.conv(F.hex(F.substring(_BITS, F.expr(f"{_POSITION} div 8 + 1"), F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, F.col(_POSITION) % 8) == 1, F.lit(False))
    return placed.withColumn(name, hit).drop(_BUCKET, _POSITION, _BITS)
