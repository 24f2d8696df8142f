"""NULL filling, clamping and flagging; projections only, no shuffle."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from delayworks.functions import at_least, clamped


def fill_nulls(df: DataFrame, cols: Sequence[str], value: float = 0) -> DataFrame:
    """Replace NULL and NaN in the named numeric columns."""
    return df.na.fill(value, list(cols))


def clamp_min(df: DataFrame, cols: Sequence[str], floor: float = 0) -> DataFrame:
    """Raise values below ``floor`` to it, keeping each column's type."""
    return df.withColumns({c: clamped(c, floor, df.schema[c].dataType) for c in cols})


def flag_at_least(df: DataFrame, col: str, threshold: float, name: str) -> DataFrame:
    """Add a 0/1 column telling whether ``col`` reaches ``threshold``."""
    return df.withColumn(name, at_least(col, threshold))
