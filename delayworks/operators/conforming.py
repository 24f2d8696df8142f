"""Fitting a frame to a declared schema."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StructType

from delayworks.functions import column


def conform(df: DataFrame, schema: StructType, on_error: str = "fail") -> DataFrame:
    """Cast every declared column that is present; leave the others as they are.

    ``on_error="fail"`` casts by the session's ANSI rule (on by default, so a
    bad value ends the job); ``"null"`` turns bad values into NULL, numbers too
    that the declared type cannot hold exactly.
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    declared = {field.name: field.dataType for field in schema}

    def fitted(name: str, found: DataType) -> Column:
        value, wanted = column(name), declared.get(name, found)
        if wanted == found:
            return value
        cast = value.cast(wanted.simpleString()) if on_error == "fail" else _lenient_cast(value, found, wanted)
        return cast.alias(name)

    return df.select(*(fitted(field.name, field.dataType) for field in df.schema))


def rescue_columns(
    df: DataFrame, schema: StructType, rescue_col: str = "_rescued_data"
) -> DataFrame:
    """Exactly the declared columns, plus one JSON column for what does not fit.

    Values that cannot be cast without loss and columns that are not declared go into
    ``rescue_col``, which is NULL where nothing was rescued. Declared columns
    that are absent read as NULL. Read the input with the files' own schema
    first: a declared type that contradicts the file fails in the scan.
    """
    declared, rescued = [], []
    for field in schema:
        if field.name not in df.columns:
            declared.append(F.lit(None).cast(field.dataType.simpleString()).alias(field.name))
            continue
        raw, found = column(field.name), df.schema[field.name].dataType
        if found == field.dataType:
            declared.append(raw)
            continue
        typed = _lenient_cast(raw, found, field.dataType)
        declared.append(typed.alias(field.name))
        rescued.append(F.when(typed.isNull(), raw).alias(field.name))
    rescued += [column(c) for c in df.columns if c not in schema.names]
    if not rescued:
        return df.select(*declared, F.lit(None).cast("string").alias(rescue_col))
    packed = F.to_json(F.struct(*rescued))  # NULL fields are left out
    return df.select(*declared, F.nullif(packed, F.lit("{}")).alias(rescue_col))


def _lenient_cast(value: Column, found: DataType, wanted: DataType) -> Column:
    """``try_cast``, by way of a string for pairs of types Spark refuses to cast.

    A number becomes NULL where the cast back doesn't give it again; not-a-number stays where it can.
    """
    name = wanted.simpleString()
    if not (isinstance(found, NumericType) and isinstance(wanted, NumericType)):
        return value.cast("string").try_cast(name)
    typed = value.try_cast(name)
    return F.when(typed.try_cast(found.simpleString()).eqNullSafe(value), typed)
