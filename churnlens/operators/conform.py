"""Bring a frame to a declared schema: by name, in schema order, typed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


INTEGRAL_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns by name, in its order, cast to its types.

    A missing column raises. Casts to an integer type from text or a
    fractional type round half to even first (``'25.0'`` -> 25), the way a
    float column is inserted into an INTEGER column; other casts are plain
    ANSI casts, so malformed text raises instead of loading as NULL. A value
    that is NaN or out of an integer type's range raises with ANSI mode on or off.
    Columns not in the schema are dropped.
    """
    source = df.schema  # fetched once: each call is a round trip to the JVM
    missing = [f.name for f in schema.fields if f.name not in source.names]
    if missing:
        raise ValueError(f"missing columns for schema: {missing}")
    return df.select(
        *[
            cast_to(F.col(f.name), source[f.name].dataType, f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def cast_to(col: Column, src_type: T.DataType, dst_type: T.DataType) -> Column:
    """The cast :func:`conform` applies to one column."""
    if src_type == dst_type:
        return col
    if isinstance(dst_type, T.IntegralType) and isinstance(src_type, (T.StringType, T.FractionalType)):
        rounded = F.rint(col.cast("double"))
        edge = 2.0 ** (INTEGRAL_BITS[type(dst_type)] - 1)
        # without ANSI mode a cast would turn NaN into 0 and cut what is out of range
        outside = F.isnan(rounded) | (rounded < -edge) | (rounded >= edge)
        message = F.concat(F.lit(f"value does not fit {dst_type.simpleString()}: "), col.cast("string"))
        checked = F.when(outside, F.raise_error(message)).otherwise(rounded).cast(dst_type)
        if isinstance(src_type, T.StringType):
            return F.coalesce(col.try_cast(dst_type), checked)  # large ids do not pass through a double
        return checked
    return col.cast(dst_type)


def try_cast_text(col: Column, dst_type: T.DataType) -> Column:
    """Text as ``dst_type`` by the rules of :func:`cast_to`; NULL, not an error, where it does not fit."""
    if not isinstance(dst_type, T.IntegralType):
        return col.try_cast(dst_type)
    rounded = F.rint(col.try_cast("double"))
    edge = 2.0 ** (INTEGRAL_BITS[type(dst_type)] - 1)
    inside = ~F.isnan(rounded) & (rounded >= -edge) & (rounded < edge)
    return F.coalesce(col.try_cast(dst_type), F.when(inside, rounded).cast(dst_type))
