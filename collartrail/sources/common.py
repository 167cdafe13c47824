"""Typed reading of columnar and text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collartrail.functions.nulls import nan_to_null

def load(spark: SparkSession, path: str, fmt: str, names: Sequence[str]) -> DataFrame:
    """Open a folder or file. Text formats are read as text, without an inference pass."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path)
    if fmt == "json":
        text = T.StructType([T.StructField(name, T.StringType()) for name in names])
        return spark.read.schema(text).json(path)
    return spark.read.format(fmt).load(path)


def to_schema(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to ``schema``; text that does not parse becomes NULL, a missing column is an error.

    Columns named in ``keep`` are passed on as they are if present; others are dropped.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[_typed(F.col(f.name), kinds[f.name], f.dataType).alias(f.name) for f in schema.fields],
        *[c for c in keep if c in df.columns],
    )


def _typed(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.DoubleType):
        return nan_to_null(col if have == want else col.try_cast(want))
    if have == want:
        return col
    if isinstance(want, (T.LongType, T.IntegerType)) and isinstance(have, T.StringType):
        # "39971.0" is a whole number too
        return F.coalesce(col.try_cast(want), col.try_cast("double").try_cast(want))
    return col.try_cast(want)


def times_as_text(df: DataFrame) -> DataFrame:
    """Times as ``2024-01-28 15:00:38``, with a fraction only where there is one."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("string") for c in times})
