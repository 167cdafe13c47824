"""Missing-value rules of the R verbs the workflow is defined in."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_known(test: Column, yes, no) -> Column:
    """Vector if/else whose unknown test gives NULL, not the else value."""
    return F.when(test, yes).when(~test, no)


def is_in(col: Column, values: Iterable) -> Column:
    """Membership that is never unknown; a ``None`` among the values means "is missing"."""
    values = list(values)
    present = [v for v in values if v is not None]
    hit = F.coalesce(col.isin(present), F.lit(False)) if present else F.lit(False)
    return hit | col.isNull() if len(present) < len(values) else hit


def paste(*cols: Column, sep: str = "") -> Column:
    """Concatenate, writing a missing value as the text ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def id_text(col: Column) -> Column:
    """Numeric id as text without a decimal part (39971.0 -> '39971')."""
    return col.cast("bigint").cast("string")


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)
