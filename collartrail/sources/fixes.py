"""Landed GPS fixes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collartrail.functions.timeutil import at, parse_iso
from collartrail.operators.copies import COPIES
from collartrail.operators.filters import select_collars
from collartrail.schemas import FETCH_START, FIXES
from collartrail.sources.archive import DAY, is_archive, land, read_archive
from collartrail.sources.common import load, to_schema


def read_fixes(
    spark: SparkSession, path: str, fmt: str = "parquet", start: str = FETCH_START, end=None
) -> DataFrame:
    """Fixes acquired from ``start`` on and, if given, before ``end``.

    ``idcollar`` is accepted as the name of the collar column. On a table written by
    ``land_fixes`` the bounds also select the day folders; Spark does not skip row groups
    by a zoneless time alone. A ``copies`` column is kept.
    """
    if fmt == "parquet" and is_archive(spark, path):
        # only folders of days within the bounds are opened
        df = read_archive(spark, path, F.to_date(at(start)), F.to_date(at(end)) if end is not None else None)
    else:
        df = load(spark, path, fmt, [*FIXES.names, "idcollar"])
    if "idcollar" in df.columns:
        named = [F.col(c) for c in ("collar_id", "idcollar") if c in df.columns]
        df = df.withColumn("collar_id", F.coalesce(*named))
    if dict(df.dtypes).get("acquisitiontime") == "string":
        df = df.withColumn("acquisitiontime", parse_iso(F.col("acquisitiontime")))
    if DAY in df.columns:
        df = df.filter(F.col(DAY) >= F.to_date(at(start)))
        df = df.filter(F.col(DAY) <= F.to_date(at(end))) if end is not None else df
    fixes = to_schema(df, FIXES, keep=[COPIES]).filter(F.col("acquisitiontime") >= at(start))
    return fixes.filter(F.col("acquisitiontime") < at(end)) if end is not None else fixes


def land_fixes(fixes: DataFrame, out: str, batch: str | None = None) -> bool:
    """Add downloaded fixes to an archive by day, each distinct one once with its ``copies``.

    A batch counts once, however often it is landed: by its name, or without one by its content. Only
    the days downloaded are written again, as a version that readers see when the landing is complete.
    Overlapping downloads cost nothing later on: operators that merge copies take such a table as it is.
    Returns whether there was something to land.
    """
    return land(fixes, out, batch)


def select_sources(fixes: DataFrame, ids: Iterable[int] | DataFrame) -> DataFrame:
    """Fixes of the given collars. Ids are compared whole: 399 does not match 39971."""
    return select_collars(fixes, ids)
