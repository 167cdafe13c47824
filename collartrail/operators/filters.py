"""Row selections on fixes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collartrail.functions.timeutil import at
from collartrail.schemas import MAX_COORDINATE, STUDY_END, STUDY_START


def has_coordinate(lon: str = "longitude", lat: str = "latitude") -> Column:
    """Either coordinate is present (one may be missing)."""
    return F.col(lon).isNotNull() | F.col(lat).isNotNull()


def valid_longitude(lon: str = "longitude") -> Column:
    """Longitude present and not a placeholder."""
    return F.col(lon) <= MAX_COORDINATE


def select_collars(df: DataFrame, ids: Iterable[int] | DataFrame, col: str = "collar_id") -> DataFrame:
    """Rows of the given collars, by exact id: a short list or a DataFrame of ids."""
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(col))
        return df.join(wanted, col, "left_semi")
    return df.filter(F.col(col).isin(list(ids)))


def before_removal(df: DataFrame, removed: DataFrame, t: str = "acquisitiontime") -> DataFrame:
    """Drop fixes at or after a collar's removal time; collars without one keep all."""
    cut = removed.filter(F.col("removed_at").isNotNull()).select(
        F.col("collar_id").alias("_collar"), "removed_at"
    )
    late = (F.col(t) >= F.col("removed_at")) | F.col(t).isNull()
    return df.join(cut, (F.col("collar_id") == F.col("_collar")) & late, "left_anti")


def filter_fixes(
    df: DataFrame,
    ids: Iterable[int] | DataFrame | None = None,
    start=None,
    study_start=None,
    study_end=STUDY_END,
    removed=None,
    begin=None,
    end=None,
    coordinates: bool = True,
    t: str = "acquisitiontime",
) -> DataFrame:
    """All fix selections in one; a bound given as ``None`` is not applied.

    ``start`` and ``study_start`` are inclusive, ``study_end`` and ``removed`` exclusive,
    ``begin``..``end`` closed. ``removed`` is one time for all, or a table
    (collar_id, removed_at).
    """
    time = F.col(t)
    keep = []
    if start is not None:
        keep.append(time >= at(start))
    if study_start is not None:
        keep.append(time >= at(study_start))
    if study_end is not None:
        keep.append(time < at(study_end))
    if begin is not None:
        keep.append(time >= at(begin))
    if end is not None:
        keep.append(time <= at(end))
    if removed is not None and not isinstance(removed, DataFrame):
        keep.append(time < at(removed))
    if coordinates:
        keep.append(has_coordinate())
    for test in keep:
        df = df.filter(test)
    if ids is not None:
        df = select_collars(df, ids)
    if isinstance(removed, DataFrame):
        df = before_removal(df, removed, t)
    return df


def phase(t: str = "acquisitiontime", cutoff: str = "lastfixoutsidemortclust_UTC") -> Column:
    """``pre`` up to and including the cut-off, ``post`` after it, NULL if unknown."""
    return F.when(F.col(t) <= F.col(cutoff), "pre").when(F.col(t) > F.col(cutoff), "post")


def with_phase(df: DataFrame, t: str = "acquisitiontime") -> DataFrame:
    return df.withColumn("phase", phase(t))


__all__ = [
    "STUDY_END",
    "STUDY_START",
    "before_removal",
    "filter_fixes",
    "has_coordinate",
    "phase",
    "select_collars",
    "valid_longitude",
    "with_phase",
]
