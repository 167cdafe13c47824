"""Map content as rows: layer, kind, geometry and colour."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collartrail.functions.geo import CRS_LONGLAT, point_wkt
from collartrail.operators.copies import COPIES, expand_copies
from collartrail.operators.filters import (
    filter_fixes,
    select_collars,
    valid_longitude,
    with_phase,
)
from collartrail.operators.paths import MAX_VERTICES, movement_path
from collartrail.operators.spans import BEGIN, END, join_span, with_span
from collartrail.schemas import STUDY_END, STUDY_START

LAYER_COLUMNS = [
    "layer",
    "kind",
    "collar_id",
    "t_",
    "part",
    "geometry_wkt",
    "color",
    "crs",
]

_DEPLOYMENT = ["starttestingdate", "lastfixoutsidemortclust_UTC"]


def layer_points(df: DataFrame, layer: Column, color: Column, crs: str) -> DataFrame:
    """Point rows from (collar_id, t_, x_, y_); one per fix."""
    rows = df.select(
        layer.alias("layer"),
        F.lit("point").alias("kind"),
        "collar_id",
        "t_",
        F.lit(0).cast("bigint").alias("part"),
        point_wkt(F.col("x_"), F.col("y_")).alias("geometry_wkt"),
        color.alias("color"),
        F.lit(crs).alias("crs"),
        *[c for c in (COPIES,) if c in df.columns],
    )
    return expand_copies(rows) if COPIES in rows.columns else rows


def path_layers(
    df: DataFrame,
    group: str,
    layer: Column,
    color: Column,
    crs: str,
    max_vertices: int = MAX_VERTICES,
) -> DataFrame:
    """Line rows from (collar_id, ``group``, t_, x_, y_); one per path part of ``max_vertices``."""
    return movement_path(df, ["collar_id", group], max_vertices=max_vertices).select(
        layer.alias("layer"),
        F.lit("line").alias("kind"),
        "collar_id",
        F.col("t_begin").alias("t_"),
        "part",
        "geometry_wkt",
        color.alias("color"),
        F.lit(crs).alias("crs"),
    )


def base_fixes(
    fixes: DataFrame,
    deployments: DataFrame,
    study_start=STUDY_START,
    study_end=STUDY_END,
    by_span: bool = False,
) -> DataFrame:
    """Located fixes inside the study window with their deployments' cut-off.

    The filters sit below the join. The planner broadcasts deployments below its size limit;
    larger ones are shuffled. The join has a key column of its own, dropped afterwards: what
    follows then does not rest on the rows being together by collar, so AQE may split a
    collar that has too many. A collar deployed twice has each fix once per deployment,
    unless ``by_span`` asks for those deployments that ran at the fix's time. Rows are not sorted
    here; ``ordered`` gives the order where a result is to be looked at.
    """
    kept = filter_fixes(
        fixes.filter(valid_longitude()),
        study_start=study_start,
        study_end=study_end,
        coordinates=False,
    )
    if by_span:
        spans = with_span(deployments).select("collarid", BEGIN, END, *_DEPLOYMENT)
        keys, window = {"collar_id": "collarid"}, (study_start, study_end)
        joined = join_span(kept, spans, keys, "acquisitiontime", *window)
        return joined.withColumnRenamed("collar_id", "CollarID")
    dep = deployments.select(
        F.col("collarid").alias("_key"),
        *_DEPLOYMENT,
    )
    # missing equals missing
    same = F.col("_collar").eqNullSafe(F.col("_key"))
    joined = kept.withColumn("_collar", F.col("collar_id")).join(dep, same, "left").drop("_key", "_collar")
    return joined.withColumnRenamed("collar_id", "CollarID")


def ordered(df: DataFrame, collar: str = "CollarID", t: str = "acquisitiontime") -> DataFrame:
    """Sort by collar and time, missing values last."""
    return df.orderBy(F.col(collar).asc_nulls_last(), F.col(t).asc_nulls_last())


def mappable_videos(pairs: DataFrame, study_start=STUDY_START, in_order: bool = True) -> DataFrame:
    """Paired videos from the study start on; unpaired ones have no time.

    In order unless that is turned off: a full sort is for looking at, not for layers.
    """
    kept = filter_fixes(pairs, study_start=study_start, study_end=None, coordinates=False)
    return ordered(kept) if in_order else kept


def fix_layers(
    base: DataFrame,
    videos: DataFrame | None = None,
    ids: Iterable | DataFrame | None = None,
    mortdata: bool = True,
    begin=None,
    end=None,
    max_vertices: int = MAX_VERTICES,
) -> DataFrame:
    """Rows of the fix map: points and paths by phase, and paired videos if given.

    ``mortdata`` adds the post-mortality layers. ``ids`` and ``begin``..``end`` narrow the
    map; without them all collars and times are included. A path of more than
    ``max_vertices`` fixes continues in further rows.
    """
    window = {"study_end": None, "begin": begin, "end": end}
    fixes = with_phase(filter_fixes(base.withColumnRenamed("CollarID", "collar_id"), ids, **window))
    phases = ["pre", "post"] if mortdata else ["pre"]
    track = fixes.filter(F.col("phase").isin(phases)).select(
        "collar_id",
        "phase",
        F.col("acquisitiontime").alias("t_"),
        F.col("longitude").alias("x_"),
        F.col("latitude").alias("y_"),
        *[c for c in (COPIES,) if c in fixes.columns],
    )
    color = F.when(F.col("phase") == "pre", "darkgreen").otherwise("red")
    name = F.concat(F.col("phase"), F.lit("mort_"))
    layers = layer_points(track, F.concat(name, F.lit("points")), color, CRS_LONGLAT).unionByName(
        path_layers(track, "phase", F.concat(name, F.lit("path")), color, CRS_LONGLAT, max_vertices)
    )
    if videos is None:
        return layers
    paired = (
        filter_fixes(videos, **window)
        .filter(F.col("status") == "Successful")
        .filter(F.col("coordinates").isin("Approximate", "Exact"))
        .select(
            F.col("CollarID").try_cast("bigint").alias("collar_id"),
            F.col("acquisitiontime").alias("t_"),
            F.col("longitude").alias("x_"),
            F.col("latitude").alias("y_"),
            "coordinates",
        )
    )
    if ids is not None:
        paired = select_collars(paired, ids)
    exact = F.col("coordinates") == "Exact"
    return layers.unionByName(
        layer_points(
            paired,
            F.when(exact, "videos_exact").otherwise("videos_approximate"),
            F.when(exact, "purple").otherwise("orange"),
            CRS_LONGLAT,
        )
    )
