"""Reviewed mortality results onto the deployment table, and the review map's layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collartrail.functions.geo import crs_utm
from collartrail.operators.copies import COPIES
from collartrail.operators.layers import layer_points, path_layers
from collartrail.operators.ordered import XYT
from collartrail.operators.paths import MAX_VERTICES

DATES = ["lastlivefix", "firstfixinendclust", "lastfixinendclust"]


def apply_mortality(
    deployments: DataFrame,
    dates: DataFrame,
    accepted: DataFrame,
    zeta: float,
    eta: int,
    theta_hours: float,
) -> DataFrame:
    """Write the dates and parameters of accepted collars into their deployment rows.

    ``accepted`` (collar_id, cause, removed_at) holds the collars a reviewer has confirmed;
    ``removed_at`` is stored where given. Of several rows of one collar the one removed last
    counts, then the first cause. Accepted collars without a row in ``dates``, and all rows of
    other collars, stay as they are.
    """
    # least of (not removed, later removals first, cause): one row per collar in one aggregate
    order = F.struct(
        F.col("removed_at").isNull().alias("open"),
        (-F.unix_micros(F.col("removed_at").cast("timestamp"))).alias("late"),
        F.col("cause").alias("cause"),
        F.col("removed_at").alias("at"),
    )
    update = (
        accepted.groupBy("collar_id")
        .agg(F.min(order).alias("_one"))
        .select(
            "collar_id", F.col("_one.cause").alias("_cause"), F.col("_one.at").alias("_removed_at")
        )
        .join(dates.select("collar_id", *[F.col(c).alias(f"_{c}") for c in DATES]), "collar_id")
        .withColumnRenamed("collar_id", "_collar_id")
    )
    hit = F.col("_collar_id").isNotNull()
    new = {
        **{c: F.col(f"_{c}") for c in DATES},
        "fate": F.lit(1),
        "zeta_m": F.lit(float(zeta)),
        "eta_fixes": F.lit(int(eta)),
        "theta_hr": F.lit(float(theta_hours)),
        "cause": F.col("_cause"),
    }
    removed = {
        "beginremoved_UTC": F.coalesce("_removed_at", "beginremoved_UTC"),
    }
    joined = deployments.join(update, F.col("collarid") == F.col("_collar_id"), "left")
    values = {c: F.when(hit, v).otherwise(F.col(c)).alias(c) for c, v in {**new, **removed}.items()}
    return joined.select(*[values.get(c, F.col(c)) for c in deployments.columns])


def dates_as_cutoff(deployments: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """Optional link from the mortality results to the video side's cut-off.

    Fills ``lastfixoutsidemortclust_UTC`` from ``lastlivefix`` where it is missing.
    """
    columns = columns or {"lastlivefix": "lastfixoutsidemortclust_UTC"}
    return deployments.withColumns({to: F.coalesce(to, src) for src, to in columns.items()})


def last_live_points(fixes: DataFrame, dates: DataFrame, t: str = "t_") -> DataFrame:
    """Fixes taken at their collar's last live time (none where that is unknown)."""
    live = dates.select("collar_id", F.col("lastlivefix").alias(t)).filter(F.col(t).isNotNull())
    return fixes.join(live, ["collar_id", t], "left_semi")


def mortality_layers(
    flagged: DataFrame, dates: DataFrame, zone: int = 12, max_vertices: int = MAX_VERTICES
) -> DataFrame:
    """Rows of the review map: fixes by flag, last live fix, live and post-mortem path."""
    flag = F.col("defunct_cluster_")
    points = layer_points(
        flagged,
        layer=F.when(flag, "defunct_points").otherwise("live_points"),
        color=F.when(flag, "red").otherwise("darkgreen"),
        crs=crs_utm(zone),
    )
    last = layer_points(
        last_live_points(flagged.select("collar_id", *XYT, COPIES), dates),
        layer=F.lit("last_live_point"),
        color=F.lit("purple"),
        crs=crs_utm(zone),
    )
    paths = path_layers(
        flagged,
        "defunct_cluster_",
        layer=F.when(flag, "post_mortem_path").otherwise("live_path"),
        color=F.when(flag, "red").otherwise("darkgreen"),
        crs=crs_utm(zone),
        max_vertices=max_vertices,
    )
    return points.unionByName(last).unionByName(paths)
