"""Tracks, non-movement runs and the clusters that mark a dead or dropped collar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collartrail.functions.geo import utm
from collartrail.functions.timeutil import hours
from collartrail.operators.copies import COPIES
from collartrail.operators.ordered import XYT, with_runs, with_step


def project_utm(
    df: DataFrame, lon: str = "longitude", lat: str = "latitude", zone: int = 12
) -> DataFrame:
    """Replace degrees by UTM metres in the same two columns."""
    east, north = utm(F.col(lon), F.col(lat), zone)
    return df.withColumns({lon: east, lat: north})


def make_track(
    df: DataFrame,
    x: str = "longitude",
    y: str = "latitude",
    t: str = "acquisitiontime",
    id: str = "collar_id",
) -> DataFrame:
    """(collar_id, t_, x_, y_); fixes without both coordinates or a time are left out."""
    cols = [F.col(id).alias("collar_id"), F.col(t).alias("t_"), F.col(x).alias("x_"), F.col(y).alias("y_")]
    if COPIES in df.columns:
        cols.append(F.col(COPIES))
    return df.select(*cols).filter(
        F.col("t_").isNotNull() & F.col("x_").isNotNull() & F.col("y_").isNotNull()
    )


def step_lengths(track: DataFrame) -> DataFrame:
    """Distance of each fix from the one before it (NULL for the first of a collar).

    A row stands for ``copies`` identical fixes; the further ones have step 0.
    """
    return with_step(track)


def nonmovement_runs(track: DataFrame, zeta: float) -> DataFrame:
    """Number the runs of fixes at most ``zeta`` apart; see ``with_runs``."""
    return with_runs(track, zeta)


def run_stats(runs: DataFrame) -> DataFrame:
    """One row per run: number of steps, first and last time."""
    return (
        runs.groupBy("collar_id", "run")
        .agg(
            (F.sum(COPIES) - 1).alias("steps"),
            F.min("t_").alias("run_begin"),
            F.max("t_").alias("run_end"),
        )
    )


def flag_defunct_clusters(
    track: DataFrame,
    zeta: float,
    eta: int,
    theta_hours: float,
    scope: str = "terminal",
) -> DataFrame:
    """Mark the fixes of non-movement clusters.

    A run of at least ``eta`` steps lasting at least ``theta_hours`` is a cluster; all its
    fixes but the anchor are flagged. ``scope='terminal'`` looks only at each collar's last
    run, ``'all'`` at every run. Distances and times compare inclusively, and the duration
    counts from the anchor.
    """
    if scope not in ("terminal", "all"):
        raise ValueError(f"scope must be 'terminal' or 'all', not {scope!r}")
    runs = with_runs(track, zeta)
    cluster = (F.col("run_fixes") - 1 >= eta) & (
        F.col("run_end") - F.col("run_begin") >= hours(theta_hours)
    )
    if scope == "terminal":
        cluster = F.col("is_last_run") & cluster
    runs = runs.withColumn("_cluster", F.coalesce(cluster, F.lit(False)))
    # the first of several identical anchor fixes is the anchor, the others follow it
    one, others = F.lit(1).cast("bigint"), F.col(COPIES) - 1
    split = F.array(
        F.struct(F.lit(False).alias("flag"), one.alias("n")),
        F.struct(F.lit(True).alias("flag"), others.alias("n")),
    )
    whole = F.array(
        F.struct((F.col("_cluster") & ~F.col("anchor")).alias("flag"), F.col(COPIES).alias("n"))
    )
    parts = F.when(F.col("_cluster") & F.col("anchor") & (others > 0), split).otherwise(whole)
    return runs.withColumn("_part", F.explode(parts)).select(
        "collar_id",
        *XYT,
        F.col("_part.flag").alias("defunct_cluster_"),
        F.col("_part.n").alias(COPIES),
    )


def mortality_dates(flagged: DataFrame) -> DataFrame:
    """Per collar: last live fix, first and last fix in the end cluster.

    ``firstfixinendclust`` is the latest unflagged time, ``lastlivefix`` the one before it,
    ``lastfixinendclust`` the latest flagged time.
    """
    w = Window.partitionBy("collar_id", "defunct_cluster_").orderBy(F.col("t_").desc())
    latest, flag = F.col("_rank") == 1, F.col("defunct_cluster_")
    # two times per collar and flag leave each task
    return (
        flagged.select("collar_id", "t_", "defunct_cluster_")
        .withColumn("_rank", F.dense_rank().over(w))
        .filter(F.col("_rank") <= 2)
        .groupBy("collar_id")
        .agg(
            F.max(F.when(~flag & ~latest, F.col("t_"))).alias("lastlivefix"),
            F.max(F.when(~flag & latest, F.col("t_"))).alias("firstfixinendclust"),
            F.max(F.when(flag & latest, F.col("t_"))).alias("lastfixinendclust"),
            F.max(flag).alias("has_cluster"),
        )
    )
