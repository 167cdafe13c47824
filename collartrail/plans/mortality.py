"""Mortality review in two jobs, split where a person looks at the result.

``review`` finds end clusters and writes candidates with their map layers; after someone has
put the right ones into a table of accepted collars, ``record`` updates the deployments.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from collartrail.operators.filters import filter_fixes
from collartrail.operators.mortality import apply_mortality, mortality_layers
from collartrail.operators.paths import MAX_VERTICES
from collartrail.operators.tracks import (
    flag_defunct_clusters,
    make_track,
    mortality_dates,
    project_utm,
)
from collartrail.schemas import STUDY_END
from collartrail.sources.deployments import write_deployments
from collartrail.sources.sinks import write_layers


@dataclass(frozen=True)
class ClusterRule:
    """Largest step (metres), fewest steps and shortest duration (hours) of a cluster."""

    zeta: float
    eta: int
    theta_hours: float


def flag_fixes(
    fixes: DataFrame,
    rule: ClusterRule,
    ids: Iterable[int] | DataFrame | None = None,
    start=None,
    removed=None,
    study_end=STUDY_END,
    zone: int = 12,
    scope: str = "terminal",
) -> DataFrame:
    """Fixes of the chosen collars as a flagged track in UTM metres."""
    kept = filter_fixes(fixes, ids, start=start, study_end=study_end, removed=removed)
    # projected last: a filter on projected columns would compute them twice
    track = project_utm(make_track(kept), "x_", "y_", zone)
    return flag_defunct_clusters(track, rule.zeta, rule.eta, rule.theta_hours, scope)


def review(
    fixes: DataFrame,
    rule: ClusterRule,
    out: str,
    zone: int = 12,
    max_vertices: int = MAX_VERTICES,
    **choice,
) -> DataFrame:
    """Write ``flagged``, ``dates`` and ``layers`` below ``out``; return the dates.

    A path of more than ``max_vertices`` fixes continues in further rows.

    The flagged track is computed once; dates and layers read what was written.
    """
    spark = fixes.sparkSession
    made = flag_fixes(fixes, rule, zone=zone, **choice)
    made.write.mode("overwrite").parquet(f"{out}/flagged")
    flagged = spark.read.schema(made.schema).parquet(f"{out}/flagged")
    dates = mortality_dates(flagged)
    dates.write.mode("overwrite").parquet(f"{out}/dates")
    dates = spark.read.schema(dates.schema).parquet(f"{out}/dates")
    write_layers(mortality_layers(flagged, dates, zone, max_vertices), f"{out}/layers")
    return dates


def record(
    deployments: DataFrame,
    dates: DataFrame,
    accepted: DataFrame,
    rule: ClusterRule,
    out: str,
    fmt: str = "parquet",
) -> DataFrame:
    """Write the deployment table with the accepted results to the new folder ``out``."""
    updated = apply_mortality(deployments, dates, accepted, rule.zeta, rule.eta, rule.theta_hours)
    write_deployments(updated, out, fmt)
    return updated
