"""Fix maps, and videos paired with fixes, exported and copied into group folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from collartrail.operators.layers import base_fixes, fix_layers, mappable_videos
from collartrail.operators.paths import MAX_VERTICES
from collartrail.operators.pairing import fill_cutoff, pair_videos
from collartrail.schemas import STUDY_END, STUDY_START
from collartrail.sources.deployments import known_animals
from collartrail.sources.sinks import (
    copy_manifest,
    copy_videos,
    write_layers,
    write_video_metadata,
)
from collartrail.sources.videos import list_videos


def organise(
    spark: SparkSession,
    fixes: DataFrame,
    deployments: DataFrame,
    out: str,
    video: bool = True,
    mortdata: bool = True,
    ids: Iterable[int] | DataFrame | None = None,
    begin=None,
    end=None,
    video_root: str | None = None,
    mounted: bool | None = None,
    videos: DataFrame | None = None,
    save_metadata: bool = False,
    subdivide: bool = False,
    as_of=None,
    study_start=STUDY_START,
    study_end=STUDY_END,
    max_vertices: int = MAX_VERTICES,
    by_span: bool = False,
) -> DataFrame:
    """Write the map layers below ``out`` and return them; with ``video``, pair the videos.

    Videos come from the files below ``video_root``, listed by the tasks unless it has the
    scheme of a store (``mounted`` says otherwise), or from ``videos``, a parsed listing. Base
    fixes are written once to ``out``. A path of more than ``max_vertices`` continues in rows.
    Pairs are written once to ``out``; the CSV (``save_metadata``), the layers and the copies
    into group folders (``subdivide``) read that table. ``by_span`` joins fixes and videos of a collar
    used again only to the deployment that ran at their time.
    """
    if subdivide and not video:
        raise ValueError("subdivide copies paired videos: it needs video=True")
    if video and video_root is None and (videos is None or subdivide):
        raise ValueError("video_root is needed to list or copy videos")
    dep = fill_cutoff(known_animals(deployments), as_of)
    made = base_fixes(fixes, dep, study_start, study_end, by_span)
    made.write.mode("overwrite").parquet(f"{out}/base")
    base = spark.read.schema(made.schema).parquet(f"{out}/base")
    shown = None
    if video:
        listed = videos if videos is not None else list_videos(spark, video_root, mounted)
        made = pair_videos(listed, fixes, dep, staged=True, by_span=by_span)
        made.write.mode("overwrite").parquet(f"{out}/pairs")
        pairs = spark.read.schema(made.schema).parquet(f"{out}/pairs")
        shown = mappable_videos(pairs, study_start, in_order=False)
        if save_metadata:
            write_video_metadata(pairs, f"{out}/video-metadata")
        if subdivide:
            copy_videos(copy_manifest(pairs, video_root), log=f"{out}/copy-log")
    layers = fix_layers(base, shown, ids, mortdata, begin, end, max_vertices)
    write_layers(layers, f"{out}/layers")
    return spark.read.parquet(f"{out}/layers").select(*layers.columns)
