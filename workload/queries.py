"""One query per operator; each takes (spark, sf_dir) and reads the whole tables."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collartrail.functions import geo, nulls
from collartrail.functions import timeutil as tu
from collartrail.operators import copies, filters, groups, layers, mortality, pairing, paths, tracks
from collartrail.plans.mortality import ClusterRule, review
from collartrail.plans.videos import organise
from collartrail.schemas import VIDEO_PAIR_COLUMNS
from collartrail.session import new_folder, stage
from collartrail.sources import archive
from collartrail.sources import deployments as dep_io
from collartrail.sources import fixes as fix_io
from collartrail.sources import sinks
from collartrail.sources import videos as video_io
from workload import views

ZETA, ETA, THETA = 40.0, 2, 6.0
BEGIN, END = "2024-01-05 06:00:00", "2024-01-25 18:00:00"
STUDY = {"study_start": views.STUDY_START, "study_end": views.STUDY_END}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- inputs -----------------------------------------------------------------------------


def _deployments(spark: SparkSession, d: str) -> DataFrame:
    return pairing.fill_cutoff(views.deployments(spark, d), views.AS_OF)


def _videos(spark: SparkSession, d: str) -> DataFrame:
    return video_io.parse_video_paths(views.video_paths(spark, d), views.ROOT)


def _flagged(spark: SparkSession, d: str, scope: str = "terminal") -> DataFrame:
    return tracks.flag_defunct_clusters(views.fixes_xy(spark, d), ZETA, ETA, THETA, scope)


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return pairing.pair_videos(_videos(spark, d), views.fixes(spark, d), _deployments(spark, d))


# --- filters ----------------------------------------------------------------------------


@query
def select_collars(spark, d):
    ids = views.deployments(spark, d).select("collarid")
    return fix_io.select_sources(views.fixes(spark, d), ids)


@query
def fixes_window(spark, d):
    return filters.filter_fixes(
        views.fixes(spark, d), start="2024-01-02T00:00:01", begin=BEGIN, end=END, **STUDY
    )


@query
def has_coordinate(spark, d):
    return views.fixes(spark, d).filter(filters.has_coordinate())


@query
def valid_longitude(spark, d):
    return views.fixes(spark, d).filter(filters.valid_longitude())


@query
def before_removal(spark, d):
    removed = views.deployments(spark, d).select(
        F.col("collarid").alias("collar_id"),
        F.col("lastfixoutsidemortclust_UTC").alias("removed_at"),
    )
    return filters.filter_fixes(views.fixes(spark, d), removed=removed)


@query
def known_animals(spark, d):
    dep = views.deployments(spark, d).withColumn(
        "animalid", F.when(F.col("sex") != "BUILDING", F.col("animalid"))
    )
    return dep_io.known_animals(dep).select("animalid", "collarid", "sex")


# --- scalar functions -------------------------------------------------------------------


@query
def time_functions(spark, d):
    ts = F.col("acquisitiontime")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    plain = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    hour = tu.hour_of(ts)
    return views.fixes(spark, d).select(
        "collar_id",
        ts,
        tu.parse_iso(iso).alias("from_iso"),
        tu.parse_iso(plain).alias("from_wrong_layout"),
        tu.parse_plain(plain).alias("from_plain"),
        tu.date_of(ts).alias("day"),
        hour.alias("hour"),
        tu.make_time(F.year(ts), F.month(ts), F.day(ts), hour, F.minute(ts), F.lit(30)).alias("built"),
        tu.make_time(F.year(ts), F.lit(13), F.day(ts), hour, F.minute(ts), F.lit(30)).alias("impossible"),
        (ts + tu.hours(F.col("temperature") / 4)).alias("later"),
        tu.to_day(plain).alias("day_from_text"),
    )


@query
def text_functions(spark, d):
    props, kind = F.col("props"), F.col("event_type")
    number = F.when(kind != "error", F.col("value"))
    return spark.read.parquet(f"{d}/events.parquet").select(
        "event_id",
        nulls.id_text(F.col("user_id").cast("double")).alias("id_text"),
        tu.to_number(F.regexp_replace(props, "[^0-9]", "")).alias("number_in_text"),
        tu.to_number(kind).alias("no_number"),
        nulls.paste(F.col("user_id"), F.when(kind != "error", kind), sep="/").alias("pasted"),
        nulls.if_known(number > 20, "Yes", "No").alias("over_20"),
        nulls.is_in(F.when(kind != "error", kind), ["view", "click"]).alias("is_view_or_click"),
        nulls.is_in(F.when(kind != "error", kind), ["view", None]).alias("is_view_or_missing"),
        F.replace(props, F.lit(": "), F.lit("/")).alias("replaced"),
        props.contains("9").alias("has_9"),
    )


@query
def approx_hour(spark, d):
    return _videos(spark, d).select(
        "AnimalID",
        "TimeStamp_UTC",
        tu.approx_hour(F.col("Hour"), F.col("Minute")).alias("Hour2"),
    )


# --- tracks and clusters ----------------------------------------------------------------


@query
def make_track(spark, d):
    return tracks.make_track(views.fixes(spark, d))


@query
def step_lengths(spark, d):
    steps = tracks.step_lengths(views.fixes_xy(spark, d))
    return steps.withColumn("step", F.round("step", 6))


@query
def nonmovement_runs(spark, d):
    return tracks.nonmovement_runs(views.fixes_xy(spark, d), ZETA).withColumn(
        "step", F.round("step", 6)
    )


@query
def run_stats(spark, d):
    return tracks.run_stats(tracks.nonmovement_runs(views.fixes_xy(spark, d), ZETA))


@query
def defunct_flags_terminal(spark, d):
    return _flagged(spark, d)


@query
def defunct_flags_all(spark, d):
    return _flagged(spark, d, "all")


@query
def mortality_dates(spark, d):
    return tracks.mortality_dates(_flagged(spark, d))


@query
def mortality_from_fixes(spark, d):
    """From raw fixes to dates: window, projection, track, clusters."""
    kept = filters.filter_fixes(views.fixes(spark, d), **STUDY)
    track = tracks.project_utm(tracks.make_track(kept), "x_", "y_")
    return tracks.mortality_dates(tracks.flag_defunct_clusters(track, 30_000.0, 2, 6.0))


@query
def latest_per_flag(spark, d):
    keys = ["collar_id", "defunct_cluster_"]
    return groups.latest_per_group(_flagged(spark, d), keys, "t_")


@query
def second_latest(spark, d):
    keys = ["collar_id", "defunct_cluster_"]
    return groups.latest_per_group(_flagged(spark, d), keys, "t_", rank=2)


@query
def last_live_point(spark, d):
    track = views.fixes_xy(spark, d)
    return mortality.last_live_points(track, tracks.mortality_dates(_flagged(spark, d)))


@query
def apply_mortality(spark, d):
    dates = stage(tracks.mortality_dates(_flagged(spark, d)), "dates")  # read twice
    return mortality.apply_mortality(
        views.deployments(spark, d), dates, _accepted(dates), ZETA, ETA, THETA
    )


def _accepted(dates: DataFrame) -> DataFrame:
    last = F.col("lastfixinendclust")
    return dates.filter("has_cluster").select(
        "collar_id",
        F.lit("cougar").alias("cause"),
        F.when(last < tu.at("2024-01-30 12:00:00"), last).alias("removed_at"),
    )


@query
def merged_copies(spark, d):
    coarse = views.fixes(spark, d).select(
        "collar_id", tu.date_of(F.col("acquisitiontime")).alias("day"), "longitude"
    )
    return copies.merge_copies(coarse)


@query
def expanded_copies(spark, d):
    return copies.expand_copies(merged_copies(spark, d))


# --- geometry ---------------------------------------------------------------------------


@query
def utm_projection(spark, d):
    east, north = geo.utm(F.col("longitude"), F.col("latitude"))
    return views.fixes(spark, d).select(
        "collar_id",
        "acquisitiontime",
        F.round(east, 3).alias("easting"),
        F.round(north, 3).alias("northing"),
    )


@query
def fix_points(spark, d):
    points = paths.as_points(views.fixes(spark, d), "longitude", "latitude", geo.CRS_LONGLAT)
    return points.select("collar_id", "acquisitiontime", "geometry_wkt", "crs")


@query
def movement_paths(spark, d):
    return paths.movement_path(
        views.fixes(spark, d), x="longitude", y="latitude", order_by="acquisitiontime"
    )


@query
def movement_path_parts(spark, d):
    """Paths in parts of five vertices."""
    return paths.movement_path(
        views.fixes(spark, d),
        x="longitude",
        y="latitude",
        order_by="acquisitiontime",
        max_vertices=5,
    )


# --- fixes with deployments -------------------------------------------------------------


def _base(spark: SparkSession, d: str) -> DataFrame:
    return layers.base_fixes(views.fixes(spark, d), _deployments(spark, d), **STUDY)


@query
def base_fixes(spark, d):
    return _base(spark, d)


@query
def base_fixes_by_span(spark, d):
    """Fixes with the deployment of their collar that was running, if one was."""
    return layers.base_fixes(views.fixes(spark, d), _removed(spark, d), by_span=True, **STUDY)


def _removed(spark: SparkSession, d: str) -> DataFrame:
    """Deployments of which some were removed, before or after the collar's next one began."""
    days = F.when(F.col("sex") == "BUILDING", 4).when(F.col("sex") == "MACHINERY", 14)
    removed = F.date_add("starttestingdate", days).cast("timestamp_ntz") + tu.hours(11.5)
    begin = F.when(F.col("sex") != "FURNITURE", F.col("starttestingdate"))
    return _deployments(spark, d).withColumns(
        {"beginremoved_UTC": removed, "starttestingdate": begin}
    )


@query
def base_fixes_ordered(spark, d):
    return layers.ordered(_base(spark, d)).select("CollarID", "acquisitiontime", "longitude")


@query
def fixes_by_phase(spark, d):
    return filters.with_phase(_base(spark, d)).select("CollarID", "acquisitiontime", "phase")


@query
def fill_cutoff(spark, d):
    return _deployments(spark, d).select("animalid", "collarid", "lastfixoutsidemortclust_UTC")


# --- videos -----------------------------------------------------------------------------


@query
def parse_video_paths(spark, d):
    return _videos(spark, d)


@query
def life_phase(spark, d):
    return pairing.with_deployment(_videos(spark, d), _deployments(spark, d)).select(
        "AnimalID",
        "TimeStamp_UTC",
        "directoryname",
        "livevideoprerelease",
        "livevideopostrelease",
        "mortvideo",
    )


@query
def life_phase_by_span(spark, d):
    """The same with the deployment that was running at the video's time."""
    study = {"lower": views.STUDY_START, "upper": views.STUDY_END}
    known = pairing.with_deployment(_videos(spark, d), _removed(spark, d), by_span=True, **study)
    return known.select(
        "AnimalID", "CollarID", "TimeStamp_UTC", "directoryname", "sex", "starttestingdate",
        "livevideoprerelease", "livevideopostrelease", "mortvideo",
    )


@query
def earliest_fixes(spark, d):
    """The fix each (collar, date, hour) is paired with, ties kept."""
    slots = pairing.earliest_fixes(views.fixes(spark, d))
    columns = [F.col("_collar").alias("collar_id"), "acquisitiontime", "longitude", "latitude"]
    return copies.expand_copies(slots.select(*columns, copies.COPIES))


@query
def earliest_keep_ties(spark, d):
    """Earliest located time per collar, a fix without longitude having an unknown time."""
    fixes = views.fixes(spark, d).select(
        "collar_id",
        tu.date_of(F.col("acquisitiontime")).alias("day"),
        F.when(F.col("longitude").isNotNull(), F.col("acquisitiontime")).alias("located_at"),
        "height",
    )
    return groups.earliest_keep_ties(fixes, ["collar_id", "day"], "located_at")


@query
def pair_exact(spark, d):
    return pairing.pair_exact(_videos(spark, d), views.fixes(spark, d), _deployments(spark, d))


@query
def pair_approx(spark, d):
    return pairing.pair_approx(_videos(spark, d), views.fixes(spark, d), _deployments(spark, d))


@query
def pair_videos(spark, d):
    return _pairs(spark, d)


@query
def pair_videos_staged(spark, d):
    """The same, with the first pass written to the shared folder in between."""
    return pairing.pair_videos(
        _videos(spark, d), views.fixes(spark, d), _deployments(spark, d), staged=True
    )


@query
def append_full_join(spark, d):
    """Videos before an animal's cut-off, appended to those after its release."""
    known = pairing.with_deployment(_videos(spark, d), _deployments(spark, d))
    cols = ["AnimalID", "CollarID", "TimeStamp_UTC", "directoryname"]
    live = known.filter(F.col("mortvideo") == "No").select(*cols).distinct()
    free = known.filter(F.col("livevideoprerelease") == "No").select(*cols).distinct()
    return groups.append_rows(live, free)


@query
def video_groups(spark, d):
    return sinks.video_groups(_pairs(spark, d))


@query
def copy_manifest(spark, d):
    manifest = sinks.copy_manifest(_pairs(spark, d), views.ROOT)
    return manifest.select("AnimalID", "TimeStamp_UTC", "source", "target")


@query
def copy_manifest_by_key(spark, d):
    pairs = stage(_pairs(spark, d), "pairs")  # read twice
    manifest = sinks.copy_manifest_by_key(pairs, sinks.video_groups(pairs), views.ROOT)
    return manifest.select("AnimalID", "TimeStamp_UTC", "source", "target")


@query
def videos_per_class(spark, d):
    return sinks.videos_per_class(_pairs(spark, d))


@query
def mappable_videos(spark, d):
    pairs = layers.mappable_videos(_pairs(spark, d), views.STUDY_START)
    return pairs.select("CollarID", "acquisitiontime", "status", "coordinates", "directoryname")


# --- layers -----------------------------------------------------------------------------


@query
def fix_layers(spark, d):
    return layers.fix_layers(_base(spark, d))


@query
def fix_layers_window(spark, d):
    return layers.fix_layers(_base(spark, d), mortdata=False, begin=BEGIN, end=END)


@query
def fix_video_layers(spark, d):
    videos = layers.mappable_videos(_pairs(spark, d), views.STUDY_START, in_order=False)
    return layers.fix_layers(_base(spark, d), videos, begin=BEGIN, end=END)


@query
def mortality_layers(spark, d):
    flagged = stage(_flagged(spark, d), "flagged")  # read several times
    return mortality.mortality_layers(flagged, tracks.mortality_dates(flagged))


# --- whole jobs: results written below the shared folder ---------------------------------


@query
def mortality_review(spark, d):
    rule = ClusterRule(30_000.0, 2, 6.0)
    out = new_folder(spark, "review")
    return review(
        views.fixes(spark, d), rule, out, start=views.STUDY_START, study_end=views.STUDY_END
    )


@query
def organised_layers(spark, d):
    return organise(
        spark,
        views.fixes(spark, d),
        views.deployments(spark, d),
        new_folder(spark, "organised"),
        videos=_videos(spark, d),
        save_metadata=True,
        as_of=views.AS_OF,
        **STUDY,
    )


@query
def read_fixes_text(spark, d):
    """Fixes as a download has them, text with its own column name, read back typed."""
    out = new_folder(spark, "fix-text")
    iso = F.date_format("acquisitiontime", "yyyy-MM-dd'T'HH:mm:ss")
    text = views.fixes(spark, d).withColumn("acquisitiontime", iso)
    text.withColumnRenamed("collar_id", "idcollar").write.option("header", True).csv(out)
    return fix_io.read_fixes(spark, out, "csv")


@query
def read_landed_fixes(spark, d):
    """Fixes landed in two overlapping downloads, read between two times."""
    out = new_folder(spark, "landed")
    fixes = views.fixes(spark, d)
    fix_io.land_fixes(fixes, out)
    fix_io.land_fixes(fixes.filter(F.col("acquisitiontime") >= tu.at(BEGIN)), out)
    return fix_io.read_fixes(spark, out, start="2024-01-02 00:00:00", end=END)


@query
def read_repeated_landing(spark, d):
    """An archive after a batch landed twice, another broke off, and that one landed again."""
    out, fixes = new_folder(spark, "landed"), views.fixes(spark, d)
    late = fixes.filter(F.col("acquisitiontime") >= tu.at(BEGIN))
    fix_io.land_fixes(fixes, out, "all")
    fix_io.land_fixes(fixes, out, "all")
    archive.write_version(late, out)  # as far as a landing comes that ends before its log
    fix_io.land_fixes(late, out)
    fix_io.land_fixes(late.orderBy("height"), out)
    return archive.read_archive(spark, out).drop(archive.DAY)


# --- sinks: written below the shared folder and read back --------------------------------


@query
def video_metadata_csv(spark, d):
    out = new_folder(spark, "video-metadata")
    pairs = _pairs(spark, d)
    sinks.write_video_metadata(pairs, out)
    types = {f.name: f.dataType for f in pairs.schema.fields}
    text = spark.read.option("header", True).option("nullValue", "NA").csv(out)
    return text.select(*[F.col(c).try_cast(types[c]).alias(c) for c in VIDEO_PAIR_COLUMNS])


@query
def deployments_out(spark, d):
    out = new_folder(spark, "deployments")
    dep_io.write_deployments(apply_mortality(spark, d), out, "csv")
    return dep_io.read_deployments(spark, out, "csv")


@query
def layers_out(spark, d):
    out = new_folder(spark, "layers")
    sinks.write_layers(fix_layers(spark, d), out)
    return spark.read.parquet(out).select(*layers.LAYER_COLUMNS)


def _made(paths: Iterator[str], content: Callable[[str], bytes]) -> None:
    for path in paths:
        try:
            f = open(path, "wb", buffering=0)
        except FileNotFoundError:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            f = open(path, "wb", buffering=0)
        with f:
            if some := content(path):
                f.write(some)


def _make_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        _made(batch["path"], lambda path: os.path.basename(path).encode())
        yield batch[["path"]]


def _make_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        _made(batch["path"], lambda path: b"")
        yield batch[["path"]]


def _video_files(spark: SparkSession, d: str, filled: bool = True) -> str:
    """Small files named as the videos; their names are their content, if they are ``filled`` at once."""
    root = new_folder(spark, "videos").removeprefix("file://").removeprefix("file:")
    # in ranges a folder is in few tasks, however many videos it has; a given number is not made smaller
    tasks = spark.sparkContext.defaultParallelism * 4
    named = views.video_paths(spark, d).repartitionByRange(tasks, "path").distinct()
    rel = F.substr("path", F.lit(len(views.ROOT) + 1))
    made = named.sortWithinPartitions("path").select(F.concat(F.lit(root), rel).alias("path"))
    _on_files(made, _make_files if filled else _make_names)
    return root


def _on_files(paths: DataFrame, work: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> None:
    paths.mapInPandas(work, "path string").write.format("noop").mode("overwrite").save()


def _fill_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Content for files that have none yet; one that was not made stays missing."""
    for batch in batches:
        for path in batch["path"]:
            with suppress(FileNotFoundError), open(path, "r+b", buffering=0) as f:
                f.write(os.path.basename(path).encode())
        yield batch


def _empty_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with suppress(FileNotFoundError):
                os.truncate(path, 0)
        yield batch


def _remove_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path in batch["path"]:
            with suppress(FileNotFoundError):
                os.unlink(path)
        yield batch


#: Made videos that have their content at the same time, about.
WAVE = 50_000


def _copy_made(spark: SparkSession, d: str, manifest: DataFrame) -> DataFrame:
    """The log of ``copy_videos`` for files made without content.

    A file takes a block of disk, however short it is. So the made files of one wave get their content,
    are copied and, once the log of that is written, emptied; what is emptied soon never reaches the disk.
    They are removed in the end, since some file systems are slow to make files while others go.
    All rows of a name are in one wave: the rows of one source, and the sources that meet in a target.
    """
    planned, logs = new_folder(spark, "planned"), new_folder(spark, "copy-logs")
    cores = spark.sparkContext.defaultParallelism
    waves = max(1, -(-views.video_paths(spark, d).count() // WAVE))
    wave = F.pmod(F.xxhash64(F.substring_index("source", "/", -1)), F.lit(waves))
    (
        manifest.select("source", "target", wave.cast("int").alias("wave"))
        .repartition(cores * 4, "source")
        .sortWithinPartitions("wave", "source")
        .write.partitionBy("wave")
        .parquet(planned)
    )
    rows = spark.read.schema("source string, target string, wave int").parquet(planned)

    def copied(k: int) -> DataFrame:
        part = rows.filter(F.col("wave") == k)
        made = part.select(F.col("source").alias("path"))
        _on_files(made, _fill_files)
        log = sinks.copy_videos(part, tasks=cores, log=f"{logs}/{k}")
        _on_files(made, _empty_files)
        return log

    # the next wave runs while one waits for its last tasks
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(copied, range(waves)))
    _on_files(rows.select(F.col("source").alias("path")), _remove_files)
    return spark.read.schema(done[0].schema).parquet(*[f"{logs}/{k}" for k in range(waves)])


def _below(root: str, col: str):
    return F.replace(F.col(col), F.lit(root), F.lit(""))


def _plain_listing(files: DataFrame, root: str) -> DataFrame:
    path = F.regexp_replace("path", "^file:/+", "/")
    return files.select(F.replace(path, F.lit(root), F.lit("")).alias("path"), "length")


@query
def scan_videos(spark, d):
    root = _video_files(spark, d)
    return _plain_listing(video_io.scan_videos(spark, root), root)


@query
def scan_mounted_videos(spark, d):
    root = _video_files(spark, d)
    return _plain_listing(video_io.scan_mounted_videos(spark, root), root)


@query
def copy_videos(spark, d):
    root = _video_files(spark, d, filled=False)
    videos = video_io.list_videos(spark, root)
    pairs = pairing.pair_videos(videos, views.fixes(spark, d), _deployments(spark, d))
    log = _copy_made(spark, d, sinks.copy_manifest(pairs, root))
    return log.select(
        _below(root, "source").alias("source"), _below(root, "target").alias("target"), "outcome",
        "length", "sha256",
    )


@query
def check_copies(spark, d):
    """The copies, read back: length and hash of each file in place."""
    root = _video_files(spark, d, filled=False)
    below = F.substr("directoryname", F.lit(len(views.ROOT) + 1))
    pairs = _pairs(spark, d).withColumn("directoryname", F.concat(F.lit(root), below))
    log = _copy_made(spark, d, sinks.copy_manifest(pairs, root))
    found = sinks.check_copies(log)
    return found.select(_below(root, "path").alias("path"), "length_found", "sha256_found", "intact")


# task functions travel with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
