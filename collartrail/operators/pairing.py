"""Pair each video with the fix of its hour, or of the evening's 21 h."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collartrail.functions import timeutil as tu
from collartrail.functions.nulls import id_text, if_known, is_in, paste
from collartrail.operators.copies import COPIES, expand_copies, merge_copies
from collartrail.operators.spans import BEGIN, END, join_span, with_span
from collartrail.schemas import (
    MAX_COORDINATE,
    VIDEO_DEPLOYMENT_COLUMNS,
    VIDEO_PAIR_COLUMNS,
    VIDEOS,
)
from collartrail.session import stage

# Hours with a scheduled fix (pass 1), and the evening fix (pass 2).
SCHEDULED_HOURS = (0, 15)
EVENING_HOUR = 21

_FIX = ["acquisitiontime", "latitude", "longitude", "height", "temperature"]
_VIDEO = ["AnimalID", "CollarID", "Date", "Hour"]


def fill_cutoff(deployments: DataFrame, as_of=None) -> DataFrame:
    """An open mortality cut-off is the midnight after ``as_of`` (default: today)."""
    col = "lastfixoutsidemortclust_UTC"
    return deployments.withColumn(col, F.coalesce(col, tu.day_after(as_of)))


def life_phase(df: DataFrame) -> DataFrame:
    """'Yes'/'No' flags: before release, between release and cut-off, after the cut-off.

    A flag is NULL when the times do not tell.
    """
    t = F.col("TimeStamp_UTC")
    release, cutoff = F.col("firstfixoutsidepen_UTC"), F.col("lastfixoutsidemortclust_UTC")
    return df.withColumns(
        {
            "livevideoprerelease": if_known(t < release, "Yes", "No"),
            "livevideopostrelease": if_known((t >= release) & (t <= cutoff), "Yes", "No"),
            "mortvideo": if_known(t > cutoff, "Yes", "No"),
        }
    )


def with_deployment(
    videos: DataFrame, deployments: DataFrame, by_span: bool = False, **bounds
) -> DataFrame:
    """Add the deployment of (AnimalID, CollarID), one row per match, and the life phase.

    With ``by_span`` only deployments that ran at the video's time match; ``lower`` and ``upper``
    bound the times looked at (see ``join_span``).
    """
    if by_span:
        spans = with_span(deployments).select(
            F.col("animalid").alias("_animal"),
            id_text(F.col("collarid")).alias("_collar"),
            BEGIN,
            END,
            *VIDEO_DEPLOYMENT_COLUMNS,
        )
        keys = {"AnimalID": "_animal", "CollarID": "_collar"}
        return life_phase(join_span(videos, spans, keys, "TimeStamp_UTC", **bounds))
    dep = deployments.select(
        F.col("animalid").alias("_animal"),
        id_text(F.col("collarid")).alias("_collar"),
        *VIDEO_DEPLOYMENT_COLUMNS,
    )
    on = videos["AnimalID"].eqNullSafe(dep["_animal"]) & videos["CollarID"].eqNullSafe(
        dep["_collar"]
    )
    return life_phase(videos.join(dep, on, "left").drop("_animal", "_collar"))


def mark_missing(fixes: DataFrame) -> DataFrame:
    """Mark rows as existing fixes, so that after a left join "fix without position" and
    "no fix" differ; placeholder coordinates become NULL."""
    keep = {c: F.when(F.col(c) <= MAX_COORDINATE, F.col(c)) for c in ("latitude", "longitude")}
    return fixes.withColumns({**keep, "fix_found": F.lit(True)})


def earliest_fixes(fixes: DataFrame) -> DataFrame:
    """The earliest fix of every collar and hour, ties kept, ready to join as ``_slot``.

    Reducing before the join gives what filtering after it would: all rows of a group of
    videos share one hour. The rank filter drops all but a task's own earliest rows before
    the shuffle; copies of one fix, which it cannot drop, are merged first.
    """
    fixes = fixes.select(F.col("collar_id").alias("_collar"), *_FIX, *_copies(fixes))
    hour = tu.hour_of(F.col("acquisitiontime"))
    fixes = mark_missing(merge_copies(fixes, ["_collar", *_FIX])).withColumns(
        {"_date": tu.date_of(F.col("acquisitiontime")), "_hour": hour}
    )
    w = Window.partitionBy("_collar", "_date", "_hour").orderBy("acquisitiontime")
    first = fixes.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1)
    # a key of its own for the join: both sides are then exchanged for it, and AQE can
    # split the videos of a crowded hour
    return first.withColumn("_slot", tu.hour_slot(F.col("_date"), F.col("_hour"))).drop(
        "_date", "_hour", "_rank"
    )


def _copies(df: DataFrame) -> list[str]:
    return [COPIES] if COPIES in df.columns else []


def _hours_with_fix(fixes: DataFrame) -> DataFrame:
    """Distinct (collar, hour) in which there is any fix, in the shape of a join side."""
    t = F.col("acquisitiontime")
    hours = fixes.select(
        F.col("collar_id").alias("_collar"), tu.date_of(t).alias("_date"), tu.hour_of(t).alias("_hour")
    ).distinct()
    return hours.select(
        "_collar",
        tu.hour_slot(F.col("_date"), F.col("_hour")).alias("_slot"),
        F.lit(True).alias("fix_found"),
    )


def _join_slot(videos: DataFrame, slots: DataFrame, slot: Column) -> DataFrame:
    """Videos with what ``slots`` has for their collar and hour slot, if anything."""
    # a collar id that is not written as a plain number equals no fix's id
    number = F.col("CollarID").try_cast("bigint")
    written = (number.cast("string") == F.col("CollarID")) | F.col("CollarID").isNull()
    keyed = videos.withColumns(
        {
            "_video_collar": F.when(written, number),
            "_video_slot": F.when(written, slot),
        }
    )
    # missing equals missing, but for the hour
    same = F.col("_video_collar").eqNullSafe(F.col("_collar")) & (F.col("_video_slot") == F.col("_slot"))
    joined = keyed.join(slots, same, "left").drop("_video_collar", "_video_slot", "_collar", "_slot")
    return joined.withColumn("fix_found", F.coalesce("fix_found", F.lit(False)))


def _classify(df: DataFrame) -> DataFrame:
    """Status and coordinates: a fix with or without longitude, a failed try, or neither."""
    own, found, located = F.col("_pass") == 1, F.col("fix_found"), F.col("longitude").isNotNull()
    tried = F.when(own, is_in(F.col("Hour"), SCHEDULED_HOURS)).otherwise(F.col("_evening"))
    status = F.when(found, "Successful").when(tried, "Unsuccessful")
    coordinates = (
        F.when(found & located, F.when(own, "Exact").otherwise("Approximate"))
        .when(found, F.when(own, "Missing").otherwise("ApproxMissing"))
        .when(tried, "None")
        .when(own, "")
    )
    return df.withColumns({"status": status, "coordinates": coordinates})


def with_date(videos: DataFrame) -> DataFrame:
    return videos.withColumn("Date", tu.date_of(F.col("TimeStamp_UTC")))


def _settled_untimed(videos: DataFrame, fixes: DataFrame) -> DataFrame:
    """Animals with a video without a time that pass 1 settles: by its hour, or by a fix without one."""
    rows = with_date(videos.filter(F.col("TimeStamp_UTC").isNull()))
    untimed = _hours_with_fix(fixes.filter(F.col("acquisitiontime").isNull()))
    found = _join_slot(rows.select(*_VIDEO), untimed, _own_slot())
    settled = found.filter(F.col("fix_found") | is_in(F.col("Hour"), SCHEDULED_HOURS))
    return settled.select(F.struct("AnimalID").alias("_animal"), F.lit(True).alias("_blocked")).distinct()


def _rows(videos: DataFrame, deployments: DataFrame, by_span: bool = False) -> DataFrame:
    """Videos with deployment and date, equal ones merged and counted, and whether they look at 21 h."""
    merged = merge_copies(videos.select(*VIDEOS.names)).withColumnRenamed(COPIES, "_videos")
    rows = with_date(with_deployment(merged, deployments, by_span))
    late = tu.approx_hour(F.col("Hour"), F.col("Minute"))
    return rows.withColumn("_evening", is_in(late, [EVENING_HOUR]))


def _with_fix(rows: DataFrame, fixes: DataFrame, evening: bool) -> DataFrame:
    """Each video once, or with ``evening`` once for each pass, with the fix of that pass, if there is one.

    Both passes ask the same table of earliest fixes: pass 1 for the video's own hour, pass 2 for the
    evening's, if the video is late enough. So one join serves both.
    """
    own = F.struct(F.lit(1).alias("number"), _own_slot().alias("slot"))
    late = F.struct(
        F.lit(2).alias("number"),
        F.when(F.col("_evening"), tu.hour_slot(F.col("Date"), F.lit(EVENING_HOUR))).alias("slot"),
    )
    asked = F.array(own)
    if evening:
        # at scheduled hours pass 1 settles every video
        settled = is_in(F.col("Hour"), SCHEDULED_HOURS)
        asked = F.when(settled, asked).otherwise(F.array(own, late))
    each = rows.withColumn("_ask", F.explode(asked)).withColumn("_pass", F.col("_ask.number"))
    return _classify(_join_slot(each, earliest_fixes(fixes), F.col("_ask.slot")))


def _own_slot() -> Column:
    return tu.hour_slot(F.col("Date"), F.col("Hour"))


def _spread(apart: Column) -> Column:
    """0, or for rows that need not meet others, some number, so that they crowd no task."""
    return F.when(apart, F.pmod(F.xxhash64("directoryname"), F.lit(1024)) + 1).otherwise(0)


def _passes(
    videos: DataFrame,
    fixes: DataFrame,
    deployments: DataFrame,
    null_poisons: bool,
    staged: bool = False,
    by_span: bool = False,
) -> DataFrame:
    """Rows of both passes, told apart by ``_pass``; pass 2 has what pass 1 did not settle.

    What the rows of an animal's second, and of an hour, say about each other comes from windows over
    the joined rows. Only rows that can tell each other something meet there.
    """
    untimed = F.when(F.col("TimeStamp_UTC").isNull(), F.struct("AnimalID"))
    rows = _rows(videos, deployments, by_span).join(
        _settled_untimed(videos, fixes), untimed == F.col("_animal"), "left"
    )
    joined = _with_fix(rows.drop("_animal"), fixes, evening=True)
    if staged:
        joined = stage(joined, "pairing")
    timed = F.col("TimeStamp_UTC").isNotNull()
    second = Window.partitionBy("AnimalID", "TimeStamp_UTC", _spread(~timed))
    own = (F.col("_pass") == 1) & F.col("status").isNotNull()
    settled = F.when(timed, F.max(own).over(second)).otherwise(F.col("_blocked"))
    both = joined.withColumn("_settled", F.coalesce(settled, F.lit(False))).filter(
        own | ((F.col("_pass") == 2) & ~F.col("_settled"))
    )
    if not null_poisons:
        return both
    # only hour 19 holds both rows that look at 21 h and rows that do not; there the latter have no
    # time, which leaves the hour's minimum unknown and drops the former
    meets = (F.col("_pass") == 2) & is_in(F.col("Hour"), [19]) & F.col("Date").isNotNull()
    hour = Window.partitionBy(*_VIDEO, _spread(~meets))
    unknown = F.max(meets & ~F.col("_evening")).over(hour)
    return both.withColumn("_unknown", unknown).filter(~(meets & F.col("fix_found") & F.col("_unknown")))


def _result(df: DataFrame) -> DataFrame:
    copies = F.col("_videos") * F.coalesce(COPIES, F.lit(1))
    return expand_copies(df.select(*VIDEO_PAIR_COLUMNS, copies.alias(COPIES)))


def pair_exact(videos: DataFrame, fixes: DataFrame, deployments: DataFrame) -> DataFrame:
    """Pass 1: every video with the earliest fix of its own hour, or none.

    Rows it does not settle have no status and empty coordinates.
    """
    return _result(_with_fix(_rows(videos, deployments), fixes, evening=False))


def pair_approx(
    videos: DataFrame, fixes: DataFrame, deployments: DataFrame, null_poisons: bool = True
) -> DataFrame:
    """Pass 2: videos pass 1 left without a status, with the evening's 21 h fix, or none."""
    return _result(_passes(videos, fixes, deployments, null_poisons).filter("_pass = 2"))


def pair_videos(
    videos: DataFrame,
    fixes: DataFrame,
    deployments: DataFrame,
    null_poisons: bool = True,
    staged: bool = False,
    by_span: bool = False,
) -> DataFrame:
    """Both passes in one table, with the key ``bindingcolumn`` of the output folder.

    One join of videos and fixes serves both. With ``staged`` its result is written below the shared
    folder first; use it where executors are often lost. ``by_span`` joins a video only to deployments that
    ran at its time.
    """
    both = _result(_passes(videos, fixes, deployments, null_poisons, staged, by_span))
    return both.withColumn("bindingcolumn", folder_key())


def folder_key():
    return paste(F.col("CollarID"), F.col("status"), F.col("coordinates"))
