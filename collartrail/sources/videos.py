"""Video listings: only names are read, never video content."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from itertools import batched, islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from collartrail.functions.timeutil import make_time, to_number
from collartrail.session import new_folder

GROUPED = "groupedvideos"

# What separates the parts of a name, and the name suffix of a video.
_SEPARATOR = "[^A-Za-z0-9]+"
_SUFFIX = "mp4"


#: Files that Spark lists at once, about: the driver holds the listing of so many.
BATCH = 50_000

_FILE = "path string, length bigint, modificationTime timestamp"
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _hidden(name: str) -> bool:
    """Whether Spark leaves out a folder of this name, as it does within a folder that it lists."""
    odd = name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)
    return odd and not name.startswith(("_common_metadata", "_metadata"))


def _inside(spark: SparkSession, root: str) -> Iterator[str]:
    """What is directly in ``root`` by any file system, but for hidden names and the output folder.

    The store hands it out one by one. A file is as good as a folder: Spark lists it alone.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatusIterator(place)
    while found.hasNext():
        path = found.next().getPath().toString()
        name = path.rsplit("/", 1)[-1]
        if name != GROUPED and not _hidden(name):
            yield re.sub(r"([\\{}\[\]*?])", r"\\\1", path)  # a name, not a pattern


def scan_videos(spark: SparkSession, root: str) -> DataFrame:
    """Video files below ``root``: (path, length, modificationTime).

    Files in ``root`` itself and in its output folder ``groupedvideos`` are left out. Names
    starting with ``.`` or ``_`` are not listed by Spark. Only the listing is read. Folders of
    ``root`` are listed some at a time and written below the shared folder: the driver holds about
    ``BATCH`` files, or those of the largest folder.
    """
    out, tasks = new_folder(spark, "listing"), spark.sparkContext.defaultParallelism * 4
    inside, some, batch = _inside(spark, root), 64, 0
    # else each folder is a task of its own, which the driver would remember
    listers = spark.conf.get(_LISTERS)
    spark.conf.set(_LISTERS, str(tasks))
    try:
        while folders := list(islice(inside, some)):
            seen = Observation()
            (
                spark.read.format("binaryFile")
                .option("recursiveFileLookup", True)
                .load(folders)
                .select("path", "length", "modificationTime")
                .observe(seen, F.count(F.lit(1)).alias("files"))
                .coalesce(tasks)
                .write.parquet(f"{out}/{batch}")
            )
            # as many folders as hold a batch, by those seen last
            some = max(1, min(4 * some, BATCH, len(folders) * BATCH // max(1, seen.get["files"])))
            batch += 1
    finally:
        spark.conf.set(_LISTERS, listers)
    if not batch:
        return spark.createDataFrame([], _FILE)
    return spark.read.schema(_FILE).option("recursiveFileLookup", True).parquet(out).filter(_below_root(root))


_ENTRY = "path string, is_folder boolean, length bigint, modificationTime timestamp"


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What is directly in each folder, many folders in one table."""

    def found() -> Iterator[tuple[str, bool, int | None, int | None]]:
        for batch in batches:
            for folder in batch["folder"]:
                with os.scandir(folder) as entries:
                    for e in entries:
                        if e.is_dir(follow_symlinks=False):
                            yield e.path, True, None, None
                        else:
                            s = e.stat(follow_symlinks=False)
                            yield e.path, False, s.st_size, s.st_mtime_ns // 1_000_000

    for some in batched(found(), 10_000):
        path, is_folder, length, time = zip(*some, strict=True)
        yield pd.DataFrame(
            {
                "path": path,
                "is_folder": is_folder,
                "length": pd.array(length, "Int64"),
                "modificationTime": pd.to_datetime(pd.array(time, "Int64"), unit="ms", utc=True),
            }
        )


def scan_mounted_videos(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """As ``scan_videos``, for a folder all executors mount, hidden files included.

    Folders are listed by the tasks, one level of the tree after the other; each level is
    written below the shared folder, and no listing goes through the driver.
    """
    root = root.rstrip("/")
    tasks = tasks or spark.sparkContext.defaultParallelism * 4
    out, levels = new_folder(spark, "listing"), []
    folders = spark.createDataFrame([(root,)], "folder string")
    while not levels or not folders.isEmpty():
        levels.append(f"{out}/{len(levels)}")
        listed = folders.repartition(tasks, "folder").mapInPandas(_entries, _ENTRY)
        listed.write.parquet(levels[-1])
        seen = spark.read.schema(_ENTRY).parquet(levels[-1])
        inside = F.col("is_folder") & (F.col("path") != f"{root}/{GROUPED}")
        folders = seen.filter(inside).select(F.col("path").alias("folder"))
    files = spark.read.schema(_ENTRY).parquet(*levels).filter(~F.col("is_folder"))
    return files.drop("is_folder").filter(_below_root(root))


def _relative(root: str, path: str):
    """The part of a plain path below ``root``."""
    base = _plain(F.lit(root.rstrip("/") + "/"))
    return F.substr(F.col(path), F.length(base) + 1)


def _plain(col):
    return F.when(col.startswith("file:"), F.regexp_replace(col, "^file:/+", "/")).otherwise(col)


def _parts(col):
    """Split at runs of separators. Splitting at one plain character compiles no pattern per row."""
    return F.split(F.regexp_replace(col, _SEPARATOR, "_"), "_")


def _below_root(root: str):
    base = _plain(F.lit(root.rstrip("/") + "/"))
    rel = F.substr(_plain(F.col("path")), F.length(base) + 1)
    return rel.contains("/") & ~rel.startswith(f"{GROUPED}/") & rel.endswith(_SUFFIX)


def parse_video_paths(df: DataFrame, root: str) -> DataFrame:
    """Animal, collar and time from ``<root>/<animal>_<collar>/<Y>-<M>-<D> <HHMMSS>.mp4``.

    Takes a scan or any listing with a ``path`` column, so a stored inventory serves as
    well. Parts a name lacks are NULL, further ones are ignored, and an impossible time is
    NULL; the row stays.
    """
    rel, name = F.col("rel"), F.substring_index("rel", "/", -1)
    # through a generator here and below: what is computed once is not put into each of its
    # uses, and filters on the parts stay above it
    split = (
        df.select(F.explode(F.array(_plain(F.col("path")))).alias("directoryname"))
        .withColumn("rel", _relative(root, "directoryname"))
        .select(
            "directoryname",
            _parts(F.left(rel, F.length(rel) - F.length(name) - 1)).alias("folder"),
            _parts(name).alias("name"),
        )
    )
    clock = F.get("name", F.lit(3))
    parts = {
        "Year": F.get("name", F.lit(0)),
        "Month": F.get("name", F.lit(1)),
        "Day": F.get("name", F.lit(2)),
        "Hour": F.substring(clock, 1, 2),
        "Minute": F.substring(clock, 3, 2),
        "Second": F.substr(clock, F.lit(5)),
    }
    named = split.select(
        F.inline(
            F.array(
                F.struct(
                    F.get("folder", F.lit(0)).alias("AnimalID"),
                    F.get("folder", F.lit(1)).alias("CollarID"),
                    *[to_number(part).alias(key) for key, part in parts.items()],
                )
            )
        ),
        "directoryname",
    )
    time = make_time(*[F.col(c) for c in parts])
    return named.select(
        "AnimalID", "CollarID", time.alias("TimeStamp_UTC"), *parts, "directoryname"
    )


def list_videos(spark: SparkSession, root: str, mounted: bool | None = None) -> DataFrame:
    """Scan and parse in one.

    Tasks list the folders, unless ``root`` is in a store that has a scheme of its own;
    ``mounted`` says otherwise.
    """
    if mounted is None:
        mounted = "://" not in root or root.startswith("file:")
    if not mounted:
        return parse_video_paths(scan_videos(spark, root), root)
    root = re.sub("^file:/+", "/", root)
    return parse_video_paths(scan_mounted_videos(spark, root), root)


# task functions travel with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
