"""An archive of fixes that landings add to, each batch once and either whole or not at all.

    <archive>/days/version=<id>/acquisition_date=<day>/   fixes of a day, as some landing left them
    <archive>/batches/<name>/                             what a landing changed: day and version

A landing writes the days it touches as a new version, with the copies of what lay there added up, and
then one small table that names them. That table counts once its job is committed; until then readers
see the days as they were, and a landing that broke off leaves nothing but an unused version. A batch
whose table is there has landed and is not landed again. One landing at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collartrail.operators.copies import COPIES, merge_copies
from collartrail.schemas import FIXES

#: Partition columns of the days.
DAY, VERSION = "acquisition_date", "version"

_LOG = "seq bigint, acquisition_date date, version string"
_KEPT = T.StructType(
    [*FIXES.fields, T.StructField(COPIES, T.LongType()), T.StructField(VERSION, T.StringType()), T.StructField(DAY, T.DateType())]
)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def is_archive(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/batches")


def _batches(spark: SparkSession, archive: str) -> list[str]:
    """Names of the batches whose log is committed."""
    place, files = _place(spark, f"{archive}/batches")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return [n for n in names if exists(spark, f"{archive}/batches/{n}/_SUCCESS")]


def _current(spark: SparkSession, archive: str) -> DataFrame:
    """The version of each day that counts."""
    paths = [f"{archive}/batches/{name}" for name in _batches(spark, archive)]
    log = spark.read.schema(_LOG).parquet(*paths) if paths else spark.createDataFrame([], _LOG)
    named = log.filter(F.col(VERSION).isNotNull())
    return named.groupBy(DAY).agg(F.max_by(VERSION, "seq").alias(VERSION))


def read_days(spark: SparkSession, archive: str, days: DataFrame) -> DataFrame:
    """Fixes of the (day, version) pairs in ``days``; the driver holds one path for each."""
    pairs = days.select(VERSION, F.coalesce(F.col(DAY).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("d"))
    paths = [f"{archive}/days/{VERSION}={v}/{DAY}={d}" for v, d in pairs.collect()]
    if not paths:
        return spark.createDataFrame([], _KEPT)
    return spark.read.schema(_KEPT).option("basePath", f"{archive}/days").parquet(*paths)


def read_archive(spark: SparkSession, archive: str, first=None, last=None) -> DataFrame:
    """Fixes with ``copies``, of the days from ``first`` to ``last`` if given."""
    days = _current(spark, archive)
    days = days.filter(F.col(DAY) >= first) if first is not None else days
    days = days.filter(F.col(DAY) <= last) if last is not None else days
    return read_days(spark, archive, days).drop(VERSION)


def content_name(fixes: DataFrame) -> str:
    """A name that a download has whatever the order of its rows."""
    columns = [F.col(c) for c in sorted(fixes.columns)]
    both = fixes.select(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))
    sums = [F.coalesce(F.sum(F.col(c).cast("decimal(38,0)")), F.lit(0)).cast("string") for c in "ab"]
    n, a, b = both.agg(F.count("*"), *sums).first()
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{n} {a} {b}").hex


def write_version(fixes: DataFrame, archive: str) -> str:
    """Write the days of ``fixes``, with what the archive has for them, as a new version; its id."""
    spark, version = fixes.sparkSession, uuid.uuid4().hex
    new = merge_copies(fixes.select(*FIXES.names, *[c for c in (COPIES,) if c in fixes.columns]))
    new = new.withColumn(DAY, F.to_date("acquisitiontime"))
    touched = new.select(F.col(DAY).alias("_day")).distinct()
    current = _current(spark, archive)
    same = current[DAY].eqNullSafe(touched["_day"])
    old = read_days(spark, archive, current.join(touched, same, "left_semi")).drop(VERSION)
    both = new.unionByName(old.select(*new.columns))
    merged = both.groupBy(*[c for c in new.columns if c != COPIES]).agg(F.sum(COPIES).alias(COPIES))
    # a day's size decides its number of files
    merged.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{archive}/days/{VERSION}={version}")
    return version


def land(fixes: DataFrame, archive: str, batch: str | None = None) -> bool:
    """Add ``fixes`` as ``batch`` (default: named by its content); False if that has landed before."""
    spark = fixes.sparkSession
    place, files = _place(spark, archive)
    held = [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []
    if held and not {"days", "batches"} & set(held):
        raise ValueError(f"{archive} holds something else than an archive")
    batch = batch or content_name(fixes)
    landed = _batches(spark, archive)
    if batch in landed:
        return False
    version = write_version(fixes, archive)
    written = spark.read.schema(_KEPT).option("basePath", f"{archive}/days")
    touched = written.parquet(f"{archive}/days/{VERSION}={version}").select(DAY).distinct()
    # the first row stands for the batch itself, which may have no days
    log = touched.withColumn(VERSION, F.lit(version)).unionByName(
        spark.range(1).select(F.lit(None).cast("date").alias(DAY), F.lit(None).cast("string").alias(VERSION))
    )
    rows = log.select(F.lit(len(landed)).cast("bigint").alias("seq"), DAY, VERSION)
    # what a broken-off landing of this name may have left is not committed, and replaced
    rows.coalesce(1).write.mode("overwrite").parquet(f"{archive}/batches/{batch}")
    return True
