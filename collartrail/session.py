"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_shared: dict[str, str] = {}


def build_session(
    app: str = "collartrail", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the operators expect: UTC, AQE, ANSI left on.

    On a cluster, leave ``master`` and resources to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app_id = spark.sparkContext.applicationId
    if app_id not in _local_shared:
        _local_shared[app_id] = tempfile.mkdtemp(prefix="collartrail-")
    return _local_shared[app_id]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    Cuts the lineage: later jobs read the files, also after executors are lost.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
