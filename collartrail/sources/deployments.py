"""Deployment metadata: read, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collartrail.schemas import DEPLOYMENTS
from collartrail.sources.common import load, times_as_text, to_schema


def read_deployments(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Deployment table with fixed types; a collar id that is no number becomes NULL."""
    return to_schema(load(spark, path, fmt, DEPLOYMENTS.names), DEPLOYMENTS)


def known_animals(deployments: DataFrame) -> DataFrame:
    return deployments.filter(F.col("animalid").isNotNull())


def write_deployments(df: DataFrame, out: str, fmt: str = "parquet") -> None:
    """Write the updated table as a folder of its own; missing values are blank in CSV."""
    if fmt == "csv":
        writer = times_as_text(df).write.option("header", True).option("nullValue", "")
    else:
        writer = df.write
    writer.mode("overwrite").format(fmt).save(out)
