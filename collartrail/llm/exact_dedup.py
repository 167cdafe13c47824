"""Exact dedup in three steps of combining, with whole texts compared in each. DataFrame only.

1. Each task combines its own equal texts (the partial aggregate in front of the first shuffle).
2. Rows meet by digest, salt and text. The salt comes from the task, so a text that every task
   holds does not arrive in one place.
3. The winners of all salts, at most ``salts`` for a text, meet by digest and are compared by text.

The digest places rows and links documents to their winner. Where two texts share one, the link
compares the texts as well, so results do not depend on the digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collartrail.llm.text import id_and_text
from collartrail.session import stage

SALTS = 32


def squeeze_blanks(text: Column) -> Column:
    """Each run of blanks becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = squeeze_blanks,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, digest``.

    A NULL text is empty and equal to other empty texts. Rows without an id count in
    ``group_size`` but only name the group (NULL) if none of its rows has an id. Rows that repeat an
    id with an equal text are all ``kept``: they are one document. An empty table gives no rows.
    Other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", normalise(F.col("text")).alias("body"))
    rows = rows.withColumn("digest", digest(F.col("body")))
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "body")
        .agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    )
    winners = (
        salted.repartition("digest")
        .groupBy("digest", "body")
        .agg(F.min("first").alias("keep_id"), F.sum("n").alias("group_size"))
    )
    shared = F.count("*").over(Window.partitionBy("digest")) > 1
    winners = stage(
        winners.select(
            "digest", "keep_id", "group_size", F.when(shared, F.col("body")).alias("proof")
        ),
        "exact-winners",
    )
    clashing = winners.filter(F.col("proof").isNotNull())
    if clashing.isEmpty():
        linked = rows.select("doc_id", "digest", "body").join(winners.drop("proof"), "digest")
    else:
        alone = winners.filter(F.col("proof").isNull()).drop("proof")
        linked = rows.join(alone, "digest").unionByName(
            rows.join(clashing.withColumnRenamed("proof", "body"), ["digest", "body"])
        )
    return linked.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )
