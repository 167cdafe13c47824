"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collartrail.llm.text import id_and_text


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    per_class: tuple[int, ...],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, text, label`` of at most ``per_class[c]`` documents of each class c.

    The ids with the least hashes are taken, so the choice is even and the same in each run. Labels
    that are NULL or for no id are left out; of several for one id the largest counts. The ids chosen
    are ``sum(per_class)`` at most, which bounds what is broadcast to the texts.
    """
    known = (
        labels.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
        )
        .filter("doc_id is not null and label is not null")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = None
    for c, most in enumerate(per_class):
        part = known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    return id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
