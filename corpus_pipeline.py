"""A corpus pipeline of five stages. Each takes ``(spark, docs, sf_dir)`` and returns documents.

All stages but the last return the columns of ``documents``; results are written as Parquet and read
again as the next stage's documents. Rows of one id count as one document, a NULL text is empty, other
columns travel along, and an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collartrail.llm import byte_bpe, decontaminate, hyperminhash, line_dedup, toxicity
from collartrail.session import stage

NEAR_WORDS = 5
NEAR_PERCENT = 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model takes for toxic go. It learns from ``documents`` and ``labels``."""
    taught, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, taught, labels)
    return scored.filter(F.col("found.toxic") == 0).select("doc.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three documents or more stay in the last of them; ``n_chars`` follows the new text.

    A document of which nothing but blanks is left goes, unless it was so before.
    """
    cleaned = line_dedup.drop_shared_lines(docs)
    emptied = (F.col("found.n_dropped") > 0) & (F.btrim("found.kept_text", F.lit(" \t\n\x0b\f\r")) == "")
    changed = F.col("found.n_dropped") > 0
    new = {"text": F.col("found.kept_text"), "n_chars": F.length("found.kept_text").cast("long")}
    return cleaned.filter(~emptied).select(
        *[
            F.when(changed, new[c]).otherwise(F.col(f"doc.`{c}`")).alias(c)
            if c in new
            else F.col(f"doc.`{c}`").alias(c)
            for c in docs.columns
        ]
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    found = hyperminhash.near_duplicates(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id_")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone_id_"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words benchmark items' windows hold a twentieth or more."""
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    gone = found.filter("contaminated").select(
        F.col("doc_id").alias("gone_id_"), F.col("at_text").alias("gone_text_")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id_")) & (
        F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("gone_text_")
    )
    return docs.join(gone, same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, number and hash of the byte-level BPE ids, and hash of the bytes they decode to."""
    return byte_bpe.round_trip(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: The model and the tokenizer have no form in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; every result but the last is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
