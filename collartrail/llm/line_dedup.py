"""Line dedup: lines that many documents share stay only in the last of them.

Keys of lines travel as hashes of 128 bits with the document's id; texts move once, to meet the
positions of the lines they lose.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collartrail.llm.text import BLANKS, NO_ID, ascii_lower, salted_join

MIN_CHARS = 20
MIN_DOCS = 3


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """Line keys of at least ``min_chars`` code points, hashed: ``h1, h2, at_id, at_text, pos``."""
    key = F.col("key")
    return (
        rows.select("at_id", "at_text", F.posexplode(F.split("body", "\n")).alias("pos", "line"))
        .select("at_id", "at_text", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.length(key) >= min_chars)
        .select(
            F.xxhash64(F.lit(1), key).alias("h1"),
            F.xxhash64(F.lit(2), key).alias("h2"),
            "at_id",
            "at_text",
            "pos",
        )
    )


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``doc`` (the input row) and ``found: struct<n_lines, n_dropped, kept_text>`` for each input row.

    A NULL or empty text is one empty line. A NULL id is an id of its own, smaller than all others.
    Rows of one id are one document when documents are counted; each row keeps its own text. Lines
    with equal keys in the document with the largest id all stay. If nothing stays the text is empty.
    An empty table gives no rows.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    where = (F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(body))
    rows = docs.select(where[0].alias("at_id"), where[1].alias("at_text"), body.alias("body"))
    lines = _lines(rows, min_chars)
    shared = (
        lines.groupBy("h1", "h2")
        .agg(F.countDistinct("at_id").alias("n_docs"), F.max("at_id").alias("last_id"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "last_id")
    )
    lost = (
        salted_join(lines, shared, ["h1", "h2"], "at_id")
        .filter(F.col("at_id") < F.col("last_id"))
        .groupBy("at_id", "at_text")
        .agg(F.collect_set("pos").alias("lost"))
    )
    own = docs.select(
        F.struct("*").alias("doc"), where[0].alias("at_id"), where[1].alias("at_text")
    )
    text = F.coalesce(F.col(f"doc.`{text_col}`"), F.lit(""))
    shorter = without_lines(F.when(F.col("lost").isNotNull(), text), F.col("lost"))
    return own.join(lost, ["at_id", "at_text"], "left").select(
        "doc",
        F.struct(
            F.size(F.split(text, "\n")).cast("long").alias("n_lines"),
            F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce(shorter, text).alias("kept_text"),
        ).alias("found"),
    )


@F.pandas_udf(T.StringType())
def without_lines(texts: pd.Series, lost: pd.Series) -> pd.Series:
    """Each text without the lines at the positions listed; NULL stays NULL."""
    kept = []
    for text, gone in zip(texts, lost, strict=True):
        if text is not None:
            gone = set(gone)
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        kept.append(text)
    return pd.Series(kept, dtype=object)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
