"""Identical rows as one row with a count.

Fix archives are fetched again and again, so copies of one fix can be a large share of a
table. Operators that must bring rows of a collar together first merge copies, partially
already before the shuffle, into rows with ``copies``; ``expand_copies`` gives them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = "copies"
_BLOCK = 10_000


def merge_copies(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct ``cols`` with the number of rows it stands for.

    A table that already carries ``copies`` for exactly these columns is returned as it is,
    so a merged table written once is not shuffled for this again.
    """
    merged = COPIES in df.columns
    cols = list(cols) if cols else [c for c in df.columns if c != COPIES]
    if merged and set(df.columns) == {*cols, COPIES}:
        return df
    count = F.sum(COPIES) if merged else F.count(F.lit(1))
    return df.groupBy(*cols).agg(count.alias(COPIES))


def expand_copies(df: DataFrame) -> DataFrame:
    """As many rows as ``copies`` says; a missing count stands for one row.

    Works in blocks, so no array grows with the number of copies beyond one per 10,000.
    """
    n = F.coalesce(F.col(COPIES), F.lit(1).cast("bigint"))
    rest = [c for c in df.columns if c != COPIES]
    blocks = df.select(
        *rest,
        n.alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(coalesce(copies, 1) - 1) div 10000"))).alias("_block"),
    )
    in_block = F.least(F.lit(_BLOCK), F.col("_n") - F.col("_block") * _BLOCK)
    return blocks.withColumn(
        "_one", F.explode(F.array_repeat(F.lit(True), in_block.cast("int")))
    ).select(*rest)
