"""Columns and checks that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"
NO_ID = -(2**63)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the faster general function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` only, so that no other column's name matters; a NULL text is empty."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def remainder_of_id(divisor: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a NULL id has remainder 0."""
    return F.coalesce(
        F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(divisor)), F.lit(0)
    ).cast("int")


def salted_join(
    many: DataFrame, few: DataFrame, on: list[str], spread: str, how: str = "inner", salts: int = 8
) -> DataFrame:
    """Join to a table with one row per key, where a key may hold a large part of ``many``.

    Rows of a key are dealt over ``salts`` places by their column ``spread``; ``few`` goes to all.
    """
    salted = many.withColumn("salt_", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = few.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "salt_"], how).drop("salt_")
