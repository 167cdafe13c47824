"""Token counts by a tokenizers file: batches balanced by bytes, texts cut at safe boundaries.

A cut in front of a single space between two characters that are no white space is safe for the
byte-level vocabularies this is for: their pattern takes such a space to the word that follows.
Units between cuts repeat a lot, so each task encodes a unit once and then only adds lengths.
"""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from collartrail.llm.arrow import BATCH_BYTES, by_bytes
from collartrail.llm.text import id_and_text

CACHE_UNITS = 400_000
_TWO_BLANKS = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def units(text: str) -> list[str]:
    """The text cut at every safe boundary; joined, the units give the text."""
    if _TWO_BLANKS.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    if rest and not first:
        first, rest = " " + rest[0], rest[1:]
    if rest and not rest[-1]:
        rest.pop()
        if rest:
            rest[-1] += " "
        else:
            first += " "
    return [first, *[" " + x for x in rest]]


class UnitLengths(dict):
    """Lengths of units in tokens. Emptied when full, so memory is bounded and results the same."""

    def __init__(self, tokenizer, most: int = CACHE_UNITS):
        super().__init__()
        self.tokenizer, self.most = tokenizer, most

    def of(self, texts: list[str]) -> list[int]:
        cut = [units(t) for t in texts]
        needed = set().union(*cut)
        if len(self) + len(needed) > self.most:
            self.clear()
        new = [u for u in needed if u not in self]
        for start in range(0, len(new), 8192):
            part = new[start : start + 8192]
            found = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.update(zip(part, map(len, found), strict=True))
        return [sum(map(self.__getitem__, x)) for x in cut]


def count_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens``, one row per input row.

    A NULL text is empty and has no tokens; ids may be NULL or repeat. Other columns are ignored.
    An empty table gives no rows. ``tokenizer_file`` must be readable on the executors.
    """
    rows = id_and_text(docs, id_col, text_col).selectExpr(
        "doc_id", "cast(octet_length(text) as long) n_bytes", "text"
    )

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        lengths = UnitLengths(Tokenizer.from_file(tokenizer_file))
        for batch in by_bytes(batches, batch_bytes):
            found = lengths.of(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(found, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
