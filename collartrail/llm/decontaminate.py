"""Benchmark items inside documents: a prefix-filtered join of shingle sets, verified word by word.

An item's windows are sets of shingles. A document contains a window only if it contains all of them,
so the necessary prefix, with shingles in order of rarity, is the rarest one:

1. A pass over the texts keeps, of each document, the stretches made of shingles that items have. A
   bitmap of fixed size tells which; what it lets through in error is sorted out by the joins.
2. Shingles are counted over all those stretches, and each window takes its rarest.
3. Stretches join windows on that shingle. Length and position bound the place of the window, and the
   words of the place are compared with those of the window.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collartrail.llm.arrow import by_bytes
from collartrail.llm.bitmap import bitmap_of, in_bitmap
from collartrail.llm.shingles import WordHashes, shingle_hashes
from collartrail.llm.text import NO_ID, id_and_text, salted_join
from collartrail.session import stage

WINDOW = 13
SHINGLE = 5
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters and all characters beyond ASCII, with A-Z in lower case."""
    return text.encode().translate(_WORD_BYTES).split()


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """``item, words, shingles``: runs of ``window`` words, or the whole shorter item."""
    rows = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def run(batches):
        hashes = WordHashes()
        for batch in by_bytes(batches):
            for item, text in zip(
                batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True
            ):
                words = words_of(text)
                n = min(window, len(words))
                size = min(shingle, n)
                found = shingle_hashes(hashes.of(words), size).view(np.int64)
                rows = [
                    (item, [w.decode() for w in words[k : k + n]], found[k : k + n - size + 1].tolist())
                    for k in range(len(words) - n + 1 if n else 0)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in rows]),
                            pa.array([r[1] for r in rows], pa.list_(pa.string())),
                            pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                        ],
                        names=["item", "words", "shingles"],
                    )

    return rows.mapInArrow(run, "item string, words array<string>, shingles array<long>")


def _stretches(rows: DataFrame, bitmap, sizes: list[int]) -> DataFrame:
    """``doc_id, at_text, n_words, starts, bodies``: runs of words that the bitmap's shingles cover."""

    def run(batches):
        hashes = WordHashes()
        for batch in by_bytes(batches):
            n_words, starts, bodies = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                n_words.append(len(words))
                cover = np.zeros(len(words) + 1, np.int32)
                found = hashes.of(words)
                for size in sizes:
                    if size <= len(words):
                        at = np.flatnonzero(in_bitmap(shingle_hashes(found, size), bitmap.value))
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + size, -1)
                edge = np.flatnonzero(np.diff(np.cumsum(cover) > 0, prepend=False, append=False))
                starts.append(edge[::2])
                bodies.append(
                    [b" ".join(words[a:z]).decode() for a, z in zip(edge[::2], edge[1::2], strict=True)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("at_text"),
                    pa.array(n_words, pa.int64()),
                    pa.array(starts, pa.list_(pa.int64())),
                    pa.array(bodies, pa.list_(pa.string())),
                ],
                names=["doc_id", "at_text", "n_words", "starts", "bodies"],
            )

    return rows.mapInArrow(
        run, "doc_id long, at_text long, n_words long, starts array<long>, bodies array<string>"
    )


def _counts(stretches: DataFrame, sizes: list[int]) -> DataFrame:
    """``shingle, n``: how often each shingle stands in the stretches; tasks count their own first."""

    def run(batches):
        hashes = WordHashes()
        for batch in by_bytes(batches, column="body"):
            found = []
            for body in batch.column("body").to_pylist():
                words = hashes.of(body.encode().split())
                found += [shingle_hashes(words, size) for size in sizes if size <= len(words)]
            if found:
                shingle, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"]
                )

    counted = stretches.select("body").mapInArrow(run, "shingle long, n long")
    return counted.groupBy("shingle").agg(F.sum("n").alias("n"))


def _places(stretches: DataFrame, bitmap, sizes: list[int], window: int) -> DataFrame:
    """Where prefix shingles may stand, with the words around: ``doc_id, at_text, shingle, pos, from, words``."""

    def run(batches):
        hashes = WordHashes()
        for batch in by_bytes(batches, column="body"):
            rows = []
            for doc_id, at_text, start, body in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "at_text", "start", "body")), strict=True
            ):
                words = body.split(" ")
                own = hashes.of([w.encode() for w in words])
                for size in sizes:
                    if size <= len(words):
                        found = shingle_hashes(own, size)
                        for p in np.flatnonzero(in_bitmap(found, bitmap.value)).tolist():
                            a = max(0, p - window + size)
                            rows.append(
                                (doc_id, at_text, int(found[p].view(np.int64)), start + p, start + a,
                                 words[a : p + window])
                            )
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["doc_id", "at_text", "shingle", "pos", "from", "around"],
                )

    kinds = [pa.int64()] * 5 + [pa.list_(pa.string())]
    return stretches.mapInArrow(
        run, "doc_id long, at_text long, shingle long, pos long, from long, around array<string>"
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    min_share: float = 0.05,
) -> DataFrame:
    """``doc_id, at_text, n_words, n_hit, n_items, items_sha256, contaminated``, a row per input row.

    A word is hit if it stands in an occurrence of a window: ``window`` consecutive words of an item,
    or all words of a shorter one. ``contaminated``: some words are hit, and ``min_share`` of all.
    ``at_text`` is the xxhash64 of the text and tells rows of one id apart. A NULL text has no words;
    ids of documents may be NULL or repeat. A NULL item id counts as the empty string; items of one
    id are one item; items without words are in no document. Other columns are ignored. Without
    documents there are no rows, without items nothing is hit.
    """
    spark = docs.sparkSession
    windows = stage(
        item_windows(items, item_id_col, item_text_col, window, shingle).withColumn(
            "window", F.sha2(F.concat_ws(" ", "words"), 256)
        ),
        "item-windows",
    )
    distinct = windows.dropDuplicates(["window"]).select("window", "words", "shingles")
    of_items = distinct.select(
        "window", "words", F.posexplode("shingles").alias("offset", "shingle")
    )
    size = F.least(F.lit(shingle), F.size("words"))
    sizes = sorted(r[0] for r in distinct.select(size).distinct().collect())  # at most ``shingle``
    rows = id_and_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("at_text"), "text"
    )
    known = spark.sparkContext.broadcast(bitmap_of(of_items, "shingle"))
    read = stage(_stretches(rows, known, sizes), "stretches")
    stretches = (
        read.filter(F.size("starts") > 0)
        .dropDuplicates(["doc_id", "at_text"])
        .select("doc_id", "at_text", F.explode(F.arrays_zip("starts", "bodies")).alias("run"))
        .select("doc_id", "at_text", F.col("run.starts").alias("start"), F.col("run.bodies").alias("body"))
    )
    rarity = of_items.join(_counts(stretches, sizes), "shingle")
    least = F.row_number().over(Window.partitionBy("window").orderBy("n", "offset"))
    n_shingles = F.count("*").over(Window.partitionBy("window"))
    prefixes = stage(
        rarity.withColumn("place", least)
        .withColumn("n_found", n_shingles)
        # a window with a shingle that no document has is in none
        .filter((F.col("place") == 1) & (F.col("n_found") == F.size("words") - size + 1))
        .select("shingle", "window", "words", F.col("offset").cast("long").alias("offset")),
        "prefixes",
    )
    rare = spark.sparkContext.broadcast(bitmap_of(prefixes, "shingle"))
    first = F.col("pos") - F.col("offset")
    n = F.size("words").cast("long")
    hits = stage(
        salted_join(_places(stretches, rare, sizes, window), prefixes, ["shingle"], "doc_id")
        .withColumn("first", first)
        .filter(
            (F.col("first") >= F.col("from"))
            & (F.col("first") - F.col("from") + n <= F.size("around"))
        )
        .filter(
            F.slice("around", (F.col("first") - F.col("from") + 1).cast("int"), n.cast("int"))
            == F.col("words")
        )
        .select("doc_id", "at_text", "window", "first", (F.col("first") + n).alias("end")),
        "hits",
    )
    by_document = Window.partitionBy("doc_id", "at_text").orderBy("first", "end")
    before = F.max("end").over(by_document.rowsBetween(Window.unboundedPreceding, -1))
    n_hit = (
        hits.withColumn("from", F.greatest("first", F.coalesce(before, F.lit(0))))
        .groupBy("doc_id", "at_text")
        .agg(F.sum(F.greatest(F.col("end") - F.col("from"), F.lit(0))).alias("n_hit"))
    )
    of_window = windows.select("window", "item").distinct()
    names = (
        hits.select("doc_id", "at_text", "window")
        .distinct()
        .join(of_window, "window")
        .groupBy("doc_id", "at_text")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    key = ["doc_id", "at_text"]
    hit = F.coalesce("n_hit", F.lit(0))
    return (
        read.select(*key, "n_words")
        .join(n_hit.join(names, key), key, "left")
        .select(
            F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
            "at_text",
            "n_words",
            hit.alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256).alias(
                "items_sha256"
            ),
            ((hit > 0) & (hit >= F.col("n_words") * F.lit(min_share).cast("decimal(9,6)"))).alias(
                "contaminated"
            ),
        )
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
