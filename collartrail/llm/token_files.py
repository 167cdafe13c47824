"""Token ids of documents in files of ``seekable``, written and read by tasks.

Documents are dealt out by ranges of their ids, so file k holds smaller ids than file k + 1. The
manifest, one row per file, is what counts as written: a file left by a lost task is not in it.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from collartrail.llm.arrow import by_bytes, per_worker
from collartrail.llm.seekable import Reader, Writer
from collartrail.llm.text import id_and_text

CACHE_UNITS = 600_000
#: Units of a lower-cased text for vocabularies that split words, digits and punctuation apart:
#: letters, a digit, punctuation. What stands next to a character of another kind, or an apostrophe
#: in front of a letter, is taken to the end of its word, and the library splits it.
_UNIT = re.compile(
    rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++(?![\x80-\xff])"
    rb"|[0-9](?![\x80-\xff])"
    rb"|(?!'[a-z\x80-\xff])[!-/:-@\[-`{-~]++(?![\x00-\x08\x0e-\x1f\x7f-\xff])"
    rb"|[^\x20\x09-\x0D]+"
)
MANIFEST = "shard int, path string, n_docs long, n_tokens long, first_id long, last_id long"


def units(text: str) -> list[bytes]:
    """Parts of a text that the vocabulary treats each on its own.

    A text that may hold a special token is only cut at blanks and keeps its capitals.
    """
    body = text.encode()
    return body.split() if b"<|" in body else _UNIT.findall(body.lower())


class Places(dict):
    """Numbers units in the order in which they are first asked for; ``new`` lists the latest."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, unit: bytes) -> int:
        self[unit] = place = len(self)
        self.new.append(unit)
        return place


class UnitIds:
    """Ids of texts, each unit encoded once. Emptied when full: memory is bounded, ids the same."""

    def __init__(self, tokenizer, most: int = CACHE_UNITS):
        self.tokenizer, self.most = tokenizer, most
        self._clear()

    def _clear(self) -> None:
        self.places = Places()
        self.flat = np.zeros(0, np.uint32)
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)

    def _learn(self) -> None:
        flat, lengths = [self.flat], [self.lengths]
        for start in range(0, len(self.places.new), 8192):
            part = [u.decode() for u in self.places.new[start : start + 8192]]
            found = [x.ids for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            flat.append(np.fromiter(chain.from_iterable(found), np.uint32))
        self.places.new = []
        self.flat, self.lengths = np.concatenate(flat), np.concatenate(lengths)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def of(self, texts: Sequence[str]) -> list[np.ndarray]:
        if len(self.places) > self.most:
            self._clear()
        cut = [units(t) for t in texts]
        n_units = np.fromiter(map(len, cut), np.int64, len(cut))
        place = self.places.__getitem__
        at = np.fromiter(map(place, chain.from_iterable(cut)), np.int64, int(n_units.sum()))
        if self.places.new:
            self._learn()
        n = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.starts[at] - ends[:-1], n) + np.arange(ends[-1])]
        return np.split(ids, ends[np.cumsum(n_units)[:-1]])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text, append ``end_id``, write files below ``folder``; returns the manifest.

    ``folder`` is a place that all tasks reach, as a path or URI that Arrow opens. Documents are in
    ascending order of id: NULL first, rows of one id by their text's length and hash. A NULL or
    empty text has the end id only. Other columns are ignored. An empty table gives an empty
    manifest and no file.
    """
    spark = docs.sparkSession
    order = ["doc_id", F.octet_length("text"), F.xxhash64("text")]
    rows = id_and_text(docs, id_col, text_col)
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        unit_ids = per_worker(
            ("ids", tokenizer_file), lambda: UnitIds(Tokenizer.from_file(tokenizer_file))
        )
        end = np.array([end_id], np.uint32)
        shard = TaskContext.get().partitionId()
        path = f"{folder}/ids-{shard:06d}-{uuid.uuid4().hex}.zst"
        writer = stream = None
        for batch in by_bytes(batches):
            if stream is None:
                store, place = fs.FileSystem.from_uri(path)
                store.create_dir(os.path.dirname(place), recursive=True)
                stream = store.open_output_stream(place, compression=None)
                writer = Writer(stream)
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(),
                unit_ids.of(batch.column("text").to_pylist()),
                strict=True,
            ):
                writer.add(doc_id, np.concatenate([ids, end]))
        if stream is not None:
            writer.close()
            stream.close()
            known = [d[0] for d in writer.documents if not d[1]]
            row = (shard, path, len(writer.documents), sum(d[2] for d in writer.documents))
            row += (known[0], known[-1]) if known else (None, None)
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("shard", "path", "n_docs", "n_tokens", "first_id", "last_id"), row, strict=True))],
                schema=pa.schema(
                    [("shard", pa.int32()), ("path", pa.string())]
                    + [(c, pa.int64()) for c in ("n_docs", "n_tokens", "first_id", "last_id")]
                ),
            )

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(
    manifest: DataFrame, doc_ids: Sequence[int] | None = None, with_ids: bool = False
) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, if asked for, ``ids``, read from the files.

    ``start`` counts the ids of all documents before. With ``doc_ids`` only files whose range holds
    one of them are opened, and only their documents are decompressed.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    wanted = None if doc_ids is None else sorted(set(doc_ids))
    if wanted is not None:
        near = F.exists(
            F.array(*[F.lit(i).cast("long") for i in wanted]).cast("array<long>"),
            lambda i: i.between(F.col("first_id"), F.col("last_id")),
        )
        files = files.filter(near)
    files = files.select("path", "base").repartition(max(1, manifest.count()))
    columns = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]
    columns += [("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids
    schema = pa.schema(columns)

    def run(batches):
        for batch in batches:
            for file in batch.to_pylist():
                store, place = fs.FileSystem.from_uri(file["path"])
                with store.open_input_file(place) as stream:
                    reader = Reader(stream)
                    n = reader.documents["n_tokens"].astype(np.int64)
                    starts = file["base"] + np.cumsum(n) - n
                    at = range(len(n)) if wanted is None else [k for i in wanted for k in reader.find(i)]
                    rows = []
                    for k in at:
                        ids = reader.ids(k)
                        row = (reader.doc_id(k), int(starts[k]), len(ids), zlib.crc32(ids.tobytes()))
                        rows.append((*row, ids.tolist()) if with_ids else row)
                        if len(rows) == 4096:
                            yield _batch(rows, schema)
                            rows = []
                    if rows:
                        yield _batch(rows, schema)

    kinds = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return files.mapInArrow(run, kinds)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
