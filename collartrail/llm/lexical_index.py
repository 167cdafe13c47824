"""Inverted index over whole texts, in shards, and ranked search by Block-Max MaxScore.

A task turns texts into shards of bounded size. A shard holds one row for each term: its postings in
blocks of ``BLOCK``, packed, with the last document and the highest impact of each block, and one row
for its documents. Searching brings the lists of the queries' terms of a shard together, once for each
block of queries. There

- lists whose highest scores together cannot reach the threshold are not essential: documents in
  them alone are never looked at;
- a candidate from the essential lists is dropped, before anything is unpacked, when the maximum of
  the block it would be in cannot lift it over the threshold;
- the best of a task's shards are kept in one heap for each query, and Spark merges the tasks' heaps.

All but the terms' weights is whole numbers, so scores are exact and do not depend on shards.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collartrail.llm.arrow import by_bytes
from collartrail.llm.text import ascii_lower
from collartrail.session import stage

#: Postings in a block, bytes of text in a shard, documents scored at a time.
BLOCK = 128
SHARD_BYTES = 32_000_000
WINDOW = 2_048
#: Bytes of query text, and queries, that are searched together.
QUERY_BYTES, QUERIES = 1_000_000, 1_000

# What a term is made of, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, FLAT, STEEP = 1_000_000_000, 25, 75

#: Separators become blanks and A-Z lower case; other bytes stay.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_PIECE = 1_000_000
_NO_ID = 2**63 - 1

_INDEX = (
    "shard long, term binary, found long, lasts array<int>, maxima array<long>, ends array<int>, "
    "body binary, ids array<long>, sizes array<int>"
)
_INDEX_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("term", pa.binary()),
        ("found", pa.int64()),
        ("lasts", pa.list_(pa.int32())),
        ("maxima", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int32())),
        ("body", pa.binary()),
        ("ids", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int32())),
    ]
)
_HITS = "item long, doc_id long, score long"
_HITS_ARROW = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


# --- packed numbers -----------------------------------------------------------------------


def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Seven bits to a byte, the last byte of a value below 128; and the end of each value."""
    values = values.astype(np.uint64)
    n_bytes = np.ones(len(values), np.int64)
    for k in range(1, 5):
        n_bytes += values >= np.uint64(1 << (7 * k))
    ends = np.cumsum(n_bytes)
    starts = ends - n_bytes
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(5):
        has = n_bytes > k
        part = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[starts[has] + k] = part | np.where(n_bytes[has] > k + 1, 128, 0).astype(np.uint64)
    return out.tobytes(), ends


def unpack(body: bytes) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    values = np.zeros(len(ends), np.int64)
    for k in range(int((ends - starts).max()) + 1 if len(ends) else 0):
        at = starts + k
        has = at <= ends
        values[has] |= (raw[at[has]].astype(np.int64) & 127) << (7 * k)
    return values


# --- building -----------------------------------------------------------------------------


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in pieces of bounded size, cut between terms."""
    start = 0
    while len(text) - start > _PIECE:
        piece = text[start : start + _PIECE].translate(_PLAIN)
        cut = piece.rfind(b" ")
        if cut < 0:
            # one term is longer than a piece: take all to its end
            rest = text[start + _PIECE :].translate(_PLAIN)
            end = rest.find(b" ")
            cut = _PIECE + (len(rest) if end < 0 else end)
            piece = text[start : start + cut].translate(_PLAIN)
        yield piece[:cut].split()
        start += cut
    yield text[start:].translate(_PLAIN).split()


def length_norm(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return FLAT + (STEEP * sizes.astype(np.int64) * n_docs) // max(n_terms, 1)


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + 8 * norm)


class _Terms(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


class ShardBuilder:
    """Collects texts and writes them as the rows of one shard."""

    def __init__(self, n_docs: int, n_terms: int, block: int):
        self.n_docs, self.n_terms, self.block = n_docs, n_terms, block
        self.clear()

    def clear(self):
        self.terms, self.ids, self.sizes, self.bytes = _Terms(), [], [], 0
        self.at_term, self.at_doc, self.tf = [], [], []

    def add(self, doc_id: int | None, text: bytes):
        found = np.zeros(0, np.int64)
        counts, size = found, 0
        for words in words_of(text):
            numbers = np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))
            size += len(words)
            both, n = np.unique(numbers, return_counts=True)
            if len(found):
                both, place = np.unique(np.concatenate([found, both]), return_inverse=True)
                n = np.bincount(place, np.concatenate([counts, n])).astype(np.int64)
            found, counts = both, n
        self.bytes += len(text)
        if not size:
            return
        self.at_term.append(found.astype(np.int32))
        self.tf.append(counts.astype(np.int32))
        self.at_doc.append(np.full(len(found), len(self.ids), np.int32))
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.sizes.append(size)

    def rows(self, shard: int, most: int = 20_000) -> Iterator[pa.RecordBatch]:
        """The documents' row, then the terms' rows in batches."""
        if not self.ids:
            return
        sizes = np.array(self.sizes, np.int64)
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "ids": self.ids, "sizes": self.sizes}], _INDEX_ARROW
        )
        term, doc, tf = (np.concatenate(x) for x in (self.at_term, self.at_doc, self.tf))
        order = np.argsort(term, kind="stable")  # documents stay in order within a term
        doc, tf = doc[order].astype(np.int64), tf[order].astype(np.int64)
        found = np.bincount(term, minlength=len(self.terms)).astype(np.int64)
        worth = impact(tf, length_norm(sizes, self.n_docs, self.n_terms)[doc])
        names = list(self.terms)
        begin = np.concatenate([[0], np.cumsum(found)])
        for low in range(0, len(names), most):
            high = min(low + most, len(names))
            part = slice(begin[low], begin[high])
            yield self._batch(shard, names[low:high], found[low:high], doc[part], tf[part], worth[part])

    def _batch(self, shard, names, found, doc, tf, worth) -> pa.RecordBatch:
        block = self.block
        n_blocks = -(-found // block)
        list_of_block = np.repeat(np.arange(len(found)), n_blocks)
        first_block = np.cumsum(n_blocks) - n_blocks
        within = np.arange(len(list_of_block)) - first_block[list_of_block]
        begins = (np.cumsum(found) - found)[list_of_block] + within * block
        lengths = np.minimum(found[list_of_block] - within * block, block)
        # gaps within a block, the first document as it is; then how often each has the term
        gaps = np.diff(doc, prepend=0)
        gaps[begins] = doc[begins]
        place = np.arange(len(doc)) + np.repeat(begins, lengths)
        mixed = np.zeros(2 * len(doc), np.int64)
        mixed[place] = gaps
        mixed[place + np.repeat(lengths, lengths)] = tf
        body, ends = pack(mixed)
        block_end = ends[2 * (begins + lengths) - 1]
        list_end = block_end[np.cumsum(n_blocks) - 1]
        list_begin = np.concatenate([[0], list_end[:-1]])
        offsets = pa.array(np.concatenate([[0], np.cumsum(n_blocks)]).astype(np.int32))

        def lists(values, kind):
            return pa.ListArray.from_arrays(offsets, pa.array(values, kind))

        empty = pa.nulls(len(names), pa.list_(pa.int64())), pa.nulls(len(names), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(names), shard, np.int64)),
                pa.array(names, pa.binary()),
                pa.array(found),
                lists(doc[begins + lengths - 1].astype(np.int32), pa.int32()),
                lists(np.maximum.reduceat(worth, begins), pa.int64()),
                lists((block_end - list_begin[list_of_block]).astype(np.int32), pa.int32()),
                pa.array([body[a:b] for a, b in zip(list_begin, list_end)], pa.binary()),
                *empty,
            ],
            schema=_INDEX_ARROW,
        )


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and all terms of the table with repeats."""
    n = F.regexp_count(F.col(f"`{text_col}`"), F.lit(TERM))
    row = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    return int(row[0] or 0), int(row[1] or 0)


def build_index(
    docs: DataFrame,
    n_docs: int,
    n_terms: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    block: int = BLOCK,
) -> DataFrame:
    """All terms of all texts, as rows of shards of about ``shard_bytes`` of text; one text is never
    split over shards. Written below the shared folder."""

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        shard = ShardBuilder(n_docs, n_terms, block)
        for batch in by_bytes(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                shard.add(doc_id, text)
                if shard.bytes >= shard_bytes:
                    yield from shard.rows((task << 32) + made)
                    shard.clear()
                    made += 1
        yield from shard.rows((task << 32) + made)

    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
    )
    return stage(texts.mapInArrow(run, _INDEX), "lexical-index")


# --- searching ----------------------------------------------------------------------------


class Postings:
    """One term's list in one shard; blocks are unpacked when needed, and then kept."""

    def __init__(self, row: dict, norm: np.ndarray):
        self.lasts = np.array(row["lasts"], np.int64)
        self.maxima = np.array(row["maxima"], np.int64)
        self.begins = [0, *row["ends"]]
        self.body, self.norm, self.made = row["body"], norm, {}
        self.highest = int(self.maxima.max())
        self.unpacked = 0

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and the term's impact in each."""
        if b not in self.made:
            values = unpack(self.body[self.begins[b] : self.begins[b + 1]])
            half = len(values) // 2
            docs = np.cumsum(values[:half])
            self.made[b] = docs, impact(values[half:], self.norm[docs])
            self.unpacked += 1
        return self.made[b]

    def between(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents from ``low`` up to before ``high``, with impacts."""
        first = int(np.searchsorted(self.lasts, low))
        last = min(int(np.searchsorted(self.lasts, high - 1)), len(self.lasts) - 1)
        for b in range(first, last + 1):
            docs, worth = self.block(b)
            a, z = np.searchsorted(docs, [low, high])
            if z > a:
                yield docs[a:z], worth[a:z]

    def block_maxima(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block each document would be in, and that block's maximum; 0 behind the last."""
        at = np.searchsorted(self.lasts, docs)
        known = at < len(self.lasts)
        return at, np.where(known, self.maxima[np.minimum(at, len(self.lasts) - 1)], 0)

    def of(self, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Impacts in ``docs``, which are in blocks ``at``; 0 where the term is not."""
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(at[at < len(self.lasts)]):
            mine = np.flatnonzero(at == b)
            held, worth = self.block(int(b))
            place = np.minimum(np.searchsorted(held, docs[mine]), len(held) - 1)
            out[mine] = np.where(held[place] == docs[mine], worth[place], 0)
        return out


class Heap:
    """The ``top`` best of what was offered: highest score first, then least id."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        """A score below this one cannot enter; no score below 1 ever does."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray):
        good = scores >= self.threshold
        if not good.any():
            return
        scores = np.concatenate([self.scores, scores[good]])
        ids = np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


def search_shard(
    lists: list[tuple[int, Postings]], ids: np.ndarray, heap: Heap, window: int = WINDOW
) -> None:
    """Offer ``heap`` the documents of a shard that can enter it. ``lists``: weight and postings."""
    lists = sorted(((w * p.highest, w, p) for w, p in lists), key=lambda x: x[0])
    #: what the lists up to and with each can give together
    reach = np.cumsum([bound for bound, _, _ in lists])
    for low in range(0, len(ids), window):
        high = min(low + window, len(ids))
        essential = int(np.searchsorted(reach, heap.threshold))
        if essential == len(lists):
            return  # no document of the shard can enter any more
        score, seen = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
        for _, w, postings in lists[essential:]:
            for docs, worth in postings.between(low, high):
                score[docs - low] += w * worth
                seen[docs - low] = True
        docs = np.flatnonzero(seen)
        score, docs = score[docs], docs + low
        for k in range(essential - 1, -1, -1):
            _, w, postings = lists[k]
            rest = reach[k - 1] if k else 0
            good = score + reach[k] >= heap.threshold
            score, docs = score[good], docs[good]
            at, most = postings.block_maxima(docs)
            good = score + w * most + rest >= heap.threshold
            score, docs, at = score[good], docs[good], at[good]
            if not len(docs):
                break
            score = score + w * postings.of(docs, at)
        heap.offer(score, ids[docs])


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``query_id, digest, n_bytes, term, times``: rows equal in id and text are one query."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = queries.select(
        F.col(f"`{id_col}`").cast("long").alias("query_id"), F.sha2(text, 256).alias("digest"), text.alias("text")
    ).dropDuplicates(["query_id", "digest"])
    terms = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0))
    return (
        own.select("query_id", "digest", F.octet_length("text").alias("n_bytes"), F.explode(terms).alias("term"))
        .groupBy("query_id", "digest", "n_bytes", F.col("term").cast("binary").alias("term"))
        .agg(F.count("*").alias("times"))
    )


def _weights(wanted: DataFrame, index: DataFrame, n_docs: int) -> DataFrame:
    """``wanted`` with the weight of each term; terms of no document are left out."""
    held = index.select("term", "found").join(wanted.select("term").distinct(), "term", "left_semi")
    df = held.groupBy("term").agg(F.sum("found").alias("df"))
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    return wanted.join(df, "term").withColumn("weight", w * F.col("times")).drop("df", "times")


def search(
    index: DataFrame,
    queries: DataFrame,
    n_docs: int,
    n_terms: int,
    top: int = 10,
    id_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """``query_id, digest, rank, doc_id, score``: the ``top`` best documents of each query.

    Rows of ``queries`` equal in id and text are one query; such with one id and other texts are
    ranked each for itself (``digest`` tells them apart). A query without terms has no rows. Scores
    are above 0; equal ones go by ascending id, documents without an id last. Documents that repeat
    an id are ranked each for itself.
    """
    wanted = query_terms(queries, id_col, text_col)
    named = wanted.select("query_id", "digest", "n_bytes").distinct()
    size = named.agg(F.count("*"), F.sum("n_bytes")).first()
    groups = max(-(-(size[0] or 0) // QUERIES), -(-(size[1] or 0) // QUERY_BYTES), 1)
    weighted = _weights(wanted, index, n_docs).withColumn("item", F.xxhash64("query_id", "digest"))
    group = F.pmod("item", F.lit(groups)).cast("int")
    weighted = stage(weighted.withColumn("group", group).drop("n_bytes"), "lexical-terms")
    by_query = weighted.groupBy("item", "group").agg(
        F.collect_list(F.struct("term", "weight")).alias("asked")
    )
    # a shard meets each group of queries: its documents, the queries, and lists of their terms
    every_group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    documents = index.filter("term is null").select("shard", "ids", "sizes", every_group.alias("group"))
    parts = [
        documents.withColumn("kind", F.lit(0)),
        index.filter("term is not null")
        .drop("ids", "sizes", "found")
        .join(weighted.select("term", "group").distinct(), "term")
        .withColumn("kind", F.lit(1)),
        documents.select("shard", "group").join(by_query, "group").withColumn("kind", F.lit(2)),
    ]
    met = parts[0]
    for part in parts[1:]:
        met = met.unionByName(part, allowMissingColumns=True)
    # the shards of one group of queries follow each other in a task, and share its heaps
    met = met.repartition("group", "shard").sortWithinPartitions("group", "shard", "kind")
    hits = met.mapInArrow(_searcher(n_docs, n_terms, top), _HITS)
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    names = weighted.select("item", "query_id", "digest").distinct()
    return ranked.join(names, "item").select("query_id", "digest", "rank", "doc_id", "score")


def _searcher(n_docs: int, n_terms: int, top: int):
    def run(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, of_group in groupby(rows, key=lambda r: r["group"]):
            heaps = defaultdict(lambda: Heap(top))
            for _, of_shard in groupby(of_group, key=lambda r: r["shard"]):
                documents = next(of_shard)
                norm = length_norm(np.array(documents["sizes"]), n_docs, n_terms)
                ids, lists = np.array(documents["ids"], np.int64), {}
                for row in of_shard:
                    if row["kind"] == 1:
                        lists[row["term"]] = Postings(row, norm)
                        continue
                    asked = [
                        (a["weight"], lists[a["term"]]) for a in row["asked"] if a["term"] in lists
                    ]
                    search_shard(asked, ids, heaps[row["item"]])
            yield from _hits(heaps)

    return run


def _hits(heaps: dict[int, Heap]) -> Iterator[pa.RecordBatch]:
    for item, heap in heaps.items():
        ids = [None if i == _NO_ID else i for i in heap.ids.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([item] * len(ids), pa.int64()), pa.array(ids, pa.int64()), pa.array(heap.scores)],
            schema=_HITS_ARROW,
        )


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
) -> DataFrame:
    """Index ``docs`` and rank them for ``queries``; see ``search``.

    A NULL or empty text has no terms; such documents are in no result. An empty table of documents
    or queries gives no rows. Other columns are ignored.
    """
    n_docs, n_terms = corpus_size(docs, text_col)
    index = build_index(docs, n_docs, n_terms, id_col, text_col)
    return search(index, queries, n_docs, n_terms, top, query_id_col, query_text_col)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
