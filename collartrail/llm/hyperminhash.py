"""Near-duplicates by HyperMinHash: banded registers, corrected estimates, exact verification.

A document's shingles fall into buckets; a register holds the leading zeros of the least hash of its
bucket and the bits that follow. Empty buckets borrow from others in a fixed random order.

1. Documents with equal shingle sets form a class; only the class's least id goes on.
2. Bands of registers name places; all classes in a place form a star around the least of them.
   Stars around one class are one group: what shares a place shares a group.
3. A group is cut into blocks of bounded size. Within a block registers of all pairs are compared,
   and what may be similar is verified on full sets. A block returns a spanning forest of its links.
4. In groups of several blocks, classes that the links have not joined to the group's centre, and
   that have enough shingles in common with the group to be linked at all, are compared with all
   blocks. Then no pair of a group is left that could still join two components.
5. Links give components.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collartrail.llm.arrow import by_bytes
from collartrail.llm.bitmap import bitmap_of, in_bitmap
from collartrail.llm.components import components
from collartrail.llm.shingles import WordHashes, mix, shingle_sets
from collartrail.llm.text import NO_ID, id_and_text, salted_join
from collartrail.session import stage

ROWS = 5
MISS = 1e-6
MANTISSA_BITS = 10
VALUE_BITS = 44
MARGIN = 5.0
BLOCK_NODES = 1500
BLOCK_SHINGLES = 1_000_000
DENSE_COLUMNS = 4096
_EMPTY = np.uint64(2**64 - 1)


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands so that a pair of this similarity shares none with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


def least_size(similarity: float) -> int:
    """Sets of fewer shingles are similar to equal sets only."""
    return math.ceil(similarity / (1 - similarity) - 1e-9)


class Registers:
    """HyperMinHash registers of shingle sets, ``n`` a set."""

    def __init__(self, n: int):
        self.n = n
        # where an empty bucket looks for a value, the same for all documents
        order = mix(np.arange(1, n * n + 1, dtype=np.uint64)).reshape(n, n)
        self.lenders = np.argsort(order, axis=1)

    def of(self, sets: list[np.ndarray]) -> np.ndarray:
        """16-bit registers, one row per set; sets must not be empty."""
        least = np.full((len(sets), self.n), _EMPTY)
        for row, hashes in zip(least, sets, strict=True):
            bucket = ((hashes >> np.uint64(VALUE_BITS)) * np.uint64(self.n)) >> np.uint64(64 - VALUE_BITS)
            np.minimum.at(row, bucket.astype(np.int64), hashes & np.uint64((1 << VALUE_BITS) - 1))
        lent, missing = least.copy(), least == _EMPTY
        for k in range(self.n):
            rows, columns = np.nonzero(missing)
            if not len(rows):
                break
            found = least[rows, self.lenders[columns, k]]
            lent[rows, columns] = found
            missing[rows, columns] = found == _EMPTY
        return compress(lent)


def compress(values: np.ndarray) -> np.ndarray:
    """Leading zeros of values of ``VALUE_BITS`` bits, then ``MANTISSA_BITS`` bits behind the first one."""
    _, exponent = np.frexp(values.astype(np.float64))
    zeros = VALUE_BITS - exponent.astype(np.int64)
    shift = np.clip(exponent - 1 - MANTISSA_BITS, 0, None).astype(np.uint64)
    up = np.clip(MANTISSA_BITS + 1 - exponent, 0, None).astype(np.uint64)
    mantissa = ((values >> shift) << up) & np.uint64((1 << MANTISSA_BITS) - 1)
    return (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)


def band_places(registers: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit place for each set and band."""
    place = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(registers), 1))
    rows = registers.shape[1] // bands
    parts = registers[:, : bands * rows].reshape(len(registers), bands, rows).astype(np.uint64)
    for k in range(rows):
        place = mix(place * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return place.view(np.int64)


def corrected(equal_share: np.ndarray) -> np.ndarray:
    """Jaccard estimates from shares of equal registers, without what collides by chance.

    Two different least values agree in zeros and mantissa with a probability of about
    ``2**-MANTISSA_BITS`` times the chance of as many leading zeros, a third for equal scales.
    """
    chance = 2.0**-MANTISSA_BITS / 3
    return np.clip((equal_share - chance) / (1 - chance), 0, 1)


def intersections(sets: list[np.ndarray], dense_from: int = 24) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as a matrix.

    Shingles in many sets go through a dense product in slices, those in few are counted pair by pair.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    owner = np.repeat(np.arange(n), sizes)
    _, word, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    out = np.diag(sizes).astype(np.float32)
    common = np.flatnonzero(count >= dense_from)
    column = np.full(len(count), -1)
    column[common] = np.arange(len(common))
    for start in range(0, len(common), DENSE_COLUMNS):
        at = column[word]
        use = (at >= start) & (at < start + DENSE_COLUMNS)
        dense = np.zeros((n, min(DENSE_COLUMNS, len(common) - start)), np.float32)
        dense[owner[use], at[use] - start] = 1
        product = dense @ dense.T
        np.fill_diagonal(product, 0)
        out += product
    few = (count[word] > 1) & (count[word] < dense_from)
    by_word = np.lexsort((owner[few], word[few]))
    w, o = word[few][by_word], owner[few][by_word]
    for gap in range(1, dense_from):
        same = w[gap:] == w[:-gap]
        if not same.any():
            break
        pair = o[:-gap][same] * n + o[gap:][same]
        found, times = np.unique(pair, return_counts=True)
        i, j = np.divmod(found, n)
        out[i, j] += times
        out[j, i] += times
    return out


def linked_pairs(
    sets: list[np.ndarray], percent: int, registers: Registers, margin: float = MARGIN
) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j of the pairs with ``100 * intersection >= percent * union``."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    similarity = percent / 100
    found = registers.of(sets)
    low = similarity - margin * math.sqrt(similarity * (1 - similarity) / registers.n)
    near = np.zeros((len(sets), len(sets)), bool)
    for i, row in enumerate(found[:-1]):
        share = corrected((found[i + 1 :] == row).mean(axis=1))
        # few shingles fill few buckets, so that registers repeat each other and tell less
        unsure = np.minimum(n[i + 1 :], n[i]) < registers.n
        fits = 100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i])
        near[i, i + 1 :] = fits & ((share >= low) | unsure)
    use = np.flatnonzero(near.any(axis=0) | near.any(axis=1))
    if not len(use):
        return use, use
    both = intersections([sets[k] for k in use]).astype(np.int64)
    union = n[use][:, None] + n[use][None, :] - both
    i, j = np.nonzero(near[np.ix_(use, use)] & (100 * both >= percent * union))
    return use[i], use[j]


def forest(n: int, pairs: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those of the pairs that join two trees."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            yield i, j


def signatures(rows: DataFrame, words: int, bands: int, least: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, places``: size and digest of the set, and its places.

    Sets of fewer than ``least`` shingles have no places.
    """

    def run(batches):
        hashes, registers = WordHashes(), Registers(bands * ROWS)
        for batch in by_bytes(batches):
            texts = batch.column("text").to_pylist()
            sets = shingle_sets([t.encode().lower().split() for t in texts], words, hashes)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            banded = [k for k, s in enumerate(sets) if len(s) >= least]
            places: list = [None] * len(sets)
            if banded:
                found = band_places(registers.of([sets[k] for k in banded]), bands)
                for k, row in zip(banded, found, strict=True):
                    places[k] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(halves[:, 0]),
                    pa.array(halves[:, 1]),
                    pa.array(places, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "places"],
            )

    return rows.mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, places array<long>"
    )


def _sets(rows: DataFrame, words: int, needed: DataFrame) -> DataFrame:
    """``node, shingles``: the distinct hashes of texts in ascending order, as bytes.

    Of all documents in ``needed``, and of the few that its bitmap lets through in error.
    """
    some = rows.sparkSession.sparkContext.broadcast(
        bitmap_of(needed.select(F.xxhash64("node").alias("hash")), "hash")
    )

    def run(batches):
        hashes = WordHashes()
        for batch in by_bytes(batches):
            hash_of_id = batch.column("hash").to_numpy().view(np.uint64)
            batch = batch.filter(pa.array(in_bitmap(hash_of_id, some.value)))
            texts = batch.column("text").to_pylist()
            sets = shingle_sets([t.encode().lower().split() for t in texts], words, hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["node", "shingles"],
            )

    hashed = rows.select("doc_id", F.xxhash64("doc_id").alias("hash"), "text")
    return hashed.mapInArrow(run, "node long, shingles binary")


def _links_in_blocks(blocks: DataFrame, percent: int, n_registers: int) -> DataFrame:
    """Links within each (``centre``, ``block``), a spanning forest of them: ``a, b``.

    Rows ``centre, block, node, shingles, asks``. If a block has rows that ask, only pairs with one
    of them count.
    """

    def run(batches):
        registers = Registers(n_registers)
        for members in _runs(batches):
            sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
            nodes = [m["node"] for m in members]
            i, j = linked_pairs(sets, percent, registers)
            asks = np.array([m["asks"] for m in members])
            if asks.any():
                use = asks[i] | asks[j]
                i, j = i[use], j[use]
            found = list(forest(len(nodes), zip(i.tolist(), j.tolist(), strict=True)))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([nodes[x] for x, _ in found], pa.int64()),
                        pa.array([nodes[y] for _, y in found], pa.int64()),
                    ],
                    names=["a", "b"],
                )

    dealt = blocks.repartition("centre", "block").sortWithinPartitions("centre", "block", "node")
    return dealt.mapInArrow(run, "a long, b long")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (``centre``, ``block``) after another, two rows at least."""
    own, members = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["centre"], row["block"]
            if key != own:
                if len(members) > 1:
                    yield members
                own, members = key, []
            members.append(row)
    if len(members) > 1:
        yield members


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_nodes: int = BLOCK_NODES,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row.

    Documents with ``100 * intersection >= percent * union`` of their sets of ``words``-word shingles
    are linked; ``component_id`` is the least id reachable. Words are what stands between blanks,
    A-Z in lower case. A NULL text is empty; texts without words are linked with nothing. Rows of
    one id count as one document. A NULL id is the least of all and stays NULL. Other columns are
    ignored. An empty table gives no rows.
    """
    similarity = percent / 100
    bands, least = bands_for(similarity), least_size(similarity)
    rows = id_and_text(docs, id_col, text_col).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID))
    )
    signed = stage(signatures(rows, words, bands, least), "signatures")
    worded = signed.filter("n_shingles > 0")
    classes = worded.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
    nodes = stage(
        salted_join(
            worded.select("doc_id", "n_shingles", "d1", "d2"), classes, ["d1", "d2"], "doc_id"
        ).drop("d1", "d2"),
        "nodes",
    )
    placed = (
        signed.filter("places is not null")
        .join(classes, ["d1", "d2"])
        .filter("doc_id = node")
        .select("node", "n_shingles", F.explode("places").alias("place"))
    )
    centres = (
        placed.groupBy("place")
        .agg(F.min("node").alias("centre"), F.max("node").alias("other"))
        .filter("centre < other")
        .select("place", "centre")
    )
    members = stage(
        salted_join(placed, centres, ["place"], "node")
        .groupBy("centre", "node")
        .agg(F.max("n_shingles").alias("n")),
        "members",
    )
    groups = members.groupBy("centre").agg(
        F.greatest(F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n") / block_shingles))
        .cast("int")
        .alias("n_blocks")
    )
    in_blocks = salted_join(members, groups, ["centre"], "node").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    )
    sets = stage(_sets(rows, words, members), "sets")
    of_centres = groups.filter("n_blocks > 1").select(
        "centre",
        F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"),
        F.col("centre").alias("node"),
    )
    with_centre = (
        in_blocks.filter("n_blocks = 1 or node != centre")
        .select("centre", "block", "node")
        .unionByName(of_centres)
        .withColumn("asks", F.lit(False))
    )
    links = stage(_links_in_blocks(with_centre.join(sets, "node"), percent, bands * ROWS), "links")
    large = in_blocks.filter("n_blocks > 1")
    if not large.isEmpty():
        large = stage(large, "large-groups")
        more = _links_across_blocks(large, sets, links, percent, bands * ROWS, block_nodes, block_shingles)
        links = links.unionByName(stage(more, "links"))
    of_id = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    repeated = (
        nodes.join(of_id.filter("a < z"), "doc_id")
        .filter("a < node")
        .select("a", F.col("node").alias("b"))
    )
    joined = components(links.unionByName(repeated))
    found = salted_join(nodes, joined, ["node"], "doc_id", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    alone = signed.filter("n_shingles = 0").withColumn("component", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component"]
    return (
        found.select(*columns)
        .unionByName(alone.select(*columns))
        .select(
            F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
            "n_shingles",
            F.nullif("component", F.lit(NO_ID)).alias("component_id"),
            (F.col("doc_id") == F.col("component")).alias("kept"),
        )
    )


def _links_across_blocks(
    large: DataFrame,
    sets: DataFrame,
    links: DataFrame,
    percent: int,
    n_registers: int,
    block_nodes: int,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """Links of groups of several blocks that the first pass could not see."""
    joined = stage(components(links), "components")
    of_node = joined.select("node", F.col("component"))
    of_centre = joined.select(F.col("node").alias("centre"), F.col("component").alias("main"))
    apart = (
        large.join(of_node, "node", "left")
        .join(of_centre, "centre", "left")
        .filter(F.coalesce("component", "node") != F.coalesce("main", "centre"))
        .select("centre", "node", "n_blocks")
    )
    asking = _may_be_linked(large, sets, apart, percent)
    slices = _slices(asking, block_nodes, block_shingles)
    at = lambda i: (F.col("block") * F.col("n_slices") + i).cast("int")
    asked = (
        large.join(slices, "centre")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("n_slices") - 1)))
        .select("centre", at(F.col("slice")).alias("block"), "node", F.lit(False).alias("asks"))
    )
    queries = (
        asking.join(slices, "centre")
        .withColumn("slice", F.pmod(F.xxhash64(F.lit(5), F.col("node")), F.col("n_slices")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("centre", at(F.col("slice")).alias("block"), "node", F.lit(True).alias("asks"))
    )
    both = asked.unionByName(queries).groupBy("centre", "block", "node").agg(F.max("asks").alias("asks"))
    return _links_in_blocks(both.join(sets, "node"), percent, n_registers)


def _slices(asking: DataFrame, block_nodes: int, block_shingles: int) -> DataFrame:
    """Into how many parts the asking nodes of a group are cut, which are as bounded as blocks."""
    return asking.groupBy("centre").agg(
        F.greatest(F.ceil(F.count("*") / block_nodes), F.ceil(F.sum("n_all") / block_shingles), F.lit(1))
        .cast("int")
        .alias("n_slices")
    )


def _may_be_linked(large: DataFrame, sets: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """Of the nodes in ``apart``, those with enough shingles that others of the large groups have too.

    A set can only be linked if ``percent`` of its shingles are also in another set.
    """
    nodes = large.select("node").distinct().join(sets, "node")

    def run(batches):
        for batch in batches:
            for node, packed in zip(
                batch.column("node").to_pylist(), batch.column("shingles").to_pylist(), strict=True
            ):
                hashes = np.frombuffer(packed, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hashes), node)), pa.array(hashes)], names=["node", "shingle"]
                )

    shingles = nodes.mapInArrow(run, "node long, shingle long")
    own = (
        shingles.groupBy("shingle")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"))
        .filter("n = 1")
        .groupBy("node")
        .agg(F.count("*").alias("n_own"))
    )
    size = sets.select("node", (F.octet_length("shingles") / 8).cast("long").alias("n_all"))
    return (
        apart.join(size, "node")
        .join(own, "node", "left")
        .filter((F.col("n_all") - F.coalesce("n_own", F.lit(0))) * 100 >= F.col("n_all") * percent)
        .select("centre", "node", "n_blocks", "n_all")
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
