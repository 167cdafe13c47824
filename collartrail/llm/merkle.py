"""Merkle manifest of a table: a tree for each source, and one over the sources.

Leaves are put in order by one range shuffle. Trees are then climbed a block of ``FANOUT ** LEVELS``
nodes at a time, so a task holds one block, never a source, and each round is a written table that is
a block's size smaller than the one before. On the way down each block is given what lies above it once
for all its leaves.

A parent keeps a copy of its hash state from before each of its children. A changed child is folded by
going on from the copy at its place with the new digest and those to the right of it; what is to the
left is never hashed again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collartrail.session import stage

# Fixed values of the format: children of a parent, and what stands for a missing value.
FANOUT = 3
MISSING = "-"

#: Levels climbed in one task; a block has FANOUT ** LEVELS nodes at most.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<left: array<string>, right: array<string>>>"
_NODE = "grp string, pos long, n long, digest string"
_PATH = f"grp string, pos long, steps {_STEPS}, subroot string, root string"
_ROWS = 5_000


# --- hash states --------------------------------------------------------------------------


class Slot:
    """A place among a parent's children: the state before it, and the digests to its right."""

    __slots__ = ("state", "left", "right")

    def __init__(self, state, left: Sequence[bytes], right: Sequence[bytes]):
        self.state, self.left, self.right = state, left, right

    def fold(self, child: bytes) -> bytes:
        """The parent's digest with ``child`` in this place."""
        state = self.state.copy()
        state.update(child)
        for digest in self.right:
            state.update(digest)
        return state.hexdigest().encode()


def parent(children: Sequence[bytes]) -> tuple[bytes, list[Slot]]:
    """The digest over ``children``, and a slot for each of them."""
    state, slots = sha256(), []
    for k, child in enumerate(children):
        slots.append(Slot(state.copy(), children[:k], children[k + 1 :]))
        state.update(child)
    return state.hexdigest().encode(), slots


def climb(digests: list[bytes], levels: int) -> tuple[list[bytes], list[list[Slot]]]:
    """The nodes ``levels`` higher, and the slots of the nodes of each level on the way."""
    passed = []
    for _ in range(levels):
        made = [parent(digests[k : k + FANOUT]) for k in range(0, len(digests), FANOUT)]
        passed.append([slot for _, slots in made for slot in slots])
        digests = [digest for digest, _ in made]
    return digests, passed


def levels_in_block(n: int, levels: int) -> int:
    """Levels to climb where a group has ``n`` nodes: ``levels``, or fewer if one node is reached."""
    if n > FANOUT**levels:
        return levels
    up = 0
    while FANOUT**up < n:
        up += 1
    return up


def way_up(passed: list[list[Slot]], at: int) -> list[Slot]:
    return [slots[at // FANOUT**level] for level, slots in enumerate(passed)]


def resumed(steps: Sequence[dict]) -> list[Slot]:
    """Slots from the siblings above a block; each hashes what is to its left once for the block."""
    slots = []
    for step in steps:
        left, right = ([d.encode() for d in step[side]] for side in ("left", "right"))
        state = sha256()
        for digest in left:
            state.update(digest)
        slots.append(Slot(state, left, right))
    return slots


def siblings(slots: Sequence[Slot]) -> bytes:
    return b"".join(b"".join((*s.left, *s.right)) for s in slots)


# --- leaves and their order ---------------------------------------------------------------


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Hash of the columns, each as its length in UTF-8 bytes, a colon and its text."""
    parts = []
    for col in columns:
        text = col.cast("string")
        parts += [
            F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit(MISSING))
        ]
    return F.sha2(F.concat(*parts), 256)


def numbered(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place in its ``grp``, and ``n``, the number of its nodes.

    One range shuffle over group and order, however large a group is; places within a slice are
    numbers of rows, and one small row for each slice and group says what lies before it.
    """
    placed = (
        nodes.repartitionByRange("grp", *order)
        .sortWithinPartitions("grp", *order)
        .withColumns({"slice": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    )
    placed = stage(placed, "merkle-order")
    counts = placed.groupBy("grp", "slice").agg(F.count("*").alias("here"), F.min("row").alias("first"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("grp").alias("grp_"),
        F.col("slice").alias("slice_"),
        (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(whole).alias("n"),
    )
    same = F.col("grp").eqNullSafe(F.col("grp_")) & (F.col("slice") == F.col("slice_"))
    return (
        placed.join(counts, same)
        .withColumn("pos", F.col("row") + F.col("shift"))
        .drop("grp_", "slice_", "slice", "row", "shift")
    )


# --- blocks -------------------------------------------------------------------------------


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")


def _blocks(batches) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of each (group, block) in turn; they come sorted and may span batches."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, block in groupby(rows, key=lambda r: (r["grp"], r["block"])):
        yield key, list(block)


def _in_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) >= _ROWS:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


_NODE_ARROW = pa.schema(
    [("grp", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("digest", pa.string())]
)
_STEP_ARROW = pa.struct([("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])
_PATH_ARROW = pa.schema(
    [
        ("grp", pa.string()),
        ("pos", pa.int64()),
        ("steps", pa.list_(_STEP_ARROW)),
        ("subroot", pa.string()),
        ("root", pa.string()),
    ]
)
_PROOF_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
        ("verified", pa.bool_()),
    ]
)


def _next_round(nodes: DataFrame, levels: int) -> DataFrame:
    """One node for each block of ``nodes``; groups of one node come out as they are."""

    def tops(batches):
        for (grp, block), rows in _blocks(batches):
            up = levels_in_block(rows[0]["n"], levels)
            (top,), _ = climb([r["digest"].encode() for r in rows], up)
            blocks = -(-rows[0]["n"] // FANOUT**levels)
            yield {"grp": grp, "pos": block, "n": blocks, "digest": top.decode()}

    def run(batches):
        yield from _in_batches(tops(batches), _NODE_ARROW)

    return _by_block(_with_block(nodes, levels).select("grp", "block", "pos", "n", "digest")).mapInArrow(
        run, _NODE
    )


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / F.lit(FANOUT**levels)).cast("long"))


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """``nodes`` and, in tables of their own, the block tops above them up to one for each group."""
    tables = [nodes]
    while len(tables) == 1 or (tables[-1].agg(F.max("n")).first()[0] or 1) > 1:
        tables.append(stage(_next_round(tables[-1], levels), "merkle-nodes"))
    return tables


def _meeting(nodes: DataFrame, paths: DataFrame, levels: int, columns: Sequence[str]) -> DataFrame:
    """Blocks of ``nodes``, each led by the path of its top, which has place -1."""
    below = _with_block(nodes, levels).select("grp", "block", "pos", "n", *columns)
    above = paths.select("grp", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "steps", "subroot", "root")
    return _by_block(below.unionByName(above, allowMissingColumns=True))


def _led_blocks(batches, levels: int):
    """For each block: its path's row, its other rows, their slots by level, the slots above."""
    for (grp, _), (path, *rows) in _blocks(batches):
        _, passed = climb(
            [r["digest"].encode() for r in rows], levels_in_block(rows[0]["n"], levels)
        )
        yield grp, path, rows, passed


def _paths_below(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """The path of each of ``nodes`` from the paths of the block tops above them."""

    def found(batches):
        for grp, path, rows, passed in _led_blocks(batches, levels):
            for at, row in enumerate(rows):
                own = [
                    {"left": [d.decode() for d in s.left], "right": [d.decode() for d in s.right]}
                    for s in way_up(passed, at)
                ]
                yield {
                    "grp": grp,
                    "pos": row["pos"],
                    "steps": own + path["steps"],
                    "subroot": path["subroot"],
                    "root": path["root"],
                }

    def run(batches):
        yield from _in_batches(found(batches), _PATH_ARROW)

    return _meeting(nodes, paths, levels, ["digest"]).mapInArrow(run, _PATH)


def _proofs(leaves: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Proof of each leaf, and the root that its altered digest folds to."""

    def found(batches):
        for _, path, rows, passed in _led_blocks(batches, levels):
            above = resumed(path["steps"])
            beyond = siblings(above)
            for at, row in enumerate(rows):
                own = way_up(passed, at)
                digest = (row["altered"] or row["digest"]).encode()
                for slot in (*own, *above):
                    digest = slot.fold(digest)
                folded = digest.decode()
                yield {
                    "doc_id": row["doc_id"],
                    "leaf": row["digest"],
                    "subroot": path["subroot"],
                    "root": path["root"],
                    "proof_sha256": sha256(siblings(own) + beyond).hexdigest(),
                    "folded_root": folded,
                    "verified": folded == path["root"],
                }

    def run(batches):
        yield from _in_batches(found(batches), _PROOF_ARROW)

    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"
    )
    return _meeting(leaves, paths, levels, ["doc_id", "digest", "altered"]).mapInArrow(run, schema)


# --- the operator -------------------------------------------------------------------------


def manifest(
    docs: DataFrame,
    altered_text: Column | None = None,
    fields: Sequence[str] = FIELDS,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs`` with its leaf, subroot, root, proof, and a check of a second text.

    ``fields`` name id, group, further columns and text, hashed in this order. ``altered_text`` is the
    text to verify against the manifest (by default the text itself): ``folded_root`` is the root with
    the leaf of that text in the row's place, ``verified`` whether it equals ``root``. Rows without an
    id come first in their group, and a missing group is a group of its own, the first one. Rows of
    one id are ordered by their leaves; rows alike in all fields have places of their own, in any order.
    NULL and empty texts differ. Other columns are ignored. An empty table gives no rows.
    """
    id_col, group_col, text_col = fields[0], fields[1], fields[-1]
    own = [F.col(f"`{c}`") for c in fields]
    leaf = leaf_digest(own)
    changed = F.lit(None).cast("string")
    if altered_text is not None:
        # only a text that differs is hashed again
        differs = ~altered_text.eqNullSafe(F.col(f"`{text_col}`"))
        changed = F.when(differs, leaf_digest([*own[:-1], altered_text]))
    leaves = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{group_col}`").cast("string").alias("grp"),
        leaf.alias("digest"),
        changed.alias("altered"),
        # rows alike in all else spread over slices
        F.monotonically_increasing_id().alias("spread"),
    )
    leaves = stage(leaves, "merkle-leaves")
    leaves = stage(numbered(leaves, ["doc_id", "digest", "spread"]).drop("spread"), "merkle-leaves")
    tables = _rounds(leaves, levels)
    subroots = tables[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    subroots = stage(numbered(subroots, ["name"]), "merkle-subroots")
    upper = _rounds(subroots, levels)
    paths = upper[-1].select(
        "grp",
        "pos",
        F.lit(None).cast(_STEPS).alias("steps"),
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    paths = paths.withColumn("steps", F.coalesce("steps", F.array().cast(_STEPS)))
    for nodes in reversed(upper[:-1]):
        paths = stage(_paths_below(nodes, paths, levels), "merkle-paths")
    paths = (
        subroots.join(paths.drop("grp", "subroot"), "pos")
        .select(
            F.col("name").alias("grp"),
            F.lit(0).cast("long").alias("pos"),
            "steps",
            F.col("digest").alias("subroot"),
            "root",
        )
    )
    for nodes in reversed(tables[1:-1]):
        paths = stage(_paths_below(nodes, paths, levels), "merkle-paths")
    return _proofs(leaves, paths, levels)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
