"""Order-dependent work on tracks, with no group too long for a task.

Copies of a fix are merged, partially before the shuffle. Tracks are then cut into slices by one range
shuffle over group, time and position, so slices are alike in size however the fixes are spread over
collars, days or seconds: a crowded collar, or one day of it, is many slices. A task scans its slice in
order and notes what can be said without the fixes before it. A slice and group together have one
summary row; windows over those say what each slice inherits; and that is joined back.

Scanned slices are written to the shared folder: where a slice ends must be the same for fixes and
summaries. Rows of the results carry ``copies``, the number of identical fixes a row stands for.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collartrail.functions.geo import distance
from collartrail.operators.copies import COPIES
from collartrail.session import stage

SEGMENT = "_segment"
XYT = ["t_", "x_", "y_"]
_BY = ("collar_id",)

_SCANNED = {
    SEGMENT: T.IntegerType(),
    "_first": T.BooleanType(),  # of its group in the slice
    "step": T.DoubleType(),
    "_before": T.LongType(),  # fixes of the group and slice before
    "_moved": T.BooleanType(),
    "_moves": T.LongType(),  # moves of the group and slice up to here
    # of the run as far as the slice has it
    "_in_fixes": T.LongType(),
    "_in_begin": T.TimestampNTZType(),
    "_in_end": T.TimestampNTZType(),
}


def _merged(track: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per distinct fix with its number of copies.

    Rows that lack a time or a group key belong to no group.
    """
    n = F.col(COPIES) if COPIES in track.columns else F.lit(1).cast("bigint")
    placed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, "t_"]])
    return track.filter(placed).groupBy(*by, *XYT).agg(F.sum(n).alias(COPIES))


def _scanned(track: DataFrame, by: Sequence[str], zeta: float = float("inf")) -> DataFrame:
    """Distinct fixes with slice and what the slice says about each; see ``_SCANNED``."""
    merged = _merged(track, by)
    kinds = {f.name: f.dataType for f in merged.schema.fields} | _SCANNED
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    by = list(by)

    def run(batches):
        whole = [b for b in batches if b.num_rows]
        if whole:
            table = pa.Table.from_batches(whole)
            yield from _scan(table, by, zeta, TaskContext.get().partitionId()).to_batches()

    ranged = merged.repartitionByRange(*by, *XYT).sortWithinPartitions(*by, *XYT)
    return stage(ranged.mapInArrow(run, schema), "slices")


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first differs from the one before; there are no missing ones."""
    values = column.combine_chunks()
    return pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)


def _scan(table: pa.Table, by: list[str], zeta: float, segment: int) -> pa.Table:
    """A sorted slice with the columns of ``_SCANNED``."""
    n = table.num_rows
    first = np.ones(n, bool)
    first[1:] = reduce(np.logical_or, [_changes(table.column(c)) for c in by])
    x, y = (table.column(c).to_numpy().astype(float) for c in ("x_", "y_"))
    dx, dy = np.diff(x, prepend=np.nan), np.diff(y, prepend=np.nan)
    step = np.sqrt(dx * dx + dy * dy)
    step[first] = np.nan
    moved = step > zeta
    copies = table.column(COPIES).to_numpy()
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    total, moves = np.cumsum(copies), np.cumsum(moved)
    before = total - copies
    starts = np.flatnonzero(first | moved)
    lengths = np.diff(starts, append=n)
    t = table.column("t_").combine_chunks()
    made = {
        SEGMENT: pa.array(np.full(n, segment, np.int32)),
        "_first": pa.array(first),
        "step": pa.array(step, mask=np.isnan(step)),
        "_before": pa.array(before - before[group]),
        "_moved": pa.array(moved),
        "_moves": pa.array((moves - moves[group]).astype(np.int64)),
        "_in_fixes": pa.array(np.repeat(np.add.reduceat(copies, starts), lengths)),
        "_in_begin": t.take(pa.array(np.repeat(starts, lengths))),
        "_in_end": t.take(pa.array(np.repeat(starts + lengths - 1, lengths))),
    }
    for name, column in made.items():
        table = table.append_column(name, column)
    return table


def _over_segments(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy(SEGMENT)


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _upto(window):
    # rows, not the range of tied values
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0).cast("bigint"))


# --- position ---------------------------------------------------------------------------


def with_position(track: DataFrame, by: Sequence[str] = _BY) -> DataFrame:
    """Fixes with ``start``, the number of fixes of their group before them."""
    by = list(by)
    rows = _scanned(track, by)
    carried = (
        rows.groupBy(*by, SEGMENT)
        .agg(F.sum(COPIES).alias("_n"))
        .withColumn("_offset", _zero(F.sum("_n").over(_before(_over_segments(by)))))
        .drop("_n")
    )
    return (
        rows.join(carried, [*by, SEGMENT])
        .withColumn("start", F.col("_offset") + F.col("_before"))
        .select(*by, *XYT, COPIES, "start")
    )


# --- steps ------------------------------------------------------------------------------


def _ends() -> list[Column]:
    vertex = F.struct(*XYT)
    return [F.min(vertex).alias("_head"), F.max(vertex).alias("_tail")]


def _with_entry_step(summary: DataFrame, by: Sequence[str]) -> DataFrame:
    prev = F.lag("_tail").over(_over_segments(by))
    return summary.withColumn("_prev", prev).withColumn(
        "_entry_step",
        distance(F.col("_prev.x_"), F.col("_prev.y_"), F.col("_head.x_"), F.col("_head.y_")),
    )


def with_step(track: DataFrame, by: Sequence[str] = _BY) -> DataFrame:
    """Fixes with ``step``, the distance from the fix before; NULL for a group's first.

    Of a row that stands for several fixes, the further ones have step 0.
    """
    by = list(by)
    rows = _scanned(track, by)
    carried = _with_entry_step(rows.groupBy(*by, SEGMENT).agg(*_ends()), by).select(
        *by, SEGMENT, "_entry_step"
    )
    step = F.when(F.col("_first"), F.col("_entry_step")).otherwise(F.col("step"))
    return (
        rows.join(carried, [*by, SEGMENT])
        .withColumn("step", step)
        .select(*by, *XYT, COPIES, "step")
    )


# --- runs -------------------------------------------------------------------------------

_RUN_COLUMNS = ["step", "run", "anchor", "is_last_run", "run_fixes", "run_begin", "run_end"]


def with_runs(track: DataFrame, zeta: float, by: Sequence[str] = _BY) -> DataFrame:
    """Fixes with the non-movement run they belong to.

    A run is an anchor fix and all following fixes at most ``zeta`` from the fix before.
    Adds ``step``, ``run`` (1, 2, ... per group), ``anchor``, ``is_last_run`` and the run's
    ``run_fixes``, ``run_begin``, ``run_end``.
    """
    if zeta < 0:
        raise ValueError("zeta must not be negative")
    zeta, by = float(zeta), list(by)
    keys = [*by, SEGMENT]
    rows = _scanned(track, by, zeta)
    rows = rows.join(_run_carry(rows, zeta, by), keys)
    head_run, tail_run = F.col("_moves") == 0, F.col("_moves") == F.col("_inner_moves")
    totals = {
        f"run_{name}": F.when(head_run, F.col(f"_head_run.{name}"))
        .when(tail_run, F.col(f"_tail_run.{name}"))
        .otherwise(F.col(f"_in_{name}"))
        for name in ("fixes", "begin", "end")
    }
    return rows.withColumns(
        {
            **totals,
            "step": F.when(F.col("_first"), F.col("_entry_step")).otherwise(F.col("step")),
            "run": F.col("_head_no") + F.col("_moves"),
            "anchor": F.when(F.col("_first"), F.col("_entry_moved")).otherwise(F.col("_moved")),
            "is_last_run": F.col("_head_no") + F.col("_moves") == F.col("_last_no"),
        }
    ).select(*by, *XYT, COPIES, *_RUN_COLUMNS)


def _run_carry(rows: DataFrame, zeta: float, by: list[str]) -> DataFrame:
    """One row per slice: the numbers and totals of its first and last run.

    Everything after the aggregation is partitioned by the group alone.
    """
    at_move = F.when(F.col("_moved"), F.col("_before"))
    summary = rows.groupBy(*by, SEGMENT).agg(
        *_ends(),
        F.sum(COPIES).alias("_fixes"),
        F.max("_moves").alias("_inner_moves"),
        F.min(at_move).alias("_head_fixes"),
        F.max(at_move).alias("_tail_start"),
        F.max(F.when(F.col("_moves") == 0, F.col("t_"))).alias("_head_end"),
        F.max(F.when(F.col("_moved"), F.col("t_"))).alias("_tail_begin"),
    )
    entry_moved = F.col("_prev").isNull() | (F.col("_entry_step") > zeta)
    moves = F.col("_inner_moves") + F.col("_entry_moved").cast("bigint")
    summary = (
        _with_entry_step(summary, by)
        .withColumn("_entry_moved", entry_moved)
        .withColumn("_tail_no", F.sum(moves).over(_upto(_over_segments(by))))
        .withColumn("_head_no", F.col("_tail_no") - F.col("_inner_moves"))
    )
    head = F.struct(
        F.col("_head_no").alias("run"),
        F.coalesce("_head_fixes", "_fixes").alias(COPIES),
        F.col("_head.t_").alias("begin"),
        F.col("_head_end").alias("end"),
    )
    tail = F.struct(
        F.col("_tail_no").alias("run"),
        (F.col("_fixes") - F.col("_tail_start")).alias(COPIES),
        F.col("_tail_begin").alias("begin"),
        F.col("_tail.t_").alias("end"),
    )
    parts = F.when(F.col("_inner_moves") > 0, F.array(head, tail)).otherwise(F.array(head))
    run = Window.partitionBy(*by, "part.run")
    total = F.struct(
        F.sum(f"part.{COPIES}").over(run).alias("fixes"),
        F.min("part.begin").over(run).alias("begin"),
        F.max("part.end").over(run).alias("end"),
    )
    runs = (
        summary.withColumn("part", F.explode(parts))
        .withColumn("total", total)
        .withColumn("_last_no", F.max("_tail_no").over(Window.partitionBy(*by)))
    )
    # at most two rows per slice come back together here
    fixed = ["_head_no", "_inner_moves", "_entry_moved", "_entry_step", "_last_no"]
    return runs.groupBy(*by, SEGMENT, *fixed).agg(
        F.max(F.when(F.col("part.run") == F.col("_head_no"), F.col("total"))).alias("_head_run"),
        F.max(F.when(F.col("part.run") == F.col("_tail_no"), F.col("total"))).alias("_tail_run"),
    )


# task functions travel with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
