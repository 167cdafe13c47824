"""Grouped picks that never bring a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collartrail.operators.copies import COPIES, expand_copies, merge_copies


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality on all keys in which missing equals missing; still an equi join."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def latest_per_group(df: DataFrame, keys: Sequence[str], t: str, rank: int = 1) -> DataFrame:
    """The row at the ``rank``-th latest distinct time of each group.

    Rows tied in time are decided by the other columns, smallest first. The rank filter is
    also applied before the shuffle, so at most ``rank`` rows per group leave a task.
    """
    rest = [c for c in df.columns if c not in {*keys, t}]
    order = [F.col(t).desc_nulls_last()]
    if rank == 1:
        order += [F.col(c).asc() for c in rest]
    else:
        # one row per time first, so that ties do not count as ranks
        df = df.groupBy(*keys, t).agg(F.min(F.struct(F.lit(0), *rest)).alias("_row"))
    w = Window.partitionBy(*keys).orderBy(*order)
    top = (
        df.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= rank)
        .filter(F.col("_rn") == rank)
    )
    picked = rest if rank == 1 else [F.col(f"_row.{c}") for c in rest]
    return top.select(*keys, t, *picked)


def earliest_keep_ties(
    df: DataFrame, keys: Sequence[str], t: str, null_poisons: bool = True
) -> DataFrame:
    """Earliest rows of each group, ties kept; rows without a time are always kept.

    With ``null_poisons`` a group that has a row without a time keeps only such rows: its
    minimum is unknown. Rows without a time are not shuffled, only their distinct keys are;
    of the others, only each task's own earliest.
    """
    keys = list(keys)
    timed, untimed = df.filter(F.col(t).isNotNull()), df.filter(F.col(t).isNull())
    w = Window.partitionBy(*keys).orderBy(t)
    first = timed.withColumn("_rank", F.rank().over(w)).filter(F.col("_rank") == 1).drop("_rank")
    if null_poisons:
        poisoned = untimed.select(*keys).distinct()
        first = first.join(poisoned, null_safe(first, poisoned, keys), "left_anti")
    return first.unionByName(untimed)


def append_rows(table: DataFrame, more: DataFrame) -> DataFrame:
    """Full join on all shared columns, missing equal to missing.

    Used to append rows to a table: a row found on both sides is matched, not repeated.
    Copies are counted before the join, so a row repeated n and m times costs one row here
    and comes out n*m times, as the join defines.
    """
    shared = [c for c in table.columns if c in more.columns]
    left, right = merge_copies(table), merge_copies(more)
    a, b = left.alias("a"), right.alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in shared])
    both = F.col(f"a.{COPIES}").isNotNull()
    only_left = [c for c in table.columns if c not in shared]
    only_right = [c for c in more.columns if c not in shared]
    joined = a.join(b, on, "full_outer").select(
        *[F.when(both, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in shared],
        *[F.col(f"a.{c}") for c in only_left],
        *[F.col(f"b.{c}") for c in only_right],
        (
            F.coalesce(F.col(f"a.{COPIES}"), F.lit(1)) * F.coalesce(F.col(f"b.{COPIES}"), F.lit(1))
        ).alias(COPIES),
    )
    return expand_copies(joined)
