"""Rows joined to the deployment of their collar that was running at their time.

A collar used again has several deployments, and a join on the collar alone gives each row once for
each of them. Here a deployment has a span, the span is cut into days, and rows meet spans by collar
and day; the bounds decide within a day. It stays an equi join, and a span has one row for a day, so
a row meets a span once.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collartrail.functions.timeutil import at
from collartrail.schemas import STUDY_END, STUDY_START

BEGIN, END = "_span_begin", "_span_end"
_DAY = "_span_day"


def with_span(deployments: DataFrame) -> DataFrame:
    """Deployments with the time they run from and the time they run to, which is not part of them.

    A deployment begins with its day of testing and ends with the removal of the collar; without a
    removal it ends where the collar's next one begins. A missing begin or end is open. Where removal
    comes after the next begin, spans overlap.
    """
    begin = F.col("starttestingdate").cast("timestamp_ntz")
    own = deployments.withColumn(BEGIN, begin)
    # distinct begins: a collar has one row for a day here, however often it is listed
    begins = own.select(F.col("collarid").alias("_collar"), F.col(BEGIN).alias("_from")).distinct()
    order = Window.partitionBy("_collar").orderBy(F.col("_from").asc_nulls_first())
    following = begins.withColumn("_next", F.lead("_from").over(order))
    same = F.col("collarid").eqNullSafe(F.col("_collar")) & F.col(BEGIN).eqNullSafe(F.col("_from"))
    joined = own.join(following, same, "left")
    return joined.withColumn(END, F.coalesce("beginremoved_UTC", "_next")).drop("_collar", "_from", "_next")


def _day(t: Column) -> Column:
    return F.unix_date(F.to_date(t))


def _by_day(spans: DataFrame, lower: Column, upper: Column) -> DataFrame:
    """Each span once for each of its days from ``lower`` up to before ``upper``."""
    first = F.greatest(F.coalesce(BEGIN, lower), lower)
    end = F.least(F.coalesce(END, upper), upper)
    last = end - F.expr("interval 1 microsecond")
    # an empty span has no days
    days = F.when(first < end, F.sequence(_day(first), _day(last)))
    return spans.withColumn(_DAY, F.explode(days))


def join_span(
    rows: DataFrame,
    spans: DataFrame,
    keys: Mapping[str, str],
    t: str,
    lower=STUDY_START,
    upper=STUDY_END,
) -> DataFrame:
    """Left join of ``rows`` to the ``spans`` (see ``with_span``) that run at time ``t``.

    ``keys`` names columns of ``rows`` and the columns of ``spans`` they equal; missing equals missing.
    Rows without a time, and times before ``lower`` or from ``upper`` on, match nothing. A row that
    matches nothing is kept once. Columns in ``keys`` and the bounds are left out of the right side.
    """
    right = _by_day(spans, at(lower), at(upper))
    named = {c: f"_span_{c}" for c in keys.values()}
    right = right.withColumnsRenamed(named)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(named[c])) for k, c in keys.items()])
    time = F.col(t)
    runs = F.coalesce(time >= F.col(BEGIN), F.lit(True)) & F.coalesce(time < F.col(END), F.lit(True))
    inside = (time >= at(lower)) & (time < at(upper))
    left = rows.withColumn("_row_day", F.when(inside, _day(time)))
    joined = left.join(right, same & (F.col("_row_day") == F.col(_DAY)) & runs, "left")
    return joined.drop(*named.values(), "_row_day", _DAY, BEGIN, END)
