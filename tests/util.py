"""Small helpers: tables from tuples, rows as sorted tuples."""

from __future__ import annotations

import datetime as dt


def ts(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


def rows(df, *cols):
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def track(spark, points, collar=1):
    """Points (hour, x, y) of one collar, in hours from 2023-01-01."""
    data = [(collar, at_hour(h), float(x), float(y)) for h, x, y in points]
    return spark.createDataFrame(data, "collar_id bigint, t_ timestamp_ntz, x_ double, y_ double")


def at_hour(h: float) -> dt.datetime:
    return dt.datetime(2023, 1, 1) + dt.timedelta(hours=h)


def hour(t: dt.datetime | None):
    return None if t is None else (t - dt.datetime(2023, 1, 1)).total_seconds() / 3600


def formatted(df) -> str:
    """The physical plan with all its filters, nothing cut short."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
