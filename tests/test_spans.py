"""Deployments that ran at a row's time, against a comparison of all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from util import rows, ts

from collartrail.operators import layers, pairing, spans
from collartrail.schemas import DEPLOYMENTS, FIXES


def deployments(spark, data):
    """(animal, collar, first day or None, removal or None, sex)"""
    named = [
        {"animalid": a, "collarid": c, "starttestingdate": b and dt.date.fromisoformat(b), "beginremoved_UTC": e and ts(e), "sex": s}
        for a, c, b, e, s in data
    ]
    return spark.createDataFrame([tuple(r.get(n) for n in DEPLOYMENTS.names) for r in named], DEPLOYMENTS)


def matches(spark, data, times, **bounds):
    events = spark.createDataFrame([(c, t and ts(t)) for c, t in times], "collar long, t timestamp_ntz")
    right = spans.with_span(deployments(spark, data)).select("collarid", "sex", spans.BEGIN, spans.END)
    bounds = {"lower": "2023-01-01", "upper": "2025-01-01", **bounds}
    return rows(spans.join_span(events, right, {"collar": "collarid"}, "t", **bounds), "collar", "t", "sex")


def test_a_redeployed_collar_has_one_deployment_at_a_time(spark):
    data = [("a", 1, "2023-03-01", None, "first"), ("b", 1, "2023-06-01", None, "second")]
    times = [(1, "2023-02-28 23:59:59"), (1, "2023-03-01 00:00:00"), (1, "2023-05-31 23:59:59"), (1, "2023-06-01 00:00:00"), (1, "2024-12-31 00:00:00"), (2, "2023-04-01 00:00:00")]
    got = [r[2] for r in matches(spark, data, times)]
    assert got == [None, "first", "first", "second", "second", None]


def test_open_overlapping_and_empty_spans(spark):
    data = [
        ("a", 1, None, "2023-03-10 12:00:00", "open begin"),
        ("b", 1, "2023-03-05", "2023-03-20 00:00:00", "overlaps"),
        ("c", 1, "2023-04-01", "2023-03-01 00:00:00", "empty"),
        ("d", None, "2023-03-01", None, "no collar"),
    ]
    def at(t, collar=1):
        return sorted(str(r[2]) for r in matches(spark, data, [(collar, t)]))

    assert at("2023-01-01 00:00:00") == ["open begin"]
    assert at("2023-03-07 00:00:00") == ["open begin", "overlaps"]
    assert at("2023-03-10 12:00:00") == ["overlaps"]
    assert at("2023-03-20 00:00:00") == ["None"]
    assert at("2023-05-01 00:00:00") == ["None"]
    assert at("2023-03-02 00:00:00", None) == ["no collar"]
    assert at(None) == ["None"]
    assert at("2022-12-31 23:59:59") == ["None"]
    assert at("2025-01-01 00:00:00", None) == ["None"]


def test_same_day_and_repeated_deployments(spark):
    data = [("a", 1, "2023-03-01", "2023-03-01 06:00:00", "x"), ("a", 1, "2023-03-01", None, "y"), ("a", 1, "2023-03-01", None, "y")]
    assert [r[2] for r in matches(spark, data, [(1, "2023-03-01 05:59:59")])] == ["x", "y", "y"]
    assert [r[2] for r in matches(spark, data, [(1, "2023-03-01 06:00:00")])] == ["y", "y"]


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_equal_a_comparison_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    day = lambda: (dt.date(2023, 1, 1) + dt.timedelta(rng.randrange(200))).isoformat()
    clock = lambda: f"{day()} {rng.randrange(24):02}:{rng.randrange(60):02}:00"
    data = [(None, rng.choice([1, 2, 3, None]), rng.choice([day(), None]), rng.choice([clock(), None]), str(i)) for i in range(25)]
    times = [(rng.choice([1, 2, 3, 4, None]), rng.choice([clock(), clock(), None])) for _ in range(200)]
    begins = {}
    for _, c, b, _, _ in data:
        begins.setdefault(c, set()).add(b or "")
    want = []
    for c, t in times:
        hit = []
        for _, c2, b, e, s in data:
            later = [x for x in begins[c2] if x > (b or "")]
            end = e or (min(later) + " 00:00:00" if later else "9999")
            if c == c2 and t and (b or "") <= t < end:
                hit.append(s)
        want += [(c, t and ts(t), s) for s in hit or [None]]
    assert matches(spark, data, times) == sorted(want, key=repr)


def test_no_loop_over_pairs_in_the_plan_and_names_kept(spark):
    dep = deployments(spark, [("a", 1, "2023-03-01", None, "f")])
    fixes = spark.createDataFrame([(1, ts("2023-03-02 00:00:00"), 1.0, 1.0, 1.0, 1.0)], FIXES)
    by_span, plain = (layers.base_fixes(fixes, dep, by_span=b) for b in (True, False))
    assert by_span.columns == plain.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = layers.base_fixes(fixes, dep, by_span=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" in plan


def test_pairing_by_span_does_not_multiply_videos(spark):
    from collartrail.sources.videos import parse_video_paths

    paths = [("/v/B1_1/2023-03-02 150012.mp4",), ("/v/B1_1/2023-07-02 150012.mp4",)]
    videos = parse_video_paths(spark.createDataFrame(paths, "path string"), "/v")
    dep = deployments(spark, [("B1", 1, "2023-03-01", None, "one"), ("B1", 1, "2023-06-01", None, "two")])
    fixes = spark.createDataFrame([], FIXES)
    assert pairing.pair_videos(videos, fixes, dep).count() == 4
    assert rows(pairing.pair_videos(videos, fixes, dep, by_span=True), "Month", "sex") == [(3, "one"), (7, "two")]
    assert videos.filter(F.col("Month") == 3).count() == 1
