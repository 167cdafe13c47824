"""Tracks cut into many slices give what one pass over each track gives."""

import datetime as dt
import math
import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from collartrail.operators import ordered, paths, tracks

SCHEMA = "collar_id bigint, t_ timestamp_ntz, x_ double, y_ double"
START = dt.datetime(2023, 1, 1)


@pytest.fixture
def sliced(spark):
    """Slices are not put together again where they are small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def fixes_of(kind, seed):
    rng = random.Random(seed)

    def fix(collar, seconds):
        return (collar, START + dt.timedelta(seconds=seconds), rng.choice([0.0, 3.0, 50.0, 51.0]), rng.choice([0.0, 2.0]))

    if kind == "spread":
        return [fix(rng.randrange(30), rng.randrange(20 * 86400)) for _ in range(600)]
    if kind == "one day":
        own = [fix(7, 3 * 86400 + rng.randrange(86400)) for _ in range(400)]
    elif kind == "one second":
        own = [(7, START, rng.random() * 100, rng.random()) for _ in range(400)]
    elif kind == "standing still":
        own = [(7, START + dt.timedelta(seconds=60 * i), 1.0, 1.0) for i in range(400)]
    else:  # copies
        own = [(7, START, 1.0, 1.0)] * 400
    return own + [fix(rng.randrange(10), rng.randrange(10 * 86400)) for _ in range(200)]


def one_pass(fixes, zeta):
    """collar, t, x, y, copies -> step, run, anchor, is_last_run, run_fixes, run_begin, run_end, start"""
    out = {}
    for collar in {f[0] for f in fixes}:
        own = sorted(Counter(f for f in fixes if f[0] == collar).items())
        runs, start, before = [], 0, None
        for (_, t, x, y), n in own:
            step = None if before is None else math.sqrt((x - before[0]) ** 2 + (y - before[1]) ** 2)
            if step is None or step > zeta:
                runs.append([])
            runs[-1].append(((collar, t, x, y), n, step, start))
            before, start = (x, y), start + n
        for number, run in enumerate(runs, 1):
            total, begin, end = sum(r[1] for r in run), run[0][0][1], run[-1][0][1]
            for k, (key, n, step, at) in enumerate(run):
                out[key] = (n, step, number, k == 0, number == len(runs), total, begin, end, at)
    return out


KINDS = ["spread", "one day", "one second", "standing still", "copies"]


@pytest.mark.parametrize("kind", KINDS)
def test_runs_steps_and_places(sliced, kind):
    fixes = fixes_of(kind, 1)
    df = sliced.createDataFrame(fixes, SCHEMA).repartition(5)
    want = one_pass(fixes, 5.0)
    got = {tuple(r)[:4]: tuple(r)[4:] for r in ordered.with_runs(df, 5.0).collect()}
    assert got == {k: v[:-1] for k, v in want.items()}
    steps = {tuple(r)[:4]: tuple(r)[4:] for r in ordered.with_step(df).collect()}
    assert steps == {k: v[:2] for k, v in want.items()}
    places = {tuple(r)[:4]: tuple(r)[4:] for r in ordered.with_position(df).collect()}
    assert places == {k: (v[0], v[-1]) for k, v in want.items()}


@pytest.mark.parametrize("kind", ["spread", "one day", "one second", "standing still"])
def test_slices_are_alike_in_size(sliced, kind):
    rng = random.Random(5)
    fixes = [f[:2] + (f[2] + rng.random(), f[3]) for seed in range(6) for f in fixes_of(kind, seed)]
    df = sliced.createDataFrame(fixes, SCHEMA)
    sizes = [r["count"] for r in ordered._scanned(df, ["collar_id"]).groupBy(ordered.SEGMENT).count().collect()]
    assert len(sizes) > 8
    assert max(sizes) <= 2 * median(sizes)


def test_flags_dates_and_paths_do_not_depend_on_slices(spark):
    fixes = fixes_of("standing still", 3) + fixes_of("spread", 4)

    def found():
        df = spark.createDataFrame(fixes, SCHEMA)
        flagged = tracks.flag_defunct_clusters(df, 5, 2, 6)
        return [
            Counter(map(tuple, flagged.collect())),
            Counter(map(tuple, tracks.mortality_dates(flagged).collect())),
            Counter(map(tuple, paths.movement_path(df, max_vertices=7).collect())),
        ]

    whole = found()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found() == whole
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_group_keys_of_any_type(sliced):
    rows = [("a", True, START, 0.0, 0.0), ("a", False, START, 1.0, 0.0), ("b", True, START, 2.0, 0.0), ("a", None, START, 3.0, 0.0)]
    df = sliced.createDataFrame(rows, "who string, flag boolean, t_ timestamp_ntz, x_ double, y_ double")
    got = ordered.with_step(df, ["who", "flag"])
    assert got.filter(F.col("step").isNull()).count() == got.count() == 3


def test_no_fixes_and_missing_positions(sliced):
    df = sliced.createDataFrame([], SCHEMA)
    assert ordered.with_runs(df, 1.0).count() == ordered.with_step(df).count() == 0
    rows = [(1, START + dt.timedelta(hours=h), x, 0.0) for h, x in enumerate([0.0, None, 100.0])]
    got = ordered.with_runs(sliced.createDataFrame(rows, SCHEMA), 1.0)
    assert sorted((r.t_.hour, r.step, r.run) for r in got.collect()) == [(0, None, 1), (1, None, 1), (2, None, 1)]
