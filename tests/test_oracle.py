"""Every registered query against its SQL, on whole small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from collartrail.sources import sinks
from workload import oracle
from workload import queries as workload_queries
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["customer", "events"]
TRACK_QUERIES = [
    "step_lengths",
    "nonmovement_runs",
    "run_stats",
    "defunct_flags_terminal",
    "defunct_flags_all",
    "mortality_dates",
    "latest_per_flag",
    "second_latest",
    "movement_paths",
    "mortality_layers",
    "last_live_point",
    "earliest_fixes",
    "fix_layers",
]
CHANGED = {
    "repeated": "select * from events union all select * from events",
    "one collar": "select * replace (case when event_id % 5 < 3 then 1 else user_id end as user_id) from events",
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_same_names():
    assert set(QUERIES) == set(oracle.build())


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    _compare(spark, db, SF, name)


@pytest.mark.parametrize("change", sorted(CHANGED))
def test_tracks_with_repeated_rows_and_a_crowded_collar(spark, db, tmp_path, change):
    con = duckdb.connect()
    for table, select in (("events", CHANGED[change]), ("customer", "select * from customer")):
        path = tmp_path / f"{table}.parquet"
        db.execute(f"copy ({select}) to '{path}' (format parquet)")
        con.execute(f"create view {table} as select * from '{path}'")
    for name in TRACK_QUERIES:
        _compare(spark, con, str(tmp_path), name)


@pytest.mark.parametrize("name", ["copy_videos", "check_copies"])
def test_few_made_videos_have_content_while_they_are_copied(spark, tmp_path, monkeypatch, name):
    db = duckdb.connect()
    events = """
        select i as event_id, i % 7 as user_id, timestamp '2024-01-02' + (i // 2) * interval 53 minute as ts,
               'view' as event_type, i / 2.0::double as value, '{"k": ' || i % 100 || '}' as props
        from range(120) r(i)"""
    customer = "select i as c_custkey, (i % 25)::int as c_nationkey, 'M' as c_mktsegment from range(30) r(i)"
    for table, select in (("events", events), ("customer", customer)):
        db.execute(f"copy ({select}) to '{tmp_path}/{table}.parquet' (format parquet)")
        db.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet'")
    filled, copy = [], sinks.copy_videos

    def watched(manifest, **named):
        root = manifest.first()["source"].rsplit("/", 2)[0]
        files = [os.path.join(at, f) for at, _, some in os.walk(root) if "groupedvideos" not in at for f in some]
        filled.append(sum(os.path.getsize(f) > 0 for f in files))
        return copy(manifest, **named)

    monkeypatch.setattr(sinks, "copy_videos", watched)
    monkeypatch.setattr(workload_queries, "WAVE", 20, raising=False)
    _compare(spark, db, str(tmp_path), name)
    assert len(filled) > 1 and max(filled) < 60 <= sum(filled)


def test_made_videos_are_emptied_after_their_wave_and_removed_after_the_last(spark, tmp_path, monkeypatch):
    """No file goes while others are still to be made, which some file systems make slow."""
    (tmp_path / "events.parquet").mkdir()
    spark.range(40).selectExpr("id as event_id", "id as user_id", "timestamp_ntz '2024-01-01' as ts").write.mode(
        "overwrite"
    ).parquet(str(tmp_path / "events.parquet"))
    (tmp_path / "a").mkdir()
    for i in range(40):
        (tmp_path / "a" / f"{i}.mp4").touch()
    manifest = spark.createDataFrame(
        [(f"{tmp_path}/a/{i}.mp4", f"{tmp_path}/t") for i in range(40)], "source string, target string"
    )
    there, sources, copy = [], [], sinks.copy_videos

    def watched(part, **named):
        log = copy(part, **named)
        there.append(len(os.listdir(tmp_path / "a")))
        sources.extend(r.source for r in log.collect() if r.outcome == "copied")
        return log

    monkeypatch.setattr(sinks, "copy_videos", watched)
    monkeypatch.setattr(workload_queries, "WAVE", 10)
    log = workload_queries._copy_made(spark, str(tmp_path), manifest)
    assert len(there) > 2 and set(there) == {40} and len(set(sources)) == 40 == log.count()
    assert not os.listdir(tmp_path / "a")
    assert {(tmp_path / "t" / f"{i}.mp4").read_text() for i in range(40)} == {f"{i}.mp4" for i in range(40)}


def test_one_source_for_two_targets_and_two_sources_for_one_in_waves(spark, tmp_path, monkeypatch):
    (tmp_path / "events.parquet").mkdir()
    spark.range(6).selectExpr("id as event_id", "id as user_id", "timestamp_ntz '2024-01-01' as ts").write.mode(
        "overwrite"
    ).parquet(str(tmp_path / "events.parquet"))
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        for name in ("v.mp4", "w.mp4", "x.mp4"):
            (tmp_path / folder / name).touch()
    plan = [("a", n, t) for n in ("v.mp4", "w.mp4", "x.mp4", "absent.mp4") for t in ("t", "u")] + [("b", "v.mp4", "t")]
    manifest = spark.createDataFrame(
        [(f"{tmp_path}/{f}/{n}", f"{tmp_path}/{t}") for f, n, t in plan], "source string, target string"
    )
    monkeypatch.setattr(workload_queries, "WAVE", 1)
    log = workload_queries._copy_made(spark, str(tmp_path), manifest).collect()
    got = {(r.source[len(str(tmp_path)) + 1 :], r.target[-1]): r.outcome for r in log}
    outcome = {"absent.mp4": "missing"}
    assert len(log) == len(plan)
    assert got == {(f"{f}/{n}", t): "same name" if f == "b" else outcome.get(n, "copied") for f, n, t in plan}
    assert (tmp_path / "u" / "v.mp4").read_text() == "v.mp4" and not (tmp_path / "a" / "absent.mp4").exists()
    # what was copied is gone, what was not planned is left
    assert sorted(f"{p.parent.name}/{p.name}" for f in ("a", "b") for p in (tmp_path / f).iterdir()) == ["b/w.mp4", "b/x.mp4"]


def _compare(spark, db, folder, name):
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    result = db.execute(oracle.build()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    pick = [names.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in pick) for r in result.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got == want, name
