import datetime as dt
import hashlib
import os
import re

import pandas as pd
import pytest
from pyspark import TaskContext
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from collartrail import session
from collartrail.functions import nulls
from collartrail.functions import timeutil as tu
from collartrail.operators import copies, filters, pairing
from collartrail.plans.videos import organise
from collartrail.sources import deployments as dep_io
from collartrail.sources import archive
from collartrail.sources import fixes as fix_io
from collartrail.sources import sinks, videos
from tests.test_geo_paths import _fixes
from tests.test_pairing import FIXES
from tests.test_tracks import _deployments
from tests.util import formatted, rows, ts
from workload import queries


def _touch(root, *names):
    for name in names:
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(name)


def test_scan_and_parse(spark, tmp_path):
    root = str(tmp_path / "my videos")
    _touch(
        root, "B1_39971/2023-02-01 150012.mp4", "B1_39971/2023_02_01_160012.mp4",
        "B1_39971/sub dir/2023-02-01 170012.mp4", "B1_39971/x.MP4", "B1_39971/notes.txt",
        "a.mp4", "groupedvideos/1/Successful/Exact/2023-02-01 150012.mp4", "B2/2023-13-01 150012.mp4",
    )
    got = rows(videos.list_videos(spark, root), "AnimalID", "CollarID", "TimeStamp_UTC", "Hour")
    assert got == sorted(
        [
            ("B1", "39971", ts("2023-02-01 15:00:12"), 15),
            ("B1", "39971", ts("2023-02-01 16:00:12"), 16),
            ("B1", "39971", ts("2023-02-01 17:00:12"), 17),
            ("B2", None, None, 15),
        ],
        key=repr,
    )
    assert rows(videos.list_videos(spark, root + "/"), "directoryname")[0][0].startswith(root)
    plan = videos.scan_videos(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_spark_lists_a_store_some_folders_at_a_time(spark, tmp_path, monkeypatch):
    """The driver never holds the listing of all folders, and sees what a single listing would show."""
    root = str(tmp_path / "v")
    odd = ["B[1]_{2}*", "B?1_2", "B\\1_2", "B 1_2", "B=1", "_x=1", "_x_1", ".h_1", "_metadata_1", "B1._COPYING_", "B1:2"]
    _touch(root, *[f"{folder}/{n}.mp4" for folder in odd for n in ("a", "deep/er/b", "deep/_c", ".d/e", "_d/f")])
    _touch(root, *[f"C{i}_{i}/{n}.mp4" for i in range(300) for n in ("a", "b")])
    _touch(root, "a.mp4", "C1_1/x.MP4", "C1_1/notes.txt", "groupedvideos/1/a.mp4")
    os.makedirs(root + "/empty_1")
    whole = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    want = [(os.path.relpath(r.path.removeprefix("file:"), root), r.length) for r in whole.select("path", "length").collect()]
    want = sorted(x for x in want if x[0].endswith("mp4") and "/" in x[0] and "grouped" not in x[0])
    listed, load = [], DataFrameReader.load

    def watched(self, path=None, *some, **named):
        listed.append([path] if isinstance(path, str) else path)
        return load(self, path, *some, **named)

    monkeypatch.setattr(videos, "BATCH", 100, raising=False)
    monkeypatch.setattr(DataFrameReader, "load", watched)
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    got = [(os.path.relpath(r.path.removeprefix("file:"), root), r.length) for r in videos.scan_videos(spark, root).collect()]
    assert sorted(got) == want and len(want) == 2 * (300 + 8)
    assert len(listed) > 4 and max(map(len, listed[1:])) <= 100
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert videos.scan_videos(spark, root + "/empty_1").count() == 0


def test_mounted_scan_lists_hidden_files_too(spark, tmp_path):
    root = str(tmp_path / "v")
    _touch(
        root, "B1_1/a.mp4", "B1_1/deep/er/b.mp4", "B1_1/x.MP4", "a.mp4", "groupedvideos/1/a.mp4",
        "B2_1/.h.mp4", "B2_1/_u.mp4",
    )
    os.makedirs(root + "/empty")
    got = [(os.path.relpath(r.path, root), r.length) for r in videos.scan_mounted_videos(spark, root).collect()]
    names = ["B1_1/a.mp4", "B1_1/deep/er/b.mp4", "B2_1/.h.mp4", "B2_1/_u.mp4"]
    assert sorted(got) == [(n, len(n)) for n in names]
    seen = rows(videos.list_videos(spark, root, mounted=False), "directoryname")
    mounted = rows(videos.list_videos(spark, root + "/"), "directoryname")
    assert set(seen) < set(mounted) and len(mounted) == 4
    plain = {tuple(r) for r in videos.scan_videos(spark, root).select("length", F.date_trunc("second", "modificationTime")).collect()}
    listed = {tuple(r) for r in videos.scan_mounted_videos(spark, root).select("length", F.date_trunc("second", "modificationTime")).collect()}
    assert plain <= listed
    nothing = str(tmp_path / "nothing")
    os.makedirs(nothing)
    assert videos.scan_mounted_videos(spark, nothing).count() == 0


def test_many_small_folders_are_listed_as_one_table(tmp_path):
    _touch(str(tmp_path), *[f"{i}/{i}.mp4" for i in range(50)])
    folders = [str(tmp_path), *[f"{tmp_path}/{i}" for i in range(50)]]
    (listed,) = videos._entries(iter([pd.DataFrame({"folder": folders[:20]}), pd.DataFrame({"folder": folders[20:]})]))
    files = listed[~listed["is_folder"]]
    assert len(listed) == 100 and sorted(files["length"]) == sorted(len(f"{i}/{i}.mp4") for i in range(50))
    assert listed["modificationTime"].notna().sum() == 50
    assert not list(videos._entries(iter([pd.DataFrame({"folder": []})])))


def test_video_files_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    """However small the table of their names is, one task does not make them all."""
    events = spark.range(1000).selectExpr("id as event_id", "timestamp_ntz '2024-01-02' as ts", "id as user_id")
    events.write.parquet(f"{tmp_path}/events.parquet")

    def note(batches):
        task = TaskContext.get().partitionId()
        for batch in batches:
            (tmp_path / f"task-{task}").touch()
            yield batch[["path"]]

    monkeypatch.setattr(queries, "_make_files", note)
    queries._video_files(spark, str(tmp_path))
    assert len(list(tmp_path.glob("task-*"))) > 8


def test_parse_odd_names(spark):
    data = ["/v/B-1_7/2023-02-01 15.mp4", "/v/B1_7/2023-02-01 150012 extra parts.mp4", "/v/B1_7/x.mp4"]
    got = rows(
        videos.parse_video_paths(spark.createDataFrame([(p,) for p in data], "path string"), "/v"),
        "AnimalID", "CollarID", "Year", "Hour", "Minute", "Second",
    )
    assert got == sorted(
        [("B", "1", 2023, 15, None, None), ("B1", "7", 2023, 15, 0, 12), ("B1", "7", None, None, None, None)],
        key=repr,
    )


def test_read_fixes_from_text(spark, tmp_path):
    _touch(str(tmp_path), "csv/a.csv", "json/a.json")
    (tmp_path / "csv/a.csv").write_text(
        "idcollar,acquisitiontime,latitude,longitude,height,temperature,other\n"
        "39971,2023-02-01T15:00:40,29.1,-111.1,10,20.5,x\n"
        "39971.0,2023-02-01T15:00:40.250Z,NaN,,bad,,x\n"
        "no,2023-02-01T16:00:00,29.1,-111.1,1,1,x\n"
        "1,1999-02-01T16:00:00,29.1,-111.1,1,1,x\n"
        "1,2023-02-01 16:00:00,29.1,-111.1,1,1,x\n"
    )
    got = rows(fix_io.read_fixes(spark, str(tmp_path / "csv"), "csv"))
    t = ts("2023-02-01 15:00:40")
    assert got == sorted(
        [
            (39971, t, 29.1, -111.1, 10.0, 20.5),
            (39971, t, None, None, None, None),
            (None, ts("2023-02-01 16:00:00"), 29.1, -111.1, 1.0, 1.0),
        ],
        key=repr,
    )
    (tmp_path / "json/a.json").write_text(
        '{"idcollar": 39971, "acquisitiontime": "2023-02-01T15:00:40", "latitude": 29.1, "longitude": -111.1}\n'
    )
    got = rows(fix_io.read_fixes(spark, str(tmp_path / "json"), "json"))
    assert got == [(39971, t, 29.1, -111.1, None, None)]


def test_bounds_reach_the_scan(spark, tmp_path):
    out = str(tmp_path / "fixes")
    fixes = _fixes(spark, FIXES)
    fix_io.land_fixes(fixes.unionByName(fixes), out)
    read = fix_io.read_fixes(spark, out, start="2023-02-02 00:00:00", end="2023-02-05 21:00:00")
    plan = formatted(fix_io.select_sources(read, [1]))
    assert "GreaterThanOrEqual(acquisitiontime,2023-02-02" in plan and "EqualTo(collar_id,1)" in plan
    assert re.search(r"PartitionFilters: .*acquisition_date#\d+ >= 2023-02-02", plan)
    assert rows(read, "acquisitiontime", "copies") == [
        (ts("2023-02-02 21:00:00"), 2), (ts("2023-02-03 21:00:00"), 2),
    ]


def test_landed_copies_are_not_shuffled_again(spark, tmp_path):
    out = str(tmp_path / "fixes")
    fixes = _fixes(spark, FIXES)
    fix_io.land_fixes(fixes.unionByName(fixes), out)
    landed = fix_io.read_fixes(spark, out)
    cols = ["acquisitiontime", "latitude"]
    plain = copies.expand_copies(pairing.earliest_fixes(fixes.unionByName(fixes)))
    assert rows(copies.expand_copies(pairing.earliest_fixes(landed)), *cols) == rows(plain, *cols)
    assert formatted(pairing.earliest_fixes(landed)).count("hashpartitioning") == 1
    assert rows(copies.expand_copies(landed)) == rows(fixes.unionByName(fixes))


def test_selection_of_collars_is_exact(spark):
    df = _fixes(spark, [(39971, "2023-01-01", 1.0, 1.0), (399, "2023-01-01", 1.0, 1.0)])
    assert rows(fix_io.select_sources(df, [399]), "collar_id") == [(399,)]
    ids = spark.createDataFrame([(399,), (399,)], "id bigint")
    assert rows(fix_io.select_sources(df, ids), "collar_id") == [(399,)]


def test_missing_column_is_an_error(spark, tmp_path):
    out = str(tmp_path / "x")
    spark.range(1).write.parquet(out)
    with pytest.raises(ValueError, match="missing columns"):
        fix_io.read_fixes(spark, out)


def test_filter_bounds(spark):
    df = _fixes(spark, [(1, f"2023-01-0{d} 00:00:00", 1.0, 1.0) for d in range(1, 8)] + [(1, "2023-01-03", None, None), (1, "2023-01-03", None, 1.0)])

    def days(**kw):
        return [r.acquisitiontime.day for r in filters.filter_fixes(df, **kw).orderBy("acquisitiontime").collect()]

    assert days(start="2023-01-06T00:00:00") == [6, 7]
    assert days(study_end="2023-01-03 00:00:00") == [1, 2]
    assert days(begin="2023-01-02 00:00:00", end="2023-01-03 00:00:00") == [2, 3, 3]
    assert days(removed="2023-01-02T00:00:00") == [1]
    removed = spark.createDataFrame(
        [(1, ts("2023-01-04")), (1, ts("2023-01-03")), (1, None), (2, ts("2020-01-01"))], filters_removed()
    )
    assert days(removed=removed) == [1, 2]
    assert days(removed=removed.filter("collar_id = 2")) == [1, 2, 3, 3, 4, 5, 6, 7]
    assert days(study_end=None, coordinates=False, begin="2023-01-03", end="2023-01-03") == [3, 3, 3]


def filters_removed():
    return "collar_id bigint, removed_at timestamp_ntz"


def test_copies_round_trip(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(2, "x")], "a int, b string")
    merged = copies.merge_copies(df)
    assert rows(merged, "a", "copies") == [(1, 3), (2, 1)]
    assert copies.merge_copies(merged) is merged
    assert rows(copies.expand_copies(merged)) == rows(df)
    big = spark.createDataFrame([(1, 25_001), (2, None)], "a int, copies bigint")
    assert copies.expand_copies(big).groupBy("a").count().collect().__len__() == 2
    assert copies.expand_copies(big).count() == 25_002


def test_null_rules(spark):
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, None)], "n int, s string")
    n, s = F.col("n"), F.col("s")
    assert rows(df.select(nulls.if_known(n > 2, "Yes", "No"))) == [("No",), ("Yes",), (None,)]
    assert sorted(r[0] for r in df.select(nulls.is_in(n, [1])).collect()) == [False, False, True]
    assert sorted(r[0] for r in df.select(nulls.is_in(n, [1, None])).collect()) == [False, True, True]
    assert sorted(r[0] for r in df.select(nulls.is_in(n, [None])).collect()) == [False, False, True]
    assert sorted(r[0] for r in df.select(nulls.paste(n, s)).collect()) == ["1a", "3b", "NANA"]
    big = spark.createDataFrame([(39971.0,)], "d double")
    assert rows(big.select(nulls.id_text(F.col("d")))) == [("39971",)]


def test_time_functions(spark):
    df = spark.createDataFrame([("2024-01-28T15:00:38", "2024-1-8 5:00:38", "2024-02-30T00:00:00", 6.5)], "a string, b string, c string, h double")
    r = df.select(
        tu.parse_iso(F.col("a")), tu.parse_plain(F.col("b")), tu.parse_iso(F.col("c")), tu.parse_iso(F.col("b")),
        tu.hours(F.col("h")), tu.to_number(F.col("a")), tu.make_time(*[F.lit(v) for v in (2024, 2, 30, 1, 1, 1)]),
    ).collect()[0]
    assert tuple(r) == (ts("2024-01-28 15:00:38"), ts("2024-01-08 05:00:38"), None, None, dt.timedelta(hours=6.5), None, None)


def test_deployments_round_trip(spark, tmp_path):
    dep = _deployments(
        spark,
        [
            {"animalid": "B1", "collarid": 7, "lastlivefix": ts("2023-01-01 05:06:07"), "DOB": dt.date(2020, 1, 2), "zeta_m": 1.5},
            {"animalid": None, "collarid": None},
        ],
    )
    for fmt in ("csv", "parquet"):
        out = str(tmp_path / fmt)
        dep_io.write_deployments(dep, out, fmt)
        assert rows(dep_io.read_deployments(spark, out, fmt)) == rows(dep)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert "2023-01-01 05:06:07" in text and "NA" not in text
    assert rows(dep_io.known_animals(dep), "animalid") == [("B1",)]


def test_bad_collar_id_becomes_null(spark, tmp_path):
    names = [f.name for f in _deployments(spark, []).schema]
    (tmp_path / "d.csv").write_text(",".join(names) + "\nB1,12x" + "," * (len(names) - 2) + "\n")
    got = dep_io.read_deployments(spark, str(tmp_path / "d.csv"), "csv")
    assert rows(got, "animalid", "collarid") == [("B1", None)]


@pytest.fixture
def video_root(tmp_path):
    root = str(tmp_path / "videos")
    _touch(
        root, "B1_1/2023-02-01 150012.mp4", "B1_1/2023-02-01 201500.mp4", "B1_1/2023-02-01 100000.mp4",
        "B1_1/2023-02-04 210500.mp4",
    )
    return root


def _organise(spark, tmp_path, video_root, **kw):
    dep = _deployments(spark, [{"animalid": "B1", "collarid": 1}, {"collarid": 1}])
    return organise(
        spark, _fixes(spark, FIXES), dep, str(tmp_path / "out"), video_root=video_root, as_of="2024-01-01", **kw
    )


def test_organise_everything(spark, tmp_path, video_root):
    layers = _organise(spark, tmp_path, video_root, save_metadata=True, subdivide=True)
    counts = {r["layer"]: r["count"] for r in layers.groupBy("layer").count().collect()}
    # all seven fixes lie before the open cut-off; five have a position
    assert counts == {"premort_points": 5, "premort_path": 1, "videos_exact": 1, "videos_approximate": 1}
    copied = sorted(
        os.path.relpath(os.path.join(d, f), video_root)
        for d, _, files in os.walk(os.path.join(video_root, "groupedvideos"))
        for f in files
        if f.endswith("mp4")
    )
    assert copied == [
        "groupedvideos/1/NA/NA/2023-02-01 100000.mp4",
        "groupedvideos/1/Successful/Approximate/2023-02-01 201500.mp4",
        "groupedvideos/1/Successful/Exact/2023-02-01 150012.mp4",
        "groupedvideos/1/Unsuccessful/None/2023-02-04 210500.mp4",
    ]
    assert os.path.exists(os.path.join(video_root, "B1_1/2023-02-01 150012.mp4"))
    text = spark.read.option("header", True).csv(str(tmp_path / "out" / "video-metadata"))
    assert text.count() == 4 and "bindingcolumn" not in text.columns
    assert text.filter("status = 'NA' and longitude = 'NA'").count() == 1
    # again: the copies are not taken for videos, and existing files are left alone
    _organise(spark, tmp_path, video_root, subdivide=True)
    log = spark.read.parquet(str(tmp_path / "out" / "copy-log"))
    assert {r.outcome for r in log.collect()} == {"exists"} and log.count() == 4


def test_organise_without_videos(spark, tmp_path):
    layers = _organise(spark, tmp_path, None, video=False)
    assert {r[0] for r in rows(layers, "layer")} == {"premort_points", "premort_path"}
    with pytest.raises(ValueError, match="subdivide"):
        _organise(spark, tmp_path, None, video=False, subdivide=True)
    with pytest.raises(ValueError, match="video_root"):
        _organise(spark, tmp_path, None)


def test_manifests_agree_and_missing_files_are_reported(spark, tmp_path):
    from collartrail.operators.pairing import pair_videos

    listing = spark.createDataFrame([("/none/B1_1/2023-02-01 150012.mp4",), ("/none/B1/2023-02-01 100000.mp4",)], "path string")
    pairs = pair_videos(videos.parse_video_paths(listing, "/none"), _fixes(spark, FIXES), _deployments(spark, []))
    root = str(tmp_path)
    plain = sinks.copy_manifest(pairs, root)
    joined = sinks.copy_manifest_by_key(pairs, sinks.video_groups(pairs), root)
    assert rows(plain, "source", "target") == rows(joined, "source", "target")
    assert {r[0] for r in rows(plain, "target")} == {f"{root}/groupedvideos/1/Successful/Exact", f"{root}/groupedvideos/NA/NA/NA"}
    assert {r.outcome for r in sinks.copy_videos(plain).collect()} == {"missing"}
    assert rows(sinks.videos_per_class(pairs)) == [("Successful", "Exact", 1), (None, None, 1)]


def test_shared_folder_comes_from_the_session(spark, shared):
    assert session.shared_dir(spark) == shared
    assert rows(session.stage(spark.range(3), "some")) == [(0,), (1,), (2,)]
    assert any(name.startswith("some-") for name in os.listdir(shared))


def test_landing_twice_adds_up_by_day(spark, tmp_path):
    out = str(tmp_path / "landed")
    day1 = _fixes(spark, [(1, "2023-02-01 08:00:00", 29.0, -111.0), (1, "2023-02-01 08:00:00", 29.0, -111.0)])
    day2 = _fixes(spark, [(1, "2023-02-02 08:00:00", 29.1, -111.1)])
    fix_io.land_fixes(day1.unionByName(day2), out)
    fix_io.land_fixes(day1, out, "again")
    got = rows(fix_io.read_fixes(spark, out), "acquisitiontime", "copies")
    assert got == [(ts("2023-02-01 08:00:00"), 4), (ts("2023-02-02 08:00:00"), 1)]
    # the other day was not written again
    assert len(list((tmp_path / "landed").glob("days/*/acquisition_date=2023-02-02"))) == 1
    assert len(list((tmp_path / "landed").glob("days/*/acquisition_date=2023-02-01"))) == 2


def test_a_batch_counts_once_and_a_broken_landing_not_at_all(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "landed")
    first = _fixes(spark, [(1, "2023-02-01 08:00:00", 29.0, -111.0), (None, None, 29.0, -111.0)])
    more = _fixes(spark, [(1, "2023-02-01 08:00:00", 29.0, -111.0), (2, "2023-02-03 08:00:00", 29.2, -111.2)])

    def counts():
        return rows(archive.read_archive(spark, out), "collar_id", "copies")

    assert fix_io.land_fixes(first, out, "one")
    assert not fix_io.land_fixes(more, out, "one")  # the name has landed
    assert counts() == [(1, 1), (None, 1)]

    def broken(*_, **__):
        raise OSError("lost")

    whole = archive.write_version
    monkeypatch.setattr(archive, "write_version", lambda *a: broken(whole(*a)))
    with pytest.raises(OSError):
        fix_io.land_fixes(more, out, "two")
    monkeypatch.setattr(archive, "write_version", whole)
    assert counts() == [(1, 1), (None, 1)]
    # a log without its commit mark does not count either, and is replaced
    (tmp_path / "landed" / "batches" / "two").mkdir()
    assert counts() == [(1, 1), (None, 1)]
    assert fix_io.land_fixes(more, out, "two") and not fix_io.land_fixes(more, out, "two")
    assert counts() == [(1, 2), (2, 1), (None, 1)]
    assert fix_io.land_fixes(first.limit(0), out, "nothing") and not fix_io.land_fixes(first, out, "nothing")
    assert counts() == [(1, 2), (2, 1), (None, 1)]


def test_a_batch_without_name_is_known_by_its_content(spark, tmp_path):
    out = str(tmp_path / "landed")
    some = _fixes(spark, [(1, "2023-02-01 08:00:00", 29.0, -111.0), (2, "2023-02-01 09:00:00", None, None)])
    assert fix_io.land_fixes(some, out)
    assert not fix_io.land_fixes(some.orderBy(F.col("collar_id").desc()).repartition(3), out)
    assert fix_io.land_fixes(some.unionByName(some), out)
    assert fix_io.land_fixes(some.filter("collar_id = 1"), out)
    assert rows(fix_io.read_fixes(spark, out), "collar_id", "copies") == [(1, 4), (2, 3)]
    assert fix_io.read_fixes(spark, out, start="2024-01-01").count() == 0


def test_copying_without_hard_links_and_one_source_per_name(spark, tmp_path, monkeypatch):
    for folder in ("a", "b"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "v.mp4").write_text(folder)

    def refuse(*_):
        raise PermissionError("no links here")

    monkeypatch.setattr(sinks.os, "link", refuse)
    assert sinks._copy_one(str(tmp_path / "a" / "v.mp4"), str(tmp_path / "t"))[0] == "copied"
    assert sinks._copy_one(str(tmp_path / "b" / "v.mp4"), str(tmp_path / "t"))[0] == "exists"
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["v.mp4"]
    assert (tmp_path / "t" / "v.mp4").read_text() == "a"
    monkeypatch.undo()
    manifest = spark.createDataFrame(
        [(f"{tmp_path}/{f}/v.mp4", f"{tmp_path}/u") for f in ("b", "a")], "source string, target string"
    )
    log = {r.source[-7:]: r.outcome for r in sinks.copy_videos(manifest).collect()}
    assert log == {"a/v.mp4": "copied", "b/v.mp4": "same name"}
    assert (tmp_path / "u" / "v.mp4").read_text() == "a"


def test_a_copy_is_whole_and_has_times_and_mode_however_little_is_written_at_once(tmp_path, monkeypatch):
    body = os.urandom(100_000)
    (tmp_path / "a.mp4").write_bytes(body)
    os.chmod(tmp_path / "a.mp4", 0o440)
    os.utime(tmp_path / "a.mp4", ns=(1_600_000_000_123_456_789, 1_500_000_000_987_654_321))
    write = os.write
    monkeypatch.setattr(sinks.os, "write", lambda to, some: write(to, some[:7_777]))
    got = sinks._copy_one(str(tmp_path / "a.mp4"), str(tmp_path / "new" / "er"))
    assert got == ("copied", 100_000, hashlib.sha256(body).hexdigest())
    (copy,) = (tmp_path / "new" / "er").iterdir()
    assert copy.name == "a.mp4" and copy.read_bytes() == body
    assert copy.stat().st_mode & 0o777 == 0o440 and copy.stat().st_mtime_ns == 1_500_000_000_987_654_321


def test_copies_are_read_back_and_changed_ones_found(spark, tmp_path):
    for name, body in (("a.mp4", b"first"), ("b.mp4", b""), ("c.mp4", b"x" * 3_000_000)):
        (tmp_path / name).write_bytes(body)
    names = ["a.mp4", "b.mp4", "c.mp4", "absent.mp4"]
    manifest = spark.createDataFrame([(f"{tmp_path}/{n}", f"{tmp_path}/out") for n in names], "source string, target string")
    log = sinks.copy_videos(manifest, tasks=2)
    got = {os.path.basename(r.source): (r.outcome, r.length, r.sha256) for r in log.collect()}
    assert got["a.mp4"] == ("copied", 5, hashlib.sha256(b"first").hexdigest())
    assert got["b.mp4"][1] == 0 and got["c.mp4"][1] == 3_000_000
    assert got["absent.mp4"] == ("missing", None, None)
    assert rows(sinks.check_copies(log), "intact") == [(True,)] * 3
    (tmp_path / "out" / "a.mp4").write_bytes(b"fjrst")
    (tmp_path / "out" / "b.mp4").unlink()
    bad = sinks.check_copies(log).filter("not intact")
    assert sorted((os.path.basename(r.path), r.length_found) for r in bad.collect()) == [("a.mp4", 5), ("b.mp4", None)]
    # a second run sees what is there
    again = {os.path.basename(r.source): (r.outcome, r.sha256) for r in sinks.copy_videos(manifest).collect()}
    assert again["a.mp4"] == ("exists", hashlib.sha256(b"fjrst").hexdigest()) and again["b.mp4"][0] == "copied"


def test_nothing_is_landed_into_a_folder_of_something_else(spark, tmp_path):
    fixes = _fixes(spark, [(1, "2023-02-01 08:00:00", 29.0, -111.0)])
    fixes.write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError):
        fix_io.land_fixes(fixes, str(tmp_path / "plain"))
    assert fix_io.read_fixes(spark, str(tmp_path / "plain")).count() == 1
