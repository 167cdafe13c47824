"""Video pairing: the two passes on hand-made rows, traps, and equality of formulations."""

import pytest
from pyspark.sql import functions as F

from collartrail.functions import timeutil as tu
from collartrail.operators import groups, pairing
from collartrail.operators.copies import expand_copies
from collartrail.schemas import VIDEO_PAIR_COLUMNS, VIDEOS
from collartrail.sources.videos import parse_video_paths
from tests.test_geo_paths import _fixes
from tests.test_tracks import _deployments
from tests.util import rows, ts
from workload import views

FIXES = [
    (1, "2023-02-01 08:01:00", None, None),
    (1, "2023-02-01 15:00:40", 29.1, -111.1),
    (1, "2023-02-01 15:30:00", 29.2, -111.2),
    (1, "2023-02-01 21:00:30", 29.3, -111.3),
    (1, "2023-02-02 21:00:00", 29.4, -111.4),
    (1, "2023-02-03 21:00:00", None, None),
    (1, "2023-02-05 21:00:00", 29.5, -111.5),
]

# time, pass, status, coordinates, time of the paired fix; pass None: lost
VIDEO_CASES = [
    ("2023-02-01 15:00:12", 1, "Successful", "Exact", "2023-02-01 15:00:40"),
    ("2023-02-01 00:10:00", 1, "Unsuccessful", "None", None),
    ("2023-02-01 10:00:00", 2, None, None, None),
    ("2023-02-01 08:00:00", 1, "Successful", "Missing", "2023-02-01 08:01:00"),
    ("2023-02-01 20:15:00", 2, "Successful", "Approximate", "2023-02-01 21:00:30"),
    ("2023-02-02 19:30:00", 2, None, None, None),
    ("2023-02-02 19:50:00", None, None, None, None),
    ("2023-02-03 19:50:00", 2, "Successful", "ApproxMissing", "2023-02-03 21:00:00"),
    ("2023-02-04 21:05:00", 2, "Unsuccessful", "None", None),
    ("2023-02-04 20:59:00", 2, "Unsuccessful", "None", None),
    ("2023-02-05 19:45:59", 2, None, None, None),
]


def _videos(spark, data):
    paths = [
        (f"/v/{animal}_{collar}/{t.replace(':', '')}.mp4" if collar else f"/v/{animal}/{t.replace(':', '')}.mp4",)
        for animal, collar, t in data
    ]
    return parse_video_paths(spark.createDataFrame(paths, "path string"), "/v")


@pytest.fixture(scope="module")
def one(spark):
    videos = _videos(spark, [("B1", 1, c[0]) for c in VIDEO_CASES])
    dep = _deployments(
        spark,
        [
            {
                "animalid": "B1", "collarid": 1, "sex": "F",
                "firstfixoutsidepen_UTC": ts("2023-02-01 10:00:00"),
                "lastfixoutsidemortclust_UTC": ts("2023-02-02 19:30:00"),
            }
        ],
    )
    return videos, _fixes(spark, FIXES), dep


COLS = ["TimeStamp_UTC", "status", "coordinates", "acquisitiontime"]


def test_truth_table(one):
    got = rows(pairing.pair_videos(*one), *COLS)
    want = [(ts(t), s, c, ts(a)) for t, n, s, c, a in VIDEO_CASES if n]
    assert got == sorted(want, key=repr)


def test_each_pass(one):
    first = {r[0]: r[1:] for r in rows(pairing.pair_exact(*one), *COLS)}
    assert len(first) == len(VIDEO_CASES)
    for t, n, s, c, a in VIDEO_CASES:
        assert first[ts(t)] == ((s, c, ts(a)) if n == 1 else (None, "", None))
    second = {r[0] for r in rows(pairing.pair_approx(*one), *COLS)}
    assert second == {ts(c[0]) for c in VIDEO_CASES if c[1] == 2}


def test_unknown_minimum_can_be_turned_off(one):
    got = rows(pairing.pair_videos(*one, null_poisons=False), *COLS)
    kept = (ts("2023-02-02 19:50:00"), "Successful", "Approximate", ts("2023-02-02 21:00:00"))
    assert kept in got and len(got) == len(VIDEO_CASES)


def test_staged_is_equal(one):
    assert rows(pairing.pair_videos(*one, staged=True)) == rows(pairing.pair_videos(*one))


def test_columns_and_key(one):
    pairs = pairing.pair_videos(*one)
    assert pairs.columns == [*VIDEO_PAIR_COLUMNS, "bindingcolumn"]
    keys = {r[0] for r in rows(pairs, "bindingcolumn")}
    assert keys == {
        "1SuccessfulExact", "1SuccessfulMissing", "1UnsuccessfulNone", "1SuccessfulApproximate",
        "1SuccessfulApproxMissing", "1NANA",
    }


def test_life_phases(one):
    videos, _, dep = one
    got = {r[0]: r[1:] for r in rows(
        pairing.with_deployment(videos, dep), "TimeStamp_UTC",
        "livevideoprerelease", "livevideopostrelease", "mortvideo")}
    assert got[ts("2023-02-01 08:00:00")] == ("Yes", "No", "No")
    assert got[ts("2023-02-01 10:00:00")] == ("No", "Yes", "No")  # exactly at release
    assert got[ts("2023-02-02 19:30:00")] == ("No", "Yes", "No")  # exactly at the cut-off
    assert got[ts("2023-02-02 19:50:00")] == ("No", "No", "Yes")


def test_unknown_release_gives_no_flag_unless_decided(spark):
    videos = _videos(spark, [("B1", 1, "2023-02-01 08:00:00"), ("B1", 1, "2023-02-03 08:00:00"), ("B2", 1, "2023-02-01 08:00:00")])
    dep = _deployments(spark, [{"animalid": "B1", "collarid": 1, "lastfixoutsidemortclust_UTC": ts("2023-02-02")}])
    got = rows(pairing.with_deployment(videos, dep), "AnimalID", "livevideoprerelease", "livevideopostrelease", "mortvideo")
    assert got == [("B1", None, "No", "Yes"), ("B1", None, None, "No"), ("B2", None, None, None)]


def test_fill_cutoff(spark):
    dep = _deployments(spark, [{"animalid": "a"}, {"animalid": "b", "lastfixoutsidemortclust_UTC": ts("2023-01-01 05:00:00")}])
    got = rows(pairing.fill_cutoff(dep, "2024-02-28"), "animalid", "lastfixoutsidemortclust_UTC")
    assert got == [("a", ts("2024-02-29")), ("b", ts("2023-01-01 05:00:00"))]


def test_missing_collar_matches_missing_collar(spark):
    videos = _videos(spark, [("B7", None, "2023-02-01 15:00:00")])
    dep = _deployments(spark, [{"animalid": "B7", "collarid": None, "sex": "M"}, {"animalid": "B7", "collarid": 1, "sex": "F"}])
    got = rows(pairing.pair_videos(videos, _fixes(spark, FIXES), dep), "CollarID", "sex", "status", "bindingcolumn")
    assert got == [(None, "M", "Unsuccessful", "NAUnsuccessfulNone")]


def test_second_collar_of_an_animal_is_settled_by_the_first(spark):
    # collar 1 has a fix at 15 h; collar 2 none at 8 h, but at the same second collar 1 is settled
    videos = _videos(spark, [("B1", 1, "2023-02-01 08:00:00"), ("B1", 2, "2023-02-01 08:00:00"), ("B2", 2, "2023-02-01 08:00:00")])
    got = rows(pairing.pair_videos(videos, _fixes(spark, FIXES), _deployments(spark, [])), "AnimalID", "CollarID", "status")
    assert got == [("B1", "1", "Successful"), ("B2", "2", None)]


def test_redeployed_collar_multiplies_rows(spark, one):
    videos, fixes, dep = one
    twice = pairing.pair_videos(videos, fixes, dep.unionByName(dep))
    assert twice.count() == 2 * pairing.pair_videos(*one).count()


def test_tied_and_copied_fixes_are_all_kept(spark, one):
    videos, fixes, dep = one
    tied = _fixes(spark, [(1, "2023-02-01 15:00:40", 28.0, -110.0)])
    more = fixes.unionByName(tied).unionByName(tied).unionByName(tied)
    got = pairing.pair_videos(videos, more, dep).filter("coordinates = 'Exact'")
    assert rows(got, "latitude") == [(28.0,), (28.0,), (28.0,), (29.1,)]


def test_merging_copies_does_not_show(spark, one):
    _, fixes, _ = one
    more = fixes.unionByName(fixes).unionByName(fixes.filter("latitude > 29.2"))
    cols = ["acquisitiontime", "latitude"]
    first = pairing.earliest_fixes(more)
    plain = rows(pairing.earliest_fixes(fixes), *cols)
    assert first.count() == len(plain) == 6
    assert set(rows(expand_copies(first), *cols)) == set(plain)
    assert expand_copies(first).count() == 15


def test_placeholder_coordinates_are_missing(spark, one):
    videos, _, dep = one
    fixes = _fixes(spark, [(1, "2023-02-01 15:00:40", 7777.0, 7777.0), (1, "2023-02-01 08:00:00", 7777.0, -111.0)])
    got = {r[0]: r[1:] for r in rows(pairing.pair_exact(videos, fixes, dep), "TimeStamp_UTC", "coordinates", "latitude", "longitude")}
    assert got[ts("2023-02-01 15:00:12")] == ("Missing", None, None)
    assert got[ts("2023-02-01 08:00:00")] == ("Exact", None, -111.0)


def test_unreadable_times(spark):
    # no time: stays in the table; with hour 15 it counts as a failed scheduled video, and
    # then settles the animal's other row without a time
    data = [("/v/B1_1/2023-13-01 150012.mp4",), ("/v/B1_1/clip.mp4",), ("/v/B2_1/clip.mp4",)]
    videos = parse_video_paths(spark.createDataFrame(data, "path string"), "/v")
    got = rows(pairing.pair_videos(videos, _fixes(spark, FIXES), _deployments(spark, [])), "AnimalID", "status", "TimeStamp_UTC")
    assert got == [("B1", "Unsuccessful", None), ("B2", None, None)]


def test_collar_ids_are_compared_as_written(spark):
    videos = _videos(spark, [("B1", "01", "2023-02-01 15:00:00"), ("B1", "1x", "2023-02-01 15:00:01")])
    got = rows(pairing.pair_exact(videos, _fixes(spark, FIXES), _deployments(spark, [])), "CollarID", "coordinates")
    assert got == [("01", "None"), ("1x", "None")]


def test_approx_hour(spark):
    cases = [(19, 45, 19), (19, 46, 21), (20, 0, 21), (20, None, 21), (19, None, None), (21, 1, 21), (None, 50, None), (7, 59, 7)]
    df = spark.createDataFrame(cases, "h int, m int, want int")
    assert df.filter(~tu.approx_hour(F.col("h"), F.col("m")).eqNullSafe(F.col("want"))).count() == 0


def test_reducing_before_the_join_equals_filtering_after_it(spark):
    """Join all fixes of the hour, then keep the earliest, on the whole test tables."""
    sf = "/root/testdata/sf0.001"
    fixes = views.fixes(spark, sf)
    videos = parse_video_paths(views.video_paths(spark, sf), views.ROOT)
    dep = pairing.fill_cutoff(views.deployments(spark, sf), views.AS_OF)
    known = pairing.with_date(pairing.with_deployment(videos, dep))
    all_fixes = pairing.mark_missing(fixes).select(
        F.col("collar_id").cast("string").alias("CollarID"),
        F.to_date("acquisitiontime").alias("Date"),
        F.hour("acquisitiontime").alias("Hour"),
        "acquisitiontime",
    )
    joined = known.join(all_fixes, groups.null_safe(known, all_fixes, ["CollarID", "Date", "Hour"]), "left")
    joined = joined.drop(*[all_fixes[c] for c in ("CollarID", "Date", "Hour")])
    after = groups.earliest_keep_ties(joined, ["AnimalID", "CollarID", "Date", "Hour"], "acquisitiontime")
    cols = ["AnimalID", "directoryname", "acquisitiontime"]
    assert rows(after, *cols) == rows(pairing.pair_exact(videos, fixes, dep), *cols)


def test_every_video_is_in_one_pass(spark):
    sf = "/root/testdata/sf0.001"
    videos = parse_video_paths(views.video_paths(spark, sf), views.ROOT)
    fixes, dep = views.fixes(spark, sf), views.deployments(spark, sf)
    both = pairing.pair_videos(videos, fixes, dep, null_poisons=False)
    alone = pairing.pair_exact(videos, fixes, dep)
    # lost are those that pass 1 left over, of an animal another collar of which it settled that second
    settled = alone.filter("status is not null").select("AnimalID", "TimeStamp_UTC").distinct()
    left = alone.filter("status is null")
    lost = left.join(settled, groups.null_safe(left, settled, ["AnimalID", "TimeStamp_UTC"]), "left_semi")
    lost = set(rows(lost, "directoryname"))
    assert len(lost) == 16
    assert set(rows(both, "directoryname")) == set(rows(videos, "directoryname")) - lost
    assert videos.schema.names == VIDEOS.names


def test_repeated_rows_of_videos_stay_repeated(spark, one):
    videos, fixes, dep = one
    once = rows(pairing.pair_videos(videos, fixes, dep), "directoryname", "status")
    thrice = rows(pairing.pair_videos(videos.unionByName(videos).unionByName(videos), fixes, dep), "directoryname", "status")
    assert thrice == sorted(once * 3, key=repr)


def test_a_video_without_time_is_settled_by_a_fix_without_time(spark):
    videos = parse_video_paths(spark.createDataFrame([("/v/B1_1/clip.mp4",), ("/v/B1_2/clip.mp4",), ("/v/B2_2/clip.mp4",)], "path string"), "/v")
    got = rows(pairing.pair_videos(videos, _fixes(spark, [(1, None, 29.0, -111.0)]), _deployments(spark, [])), "AnimalID", "CollarID", "status")
    assert got == [("B1", "1", "Successful"), ("B2", "2", None)]


def test_both_passes_read_each_table_once_and_join_once(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    videos = parse_video_paths(views.video_paths(spark, sf), views.ROOT)
    names = {}
    for name, df in (("videos", videos), ("fixes", views.fixes(spark, sf)), ("deployments", views.deployments(spark, sf))):
        names[name] = str(tmp_path / name)
        df.write.parquet(names[name])
    tables = [spark.read.parquet(p) for p in names.values()]

    def planned():
        return pairing.pair_videos(*tables)._jdf.queryExecution().executedPlan().toString()

    assert planned().count("Exchange hashpartitioning") <= 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = planned()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # videos and fixes once, and once more only for rows without a time
    assert plan.count("FileScan parquet") == 5
    assert plan.count("IsNull(TimeStamp_UTC)") == 1 and plan.count("IsNull(acquisitiontime)") == 1
    assert plan.count("Exchange hashpartitioning") <= 15


def test_a_fix_without_collar_matches_a_video_without_one(spark):
    fixes = _fixes(spark, [(None, "2023-02-01 15:00:40", 29.0, -111.0), (1, "2023-02-01 15:00:50", 29.1, -111.1)])
    videos = parse_video_paths(
        spark.createDataFrame([("/v/B1/2023-02-01 150012.mp4",), ("/v/B2_1/2023-02-01 150012.mp4",)], "path string"),
        "/v",
    )
    dep = _deployments(spark, [])
    got = rows(pairing.pair_exact(videos, fixes, dep), "AnimalID", "coordinates", "latitude")
    assert got == [("B1", "Exact", 29.0), ("B2", "Exact", 29.1)]
