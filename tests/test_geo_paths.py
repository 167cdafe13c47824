
import pytest
from pyspark.sql import functions as F

from collartrail.functions.geo import utm
from collartrail.operators import paths, tracks
from collartrail.operators.layers import base_fixes, fix_layers, ordered
from tests.test_tracks import _deployments, random_fixes
from tests.util import rows, track, ts

# Longitude, latitude -> UTM 12N easting, northing.
POINTS = [
    (-111.0, 0.00, 500000.0000, 0.0000),
    (-111.0, 29.00, 500000.0000, 3207985.6161),
    (-112.5, 29.25, 354244.2754, 3236616.3848),
    (-110.2, 30.75, 576572.5608, 3402169.5274),
    (-113.9, 31.90, 225730.5327, 3533021.3645),
]


def test_utm_points(spark):
    df = spark.createDataFrame(POINTS, "lon double, lat double, e double, n double")
    east, north = utm(F.col("lon"), F.col("lat"))
    for r in df.select("e", "n", east.alias("east"), north.alias("north")).collect():
        assert r.east == pytest.approx(r.e, abs=1e-4)
        assert r.north == pytest.approx(r.n, abs=1e-4)


def test_utm_missing_and_other_zone(spark):
    df = spark.createDataFrame([(-111.0, None), (-105.0, 0.0)], "longitude double, latitude double")
    assert [r for r in rows(tracks.project_utm(df)) if None in r] == [(None, None)]
    other = tracks.project_utm(df.filter("latitude = 0"), zone=13).collect()[0]
    assert other.longitude == pytest.approx(500000.0, abs=1e-6)


def test_points(spark):
    df = spark.createDataFrame([(-111.5, 29.25), (-111.5, None)], "x double, y double")
    got = rows(paths.as_points(df, "x", "y", "here"), "geometry_wkt", "crs")
    assert got == [("POINT (-111.5 29.25)", "here"), (None, "here")]
    assert paths.as_points(df, "x", "y", "here").filter("point is null").count() == 1


def _vertices(wkt):
    if wkt is None:
        return []
    return [tuple(float(v) for v in p.split()) for p in wkt[len("LINESTRING (") : -1].split(", ")]


@pytest.mark.parametrize("seed,limit", [(1, 2), (1, 3), (2, 7), (3, 10_000)])
def test_parts_laid_end_to_end_are_the_path(spark, seed, limit):
    fixes = random_fixes(seed, collars=3, n=60)
    df = spark.createDataFrame(fixes, "collar_id bigint, t_ timestamp_ntz, x_ double, y_ double")
    got = {}
    for r in paths.movement_path(df, max_vertices=limit).collect():
        vertices = _vertices(r.geometry_wkt)
        assert 2 <= len(vertices) == r.vertices <= limit
        got.setdefault(r.collar_id, {})[r.part] = vertices
    for collar in {f[0] for f in fixes}:
        whole = []
        for part in range(len(got[collar])):
            piece = got[collar][part]
            if whole:
                assert whole[-1] == piece[0]
            whole += piece[1:] if whole else piece
        assert whole == [f[2:] for f in sorted(f for f in fixes if f[0] == collar)]


def test_many_copies_in_one_path(spark):
    df = track(spark, [(0, 0, 0), (1, 1, 1), (2, 2, 2)]).withColumn(
        "copies", F.when(F.hour("t_") == 1, 25_000).otherwise(1).cast("bigint")
    )
    got = paths.movement_path(df, max_vertices=10_000).collect()
    assert sorted((r.part, r.vertices) for r in got) == [(0, 10_000), (1, 10_000), (2, 5_004)]


def test_short_paths(spark):
    df = track(spark, [(0, 0, 0)])
    assert rows(paths.movement_path(df), "vertices", "geometry_wkt") == [(1, None)]
    with pytest.raises(ValueError):
        paths.movement_path(df, max_vertices=1)


def _fixes(spark, data):
    return spark.createDataFrame(
        [(c, ts(t), lat, lon, None, None) for c, t, lat, lon in data],
        "collar_id bigint, acquisitiontime timestamp_ntz, latitude double, longitude double, "
        "height double, temperature double",
    )


def _map_fixture(spark):
    fixes = _fixes(
        spark,
        [
            (1, "2023-01-01 00:00:00", 29.0, -111.0),
            (1, "2023-01-02 00:00:00", 29.1, -111.1),  # at the cut-off: still alive
            (1, "2023-01-03 00:00:00", 29.2, -111.2),
            (1, "2023-01-04 00:00:00", None, -111.3),  # no latitude: kept, without geometry
            (1, "2023-01-05 00:00:00", 29.4, None),
            (1, "2022-11-12 00:00:00", 29.5, -111.5),  # a second before the study
            (1, "2025-01-01 00:00:01", 29.5, -111.5),  # the study has ended
            (1, "2023-01-06 00:00:00", 29.6, 7777.0),
            (9, "2023-01-01 00:00:00", 29.0, -111.0),  # no deployment: neither phase
        ],
    )
    dep = _deployments(
        spark, [{"animalid": "B", "collarid": 1, "lastfixoutsidemortclust_UTC": ts("2023-01-02")}]
    )
    return fixes, dep


def test_base_fixes_and_layers(spark):
    fixes, dep = _map_fixture(spark)
    base = base_fixes(fixes, dep)
    assert [r.acquisitiontime.day for r in ordered(base).collect()] == [1, 2, 3, 4, 1]
    got = rows(fix_layers(base), "layer", "kind", "geometry_wkt", "color")
    assert got == [
        ("postmort_path", "line", None, "red"),
        ("postmort_points", "point", "POINT (-111.2 29.2)", "red"),
        ("postmort_points", "point", None, "red"),
        ("premort_path", "line", "LINESTRING (-111.0 29.0, -111.1 29.1)", "darkgreen"),
        ("premort_points", "point", "POINT (-111.0 29.0)", "darkgreen"),
        ("premort_points", "point", "POINT (-111.1 29.1)", "darkgreen"),
    ]
    assert {r[0] for r in rows(fix_layers(base, mortdata=False), "layer")} == {"premort_path", "premort_points"}
    assert fix_layers(base, ids=[9]).count() == 0
    narrow = fix_layers(base, begin="2023-01-02 00:00:00", end="2023-01-03 00:00:00")
    assert narrow.filter("kind = 'point'").count() == 2


def test_redeployed_collar_has_each_fix_per_deployment(spark):
    fixes, dep = _map_fixture(spark)
    twice = dep.unionByName(dep)
    assert base_fixes(fixes, twice).count() == 2 * 4 + 1


def test_copies_column_is_expanded_in_layers(spark):
    fixes, dep = _map_fixture(spark)
    plain = fix_layers(base_fixes(fixes.unionByName(fixes), dep))
    merged = fix_layers(base_fixes(fixes.withColumn("copies", F.lit(2).cast("bigint")), dep))
    assert rows(plain) == rows(merged)
