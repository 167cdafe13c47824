"""Fixed table schemas; readers cast to these and fail on missing columns."""

from __future__ import annotations

from pyspark.sql import types as T

_long, _int, _dbl, _str = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_ts, _date = T.TimestampNTZType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


FIXES = _struct(
    ("collar_id", _long),
    ("acquisitiontime", _ts),
    ("latitude", _dbl),
    ("longitude", _dbl),
    ("height", _dbl),
    ("temperature", _dbl),
)

DEPLOYMENTS = _struct(
    ("animalid", _str),
    ("collarid", _long),
    ("sex", _str),
    ("DOB", _date),
    ("starttestingdate", _date),
    ("starthandlingpens", _date),
    ("startsoftreleasepens", _date),
    ("firstfixoutsidepen_UTC", _ts),
    ("lastfixoutsidemortclust_UTC", _ts),
    ("lastlivefix", _ts),
    ("firstfixinendclust", _ts),
    ("lastfixinendclust", _ts),
    ("fate", _int),
    ("zeta_m", _dbl),
    ("eta_fixes", _int),
    ("theta_hr", _dbl),
    ("cause", _str),
    ("beginremoved_UTC", _ts),
)

ACCEPTED = _struct(("collar_id", _long), ("cause", _str), ("removed_at", _ts))

REMOVED = _struct(("collar_id", _long), ("removed_at", _ts))

VIDEOS = _struct(
    ("AnimalID", _str),
    ("CollarID", _str),
    ("TimeStamp_UTC", _ts),
    ("Year", _int),
    ("Month", _int),
    ("Day", _int),
    ("Hour", _int),
    ("Minute", _int),
    ("Second", _int),
    ("directoryname", _str),
)

#: Deployment columns a video row carries.
VIDEO_DEPLOYMENT_COLUMNS = [
    "sex",
    "lastfixoutsidemortclust_UTC",
    "starttestingdate",
    "starthandlingpens",
    "startsoftreleasepens",
    "firstfixoutsidepen_UTC",
]

# The column order of the exported video table.
VIDEO_PAIR_COLUMNS = [
    "AnimalID",
    "CollarID",
    "sex",
    "livevideoprerelease",
    "livevideopostrelease",
    "mortvideo",
    "status",
    "coordinates",
    "TimeStamp_UTC",
    "Year",
    "Month",
    "Day",
    "Hour",
    "Minute",
    "Second",
    "starttestingdate",
    "starthandlingpens",
    "startsoftreleasepens",
    "firstfixoutsidepen_UTC",
    "lastfixoutsidemortclust_UTC",
    "acquisitiontime",
    "latitude",
    "longitude",
    "height",
    "temperature",
    "directoryname",
]

# Study window, source start, and the largest value that is a coordinate.
FETCH_START = "2000-01-01 00:00:01"
STUDY_START = "2022-11-12 00:00:01"
STUDY_END = "2025-01-01 00:00:01"
MAX_COORDINATE = 5000.0
