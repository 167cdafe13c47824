"""Telemetry tables derived from the given parquet tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collartrail.functions.nulls import nan_to_null
from collartrail.schemas import DEPLOYMENTS

STUDY_START = "2024-01-01 00:00:00"
STUDY_END = "2024-02-01 00:00:00"
AS_OF = "2024-01-31"
ROOT = "/videos"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k():
    return F.regexp_extract("props", r"(\d+)", 1).try_cast("int")


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; a signup has no time, and a few fixes have no collar."""
    kind, value = F.col("event_type"), F.col("value")
    lon = F.lit(-111.0) + (_k() - 50) / F.lit(100.0)
    lat = F.lit(29.0) + value / F.lit(1000.0)
    no_lat = (kind == "error") | ((kind == "purchase") & (value < 20))
    return (
        _read(spark, sf_dir, "events")
        .select(
            F.when(F.col("event_id") % 997 != 0, F.col("user_id")).alias("collar_id"),
            F.when(kind != "signup", F.col("ts")).alias("acquisitiontime"),
            nan_to_null(F.when(~no_lat, lat)).alias("latitude"),
            F.when(kind != "error", lon).alias("longitude"),
            value.alias("height"),
            _k().cast("double").alias("temperature"),
        )
    )


def fixes_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track-shaped view of all events."""
    return _read(spark, sf_dir, "events").select(
        F.col("user_id").alias("collar_id"),
        F.col("ts").alias("t_"),
        F.col("value").alias("x_"),
        _k().cast("double").alias("y_"),
    )


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; some animals are unknown, some collars used again by another animal, some
    animals have a second collar, and a few rows have no collar."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    # first deployment; the collar's next one, ten days later; the animal's other collar
    kinds = (
        F.when(key % 13 == 5, F.array(F.lit(0), F.lit(10)))
        .when(key % 17 == 3, F.array(F.lit(0), F.lit(-1)))
        .otherwise(F.array(F.lit(0)))
    )
    customers = _read(spark, sf_dir, "customer").withColumn("kind", F.explode(kinds))
    later = F.greatest(F.col("kind"), F.lit(0))
    release = F.date_add(
        F.lit("2024-01-03").cast("date"), F.floor(nation / 5).cast("int") + later.cast("int")
    )
    cutoff = F.date_add(F.lit("2024-01-10").cast("date"), (nation + later).cast("int"))
    animal = F.concat(F.lit("B"), key.cast("string"), F.when(later > 0, "n").otherwise(""))
    made = {
        "animalid": F.when(key % 11 != 0, animal),
        "collarid": F.when(key % 4999 != 7, F.when(F.col("kind") < 0, key + 1).otherwise(key)),
        "sex": F.col("c_mktsegment"),
        "starttestingdate": F.date_sub(release, 2),
        "starthandlingpens": F.date_sub(release, 1),
        "startsoftreleasepens": release,
        "firstfixoutsidepen_UTC": F.when(nation >= 2, release),
        "lastfixoutsidemortclust_UTC": F.when(nation < 20, cutoff),
    }
    return customers.select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in DEPLOYMENTS.fields]
    )


def video_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A video for each event, some of them by two collars at once, a few in a folder without collar."""
    time = F.expr("ts + interval 7 minutes")
    user, event = F.col("user_id"), F.col("event_id")
    collars = (
        F.when(event % 997 == 0, F.array(F.lit("")))
        .when(event % 50 == 1, F.array(F.concat(F.lit("_"), user), F.concat(F.lit("_"), user + 1)))
        .otherwise(F.array(F.concat(F.lit("_"), user)))
    )
    return (
        _read(spark, sf_dir, "events")
        .withColumn("collar", F.explode(collars))
        .select(
            F.concat(
                F.lit(f"{ROOT}/B"), user.cast("string"), F.col("collar"), F.lit("/"),
                F.date_format(time, "yyyy-MM-dd HHmmss"), F.lit(".mp4"),
            ).alias("path")
        )
    )


#: The same views as SQL common table expressions.
SQL = {
    "fixes": """
        select case when event_id % 997 <> 0 then user_id end as collar_id,
               case when event_type <> 'signup' then ts end as acquisitiontime,
               case when not (event_type = 'error' or (event_type = 'purchase' and value < 20))
                    then 29.0::double + value / 1000.0::double end as latitude,
               case when event_type <> 'error'
                    then -111.0::double + (k - 50) / 100.0::double end as longitude,
               value as height, k::double as temperature
        from (select *, regexp_extract(props, '([0-9]+)', 1)::int as k from events)""",
    "xy": """
        select user_id as collar_id, ts as t_, value as x_,
               regexp_extract(props, '([0-9]+)', 1)::double as y_
        from events""",
    "deployments": """
        select case when c_custkey % 11 <> 0
                    then 'B' || c_custkey::varchar || case when kind > 0 then 'n' else '' end
               end as animalid,
               case when c_custkey % 4999 <> 7
                    then case when kind < 0 then c_custkey + 1 else c_custkey end
               end as collarid,
               c_mktsegment as sex, null::date as "DOB",
               release - 2 as starttestingdate, release - 1 as starthandlingpens,
               release as startsoftreleasepens,
               case when c_nationkey >= 2 then release::timestamp end as "firstfixoutsidepen_UTC",
               case when c_nationkey < 20
                    then (date '2024-01-10' + (c_nationkey + greatest(kind, 0))::int)::timestamp
               end as "lastfixoutsidemortclust_UTC",
               null::timestamp as lastlivefix, null::timestamp as firstfixinendclust,
               null::timestamp as lastfixinendclust, null::int as fate, null::double as zeta_m,
               null::int as eta_fixes, null::double as theta_hr, null::varchar as cause,
               null::timestamp as "beginremoved_UTC"
        from (select *, date '2024-01-03' + (c_nationkey // 5 + greatest(kind, 0))::int as release
              from (select *, unnest(case when c_custkey % 13 = 5 then [0, 10]
                                          when c_custkey % 17 = 3 then [0, -1]
                                          else [0] end) as kind
                    from customer))""",
    "video_paths": f"""
        select '{ROOT}/B' || user_id::varchar || collar || '/'
               || strftime(ts + interval 7 minute, '%Y-%m-%d %H%M%S') || '.mp4' as path
        from (select *, unnest(case when event_id % 997 = 0 then ['']
                                    when event_id % 50 = 1
                                    then ['_' || user_id::varchar, '_' || (user_id + 1)::varchar]
                                    else ['_' || user_id::varchar] end) as collar
              from events)""",
}
