"""The queries of ``queries.py`` in SQL, written from the operators' definitions."""

from __future__ import annotations

import re

from workload import views
from workload.queries import BEGIN, END, ETA, THETA, ZETA

_CUT = "lastfixoutsidemortclust_UTC"
_REL = "firstfixoutsidepen_UTC"
_DEP_COLS = f'sex, "{_CUT}", starttestingdate, starthandlingpens, startsoftreleasepens, "{_REL}"'
_PAIR_KEYS = "AnimalID, CollarID, Date, Hour"
_PAIR_COLS = f"""AnimalID as "AnimalID", CollarID as "CollarID", sex, livevideoprerelease,
    livevideopostrelease, mortvideo, status, coordinates, TimeStamp_UTC as "TimeStamp_UTC",
    Year as "Year", Month as "Month", Day as "Day", Hour as "Hour", Minute as "Minute",
    Second as "Second", starttestingdate, starthandlingpens, startsoftreleasepens, "{_REL}",
    "{_CUT}", acquisitiontime, latitude, longitude, height, temperature, directoryname"""


def _flags(alias_t: str = "TimeStamp_UTC") -> str:
    def yes_no(test: str, name: str) -> str:
        return f"case when {test} then 'Yes' when not ({test}) then 'No' end as {name}"

    return ", ".join(
        [
            yes_no(f'{alias_t} < "{_REL}"', "livevideoprerelease"),
            yes_no(f'{alias_t} >= "{_REL}" and {alias_t} <= "{_CUT}"', "livevideopostrelease"),
            yes_no(f'{alias_t} > "{_CUT}"', "mortvideo"),
        ]
    )


def _earliest(source: str) -> str:
    """Earliest fix per group after the join; a missing time leaves the minimum unknown."""
    return f"""
        select * from (
            select *, min(acquisitiontime) over w as lo,
                   bool_or(acquisitiontime is null) over w as unknown
            from {source} window w as (partition by {_PAIR_KEYS}))
        where acquisitiontime is null or (not unknown and acquisitiontime = lo)"""


def _runs(zeta: float) -> dict[str, str]:
    order = "partition by collar_id order by t_, x_, y_"
    return {
        "vertices": "select collar_id, t_, x_, y_, count(*) as copies from xy group by all",
        "stepped": f"""
            select *, sqrt((x_ - lag(x_) over w) * (x_ - lag(x_) over w)
                           + (y_ - lag(y_) over w) * (y_ - lag(y_) over w)) as step
            from vertices window w as ({order})""",
        "broken": f"select *, step is null or step > {zeta} as anchor from stepped",
        "numbered": f"""
            select *, sum(anchor::int) over ({order} rows unbounded preceding) as run
            from broken""",
        "runs": """
            select *, run = max(run) over (partition by collar_id) as is_last_run,
                   sum(copies) over (partition by collar_id, run) as run_fixes,
                   min(t_) over (partition by collar_id, run) as run_begin,
                   max(t_) over (partition by collar_id, run) as run_end
            from numbered""",
    }


def _flagged(source: str, last_only: bool, eta: int, theta: float) -> str:
    last = "is_last_run and" if last_only else ""
    return f"""
        select collar_id, t_, x_, y_, flag as defunct_cluster_, n as copies from (
            select *, false as flag, case when cluster then 1 else copies end as n
            from (select *, {last} run_fixes - 1 >= {eta}
                         and run_end - run_begin >= interval {int(theta)} hour as cluster
                  from {source}) where anchor or not cluster
            union all
            select *, true, case when anchor then copies - 1 else copies end
            from (select *, {last} run_fixes - 1 >= {eta}
                         and run_end - run_begin >= interval {int(theta)} hour as cluster
                  from {source}) where cluster and not (anchor and copies = 1))"""


def _dates(source: str) -> str:
    return f"""
        select collar_id,
               max(t_) filter (not defunct_cluster_ and r = 2) as lastlivefix,
               max(t_) filter (not defunct_cluster_ and r = 1) as firstfixinendclust,
               max(t_) filter (defunct_cluster_) as lastfixinendclust,
               bool_or(defunct_cluster_) as has_cluster
        from (select *, dense_rank() over (
                  partition by collar_id, defunct_cluster_ order by t_ desc) as r
              from {source})
        group by collar_id"""


def _utm() -> tuple[str, str, str]:
    """Constants, then easting and northing of (lam, phi)."""
    constants = """
        select n, 2 * sqrt(n) / (1 + n) as e,
               6378137.0 / (1 + n) * (1 + n*n/4 + n*n*n*n/64) * 0.9996 as r,
               n/2 - 2*n*n/3 + 5*n*n*n/16 + 41*n*n*n*n/180 as a1,
               13*n*n/48 - 3*n*n*n/5 + 557*n*n*n*n/1440 as a2,
               61*n*n*n/240 - 103*n*n*n*n/140 as a3, 49561*n*n*n*n/161280 as a4
        from (select f / (2 - f) as n from (select 1::double / 298.257222101::double as f))"""
    terms = range(1, 5)
    east = " + ".join(["eta", *[f"a{j} * cos({2*j} * xi) * sinh({2*j} * eta)" for j in terms]])
    north = " + ".join(["xi", *[f"a{j} * sin({2*j} * xi) * cosh({2*j} * eta)" for j in terms]])
    return constants, f"500000 + r * ({east})", f"r * ({north})"


_UTM, _EAST, _NORTH = _utm()

_CTES: dict[str, str] = {
    **views.SQL,
    "dep": f"""
        select * replace (coalesce("{_CUT}", (date '{views.AS_OF}' + 1)::timestamp) as "{_CUT}")
        from deployments""",
    "removals": """
        select * replace (
            case when sex <> 'FURNITURE' then starttestingdate end as starttestingdate,
            case sex when 'BUILDING' then starttestingdate + 4 + interval 690 minute
                     when 'MACHINERY' then starttestingdate + 14 + interval 690 minute
            end as "beginremoved_UTC")
        from dep""",
    "begins": """
        select collarid as c, starttestingdate as b,
               lead(starttestingdate) over (partition by collarid order by starttestingdate nulls first) as nxt
        from (select distinct collarid, starttestingdate from removals)""",
    "spans": """
        select d.*, d.starttestingdate::timestamp as span_begin,
               coalesce(d."beginremoved_UTC", nxt::timestamp) as span_end
        from removals d left join begins
            on d.collarid is not distinct from c and d.starttestingdate is not distinct from b""",
    **_runs(ZETA),
    "flagged": _flagged("runs", True, ETA, THETA),
    "each_flagged": "select *, unnest(range(copies::bigint)) as copy_no from flagged",
    "flagged_all": _flagged("runs", False, ETA, THETA),
    "dates": _dates("flagged"),
    "accepted": """
        select collar_id, 'cougar' as cause,
               case when lastfixinendclust < timestamp '2024-01-30 12:00:00'
                    then lastfixinendclust end as removed_at
        from dates where has_cluster""",
    "updated": f"""
        select d.* replace (
            case when a.collar_id is null then d.lastlivefix else t.lastlivefix end as lastlivefix,
            case when a.collar_id is null then d.firstfixinendclust
                 else t.firstfixinendclust end as firstfixinendclust,
            case when a.collar_id is null then d.lastfixinendclust
                 else t.lastfixinendclust end as lastfixinendclust,
            case when a.collar_id is null then d.fate else 1 end as fate,
            case when a.collar_id is null then d.zeta_m else {ZETA}::double end as zeta_m,
            case when a.collar_id is null then d.eta_fixes else {ETA} end as eta_fixes,
            case when a.collar_id is null then d.theta_hr else {THETA}::double end as theta_hr,
            case when a.collar_id is null then d.cause else a.cause end as cause,
            coalesce(a.removed_at, d."beginremoved_UTC") as "beginremoved_UTC")
        from deployments d left join accepted a on d.collarid = a.collar_id
             left join dates t on a.collar_id = t.collar_id""",
    "utm_constants": _UTM,
    "projected": f"""
        select collar_id, acquisitiontime, longitude, latitude,
               {_EAST} as easting, {_NORTH} as northing
        from (select *, atan2(t, cos(lam)) as xi, atanh(sin(lam) / sqrt(t * t + 1)) as eta
              from (select *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) as t
                    from (select *, radians(longitude) - radians(-111) as lam,
                                 radians(latitude) as phi
                          from fixes, utm_constants)))""",
    "base": f"""
        select f.collar_id as CollarID, f.* exclude (collar_id), d.starttestingdate, d."{_CUT}"
        from fixes f left join dep d on f.collar_id is not distinct from d.collarid
        where longitude <= 5000 and acquisitiontime >= timestamp '{views.STUDY_START}'
          and acquisitiontime < timestamp '{views.STUDY_END}'""",
    "phased": f"""
        select CollarID as collar_id, acquisitiontime as t_, longitude, latitude,
               case when acquisitiontime <= "{_CUT}" then 'pre'
                    when acquisitiontime > "{_CUT}" then 'post' end as phase
        from base""",
    "base_by_span": f"""
        select f.collar_id as "CollarID", f.* exclude (collar_id), d.starttestingdate, d."{_CUT}"
        from fixes f left join spans d on f.collar_id is not distinct from d.collarid
             and (span_begin is null or acquisitiontime >= span_begin)
             and (span_end is null or acquisitiontime < span_end)
        where longitude <= 5000 and acquisitiontime >= timestamp '{views.STUDY_START}'
          and acquisitiontime < timestamp '{views.STUDY_END}'""",
    "named": f"""
        select path, regexp_split_to_array(split_part(path, '/', 3), '[^A-Za-z0-9]+') as folder,
               regexp_split_to_array(split_part(path, '/', 4), '[^A-Za-z0-9]+') as name
        from video_paths""",
    "vid": """
        select *, make_timestamp(Year, Month, Day, Hour, Minute, Second::double) as TimeStamp_UTC
        from (select folder[1] as AnimalID, folder[2] as CollarID, name[1]::int as Year,
                     name[2]::int as Month, name[3]::int as Day, name[4][1:2]::int as Hour,
                     name[4][3:4]::int as Minute, name[4][5:]::int as Second,
                     path as directoryname
              from named)""",
    "vid_dep": f"""
        select v.*, {_DEP_COLS}, {_flags()}, TimeStamp_UTC::date as Date
        from vid v left join dep d on v.AnimalID is not distinct from d.animalid
             and v.CollarID is not distinct from d.collarid::varchar""",
    "marked": """
        select collar_id::varchar as cid, acquisitiontime, coalesce(latitude, 7777) as latitude,
               coalesce(longitude, 7777) as longitude, height, temperature,
               acquisitiontime::date as fdate, hour(acquisitiontime) as fhour
        from fixes""",
    "joined_1": """
        select v.*, f.* exclude (cid, fdate, fhour) from vid_dep v left join marked f
        on v.CollarID is not distinct from f.cid and v.Date is not distinct from f.fdate
           and v.Hour is not distinct from f.fhour""",
    "classed_1": """
        select * exclude (latitude, longitude),
               case when longitude is not null then 'Successful'
                    when Hour in (0, 15) then 'Unsuccessful' end as status,
               case when longitude <= 5000 then 'Exact' when longitude > 5000 then 'Missing'
                    when Hour in (0, 15) then 'None' else '' end as coordinates,
               case when latitude <= 5000 then latitude end as latitude,
               case when longitude <= 5000 then longitude end as longitude
        from joined_1""",
    "pass_1": _earliest("classed_1"),
    "rest": """
        select v.*, case when Hour = 19 and Minute > 45 then 21 when Hour = 20 then 21
                         else Hour end as Hour2
        from vid_dep v
        where not exists (select 1 from pass_1 p where p.status is not null
                          and p.AnimalID is not distinct from v.AnimalID
                          and p.TimeStamp_UTC is not distinct from v.TimeStamp_UTC)""",
    "joined_2": """
        select v.*, f.* exclude (cid, fdate, fhour)
        from rest v left join (select * from marked where fhour = 21) f
        on v.CollarID is not distinct from f.cid and v.Date = f.fdate and v.Hour2 = f.fhour""",
    "classed_2": """
        select * exclude (latitude, longitude),
               case when longitude is not null then 'Successful'
                    when Hour2 = 21 then 'Unsuccessful' end as status,
               case when longitude <= 5000 then 'Approximate'
                    when longitude > 5000 then 'ApproxMissing'
                    when Hour2 = 21 then 'None' end as coordinates,
               case when latitude <= 5000 then latitude end as latitude,
               case when longitude <= 5000 then longitude end as longitude
        from joined_2""",
    "pass_2": _earliest("classed_2"),
    "pairs": f"""
        select *, coalesce("CollarID", 'NA') || coalesce(status, 'NA')
                  || coalesce(coordinates, 'NA') as bindingcolumn
        from (select {_PAIR_COLS} from pass_1 where status is not null
              union all select {_PAIR_COLS} from pass_2)""",
    "manifest": f"""
        select "AnimalID", "TimeStamp_UTC", replace(directoryname, '\\', '/') as source,
               '{views.ROOT}/groupedvideos/' || coalesce("CollarID", 'NA') || '/'
               || coalesce(status, 'NA') || '/' || coalesce(coordinates, 'NA') as target
        from pairs""",
}

_CTES["layer_fixes"] = """
    select collar_id, t_, longitude, latitude, phase,
           case phase when 'pre' then 'darkgreen' else 'red' end as color
    from phased
    where phase is not null and (longitude is not null or latitude is not null)"""


def _wkt(kind: str, x: str, y: str) -> str:
    return f"'{kind} (' || {x}::varchar || ' ' || {y}::varchar || ')'"


def _line(x: str, y: str, order: str) -> str:
    text = f"string_agg({x}::varchar || ' ' || {y}::varchar, ', ' order by {order})"
    return f"case when count(*) > 1 then 'LINESTRING (' || {text} || ')' end"


def _fix_layers(source: str) -> str:
    return f"""
        select phase || 'mort_points' as layer, 'point' as kind, collar_id, t_,
               0::bigint as part, {_wkt('POINT', 'longitude', 'latitude')} as geometry_wkt,
               color, 'NAD83 longlat' as crs
        from {source}
        union all
        select phase || 'mort_path', 'line', collar_id, min(t_), 0,
               {_line('longitude', 'latitude', 't_, longitude, latitude')}, any_value(color),
               'NAD83 longlat'
        from {source} where longitude is not null and latitude is not null
          and collar_id is not null
        group by collar_id, phase"""


def _video_points(test: str) -> str:
    return f"""
        union all
        select case coordinates when 'Exact' then 'videos_exact' else 'videos_approximate' end,
               'point', collar_id, acquisitiontime, 0,
               {_wkt('POINT', 'longitude', 'latitude')},
               case coordinates when 'Exact' then 'purple' else 'orange' end, 'NAD83 longlat'
        from shown_videos where {test}"""


_IN_WINDOW = f"between timestamp '{BEGIN}' and timestamp '{END}'"
_TRACKED = "longitude is not null and latitude is not null"

_CTES["layer_rows"] = _fix_layers("layer_fixes")
_CTES["layer_window"] = f"select * from layer_fixes where t_ {_IN_WINDOW}"
_CTES["layer_window_pre"] = "select * from layer_window where phase = 'pre'"
_CTES["shown_videos"] = f"""
    select *, try_cast("CollarID" as bigint) as collar_id from pairs
    where status = 'Successful' and coordinates in ('Exact', 'Approximate')
      and (longitude is not null or latitude is not null)
      and acquisitiontime >= timestamp '{views.STUDY_START}'"""
_CTES["far"] = "select collar_id, acquisitiontime as t_, easting as x_, northing as y_ from projected"
_CTES["path_order"] = f"""
    select collar_id, acquisitiontime as t_, longitude as x_, latitude as y_,
           row_number() over (partition by collar_id
                              order by acquisitiontime, longitude, latitude) - 1 as i,
           count(*) over (partition by collar_id) as n
    from fixes where {_TRACKED} and acquisitiontime is not null and collar_id is not null"""

_LISTING = f"""
    select distinct path[{len(views.ROOT) + 1}:] as path, strlen(split_part(path, '/', 4)) as length
    from video_paths"""

_SELECTS: dict[str, str] = {
    "base_fixes_by_span": "select * from base_by_span",
    "life_phase_by_span": f"""
        select v.AnimalID as "AnimalID", v.CollarID as "CollarID", TimeStamp_UTC as "TimeStamp_UTC",
               directoryname, d.sex, d.starttestingdate, {_flags()}
        from vid v left join spans d on v.AnimalID is not distinct from d.animalid
             and v.CollarID is not distinct from d.collarid::varchar
             and (span_begin is null or TimeStamp_UTC >= span_begin)
             and (span_end is null or TimeStamp_UTC < span_end)
             and TimeStamp_UTC >= timestamp '{views.STUDY_START}'
             and TimeStamp_UTC < timestamp '{views.STUDY_END}'""",
    "select_collars": "select * from fixes where collar_id in (select collarid from deployments)",
    "fixes_window": f"""
        select * from fixes
        where acquisitiontime >= timestamp '2024-01-02 00:00:01'
          and acquisitiontime >= timestamp '{views.STUDY_START}'
          and acquisitiontime < timestamp '{views.STUDY_END}'
          and acquisitiontime {_IN_WINDOW}
          and (longitude is not null or latitude is not null)""",
    "has_coordinate": "select * from fixes where longitude is not null or latitude is not null",
    "valid_longitude": "select * from fixes where longitude <= 5000",
    "before_removal": f"""
        select * from fixes f
        where not exists (select 1 from deployments d where f.collar_id = d.collarid
                          and f.acquisitiontime >= d."{_CUT}")
          and acquisitiontime < timestamp '2025-01-01 00:00:01'
          and (longitude is not null or latitude is not null)""",
    "known_animals": """
        select animalid, collarid, sex from deployments
        where sex <> 'BUILDING' and animalid is not null""",
    "time_functions": """
        select collar_id, acquisitiontime, date_trunc('second', acquisitiontime) as from_iso,
               null::timestamp as from_wrong_layout,
               date_trunc('second', acquisitiontime) as from_plain,
               acquisitiontime::date as day, hour(acquisitiontime)::int as hour,
               date_trunc('minute', acquisitiontime) + interval 30 second as built,
               null::timestamp as impossible,
               acquisitiontime + to_seconds((temperature * 900)::bigint) as later,
               acquisitiontime::date as day_from_text
        from fixes""",
    "text_functions": """
        select event_id, user_id::varchar as id_text,
               regexp_extract(props, '([0-9]+)', 1)::int as number_in_text, null::int as no_number,
               user_id::varchar || '/'
               || case when event_type = 'error' then 'NA' else event_type end as pasted,
               case when event_type = 'error' then null when value > 20 then 'Yes' else 'No'
               end as over_20,
               event_type in ('view', 'click') as is_view_or_click,
               event_type in ('view', 'error') as is_view_or_missing,
               replace(props, ': ', '/') as replaced, contains(props, '9') as has_9
        from events""",
    "approx_hour": """
        select AnimalID as "AnimalID", TimeStamp_UTC as "TimeStamp_UTC",
               case when Hour = 20 or (Hour = 19 and Minute > 45) then 21 else Hour end as "Hour2"
        from vid""",
    "make_track": f"""
        select collar_id, acquisitiontime as t_, longitude as x_, latitude as y_
        from fixes where {_TRACKED} and acquisitiontime is not null""",
    "step_lengths": """
        select collar_id, t_, x_, y_, copies, round(step, 6) as step from stepped""",
    "nonmovement_runs": "select * replace (round(step, 6) as step, run::bigint as run, run_fixes::bigint as run_fixes) from runs",
    "run_stats": """
        select collar_id, run::bigint as run, (sum(copies) - 1)::bigint as steps,
               min(t_) as run_begin, max(t_) as run_end
        from numbered group by collar_id, run""",
    "defunct_flags_terminal": "select * from flagged",
    "defunct_flags_all": "select * from flagged_all",
    "mortality_dates": "select * from dates",
    "latest_per_flag": """
        select collar_id, defunct_cluster_, t_, x_, y_, copies from flagged
        qualify row_number() over (partition by collar_id, defunct_cluster_
                                   order by t_ desc, x_, y_, copies) = 1""",
    "second_latest": """
        select collar_id, defunct_cluster_, t_, x_, y_, copies
        from (select *, dense_rank() over (partition by collar_id, defunct_cluster_
                                           order by t_ desc) as r from flagged)
        where r = 2
        qualify row_number() over (partition by collar_id, defunct_cluster_
                                   order by x_, y_, copies) = 1""",
    "last_live_point": """
        select xy.* from xy where exists (
            select 1 from dates d where d.collar_id = xy.collar_id and d.lastlivefix = xy.t_)""",
    "apply_mortality": "select * from updated",
    "deployments_out": "select * from updated",
    "merged_copies": """
        select collar_id, acquisitiontime::date as day, longitude, count(*) as copies
        from fixes group by all""",
    "expanded_copies": "select collar_id, acquisitiontime::date as day, longitude from fixes",
    "utm_projection": """
        select collar_id, acquisitiontime, round(easting, 3) as easting,
               round(northing, 3) as northing
        from projected""",
    "fix_points": f"""
        select collar_id, acquisitiontime,
               {_wkt('POINT', 'longitude', 'latitude')} as geometry_wkt, 'NAD83 longlat' as crs
        from fixes""",
    "movement_paths": f"""
        select collar_id, 0::bigint as part, min(t_) as t_begin, max(t_) as t_end,
               count(*) as vertices, {_line('x_', 'y_', 'i')} as geometry_wkt
        from path_order group by collar_id""",
    "movement_path_parts": f"""
        select collar_id, part, min(t_) as t_begin, max(t_) as t_end, count(*) as vertices,
               {_line('x_', 'y_', 'i')} as geometry_wkt
        from (select *, i // 4 as part from path_order
              union all
              select *, i // 4 - 1 from path_order where i % 4 = 0 and i > 0)
        group by collar_id, part having part = 0 or count(*) > 1""",
    "base_fixes": 'select CollarID as "CollarID", * exclude (CollarID) from base',
    "base_fixes_ordered": """
        select CollarID as "CollarID", acquisitiontime, longitude from base
        order by 1 nulls last, 2 nulls last""",
    "fixes_by_phase": """
        select collar_id as "CollarID", t_ as acquisitiontime, phase from phased""",
    "fill_cutoff": f'select animalid, collarid, "{_CUT}" from dep',
    "parse_video_paths": """
        select AnimalID as "AnimalID", CollarID as "CollarID", TimeStamp_UTC as "TimeStamp_UTC",
               Year as "Year", Month as "Month", Day as "Day", Hour as "Hour",
               Minute as "Minute", Second as "Second", directoryname
        from vid""",
    "life_phase": """
        select AnimalID as "AnimalID", TimeStamp_UTC as "TimeStamp_UTC", directoryname,
               livevideoprerelease, livevideopostrelease, mortvideo
        from vid_dep""",
    "earliest_fixes": """
        select collar_id, acquisitiontime, longitude, latitude from fixes
        qualify rank() over (partition by collar_id, acquisitiontime::date, hour(acquisitiontime)
                             order by acquisitiontime) = 1""",
    "earliest_keep_ties": """
        select collar_id, day, located_at, height
        from (select *, min(located_at) over w as lo, bool_or(located_at is null) over w as unknown
              from (select collar_id, acquisitiontime::date as day, height,
                           case when longitude is not null then acquisitiontime end as located_at
                    from fixes)
              window w as (partition by collar_id, day))
        where located_at is null or (not unknown and located_at = lo)""",
    "pair_exact": f"select {_PAIR_COLS} from pass_1",
    "pair_approx": f"select {_PAIR_COLS} from pass_2",
    "pair_videos": "select * from pairs",
    "pair_videos_staged": "select * from pairs",
    "append_full_join": """
        select coalesce(a."AnimalID", b."AnimalID") as "AnimalID",
               coalesce(a."CollarID", b."CollarID") as "CollarID",
               coalesce(a."TimeStamp_UTC", b."TimeStamp_UTC") as "TimeStamp_UTC",
               coalesce(a.directoryname, b.directoryname) as directoryname
        from (select distinct AnimalID as "AnimalID", CollarID as "CollarID",
                     TimeStamp_UTC as "TimeStamp_UTC", directoryname
              from vid_dep where mortvideo = 'No') a
        full join (select distinct AnimalID as "AnimalID", CollarID as "CollarID",
                          TimeStamp_UTC as "TimeStamp_UTC", directoryname
                   from vid_dep where livevideoprerelease = 'No') b
        using ("AnimalID", "CollarID", "TimeStamp_UTC", directoryname)""",
    "video_groups": """
        select distinct "CollarID", status, coordinates,
               'groupedvideos/' || coalesce("CollarID", 'NA') || '/' || coalesce(status, 'NA')
               || '/' || coalesce(coordinates, 'NA') as folder
        from pairs""",
    "copy_manifest": "select * from manifest",
    "copy_manifest_by_key": "select * from manifest",
    "videos_per_class": """
        select status, coordinates, count(*) as videos from pairs group by all""",
    "mappable_videos": f"""
        select "CollarID", acquisitiontime, status, coordinates, directoryname from pairs
        where acquisitiontime >= timestamp '{views.STUDY_START}'
        order by 1 nulls last, 2 nulls last""",
    "fix_layers": "select * from layer_rows",
    "layers_out": "select * from layer_rows",
    "fix_layers_window": _fix_layers("layer_window_pre"),
    "fix_video_layers": _fix_layers("layer_window")
    + _video_points(f"acquisitiontime {_IN_WINDOW}"),
    "organised_layers": _fix_layers("layer_fixes") + _video_points("true"),
    "mortality_layers": f"""
        select case when defunct_cluster_ then 'defunct_points' else 'live_points' end as layer,
               'point' as kind, collar_id, t_, 0::bigint as part,
               {_wkt('POINT', 'x_', 'y_')} as geometry_wkt,
               case when defunct_cluster_ then 'red' else 'darkgreen' end as color,
               'NAD83 UTM 12N' as crs
        from each_flagged
        union all
        select 'last_live_point', 'point', collar_id, t_, 0, {_wkt('POINT', 'x_', 'y_')},
               'purple', 'NAD83 UTM 12N'
        from xy where exists (
            select 1 from dates d where d.collar_id = xy.collar_id and d.lastlivefix = xy.t_)
        union all
        select case when defunct_cluster_ then 'post_mortem_path' else 'live_path' end, 'line',
               collar_id, min(t_), 0, {_line('x_', 'y_', 't_, x_, y_')},
               case when defunct_cluster_ then 'red' else 'darkgreen' end, 'NAD83 UTM 12N'
        from each_flagged group by collar_id, defunct_cluster_""",
    "read_fixes_text": """
        select * replace (date_trunc('second', acquisitiontime) as acquisitiontime) from fixes
        where acquisitiontime is not null""",
    "read_repeated_landing": f"""
        select collar_id, acquisitiontime, latitude, longitude, height, temperature,
               count(*) + count(*) filter (where acquisitiontime >= timestamp '{BEGIN}') as copies
        from fixes group by all""",
    "read_landed_fixes": f"""
        select collar_id, acquisitiontime, latitude, longitude, height, temperature,
               count(*) + count(*) filter (where acquisitiontime >= timestamp '{BEGIN}') as copies
        from fixes
        where acquisitiontime >= timestamp '2024-01-02 00:00:00'
          and acquisitiontime < timestamp '{END}'
        group by all""",
    "video_metadata_csv": "select * exclude (bindingcolumn) from pairs",
    "scan_videos": _LISTING,
    "scan_mounted_videos": _LISTING,
    "copy_videos": f"""
        select distinct source[{len(views.ROOT) + 1}:] as source,
               target[{len(views.ROOT) + 1}:] as target, 'copied' as outcome,
               strlen(split_part(source, '/', -1)) as length,
               sha256(split_part(source, '/', -1)) as sha256
        from manifest""",
    "check_copies": f"""
        select distinct target[{len(views.ROOT) + 1}:] || '/' || split_part(source, '/', -1) as path,
               strlen(split_part(source, '/', -1)) as length_found,
               sha256(split_part(source, '/', -1)) as sha256_found, true as intact
        from manifest""",
}


def _needed(text: str, have: set[str]) -> set[str]:
    for name in _CTES:
        if name not in have and re.search(rf"\b{name}\b", text):
            have.add(name)
            _needed(_CTES[name], have)
    return have


def _with(select: str, **extra: str) -> str:
    ctes = {**{n: t for n, t in _CTES.items() if n not in extra}, **extra}
    names = _needed(select + " ".join(extra.values()), set(extra))
    parts = [f'"{n}" as ({ctes[n]})' for n in ctes if n in names]
    return f"with {', '.join(parts)} {select}" if parts else select


def build() -> dict[str, str]:
    sql = {name: _with(select) for name, select in _SELECTS.items()}
    # the whole job leaves out deployments of unknown animals
    known = _CTES["dep"] + " where animalid is not null"
    sql["organised_layers"] = sql["organised_layers"].replace(_CTES["dep"], known)
    # the same chain on projected fixes instead of the plain plane
    chain = {
        name: text.replace(f"step > {ZETA}", "step > 30000.0") for name, text in _runs(ZETA).items()
    }
    kept = f"""select collar_id, t_, x_, y_ from far
        where x_ is not null and y_ is not null and collar_id is not null
          and t_ >= timestamp '{views.STUDY_START}' and t_ < timestamp '{views.STUDY_END}'"""
    sql["mortality_from_fixes"] = sql["mortality_review"] = _with(
        "select * from far_dates",
        xy=kept,
        **chain,
        far_flagged=_flagged("runs", True, 2, 6.0),
        far_dates=_dates("far_flagged"),
    )
    return sql
