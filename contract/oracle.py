"""The registered queries as DuckDB SQL, for comparison.

The SQL is written for clarity on one machine and shares no formulation with
the Spark operators where there is a choice: sessions are found by plain
window functions over whole segments, summaries straight from messages.
"""

from __future__ import annotations

from seawake.config import WHITELISTED_RFMOS
from seawake.functions.cells import hilbert_steps

# name -> (names it reads, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLES: dict[str, str] = {}

WHITELIST = "(" + ", ".join(f"'{code}'" for code in WHITELISTED_RFMOS) + ")"
# The region layers of the published layout.
REGION_LAYERS = (
    "eez", "mpa", "mpa_no_take", "mpa_no_take_partial", "high_seas", "rfmo", "fao",
    "major_fao", "eez12nm", "hsp", "protectedseas", "duke_paa", "fra_gfcm_fao",
)


def cte(name: str, sql: str, *reads: str) -> str:
    TABLES[name] = (reads, sql)
    return name


def statement(final: str, *reads: str) -> str:
    """The final SELECT behind all the CTEs it needs, directly or not."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in TABLES[name][0]:
            visit(needed)
        order.append(name)

    for name in reads:
        visit(name)
    if not order:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({TABLES[n][1]})" for n in order) + "\n" + final


def check(name: str, final: str, *reads: str) -> None:
    ORACLES[name] = statement(final, *reads)


def sphere_distance(lon_a: str, lat_a: str, lon_b: str, lat_b: str) -> str:
    return (
        f"2*6371010.0*asin(sqrt(least(1.0, power(sin(radians({lat_b}-{lat_a})/2),2)"
        f" + cos(radians({lat_a}))*cos(radians({lat_b}))*power(sin(radians({lon_b}-{lon_a})/2),2))))"
    )


def hash_id(kind: str, vessel: str, start: str, end: str) -> str:
    def stamp(ts: str) -> str:
        return f"strftime({ts}, '%Y-%m-%d %H:%M:%S') || '+00'"

    return f"md5('{kind}|' || {vessel} || '|' || {stamp(start)} || '|' || {stamp(end)})"


def grid(lon: str, lat: str) -> str:
    def part(x: str) -> str:
        index = f"floor(cast({x} as decimal(18,9)) * 100)"
        return f"(case when {index} < 0 then '-' else '+' end || lpad(printf('%.2f', abs({index}/100.0)), 6, '0'))"

    return f"'lon:' || {part(lon)} || '_lat:' || {part(lat)}"


# --- sample inputs ------------------------------------------------------------------

cte("u", "select user_id as u, count(*) as n from events group by 1")
cte(
    "tracks",
    """
    select user_id,
      timestamp '2024-01-01' + to_microseconds(cast(s * 1000000 as bigint)) as t,
      (user_id*37)%120-60 + (s/3600.0)*0.008 + value/100000 as lat,
      case when (user_id*73)%360-180 + (s/3600.0)*0.01 >= 180 then (user_id*73)%360-540 + (s/3600.0)*0.01
           else (user_id*73)%360-180 + (s/3600.0)*0.01 end as lon,
      value - floor(value/12)*12 as speed_knots,
      cast(case when event_type='error' and value>200 then null when event_type='signup' then 0 else 1 end as double) as nnet_score,
      cast(case when event_type in ('view','error') then 1 else 0 end as double) as night_loitering
    from (select *, floor((epoch_us(ts)-epoch_us(timestamp '2024-01-01'))/10000000.0) as s from events)
    qualify row_number() over (partition by user_id, s order by event_id) = 1
    """,
)
cte(
    "messages",
    f"""
    select 'v'||user_id as ssvid, 's'||user_id as seg_id, t as timestamp, lat, lon, speed_knots,
      nnet_score, night_loitering,
      {sphere_distance('lag(lon) over w', 'lag(lat) over w', 'lon', 'lat')} as meters_to_prev,
      (epoch(t) - epoch(lag(t) over w))/3600.0 as hours
    from tracks window w as (partition by user_id order by t)
    """,
    "tracks",
)
cte("segments", "select 's'||u as seg_id, u%11<>4 as good_seg, n as positions, u%13=5 as overlapping_and_short from u", "u")
cte(
    "segment_vessel",
    """
    select 's'||u as seg_id, 'vid'||u as vessel_id, date '2024-01-03' as last_date from u
    union all select 's'||u, 'old'||u, date '2023-12-01' from u where u%4=0
    union all select 's'||u, 'zid'||u, date '2024-01-03' from u where u%6=0
    """,
    "u",
)
cte(
    "vessels",
    """
    select 'vid'||u as vessel_id, 2024 as year, 'v'||u as ssvid,
      case when u%7=3 then 'carrier' else 'fishing' end as prod_shiptype,
      case when u%5=0 then 'squid_jigger' else 'trawlers' end as prod_geartype,
      case when u%3=0 then 'trawlers' when u%3=1 then 'cargo' end as registry_geartype,
      u%2=0 as on_fishing_list_nn, u%9=0 as shipname_indicates_likely_gear, 'SHIP '||u as ais_shipname,
      case u%3 when 0 then 'ESP' when 1 then 'CHN' else 'USA' end as ais_mmsi_flag
    from u
    """,
    "u",
)
cte(
    "fishers",
    """
    select * from vessels
    where prod_shiptype = 'fishing'
       or (not shipname_indicates_likely_gear and (on_fishing_list_nn or coalesce(registry_geartype = 'trawlers', false)))
    """,
    "vessels",
)
cte(
    "identity_core",
    """
    select 'rec'||u as vessel_record_id, 'v'||u as ssvid, 'SHIP'||u as n_shipname,
      case when u%2=0 then null else 'CS'||u end as n_callsign, cast(null as varchar) as imo,
      case u%3 when 0 then 'ESP' when 1 then 'CHN' else 'USA' end as flag,
      timestamp '2020-01-01' as first_timestamp,
      case when u%4=1 then timestamp '2024-01-02 12:00:00' else timestamp '2025-01-01' end as last_timestamp
    from u
    """,
    "u",
)
cte(
    "grants",
    """
    select vessel_record_id, ssvid, n_shipname, n_callsign, imo, flag, timestamp '2023-01-01' as authorized_from,
      case when k%2=0 then timestamp '2024-01-02 06:00:00' else timestamp '2024-06-01' end as authorized_to, source_code
    from identity_core, (values (0,'ICCAT'),(1,'IOTC'),(2,'WCPFC'),(3,'IATTC'),(4,'CCSBT'),(5,'SPRFMO'),(6,'NAFO')) r(k, source_code)
    where (cast(substr(ssvid,2) as bigint)+k)%3=0
    """,
    "identity_core",
)
cte(
    "boxes",
    """
    select case n_nationkey%5 when 0 then 'rfmo' when 1 then 'eez' when 2 then 'mpa' when 3 then 'high_seas' else 'major_fao' end as layer,
      case when n_nationkey%5=0 then ['ICCAT','IOTC','WCPFC','NPFC','NAFO'][n_nationkey//5+1] else 'R'||n_nationkey end as id,
      -62 + (n_nationkey%5)*20 as lat0, -62 + (n_nationkey%5)*20 + 55 as lat1,
      -180 + (n_nationkey//5)*70 as lon0, -180 + (n_nationkey//5)*70 + 80 as lon1
    from nation
    """,
)
cte(
    "anchorages",
    """
    select 'a'||s_suppkey as s2id, (s_suppkey*37)%120-60+0.255::double as lat, (s_suppkey*73)%360-180+0.255::double as lon,
      'N'||s_nationkey as iso3, s_name as label, case when s_suppkey%4=0 then 'top_destination' else 'manual' end as label_source,
      upper(s_name) as top_destination, s_suppkey*100.0::double as distance_from_shore_m, s_suppkey%2=0 as at_dock
    from supplier
    """,
)
cte(
    "visits",
    """
    select 'pv'||o_orderkey as visit_id, 'vid'||(o_custkey % (select count(*) from u)) as vessel_id,
      timestamp '2024-01-01' + to_hours(cast(o_orderkey%60 as int)) as start_timestamp,
      timestamp '2024-01-01' + to_hours(cast(o_orderkey%60 + o_orderkey%30 + 1 as int)) as end_timestamp,
      (o_orderkey%30+1)*1.0::double as duration_hrs, o_orderkey%4+1 as confidence,
      'a'||(o_orderkey % (select count(*) from supplier)) as start_anchorage_id,
      'a'||((o_orderkey*3+1) % (select count(*) from supplier)) as end_anchorage_id, o_orderkey
    from orders
    """,
    "u",
)
cte(
    "visit_events",
    """
    select 'pv'||l_orderkey as visit_id,
      case when seq%9=8 then 'PORT_OTHER' when seq%4=0 then 'PORT_STOP_BEGIN' when seq%4=1 then 'PORT_STOP_END'
           when seq%4=2 then 'PORT_GAP_BEGIN' else 'PORT_GAP_END' end as event_type,
      timestamp '2024-01-01' + to_hours(cast(l_orderkey%60 as int)) + to_minutes(cast(seq as int)) as at_time,
      'a'||l_suppkey as anchorage_id, 's'||(l_partkey%15) as seg_id
    from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)
            + l_orderkey%5 as seq from lineitem)
    """,
)
# a visit needs both of its anchorages to have positions
cte(
    "raw_visits",
    """
    select v.*, s.lat as start_lat, s.lon as start_lon, e.lat as end_lat, e.lon as end_lon
    from visits v join anchorages s on s.s2id = v.start_anchorage_id join anchorages e on e.s2id = v.end_anchorage_id
    """,
    "visits",
    "anchorages",
)
cte(
    "voyages",
    """
    select vessel_id, lag(end_timestamp) over (partition by vessel_id order by start_timestamp, visit_id) as trip_start,
      start_timestamp as trip_end, visit_id as trip_end_visit_id
    from visits where o_orderkey%29=3
    """,
    "visits",
)
cte(
    "loitering",
    """
    select seg_id, ssvid, min(timestamp) as t0, max(timestamp) as t1,
      arg_min(lat,timestamp) as start_lat, arg_min(lon,timestamp) as start_lon,
      arg_max(lat,timestamp) as end_lat, arg_max(lon,timestamp) as end_lon,
      (epoch(max(timestamp))-epoch(min(timestamp)))/3600.0 as loitering_hours,
      sum(meters_to_prev)/1852 as tot_distance_nm, avg(speed_knots) as avg_speed_knots,
      cast((count(*)*7)%40 as double) as avg_distance_from_shore_nm
    from messages group by seg_id, ssvid, floor(epoch(timestamp)/21600) having count(*)>1
    """,
    "messages",
)
cte(
    "encounters",
    """
    select 'e'||a.u||'d'||d as encounter_id, 'vid'||a.u as vessel_1_id, 'vid'||(a.u+1) as vessel_2_id,
      timestamp '2024-01-01' + to_hours(cast(d*24+a.u%12 as int)) as start_time,
      timestamp '2024-01-01' + to_hours(cast(d*24+a.u%12+a.u%5+1 as int)) as end_time,
      (a.u%30)/10.0::double as median_speed_knots, (a.u%7)/10.0::double as median_distance_km,
      (a.u*37)%120-60+0.25::double+d*0.1::double as lat, (a.u*73)%360-180+0.25::double+d*0.1::double as lon,
      's'||a.u as segs_1, 's'||(a.u+1) as segs_2, a.u%50 as points_1, a.u%40 as points_2
    from u a join u b on b.u=a.u+1, range(3) t(d)
    """,
    "u",
)


def measures(name: str, corners: str, *reads: str) -> None:
    """Measured cells among the given x, y."""
    cte(
        name,
        f"""
        select distinct lon_code, cast(abs((x*31+y*17)%1000) as double)*100.0/1000 as shore_km,
          cast(abs((x*13+y*29)%1000) as double)*100.0/1000 as port_km
        from (select {grid('lon', 'lat')} as lon_code,
                cast(floor(cast(lon as decimal(18,9))*100) as bigint) as x,
                cast(floor(cast(lat as decimal(18,9))*100) as bigint) as y
              from ({corners}))
        where (cast(floor(x/100.0) as bigint)*7 + cast(floor(y/100.0) as bigint)*3 + x + y) % 10 <> 0
        """,
        *reads,
    )


# --- sessions -----------------------------------------------------------------------


def sessions(field: str = "nnet_score", first: str = "2023-12-31", last: str = "2024-01-04") -> str:
    """CTE chain of one load; returns the name of the tagged messages."""
    tag = f"{field[:2]}_{first[5:].replace('-', '')}_{last[5:].replace('-', '')}"
    cte(
        f"steps_{tag}",
        f"""
        select *, extract(year from timestamp) as year,
          sum(fresh) over (partition by seg_id order by timestamp) as run
        from (select *, {field} as score,
                case when lag({field}) over w is null or {field} <> lag({field}) over w
                       or meters_to_prev > 10000 or hours > 2 then 1 else 0 end as fresh
              from messages
              where timestamp >= timestamp '{first}' and timestamp < timestamp '{last}' and abs(lat) < 90
              window w as (partition by seg_id order by timestamp))
        """,
        "messages",
    )
    cte(
        f"runs_{tag}",
        f"""
        select seg_id, run, min(timestamp) as t0, max(timestamp) as t1, arg_min(lat, timestamp) as lat0,
          arg_min(lon, timestamp) as lon0, first(score order by timestamp) as score
        from steps_{tag} group by seg_id, run
        """,
        f"steps_{tag}",
    )
    cte(
        f"chains_{tag}",
        f"""
        select seg_id, run, min(t0) over (partition by seg_id, chain) as event_start
        from (select *, sum(apart) over (partition by seg_id order by t0) as chain
              from (select *, case when date_diff('second', lag(t1) over w, t0) > 3600
                             or {sphere_distance('lag(lon0) over w', 'lag(lat0) over w', 'lon0', 'lat0')} > 2000
                             then 1 else 0 end as apart
                    from runs_{tag} where score = 1.0 window w as (partition by seg_id order by t0)))
        """,
        f"runs_{tag}",
    )
    return cte(
        f"events_{tag}",
        f"""
        select m.*, c.event_start, max(m.timestamp) over (partition by m.seg_id, c.event_start) as event_end,
          cast(max(m.timestamp) over (partition by m.seg_id, c.event_start) as date) as event_end_date
        from steps_{tag} m join chains_{tag} c using (seg_id, run) where m.score = 1.0
        """,
        f"steps_{tag}",
        f"chains_{tag}",
    )


NNET, NIGHT = sessions("nnet_score"), sessions("night_loitering")
NNET_TAG = NNET.removeprefix("events_")
RELOADED = sessions("nnet_score", "2024-01-02", "2024-01-04")
STATE_OUT = "seg_id, timestamp, event_start, event_end, event_end_date"

check(
    "fishing_events_minimal",
    f"""
    select seg_id, event_start, event_end, message_count, round(speed, 9) as avg_speed_knots,
      round(dist, 3) as event_distance_m
    from (select seg_id, event_start, max(timestamp) as event_end, count(*) as message_count, avg(speed_knots) as speed,
            sum(meters_to_prev) filter (timestamp <> event_start) as dist
          from {NNET} group by seg_id, event_start)
    where epoch(event_end) - epoch(event_start) > 1200 and message_count > 5 and speed < 10 and dist > 500
    """,
    NNET,
)
check(
    "scan_padded",
    """
    select seg_id, timestamp, cast(extract(year from timestamp) as bigint) as year, lat, lon, speed_knots, night_loitering as score
    from messages where timestamp >= timestamp '2024-01-01' and timestamp < timestamp '2024-01-03' and abs(lat) < 90
    """,
    "messages",
)
check("sessionize_messages", f"select {STATE_OUT} from {NNET}", NNET)
check("sessionize_night", f"select {STATE_OUT} from {NIGHT}", NIGHT)
check(
    "event_boundaries",
    f"""
    select seg_id, t0 as event_start, case when lead(t0) over (partition by seg_id order by t0) is not null then t1 end as event_end,
      cast(score as double) as score, lat0 as lat, lon0 as lon
    from runs_{NNET_TAG}
    """,
    f"runs_{NNET_TAG}",
)
check(
    "fuse_runs",
    f"select seg_id, event_start, max(timestamp) as event_end, count(*) as messages from {NNET} group by 1, 2",
    NNET,
)
check(
    "messages_in_ranges",
    f"""
    select m.seg_id, m.timestamp, e.event_start
    from messages m join (select distinct seg_id, event_start, event_end from {NNET}) e
      on m.seg_id = e.seg_id and m.timestamp between e.event_start and e.event_end
    """,
    NNET,
)

# --- incremental state -----------------------------------------------------------------

cte(
    "cut",
    f"""
    select * exclude (event_end, event_end_date),
      max(timestamp) over (partition by seg_id, event_start) as event_end,
      cast(max(timestamp) over (partition by seg_id, event_start) as date) as event_end_date
    from {NNET} where timestamp < timestamp '2024-01-03'
    """,
    NNET,
)
check("truncate_state", f"select {STATE_OUT} from cut", "cut")
cte(
    "opened",
    """
    select seg_id, max(event_start) as event_start, max(event_end) as event_end
    from cut where timestamp = event_end and event_end >= timestamp '2024-01-02 22:00:00'
    group by seg_id
    """,
    "cut",
)
check("open_events", "select * from opened", "opened")
cte(
    "fresh",
    f"select * from {RELOADED} where event_end >= timestamp '2024-01-02 22:00:00'",
    RELOADED,
)
cte(
    "meeting",
    """
    with latest as (
      select seg_id, max(event_start) as event_start, max(event_end) as event_end, max(event_end_date) as event_end_date
      from fresh where timestamp >= timestamp '2024-01-02 22:00:00' and timestamp < timestamp '2024-01-03' group by seg_id)
    select seg_id, o.event_start as merged_start, l.event_end as merged_end, l.event_end_date as merged_end_date,
      o.event_end as meeting_point
    from opened o join latest l using (seg_id)
    where least(o.event_end, l.event_end) >= greatest(o.event_start, l.event_start)
    """,
    "opened",
    "fresh",
)
check("merge_overlap", "select * from meeting", "meeting")
cte(
    "staged",
    """
    select c.seg_id, c.timestamp, merged_start as event_start, merged_end as event_end, merged_end_date as event_end_date
    from cut c join meeting on c.seg_id = meeting.seg_id and c.event_start = merged_start
    union all
    select f.seg_id, f.timestamp,
      case when f.timestamp <= merged_end then merged_start else event_start end,
      case when f.timestamp <= merged_end then merged_end else event_end end,
      case when f.timestamp <= merged_end then merged_end_date else event_end_date end
    from fresh f left join meeting on f.seg_id = meeting.seg_id
    where meeting_point is null or f.timestamp > meeting_point
    """,
    "cut",
    "fresh",
    "meeting",
)
check("merge_open_events", f"select {STATE_OUT} from staged", "staged")
# a reload ends in the state of one load
check("upsert_state", f"select {STATE_OUT} from {NNET}", NNET)
check(
    "three_mode_parity",
    f"""
    select event_end_date, mode, count(*) as messages, count(*) filter (timestamp = event_start) as events,
      cast(sum(epoch(event_end) - epoch(event_start)) as bigint) as seconds
    from {NNET}, (values ('once'), ('daily'), ('again')) modes(mode) group by 1, 2
    """,
    NNET,
)
check(
    "continuous_load",
    f"""
    select event_end_date, 'stream' as mode, count(*) as messages, count(*) filter (timestamp = event_start) as events,
      cast(sum(epoch(event_end) - epoch(event_start)) as bigint) as seconds
    from {NNET} group by 1
    """,
    NNET,
)

# --- identity and summaries --------------------------------------------------------------

cte("good", "select seg_id, positions from segments where good_seg and not overlapping_and_short", "segments")
check(
    "good_segments_semi",
    f"""
    select seg_id, event_start, max(timestamp) as event_end, count(*) as message_count from {NNET}
    where exists (select 1 from good where good.seg_id = {NNET}.seg_id and positions > 10) group by 1, 2
    """,
    NNET,
    "good",
)
check(
    "good_segments_inner",
    "select seg_id, t0 as loitering_start_timestamp, avg_distance_from_shore_nm from loitering join good using (seg_id)",
    "loitering",
    "good",
)
cte(
    "best",
    "select distinct on (seg_id) seg_id, vessel_id from segment_vessel order by seg_id, last_date desc, vessel_id",
    "segment_vessel",
)
check("best_segment_vessel", "select * from best", "best")
check(
    "fishing_vessels",
    "select vessel_id, cast(year as bigint) as year, ssvid, prod_shiptype, prod_geartype, registry_geartype from fishers",
    "fishers",
)


def owned(events: str) -> str:
    return cte(
        f"owned_{events}",
        f"""
        select m.*, b.vessel_id as segment_vessel, f.vessel_id, f.ais_shipname as main_vessel_shipname,
          f.ais_mmsi_flag as main_vessel_flag, f.prod_geartype as best_best_vessel_class
        from {events} m join good g on g.seg_id = m.seg_id and g.positions > 10 join best b on b.seg_id = m.seg_id
          left join fishers f on f.vessel_id = b.vessel_id and f.year = m.year
        """,
        events,
        "good",
        "best",
        "fishers",
    )


def summed(events: str) -> str:
    """All events that pass the thresholds of every class."""
    later = "filter (timestamp <> event_start)"
    return cte(
        f"summed_{events}",
        f"""
        select * from (
          select ssvid, seg_id, vessel_id, main_vessel_shipname, main_vessel_flag, best_best_vessel_class, event_start,
            max(timestamp) as event_end, count(*) as message_count, min(lat) as lat_min, max(lat) as lat_max,
            min(lon) as w, max(lon) as e,
            min(case when lon < 0 then lon + 180 else lon - 180 end) as aw,
            max(case when lon < 0 then lon + 180 else lon - 180 end) as ae,
            avg(speed_knots) as avg_speed_knots, avg(hours) {later} as avg_hours,
            avg(meters_to_prev) {later} as avg_meters_to_prev, sum(meters_to_prev) {later} as event_distance_m,
            avg(meters_to_prev / 1852 / hours) {later} as avg_implied_speed_knots
          from owned_{events} group by all)
        where epoch(event_end) - epoch(event_start) > 1200 and message_count > 5 and avg_speed_knots < 10
        """,
        owned(events),
    )


def filtered(events: str, keep: str) -> str:
    """Filtered events with id, box and centroid."""
    lon_back = "case when {0} < 0 then {0} + 180 else {0} - 180 end"
    name = f"kept_{events}"
    cte(
        name,
        f"""
        select * exclude (w, e, aw, ae), case when e - w <= ae - aw then w else {lon_back.format('ae')} end as lon_min,
          case when e - w <= ae - aw then e else {lon_back.format('aw')} end as lon_max,
          {hash_id('fishing', 'vessel_id', 'event_start', 'event_end')} as event_id,
          cast(event_end as date) as event_end_date
        from summed_{events} where {keep}
        """,
        summed(events),
    )
    return cte(
        f"filtered_{events}",
        f"""
        select k.*, degrees(atan2(z, sqrt(x*x + y*y))) as lat_mean, degrees(atan2(y, x)) as lon_mean
        from {name} k join (
          select seg_id, event_start, vessel_id, sum(cos(radians(lat))*cos(radians(lon))) as x,
            sum(cos(radians(lat))*sin(radians(lon))) as y, sum(sin(radians(lat))) as z
          from (select distinct seg_id, event_start, vessel_id, lon, lat from owned_{events})
          group by all) c using (seg_id, event_start, vessel_id)
        """,
        name,
        f"owned_{events}",
    )


KEPT_NNET = filtered(NNET, "best_best_vessel_class <> 'squid_jigger' and event_distance_m > 500")
KEPT_NIGHT = filtered(NIGHT, "best_best_vessel_class = 'squid_jigger' and event_distance_m > 50")

check(
    "vessel_left_join",
    f"""
    select seg_id, event_start, segment_vessel as vessel_id, main_vessel_shipname, main_vessel_flag, best_best_vessel_class,
      count(*) as message_count from owned_{NNET} group by all
    """,
    f"owned_{NNET}",
)
SUMMARY_OUT = """
    ssvid, seg_id, vessel_id, main_vessel_shipname, main_vessel_flag, best_best_vessel_class, event_id, event_start, event_end,
    event_end_date, message_count, lat_min, lat_max, lon_min, lon_max, round(avg_speed_knots, 9) as avg_speed_knots,
    round(avg_hours, 9) as avg_hours, round(avg_meters_to_prev, 3) as avg_meters_to_prev,
    round(event_distance_m, 3) as event_distance_m, round(avg_implied_speed_knots, 3) as avg_implied_speed_knots,
    round(lat_mean, 6) as lat_mean, round(lon_mean, 6) as lon_mean
"""
check("summarize_events", f"select {SUMMARY_OUT} from {KEPT_NNET}", KEPT_NNET)
check("summarize_events_night", f"select {SUMMARY_OUT} from {KEPT_NIGHT}", KEPT_NIGHT)
check(
    "event_point_lists",
    f"""
    select k.event_id, string_agg(printf('%.9f', m.lon) || ' ' || printf('%.9f', m.lat), ', ' order by m.timestamp) as points_wkt,
      count(*) as points, string_agg(printf('%.9f', m.lon), ' ' order by m.timestamp) as lons,
      string_agg(printf('%.9f', m.lat), ' ' order by m.timestamp) as lats
    from kept_{NNET} k join owned_{NNET} m using (seg_id, event_start, vessel_id) group by k.event_id
    """,
    f"kept_{NNET}",
    f"owned_{NNET}",
)
check(
    "event_class_filter",
    f"""
    select seg_id, event_start, best_best_vessel_class,
      case when best_best_vessel_class = 'squid_jigger' then 'night_loitering' else 'nnet_score' end as score_field
    from summed_{NNET}
    where event_distance_m > case when best_best_vessel_class = 'squid_jigger' then 50 else 500 end
      and best_best_vessel_class is not null
    """,
    f"summed_{NNET}",
)

# --- authorizations and regions -------------------------------------------------------------

BOTH = cte("both_kept", f"select * from {KEPT_NNET} union all select * from {KEPT_NIGHT}", KEPT_NNET, KEPT_NIGHT)
cte(
    "identities",
    f"""
    select distinct c.ssvid, first_timestamp as activity_first_timestamp, last_timestamp as activity_last_timestamp,
      authorized_from as registry_authorized_from, authorized_to as registry_authorized_to, source_code as registry_rfmo
    from identity_core c join grants g on c.vessel_record_id = g.vessel_record_id
      and c.ssvid is not distinct from g.ssvid and c.n_shipname is not distinct from g.n_shipname
      and c.n_callsign is not distinct from g.n_callsign and c.imo is not distinct from g.imo
      and c.flag is not distinct from g.flag
    where source_code in {WHITELIST} and authorized_from < last_timestamp and authorized_to > first_timestamp
    """,
    "identity_core",
    "grants",
)
cte(
    "scrapes",
    f"select source_code as registry_rfmo, max(authorized_to) as last_scrape from grants where source_code in {WHITELIST} group by 1",
    "grants",
)
check("identity_authorization", "select * from identities", "identities")
check("last_scrape", "select * from scrapes", "scrapes")
check(
    "activity_interval_join",
    f"""
    select event_id, event_start, registry_rfmo, registry_authorized_from, registry_authorized_to
    from {BOTH} e left join identities i on i.ssvid = e.ssvid
      and e.event_start between activity_first_timestamp and activity_last_timestamp
    """,
    BOTH,
    "identities",
)


def vessel_grants(name: str, vessels_sql: str, *reads: str) -> str:
    return cte(
        name,
        f"""
        select distinct v.vessel_id, registry_rfmo, registry_authorized_from, registry_authorized_to
        from ({vessels_sql}) v join identities i on i.ssvid = v.ssvid
          and v.t between activity_first_timestamp and activity_last_timestamp
        """,
        "identities",
        *reads,
    )


vessel_grants("fishing_grants", f"select vessel_id, ssvid, event_start as t from {BOTH}", BOTH)
check("vessel_authorizations", "select * from fishing_grants", "fishing_grants")
check(
    "region_cells",
    """
    select layer, id, cast(x*1000 + y as bigint) as cell
    from boxes, lateral (select unnest(range(lon0, lon1 + 1)) as x) a, lateral (select unnest(range(lat0, lat1 + 1)) as y) b
    """,
    "boxes",
)
cte(
    "fishing_points",
    f"""
    select distinct k.event_id, m.lon, m.lat from kept_{NNET} k join owned_{NNET} m using (seg_id, event_start, vessel_id)
    union select distinct k.event_id, m.lon, m.lat from kept_{NIGHT} k join owned_{NIGHT} m using (seg_id, event_start, vessel_id)
    """,
    f"kept_{NNET}",
    f"owned_{NNET}",
    f"kept_{NIGHT}",
    f"owned_{NIGHT}",
)
cte(
    "fishing_regions",
    """
    select distinct event_id, layer, id from fishing_points, boxes
    where lon > lon0 and lon < lon1 and lat > lat0 and lat < lat1
    """,
    "fishing_points",
    "boxes",
)
check("region_match", "select * from fishing_regions", "fishing_regions")
check("region_match_covered", "select * from fishing_regions", "fishing_regions")


def xyz(lon: str, lat: str) -> tuple[str, str, str]:
    return (f"cos(radians({lat}))*cos(radians({lon}))", f"cos(radians({lat}))*sin(radians({lon}))", f"sin(radians({lat}))")


def left_of(a: tuple[str, str], b: tuple[str, str]) -> str:
    """Is the point left of the great circle from a to b?  Sign of a triple product."""
    (ax, ay, az), (bx, by, bz), (px, py, pz) = xyz(*a), xyz(*b), xyz("lon", "lat")
    return (
        f"(({ay})*({bz}) - ({az})*({by}))*({px}) + (({az})*({bx}) - ({ax})*({bz}))*({py})"
        f" + (({ax})*({by}) - ({ay})*({bx}))*({pz}) > 0"
    )


_corners = [("lon0", "lat0"), ("lon1", "lat0"), ("lon1", "lat1"), ("lon0", "lat1")]
_sides = " and ".join(left_of(a, b) for a, b in zip(_corners, _corners[1:] + _corners[:1]))
# a box of great circles is convex: inside means left of each side, and in a cell of the box
check(
    "region_match_spherical",
    f"""
    select distinct event_id, layer, id from fishing_points, boxes
    where floor(lon) between lon0 and lon1 and floor(lat) between lat0 and lat1 and {_sides}
    """,
    "fishing_points",
    "boxes",
)


def layer_columns(layers: tuple[str, ...]) -> str:
    return ", ".join(
        f"coalesce(string_agg(id, ',' order by id) filter (layer = '{layer}'), '') as in_{layer}" for layer in layers
    )


check("event_regions", f"select event_id, {layer_columns(REGION_LAYERS)} from fishing_regions group by 1", "fishing_regions")


def layered(name: str, regions: str) -> str:
    return cte(name, f"select event_id, {layer_columns(REGION_LAYERS)} from {regions} group by 1", regions)


layered("fishing_layers", "fishing_regions")


def status(flag: str) -> str:
    """Status from the regions of one group; flag is true where authorized."""
    return f"""case when bool_and({flag}) then 'publicly_authorized'
      when bool_and(not after and not {flag}) then 'not_matching_relevant_public_authorization'
      when bool_and(after and not {flag}) then 'pending_info' else 'partially_matched' end"""


def standing(flag: str) -> str:
    return f"case when {flag} then 'true' when start_at <= last_scrape then 'false' else 'pending' end"


def listing(value: str) -> str:
    return f"string_agg(rfmo || ':' || {value}, ',' order by rfmo, {value})"


def granted(grants: str, vessel: str) -> str:
    return f"""exists (select 1 from {grants} g where g.vessel_id = e.{vessel} and g.registry_rfmo = r.id
      and e.start_at < registry_authorized_to and e.end_at > registry_authorized_from)"""


def judged(name: str, events: str, regions: str, flags: dict[str, str], *reads: str) -> str:
    """One row per event and whitelisted region, with a flag for each vessel."""
    columns = ", ".join(f"{sql} as {flag}" for flag, sql in flags.items())
    return cte(
        name,
        f"""
        select distinct e.event_id, r.id as rfmo, e.start_at, s.last_scrape, e.start_at >= s.last_scrape as after,
          exists (select 1 from {regions} z where z.event_id = e.event_id and z.layer = 'eez') as eez, {columns}
        from ({events}) e join {regions} r on r.event_id = e.event_id and r.layer = 'rfmo' and r.id in {WHITELIST}
          left join scrapes s on s.registry_rfmo = r.id
        """,
        regions,
        "scrapes",
        *reads,
    )


judged(
    "fishing_judged",
    f"select event_id, vessel_id, event_start as start_at, event_end as end_at from {BOTH}",
    "fishing_regions",
    {"ok": granted("fishing_grants", "vessel_id")},
    BOTH,
    "fishing_grants",
)
cte(
    "fishing_status",
    f"""
    select event_id, eez, after, {status('ok')} as status, {listing(standing('ok'))} as list,
      to_json(list({{'rfmo': rfmo, 'has_publicly_listed_authorization': {standing('ok')}}} order by rfmo)) as list_json
    from fishing_judged group by event_id, eez, after
    """,
    "fishing_judged",
)
check(
    "authorization_status",
    """
    select event_id, eez as eez_event, after as event_after_last_scrape, status as vessel_public_authorization_status,
      list as public_authorizations from fishing_status
    """,
    "fishing_status",
)
measures(
    "fishing_measures",
    f"select lon_min as lon, lat_min as lat from {BOTH} union all select lon_max, lat_max from {BOTH}",
    BOTH,
)


def distances(start: str, end: str) -> str:
    return (
        f"{start}.shore_km as start_distance_from_shore_km, {end}.shore_km as end_distance_from_shore_km,"
        f" {start}.port_km as start_distance_from_port_km, {end}.port_km as end_distance_from_port_km"
    )


check(
    "gridcode_lookup",
    f"""
    select event_id, {grid('lon_min', 'lat_min')} as code, {distances('a', 'b')}
    from {BOTH} join fishing_measures a on a.lon_code = {grid('lon_min', 'lat_min')}
      join fishing_measures b on b.lon_code = {grid('lon_max', 'lat_max')}
    """,
    BOTH,
    "fishing_measures",
)
IN_LAYERS = ", ".join(f"in_{layer}" for layer in REGION_LAYERS)
NO_LIST = '[{"rfmo":null,"has_publicly_listed_authorization":null}]'
RISK = "status = 'not_matching_relevant_public_authorization' and not eez"
cte(
    "fishing_published",
    f"""
    select e.*, {IN_LAYERS}, {distances('a', 'b')},
      coalesce(status, 'publicly_authorized') as status, coalesce(cast(list_json as varchar), '{NO_LIST}') as list_json,
      case when {RISK} then 'true' else 'false' end as potential_risk, f.prod_shiptype, f.ais_shipname, f.ais_mmsi_flag
    from {BOTH} e left join fishing_layers using (event_id) left join fishing_status using (event_id)
      join fishing_measures a on a.lon_code = {grid('lon_min', 'lat_min')}
      join fishing_measures b on b.lon_code = {grid('lon_max', 'lat_max')}
      join fishers f on f.vessel_id = e.vessel_id and f.year = extract(year from e.event_start)
    """,
    BOTH,
    "fishing_layers",
    "fishing_status",
    "fishing_measures",
    "fishers",
)
DISTANCE_OUT = (
    "start_distance_from_shore_km, end_distance_from_shore_km, start_distance_from_port_km, end_distance_from_port_km"
)
check(
    "authorize_events",
    f"""
    select event_id, 'fishing' as event_type, vessel_id, seg_id, event_start, event_end, round(lat_mean, 6) as lat_mean,
      round(lon_mean, 6) as lon_mean, lat_min, lat_max, lon_min, lon_max, {IN_LAYERS}, {DISTANCE_OUT},
      cast(message_count as varchar) as messages, round(avg_hours, 9) as avg_duration_hrs,
      round(event_distance_m / 1000, 6) as distance_km, round(avg_speed_knots, 9) as avg_speed_knots, potential_risk, status,
      vessel_id as v_id, ssvid as v_ssvid, ais_shipname as v_name, ais_mmsi_flag as v_flag, prod_shiptype as v_type,
      seg_id as v_seg_id, list_json as v_authorizations
    from fishing_published
    """,
    "fishing_published",
)
check(
    "restrict_events",
    "select event_id, vessel_id, prod_shiptype as v_type from fishing_published where prod_shiptype = 'fishing'",
    "fishing_published",
)

# --- port visits ------------------------------------------------------------------------------

cte(
    "ranked",
    """
    select distinct on (v.visit_id) v.visit_id,
      case event_type when 'PORT_STOP_BEGIN' then 1 when 'PORT_STOP_END' then 2 when 'PORT_GAP_BEGIN' then 3 when 'PORT_GAP_END' then 4 end as event_rank,
      at_time as event_timestamp, anchorage_id as event_anchorage_id
    from raw_visits v left join visit_events using (visit_id)
    order by v.visit_id, event_rank nulls first, event_timestamp nulls first, event_anchorage_id nulls first
    """,
    "raw_visits",
    "visit_events",
)
check("port_visit_ranked", "select * from ranked", "ranked")
cte(
    "harbours",
    """
    select *, lower(iso3 || '-' || replace(nfc_normalize(label), ' ', '')) as port_id,
      case when label_source = 'top_destination' then null else label end as port_name
    from anchorages
    """,
    "anchorages",
)
measures("anchorage_measures", "select lon, lat from anchorages", "anchorages")
cte(
    "port_published",
    f"""
    select {hash_id('port_visit', 'v.vessel_id', 'v.start_timestamp', 'v.end_timestamp')} as event_id, v.*,
      {distances('ma', 'mb')}, (select string_agg(distinct '"' || seg_id || '"', ',' order by '"' || seg_id || '"') from visit_events x where x.visit_id = v.visit_id) as seg_list,
      p.ssvid, p.ais_shipname, p.ais_mmsi_flag, p.prod_shiptype, h as mid, sa as start_a, se as end_a
    from raw_visits v join vessels p on p.vessel_id = v.vessel_id and p.year = extract(year from v.start_timestamp)
      join harbours sa on sa.s2id = v.start_anchorage_id join harbours se on se.s2id = v.end_anchorage_id
      left join (select r.visit_id, harbours.* from ranked r join harbours on harbours.s2id = r.event_anchorage_id) h
        on h.visit_id = v.visit_id
      join anchorage_measures ma on ma.lon_code = {grid('v.start_lon', 'v.start_lat')}
      join anchorage_measures mb on mb.lon_code = {grid('v.end_lon', 'v.end_lat')}
    where confidence >= 2 and end_timestamp < timestamp '2024-01-04' and v.visit_id in (select visit_id from visit_events)
    """,
    "raw_visits",
    "vessels",
    "harbours",
    "ranked",
    "anchorage_measures",
    "visit_events",
)


def placed(name: str, events: str, lon: str, lat: str, *reads: str) -> str:
    """Regions at the mean position, boundary included."""
    cte(
        f"{name}_regions",
        f"""
        select distinct e.event_id, layer, id from ({events}) e join boxes
          on {lon} between lon0 and lon1 and {lat} between lat0 and lat1
        """,
        "boxes",
        *reads,
    )
    return layered(f"{name}_layers", f"{name}_regions")


placed("port", "select event_id, mid.lon as lon, mid.lat as lat from port_published", "lon", "lat", "port_published")


def anchorage_out(side: str, a: str) -> str:
    return f"""{a}.s2id as {side}_anchorage_id, {a}.port_id as {side}_port_id, {a}.iso3 as {side}_flag, {a}.port_name as {side}_name,
      {a}.top_destination as {side}_top_destination, round({a}.distance_from_shore_m / 1000, 6) as {side}_shore_km,
      cast({a}.at_dock as varchar) as {side}_at_dock, round({a}.lat, 6) as {side}_at_lat, round({a}.lon, 6) as {side}_at_lon"""


check(
    "port_visit_events",
    f"""
    select event_id, 'port_visit' as event_type, vessel_id, cast(null as varchar) as seg_id, start_timestamp as event_start,
      end_timestamp as event_end, mid.lat as lat_mean, mid.lon as lon_mean, start_lat as lat_min, end_lat as lat_max,
      start_lon as lon_min, end_lon as lon_max, {IN_LAYERS}, {DISTANCE_OUT}, round(duration_hrs, 6) as duration_hrs, visit_id,
      cast(confidence as varchar) as confidence, {anchorage_out('start', 'start_a')}, {anchorage_out('end', 'end_a')},
      {anchorage_out('intermediate', 'mid')}, '[' || seg_list || ']' as seg_ids,
      vessel_id as v_id, ssvid as v_ssvid, ais_shipname as v_name, prod_shiptype as v_type, ais_mmsi_flag as v_flag
    from port_published left join port_layers using (event_id)
    """,
    "port_published",
    "port_layers",
)
check(
    "versioned_publish",
    """
    select event_id, start_timestamp as event_start, '_v20240310' as version, false as previous_exists
    from port_published
    """,
    "port_published",
)

# --- loitering -------------------------------------------------------------------------------

cte(
    "destinations",
    "select visit_id, event_id as port_event_id, mid.port_id as port_id, mid.iso3 as port_flag, mid.port_name as port_name from port_published",
    "port_published",
)


def bound_for(vessel: str, start: str, end: str) -> str:
    """Join to the voyage in progress, and to the port it leads to."""
    return f"""left join voyages t on t.vessel_id = {vessel} and coalesce(t.trip_start < {start}, true) and t.trip_end > {end}
      left join destinations d on d.visit_id = t.trip_end_visit_id"""


check(
    "next_port",
    f"""
    select seg_id, t0 as loitering_start_timestamp, trip_end_visit_id, port_event_id, port_id, port_flag, port_name
    from loitering l {bound_for("'vid' || substr(seg_id, 2)", 'l.t0', 'l.t1')}
    """,
    "loitering",
    "voyages",
    "destinations",
)
measures(
    "loitering_measures",
    "select start_lon as lon, start_lat as lat from loitering union all select end_lon, end_lat from loitering",
    "loitering",
)
cte(
    "loitering_published",
    f"""
    select {hash_id('loitering', 'p.vessel_id', 'l.t0', 'l.t1')} as event_id, l.*, p.vessel_id, p.ais_shipname, p.ais_mmsi_flag,
      p.prod_shiptype, {distances('ma', 'mb')}, d.*, (start_lat + end_lat) / 2 as lat, (start_lon + end_lon) / 2 as lon
    from loitering l join good using (seg_id) join vessels p on p.vessel_id = 'vid' || substr(l.seg_id, 2)
        and p.year = extract(year from l.t0)
      {bound_for('p.vessel_id', 'l.t0', 'l.t1')}
      join loitering_measures ma on ma.lon_code = {grid('start_lon', 'start_lat')}
      join loitering_measures mb on mb.lon_code = {grid('end_lon', 'end_lat')}
    where l.t0 >= timestamp '2024-01-01' and avg_distance_from_shore_nm >= 20
    """,
    "loitering",
    "good",
    "vessels",
    "voyages",
    "destinations",
    "loitering_measures",
)
placed("loitering", "select event_id, lon, lat from loitering_published", "lon", "lat", "loitering_published")
check(
    "loitering_events",
    f"""
    select event_id, 'loitering' as event_type, vessel_id, seg_id, t0 as event_start, t1 as event_end, lat as lat_mean, lon as lon_mean,
      start_lat as lat_min, end_lat as lat_max, start_lon as lon_min, end_lon as lon_max, {IN_LAYERS}, {DISTANCE_OUT},
      round(loitering_hours, 9) as loitering_hours, round(tot_distance_nm * 1.852, 6) as total_distance_km,
      round(avg_distance_from_shore_nm * 1.852, 6) as avg_distance_from_shore_km, round(avg_speed_knots, 9) as avg_speed_knots,
      prod_shiptype as vessel_class, port_event_id, port_id, port_flag, port_name, vessel_id as v_id, ssvid as v_ssvid,
      ais_shipname as v_name, seg_id as v_seg_id, prod_shiptype as v_type, ais_mmsi_flag as v_flag
    from loitering_published left join loitering_layers using (event_id)
    """,
    "loitering_published",
    "loitering_layers",
)

# --- encounters -------------------------------------------------------------------------------

cte(
    "mirrored",
    """
    select encounter_id || '.' || side as event_id, start_time, end_time, lat, lon, median_speed_knots, median_distance_km,
      case side when 1 then vessel_1_id else vessel_2_id end as vessel_id,
      case side when 1 then vessel_2_id else vessel_1_id end as encountered_vessel_id,
      case side when 1 then segs_1 else segs_2 end as segs, case side when 1 then segs_2 else segs_1 end as other_segs,
      case side when 1 then points_1 else points_2 end as points, case side when 1 then points_2 else points_1 end as other_points
    from encounters, (values (1), (2)) sides(side)
    where epoch(end_time) - epoch(start_time) > 7200 and median_speed_knots < 2
    """,
    "encounters",
)
check(
    "mirror_encounters",
    """
    select event_id, vessel_id, encountered_vessel_id, start_time, end_time, segs as seg_ids, other_segs as encountered_seg_ids,
      points as vessel_point_count, other_points as encountered_point_count from mirrored
    """,
    "mirrored",
)
cte(
    "paired",
    """
    select m.*, a.vessel_id as main_id, a.ssvid as main_ssvid, a.ais_shipname as main_name, a.prod_shiptype as main_class,
      a.ais_mmsi_flag as main_flag, b.ssvid as other_ssvid, b.ais_shipname as other_name, b.prod_shiptype as other_class,
      b.ais_mmsi_flag as other_flag
    from mirrored m left join vessels a on a.vessel_id = m.vessel_id and a.year = extract(year from start_time)
      left join vessels b on b.vessel_id = m.encountered_vessel_id and b.year = extract(year from start_time)
    """,
    "mirrored",
    "vessels",
)
placed("encounter", "select event_id, lon, lat from paired", "lon", "lat", "paired")
vessel_grants(
    "encounter_grants",
    """
    select main_id as vessel_id, main_ssvid as ssvid, start_time as t from paired
    union select encountered_vessel_id, other_ssvid, start_time from paired
    """,
    "paired",
)
judged(
    "encounter_judged",
    "select event_id, main_id, encountered_vessel_id, start_time as start_at, end_time as end_at from paired",
    "encounter_regions",
    {"main": granted("encounter_grants", "main_id"), "other": granted("encounter_grants", "encountered_vessel_id")},
    "paired",
    "encounter_grants",
)


def json_list(flag: str) -> str:
    return f"to_json(list({{'rfmo': rfmo, 'has_publicly_listed_authorization': {standing(flag)}}} order by rfmo))"


cte(
    "encounter_status",
    f"""
    select event_id, eez, after, {status('main')} as main_status, {status('other')} as other_status,
      {status('(main and other)')} as status, {listing(standing('main'))} as main_list, {listing(standing('other'))} as other_list,
      {listing("cast(main and other as varchar)")} as joint_list, {json_list('main')} as main_json, {json_list('other')} as other_json
    from encounter_judged group by event_id, eez, after
    """,
    "encounter_judged",
)
check(
    "encounter_authorization",
    """
    select event_id, eez as eez_event, after as event_after_last_scrape, main_status as main_vessel_public_authorization_status,
      other_status as encountered_vessel_public_authorization_status, status as joint_vessel_authorization_status,
      main_list as main_vessel_region_authorizations, other_list as encountered_vessel_region_authorizations,
      joint_list as joint_vessel_region_authorizations
    from encounter_status
    """,
    "encounter_status",
)
measures("encounter_measures", "select lon, lat from encounters", "encounters")
check(
    "encounter_events",
    f"""
    select event_id, 'encounter' as event_type, p.vessel_id, cast(null as varchar) as seg_id, start_time as event_start,
      end_time as event_end, lat as lat_mean, lon as lon_mean, lat as lat_min, lat as lat_max, lon as lon_min, lon as lon_max,
      {IN_LAYERS}, {distances('m', 'm')}, round(median_distance_km, 3) as median_distance_km,
      round(median_speed_knots, 3) as median_speed_knots, encountered_vessel_id,
      coalesce(main_class, '') || '-' || coalesce(other_class, '') as vessel_classes,
      case when {RISK} then 'true' else 'false' end as potential_risk,
      coalesce(main_status, 'publicly_authorized') as main_status, coalesce(other_status, 'publicly_authorized') as encountered_status,
      port_event_id, port_id, port_flag, port_name,
      p.vessel_id as v1_id, main_ssvid as v1_ssvid, main_name as v1_name, cast(points as varchar) as v1_point_count,
      main_class as v1_type, main_flag as v1_flag, '["' || segs || '"]' as v1_seg_ids,
      coalesce(cast(main_json as varchar), '{NO_LIST}') as v1_public_authorizations,
      encountered_vessel_id as v2_id, other_ssvid as v2_ssvid, other_name as v2_name, cast(other_points as varchar) as v2_point_count,
      other_class as v2_type, other_flag as v2_flag, '["' || other_segs || '"]' as v2_seg_ids,
      coalesce(cast(other_json as varchar), '{NO_LIST}') as v2_public_authorizations
    from paired p left join encounter_layers using (event_id) left join encounter_status using (event_id)
      {bound_for('main_id', 'start_time', 'end_time')}
      join encounter_measures m on m.lon_code = {grid('lon', 'lat')}
    """,
    "paired",
    "encounter_layers",
    "encounter_status",
    "voyages",
    "destinations",
    "encounter_measures",
)

# --- column functions ----------------------------------------------------------------------------

check(
    "scalar_helpers",
    f"""
    select seg_id, timestamp, case when nnet_score = 0 then null else ssvid end as shown_ssvid,
      case when lon < 0 then lon + 180 else lon - 180 end as opposite, {grid('lon', 'lat')} as code,
      lon as lon_read_back, 1.5::double as km, floor(speed_knots) * 1.852::double as nm_km,
      {hash_id('fishing', 'ssvid', 'timestamp', 'timestamp')} as id, cast(timestamp as date) as day,
      cast(timestamp as date) - 1 as day_before, extract(year from timestamp) as year,
      date_diff('second', date_trunc('day', timestamp), timestamp) as second_of_day,
      cast(coalesce(nnet_score, -1) as double) as score_or_default, round(floor(speed_knots) / 3, 3) as third,
      lower(upper(seg_id) || '-' || 'abc') as joined
    from messages
    """,
    "messages",
)
check(
    "geo_distance",
    f"select seg_id, timestamp, round({sphere_distance('lon', 'lat', '-3.7', '40.4')}, 3) as metres from messages",
    "messages",
)
check(
    "range_deletion",
    f"""
    select seg_id, timestamp, event_start, kind from {NNET}, (values ('both'), ('left')) kinds(kind)
    where not (event_start >= timestamp '2024-01-02' and
      case kind when 'both' then event_start <= timestamp '2024-01-03' else event_start < timestamp '2024-01-03' end)
    """,
    NNET,
)


def s2_sql(level: int = 10) -> str:
    """Cell ids level by level: one nested SELECT reads one bit of i and j."""
    size = 1 << level
    x, y, z = xyz("lon", "lat")
    stretch = "case when {0} >= 0 then 0.5*sqrt(1+3*{0}) else 1-0.5*sqrt(1-3*{0}) end"
    sql = f"select seg_id, timestamp, {x} as x, {y} as y, {z} as z from messages"
    sql = f"""select *, case when abs(x) >= abs(y) and abs(x) >= abs(z) then case when x < 0 then 3 else 0 end
      when abs(y) >= abs(z) then case when y < 0 then 4 else 1 end else case when z < 0 then 5 else 2 end end as face from ({sql})"""
    sql = f"""select *, case face when 0 then y/x when 1 then -x/y when 2 then -x/z when 3 then z/x when 4 then z/y else -y/z end as u,
      case face when 0 then z/x when 1 then z/y when 2 then -y/z when 3 then y/x when 4 then -x/y else -x/z end as v from ({sql})"""
    sql = f"""select seg_id, timestamp, face, cast(least({size - 1}, greatest(0, floor(({stretch.format('u')})*{size}))) as bigint) as i,
      cast(least({size - 1}, greatest(0, floor(({stretch.format('v')})*{size}))) as bigint) as j,
      face % 2 as turn, cast(0 as hugeint) as pos from ({sql})"""
    steps = "[" + ", ".join(str(s) for s in hilbert_steps()) + "]"
    for bit in range(level - 1, -1, -1):
        sql = f"""select seg_id, timestamp, face, i, j, step % 4 as turn, pos * 4 + step // 4 as pos
          from (select *, {steps}[turn*4 + ((i >> {bit}) & 1)*2 + ((j >> {bit}) & 1) + 1] as step from ({sql}))"""
    low = 2 * (30 - level)
    whole = f"cast(face as hugeint)*{1 << 61} + pos*{1 << (low + 1)} + {1 << low}"
    return f"""select seg_id, timestamp, cast(case when whole >= {1 << 63} then whole - {1 << 64} else whole end as bigint) as cell
      from (select seg_id, timestamp, {whole} as whole from ({sql}))"""


check("s2_cells", s2_sql(), "messages")
