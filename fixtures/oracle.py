"""Plain SQL on the test tables that gives what each query should give."""

from __future__ import annotations

from fixtures.traffic import (
    AS_OF, BARE_SPEED, DUCKDB_K, FIELDS, NO_JSON, WRAPPED, WRAPPER, raw_columns)

_SILVER = ("raw_json, kafka_timestamp, vehicle_id, road_id, city_zone, speed, congestion_level,"
           " weather, event_time, dq_flag, speed_int, event_ts, speed_valid, time_valid, hour,"
           " peak_flag, speed_band")
_FACT = ("vehicle_id, road_id, city_zone, speed_int, congestion_level, event_ts, peak_flag,"
         " speed_band, hour, weather, date")


def _json_item(name: str, quoted: bool = True) -> str:
    value = f"'\"' || {name} || '\"'" if quoted else name
    return f"case when {name} is not null then '\"{name}\":' || {value} end"


_RAW_JSON = "'{' || concat_ws(',', " + ", ".join(
    _json_item(name, name != "congestion_level") for name in (
        "vehicle_id", "road_id", "city_zone", "speed", "congestion_level", "weather",
        "event_time", "note", "road_condition")) + ") || '}'"

# Fixed values from here on: attributes of members and positions of zones.
_DIM_ZONE = """
  select city_zone,
    case city_zone when 'CBD' then 'Commercial' when 'TECHPARK' then 'IT HUB'
      when 'AIRPORT' then 'TRANSIT HUB' when 'TRAINSTATION' then 'TRANSIT HUB'
      else 'Residential' end zone_type,
    case city_zone when 'CBD' then 'HIGH' when 'AIRPORT' then 'HIGH' when 'TECHPARK' then 'MEDIUM'
      else 'LOW' end traffic_risk
  from (select distinct city_zone from silver where city_zone is not null)"""

_DIM_ROAD = """
  select road_id, case when road_id in ('R100', 'R200') then 'Highway' else 'City Road' end road_type,
    cast(case when road_id in ('R100', 'R200') then 100 else 60 end as integer) speed_limit
  from (select distinct road_id from silver where road_id is not null)"""


def _layer_ctes(gaps: bool) -> list[tuple[str, str]]:
    """Layers in order, each on the ones before it; with gaps repeated readings stay."""
    raw = ", ".join(f"{sql} as {name}" for name, sql in raw_columns(DUCKDB_K, gaps).items())
    once = ("" if gaps else " qualify row_number() over (partition by vehicle_id, event_ts"
            " order by kafka_timestamp, raw_json) = 1")
    return [
        ("raw", f"select {raw} from events union all select {raw} from events"
                " where event_id % 31 = 0"),
        ("bronze", f"""select case when event_id % {NO_JSON} = 0 then 'broken line ' || event_id
               when event_id % {WRAPPED} = 0 then '{WRAPPER}' when event_id % {BARE_SPEED} = 0
               then regexp_replace({_RAW_JSON}, '"speed":"(-?[0-9]+)"', '"speed":\\1')
               else {_RAW_JSON} end raw_json, ts kafka_timestamp, """ + ", ".join(
            f"case when event_id % {NO_JSON} <> 0 and event_id % {WRAPPED} <> 0 then {c} end {c}"
            for c in FIELDS) + " from raw"),
        ("typed", """select *, case when vehicle_id is null then 'MISSING_VEHICLE'
             when event_time is null then 'MISSING_TIME'
             when raw_json like '%CORRUPTED%' then 'CORRUPTED_JSON' else 'OK' end dq_flag,
           try_cast(speed as integer) speed_int, try_cast(event_time as timestamp) event_ts
         from bronze"""),
        ("judged", f"""select *,
           cast(case when speed_int between 0 and 160 then 1 else 0 end as integer) speed_valid,
           cast(case when event_ts <= timestamp '{AS_OF}' + interval 10 minute then 1 else 0 end
             as integer) time_valid
         from typed"""),
        ("clean", "select * from judged where dq_flag = 'OK' and speed_valid = 1"
                  f" and time_valid = 1{once}"),
        ("silver", f"""select {_SILVER} from (select *,
             cast(extract(hour from event_ts) as integer) as hour,
             cast(case when extract(hour from event_ts) between 17 and 20 then 1 else 0 end
               as integer) peak_flag,
             case when speed_int < 30 then 'LOW' when speed_int < 70 then 'MEDIUM'
               else 'HIGH' end speed_band
           from clean)"""),
        ("gold_zone", _DIM_ZONE),
        ("gold_road", _DIM_ROAD),
        ("gold_fact", f"select {_FACT} from (select *, cast(event_ts as date) as date from silver)"
                      " where vehicle_id is not null and event_ts is not null"),
        ("loc", """select md5(city_zone || '|' || road_id) location_id, *
           from (select city_zone, road_id from gold_fact group by all)
           left join gold_zone using (city_zone) left join gold_road using (road_id)"""),
        ("fct", f"""select md5(vehicle_id || '|' || cast(event_ts as varchar)) event_id,
             md5(city_zone || '|' || road_id) location_id, {_FACT} from gold_fact"""),
        ("view_zone", "select distinct city_zone, zone_type, traffic_risk from loc"),
        ("view_road", "select distinct road_id, road_type, speed_limit from loc"),
        ("coords", """select * from (values ('CBD', 51.5076::double, -0.1278::double),
             ('TECHPARK', 51.5158, -0.0987), ('AIRPORT', 51.47, -0.4543),
             ('TRAINSTATION', 51.5319, -0.1233), ('SUBURB', 51.5484, -0.1982))
             t(city_zone, lat, lon)"""),
        ("frame", """select f.vehicle_id, f.road_id, f.city_zone, f.speed_int,
             f.congestion_level, f.event_ts, coalesce(f.peak_flag, 0) peak_flag,
             coalesce(f.speed_band, 'UNKNOWN') speed_band, f.hour,
             coalesce(f.weather, 'UNKNOWN') weather, f.date, z.zone_type, z.traffic_risk,
             r.road_type, r.speed_limit, c.lat, c.lon,
             case when coalesce(f.peak_flag, 0) = 1 then 'Peak'
               when coalesce(f.peak_flag, 0) = 0 then 'Off-Peak' else 'Unknown' end peak_label
           from fct f left join view_zone z on f.city_zone is not distinct from z.city_zone
           left join view_road r on f.road_id is not distinct from r.road_id
           left join coords c on f.city_zone is not distinct from c.city_zone"""),
    ]


def _with(query: str, gaps: bool = False, extra: list[tuple[str, str]] = ()) -> str:
    ctes = _layer_ctes(gaps) + list(extra)
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in ctes) + "\n" + query


_TRAFFIC = ("count(vehicle_id) events, avg(speed_int) avg_speed,"
            " avg(congestion_level) avg_congestion")
_TRAFFIC_1DP = ("count(vehicle_id) events, round_even(avg(speed_int), 1) avg_speed,"
                " round_even(avg(congestion_level), 1) avg_congestion")
_ZONE_SUMMARY = (f"select city_zone, zone_type, traffic_risk, lat, lon, {_TRAFFIC_1DP}"
                 " from frame group by all")
_ROAD_SUMMARY = f"select road_id, road_type, {_TRAFFIC_1DP} from frame group by all"
_FOCUS = "city_zone = (select min(city_zone) from frame)"
_KPIS = """select count(*) events, avg(speed_int) avg_speed, avg(congestion_level) avg_congestion,
  avg(case when peak_flag = 1 then 1.0::double else 0.0 end) * 100 peak_share,
  avg(case when traffic_risk = 'HIGH' then 1.0::double else 0.0 end) * 100 high_risk_share from frame"""
_ROAD_MIX = f"select road_id, road_type, {_TRAFFIC} from frame where {_FOCUS} group by all"
_FILTER_OPTIONS = """
  select distinct * from (
    select 'city_zone' "column", city_zone "option" from frame
    union all select 'road_id', road_id from frame
    union all select 'weather', weather from frame
    union all select 'peak_label', peak_label from frame
    union all select 'date_from', cast(min(date) as varchar) from frame
    union all select 'date_to', cast(max(date) as varchar) from frame)
  where "option" is not null"""
_SELECTED = """date between date '2024-01-05' and date '2024-01-20'
  and city_zone in ('CBD', 'AIRPORT', 'TECHPARK') and road_id in ('R100', 'R300')
  and weather in ('RAIN', 'UNKNOWN') and peak_label in ('Off-Peak', 'Unknown')"""

_BI_FACT = """select vehicle_id, road_id, city_zone, cast(speed_int as double) speed,
  congestion_level, event_ts event_time, cast(peak_flag as varchar) peak_flag, speed_band, weather,
  date event_date, hour event_hour from gold_fact"""


def _exact_mean(column: str) -> str:
    return f"cast(sum(cast({column} as decimal(9, 6))) as double) / count({column})"


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' \"table\", count(*) \"rows\" from {source}"
        for name, source in tables.items())


# ---- data checks --------------------------------------------------------------------------------

_LOC_COLUMNS = ("location_id", "city_zone", "zone_type", "traffic_risk", "road_id", "road_type",
                "speed_limit")
_FCT_COLUMNS = ("event_id", "location_id", *_FACT.replace(" ", "").split(","))
_MODELS = {"dim_locations": _LOC_COLUMNS, "fct_traffic_events": _FCT_COLUMNS}
_UNIQUE = (("dim_locations", "location_id"), ("fct_traffic_events", "event_id"))
_ACCEPTED = (
    ("dim_locations", "city_zone", "'CBD', 'AIRPORT', 'TECHPARK', 'SUBURB', 'TRAINSTATION'"),
    ("dim_locations", "traffic_risk", "'HIGH', 'MEDIUM', 'LOW'"),
    ("dim_locations", "road_id", "'R100', 'R200', 'R300', 'R400'"),
    ("fct_traffic_events", "speed_band", "'LOW', 'MEDIUM', 'HIGH'"),
    ("fct_traffic_events", "weather", "'CLEAR', 'RAIN', 'FOG', 'STORM'"),
)
# In the broken copy one zone has no location, and one road is listed twice.
_BROKEN_LOC = ("broken_loc", """select * from loc where city_zone is distinct from 'SUBURB'
  union all select * from loc where city_zone is distinct from 'SUBURB' and road_id = 'R100'""")


def _check(model: str, column: str, test: str, failures: str) -> str:
    return (f"select '{model}' model, '{column}' column_name, '{test}' test,"
            f" cast(({failures}) as bigint) failures")


def _checks(kind: str, source: dict[str, str], accepted=_ACCEPTED) -> list[str]:
    if kind == "unique":
        return [_check(m, c, kind, f"select count(*) from (select {c} from {source[m]} where {c}"
                       f" is not null group by {c} having count(*) > 1)") for m, c in _UNIQUE]
    if kind == "not_null":
        return [_check(m, c, kind, f"select count(*) from {source[m]} where {c} is null")
                for m, columns in _MODELS.items() for c in columns]
    if kind == "accepted_values":
        return [_check(m, c, kind, f"select count(distinct {c}) from {source[m]}"
                       f" where {c} not in ({v})") for m, c, v in accepted]
    return [_check("fct_traffic_events", "location_id", kind,
                   f"select count(*) from {source['fct_traffic_events']} f where location_id is"
                   f" not null and not exists (select 1 from {source['dim_locations']} l"
                   " where l.location_id = f.location_id)")]


_FRESHNESS = f"""select 'dim_locations' model, count(*) "rows", cast(null as timestamp) newest,
    cast(null as bigint) hours_old, cast(1 as integer) sla_freshness_hours from {{loc}}
  union all select 'fct_traffic_events', count(*), max(event_ts),
    datesub('hour', max(event_ts), timestamp '{AS_OF}'), cast(1 as integer) from fct"""

_KINDS = ("unique", "not_null", "accepted_values", "relationships")
_CLEAN = {"dim_locations": "loc", "fct_traffic_events": "fct"}
_BROKEN = {"dim_locations": "broken_loc", "fct_traffic_events": "fct"}


def _check_query(kinds: tuple[str, ...], broken: bool) -> str:
    found = " union all ".join(q for kind in kinds for q in _checks(
        kind, _BROKEN if broken else _CLEAN))
    query = (f"select *, case when failures = 0 then 'pass' else 'fail' end status from ({found})"
             if len(kinds) > 1 else found)
    return _with(query, gaps=broken, extra=[_BROKEN_LOC] if broken else [])


def _sample_query(limit: int = 5) -> str:
    """First failing values of every check of the broken copy, vehicle_id left out."""
    loc, fct = _BROKEN["dim_locations"], _BROKEN["fct_traffic_events"]
    source = {"dim_locations": loc, "fct_traffic_events": fct}
    key = dict(_UNIQUE)
    found = [(m, c, "unique", f"select {c} v from {source[m]} where {c} is not null group by {c}"
              " having count(*) > 1") for m, c in _UNIQUE]
    found += [(m, c, "not_null", f"select {key[m]} v from {source[m]} where {c} is null")
              for m, columns in _MODELS.items() for c in columns if c != "vehicle_id"]
    found += [(m, c, "accepted_values", f"select distinct {c} v from {source[m]}"
               f" where {c} not in ({values})") for m, c, values in _ACCEPTED]
    found += [("fct_traffic_events", "location_id", "relationships",
               f"select distinct location_id v from {fct} f where location_id is not null and"
               f" not exists (select 1 from {loc} l where l.location_id = f.location_id)")]
    query = " union all ".join(
        f"(select '{m}' model, '{c}' column_name, '{test}' test, v sample from ({sql})"
        f" order by v nulls last limit {limit})" for m, c, test, sql in found)
    return _with(query, gaps=True, extra=[_BROKEN_LOC])


# ---- publication in two parts -------------------------------------------------------------------

_EARLY = "congestion_level % 2 = 0 and extract(day from event_ts) % 5 <> 0"
_TWICE = [
    ("fact1", f"select * from gold_fact where {_EARLY}"),
    ("zone1", "select * from gold_zone where city_zone in (select city_zone from fact1)"),
    ("road1", "select * from gold_road where road_id in (select road_id from fact1)"),
    ("loc1", "select * from loc where location_id in (select md5(city_zone || '|' || road_id) from fact1)"),
    ("fct1", f"select * from fct where {_EARLY}"),
    ("days2", f"select distinct date from gold_fact where not ({_EARLY})"),
    ("fact2", "select * from gold_fact where date in (select date from days2)"),
]
_ROLLUP = """select date, hour, city_zone, road_id, weather, speed_band, peak_flag, count(*) rows_n,
  count(vehicle_id) vehicle_id_n, count(speed_int) speed_int_n, count(congestion_level) congestion_level_n,
  cast(coalesce(sum(speed_int), 0) as bigint) speed_int_sum,
  cast(coalesce(sum(congestion_level), 0) as bigint) congestion_level_sum from {source} group by all"""


def _history_query() -> str:
    strict = [(m, c, {"weather": "'RAIN'", "speed_band": "'HIGH'"}.get(c, v)) for m, c, v in _ACCEPTED]
    runs = [{"dim_locations": "loc1", "fct_traffic_events": "fct1"}, _CLEAN]
    found = " union all ".join(f"select cast({k} as integer) run, * from ({q})" for k, source in enumerate(runs, 1)
                               for kind in _KINDS for q in _checks(kind, source, strict))
    return _with(f"select *, case when failures = 0 then 'pass' else 'fail' end status from ({found})", extra=_TWICE)


def _load_query() -> str:
    first = {"stg_dim_zone": "zone1", "stg_dim_road": "road1", "stg_fact_traffic": "fact1", "dim_locations": "loc1",
             "fct_traffic_events": "fct1", "agg_traffic_daily": f"({_ROLLUP.format(source='fact1')})"}
    second = {"stg_dim_zone": "gold_zone", "stg_dim_road": "gold_road", "stg_fact_traffic": "fact2",
              "dim_locations": "(select location_id from loc except select location_id from loc1)",
              "fct_traffic_events": "fact2", "agg_traffic_daily": f"({_ROLLUP.format(source='fact2')})"}
    return _with(" union all ".join(f"select cast({k} as integer) run, * from ({_counts(tables)})"
                                    for k, tables in ((1, first), (2, second))), extra=_TWICE)


_REMOVED = " union all ".join(
    f"select '{name}' \"table\", date, count(*) \"rows\" from fct where extract(day from date) % 10 <> 4 group by date"
    for name in ("stg_fact_traffic", "fct_traffic_events", "agg_traffic_daily", "check_parts"))

# ---- streams ------------------------------------------------------------------------------------

LATE_FILES = 6

_DELIVERED = f"""
with n as (select max(event_id) + 1 as total from events),
x as (select 'V' || cast(user_id as varchar) vehicle_id, ts event_ts,
        cast(event_id * {LATE_FILES} // total as bigint)
          + case when event_id % 37 = 0 then 1 else 0 end b
      from events, n),
m as (select b, max(event_ts) mx from x group by b),
w as (select b, date_trunc('milliseconds', max(mx) over (order by b rows between unbounded preceding
        and 1 preceding)) - interval 15 minute wm from m),
kept as (select vehicle_id, event_ts, min(b) b from x join w using (b) where wm is null or event_ts > wm group by all),
a as (select b, date_trunc('milliseconds', max(mx) over (order by b rows unbounded preceding))
        - interval 15 minute wm from m)
"""

_LATE = _DELIVERED + "select vehicle_id, event_ts from kept"
_PROGRESS = _DELIVERED + """select cast(b as integer) delivery, count(*) input_rows,
  cast(count(*) filter (where event_ts <= w.wm) as bigint) late_rows,
  (select count(*) from kept where kept.b <= x.b and kept.event_ts > any_value(a.wm)) state_rows,
  any_value(a.wm) watermark from x join w using (b) join a using (b) group by b"""
_STATE = _DELIVERED + "select vehicle_id, event_ts from kept where event_ts > (select max(wm) from a)"

# ---- generic star -------------------------------------------------------------------------------

_SCALE_STAR = """
select r_name region, n_name nation, o_orderpriority priority, count(l_orderkey) events,
  round_even(cast(sum(cast(l_quantity as decimal(18, 2))) as double) / count(l_quantity), 1)
    avg_quantity,
  round_even(cast(sum(cast(l_extendedprice as decimal(18, 2))) as double)
    / count(l_extendedprice), 1) avg_price
from lineitem left join orders on l_orderkey = o_orderkey
left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
left join region on n_regionkey = r_regionkey
group by all"""


_LOOSE = """
with n as (select event_id, case when event_id % 3 = 0 then floor(cast(value as double))
  else cast(value as double) end v from events)
select event_id, case when v = floor(v) then cast(v as integer) end as_text,
  case when v = floor(v) then cast(v as integer) end as_double from n"""


def oracle_sql() -> dict[str, str]:
    queries = {
        "bronze_parse": _with("select * from bronze"),
        "dq_flag_counts": _with("select dq_flag, speed_valid, time_valid, count(*) events"
                                " from judged group by all"),
        "silver_clean": _with("select * from silver"),
        "silver_stream_dedup": _with("select * from silver"),
        "silver_stream_unthinned": _with("select * from silver"),
        "silver_stream_late": _LATE,
        "stream_progress": _PROGRESS,
        "dedup_state": _STATE,
        "gold_dim_zone": _with("select * from gold_zone"),
        "gold_dim_road": _with("select * from gold_road"),
        "gold_fact_traffic": _with("select * from gold_fact"),
        "gold_stream_rebuild": _with(_counts({"dim_zone": "gold_zone", "dim_road": "gold_road",
                                              "fact_traffic": "gold_fact"})),
        "gold_stream_incremental": _with("select * from gold_fact"),
        "mart_dim_locations": _with("select * from loc"),
        "mart_fct_events": _with("select * from fct"),
        "view_fact": _with(f"select {_FACT} from fct"),
        "view_zone": _with("select * from view_zone"),
        "view_road": _with("select * from view_road"),
        "publish_normalise": _with(f"select {_FACT} from gold_fact"),
        "publish_roundtrip": _with(_counts({"stg_dim_zone": "gold_zone",
                                            "stg_dim_road": "gold_road",
                                            "stg_fact_traffic": "gold_fact"})),
        "bi_fact": _with(_BI_FACT),
        "bi_zone": _with("select * from gold_zone"),
        "bi_road": _with("select * from gold_road"),
        "row_counts": _with(_counts({"fact_traffic": "gold_fact", "dim_zone": "gold_zone",
                                     "dim_road": "gold_road"})),
        "report_frame": _with("select * from frame"),
        "report_frame_gaps": _with("select * from frame", gaps=True),
        "filter_options": _with(_FILTER_OPTIONS),
        "filter_options_gaps": _with(_FILTER_OPTIONS, gaps=True),
        "report_filtered": _with(f"select * from frame where {_SELECTED}"),
        "report_filtered_gaps": _with(f"select * from frame where {_SELECTED}", gaps=True),
        "report_since": _with("select * from frame where date >= date '2024-01-12'"),
        "kpi_overview": _with(_KPIS),
        "kpi_overview_gaps": _with(_KPIS, gaps=True),
        "zone_summary": _with(_ZONE_SUMMARY),
        "zone_summary_gaps": _with(_ZONE_SUMMARY, gaps=True),
        "map_markers": _with(f"""select *, greatest(events, 1) * 350 radius,
            greatest(least(coalesce(avg_congestion, 0) * 42, 255.0::double), 0.0::double) red,
            greatest(least(220 - coalesce(avg_congestion, 0) * 25, 220.0::double), 50.0::double)
              green,
            cast(105 as integer) blue from ({_ZONE_SUMMARY})"""),
        "map_centre": _with(f"select {_exact_mean('lat')} latitude, {_exact_mean('lon')} longitude"
                            f" from ({_ZONE_SUMMARY})"),
        "hourly_pulse": _with("select hour, count(*) events from frame group by all"),
        "road_summary": _with(_ROAD_SUMMARY),
        "road_summary_gaps": _with(_ROAD_SUMMARY, gaps=True),
        "road_summary_top10": _with(f"{_ROAD_SUMMARY} order by events desc, road_id limit 10"),
        "weather_impact": _with(f"select weather, {_TRAFFIC} from frame group by all"),
        "weather_impact_gaps": _with(f"select weather, {_TRAFFIC} from frame group by all",
                                     gaps=True),
        "speed_mix": _with("""select speed_band, count(*) events,
            count(*) / cast((select count(*) from frame) as double) share
            from frame group by all"""),
        "feed": _with("""select event_ts, vehicle_id, city_zone, road_id, road_type, speed_int,
            congestion_level, weather, traffic_risk, peak_label from frame"""),
        "zone_kpis": _with("select count(*) events, avg(speed_int) avg_speed,"
                           f" avg(congestion_level) avg_congestion from frame where {_FOCUS}"),
        "zone_road_mix": _with(_ROAD_MIX),
        "zone_road_mix_gaps": _with(_ROAD_MIX, gaps=True),
        "zone_weather_mix": _with(f"select weather, {_TRAFFIC} from frame where {_FOCUS}"
                                  " group by all"),
        "zone_hourly": _with(f"select hour, count(*) events from frame where {_FOCUS}"
                             " group by all"),
        "zone_road_matrix": _with("select city_zone, road_id, count(*) events from frame"
                                  " group by all"),
        "zone_road_heatmap": _with("select city_zone, " + ", ".join(
            f"cast(sum(case when road_id = '{road}' then 1 end) as bigint) {road}"
            for road in ("R100", "R200", "R300", "R400")) + " from frame group by all"),
        "road_leaderboard": _with(_ROAD_MIX),
        "rollup_daily": _with(_ROLLUP.format(source="fct")),
        "rollup_incremental": _with(_ROLLUP.format(source="fct")),
        "publish_removed_day": _with(_REMOVED),
        "load_counts": _load_query(),
        "dq_history": _history_query(),
        "seed_marts": _with("select * from fct"),
        "scale_star": _SCALE_STAR,
        "nation_top10": f"select * from ({_SCALE_STAR}) order by events desc, nation, priority limit 10",
        "gold_rebuild_fact": _with("select * from gold_fact"),
        "gold_switched_fact": _with("select * from gold_fact"),
        "publish_incremental": _with("select * from fct"),
        "publish_normalise_loose": _LOOSE,
        "staging_roundtrip_fact": _with(f"select {_FACT} from gold_fact"),
        "staging_roundtrip_zone": _with("select * from gold_zone"),
        "staging_roundtrip_road": _with("select * from gold_road"),
        "full_chain_marts": _with("select * from fct"),
        "full_chain_checks": _check_query(_KINDS, broken=False),
        "mart_freshness": _with(_FRESHNESS.format(loc="loc")),
        "mart_freshness_gaps": _with(_FRESHNESS.format(loc="broken_loc"), gaps=True, extra=[_BROKEN_LOC]),
        "mart_metadata": " union all ".join(
            f"select '{m}' model, '{c}' column_name, {str(c == 'vehicle_id').lower()} pii"
            for m, columns in _MODELS.items() for c in columns),
    }
    for kind, key in zip(_KINDS, ("dq_unique", "dq_not_null", "dq_accepted_values",
                                  "dq_relationships")):
        queries[key] = _check_query((kind,), broken=False)
        queries[f"{key}_broken"] = _check_query((kind,), broken=True)
    queries["dq_report"] = _check_query(_KINDS, broken=False)
    queries["dq_report_broken"] = _check_query(_KINDS, broken=True)
    queries["dq_samples_broken"] = _sample_query()
    queries["dq_report_by_day"] = queries["dq_report"]
    queries["dq_report_by_day_broken"] = queries["dq_report_broken"]
    queries["full_chain"] = _with(_counts({
        "traffic_bronze": "bronze", "traffic_silver": "silver", "dim_zone": "gold_zone",
        "dim_road": "gold_road", "fact_traffic": "gold_fact", "stg_dim_zone": "gold_zone",
        "stg_dim_road": "gold_road", "stg_fact_traffic": "gold_fact", "dim_locations": "loc",
        "fct_traffic_events": "fct"}))
    return queries
