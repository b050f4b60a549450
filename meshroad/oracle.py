"""The registered queries' results restated as SQL for an ANSI database over the same tables."""

from __future__ import annotations

from meshroad.config import INCIDENT_NAME_VARIANTS, REQUIRED_COLUMNS, STATION_NAME_VARIANTS, TEXAS_VMT
from meshroad.sources.testdata import (CRASHES_SQL, HEADER_NAMES_SQL, HEADER_WORDS, NOTE_SQL, OTHER_STATE, STATE, STATIONS_SQL,
                                        TILES_SQL)

R = "cast(3958.8 as double)"


def _miles(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * {R} * asin(least(1.0::double, sqrt("
        f"power(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"
    )


def _steps(d: str) -> str:
    return f"cast(floor({d} * 1e9::double + 0.5::double) as bigint)"


VMT = "(values " + ", ".join(f"({y}, {v}::double)" for y, v in TEXAS_VMT.items()) + ") as {0}(vmt_year, vmt)"

DATE = """case when length(Crash_Date) = 8 then try_strptime(Crash_Date, '%m/%d/%y') else try_strptime(Crash_Date, '%m/%d/%Y') end"""

STATIONS_RAW = f"stations_raw as ({STATIONS_SQL.format(part='part')})"
CRASHES_RAW = f"crashes_raw as ({CRASHES_SQL.format(lineitem='lineitem')})"
TILES = f"tiles as ({TILES_SQL.format(nation='nation')})"

RECORDS = """records as (
  select trim(TRFC_STATN_ID) as station_id, LATITUDE as station_lat, LONGITUDE as station_lon,
    LATEST_AADT_QTY::double as Station_Count, LATEST_AADT_YR as Station_Year
  from stations_raw where LATITUDE is not null and LONGITUDE is not null and LATEST_AADT_QTY > 0)"""

STATIONS = """stations as (
  select station_id, station_lat, station_lon, Station_Count, Station_Year from (
    select *, row_number() over (partition by station_id
      order by Station_Year desc nulls last, Station_Count desc, station_lat, station_lon) as k from records) t
  where k = 1)"""

CRASHES = f"""crashes as (
  select Crash_ID, Crash_Date, Latitude, Longitude, cast(year(d) as int) as Crash_Year, ZIP_Code from (
    select *, {DATE} as d, row_number() over (partition by Crash_ID order by Crash_Date asc nulls last,
      Latitude asc nulls last, Longitude asc nulls last, ZIP_Code asc nulls last) as k from crashes_raw) t
  where k = 1 and Latitude between 29 and 31 and Longitude between -99 and -97 and year(d) between 2015 and 2024)"""

_D = _miles("c.Latitude", "c.Longitude", "s.station_lat", "s.station_lon")

NEAR = f"""near as (
  select c.*, n.station_id as Nearest_Station_LocationId, n.station_lat as Station_Lat, n.station_lon as Station_Lon,
    n.Station_Count, n.Station_Year, n.dist as Distance_Miles
  from crashes c left join (
    select * from (
      select p.*, row_number() over (partition by Crash_ID order by {_steps('dist')}, station_id) as k from (
        select c.Crash_ID, s.*, {_D} as dist from crashes c join stations s
          on s.station_lat between c.Latitude - 0.02 and c.Latitude + 0.02
          and s.station_lon between c.Longitude - 0.03 and c.Longitude + 0.03) p
      where dist <= 1) q where k = 1) n on n.Crash_ID = c.Crash_ID)"""

FAR = f"""far as (
  select c.*, n.station_id, n.station_lat, n.station_lon, n.Station_Count, n.Station_Year, n.dist
  from crashes c left join (
    select * from (
      select Crash_ID, station_id, station_lat, station_lon, Station_Count, Station_Year, dist,
        row_number() over (partition by Crash_ID order by {_steps('dist')}, station_id) as k
      from (select c.Crash_ID, s.*, {_D} as dist from crashes c cross join stations s) p) q
    where k = 1) n on n.Crash_ID = c.Crash_ID)"""

ADJUSTED = f"""adjusted as (
  select n.*, abs(n.Crash_Year::bigint - n.Station_Year) as year_gap, a.vmt as VMT_Crash, b.vmt as VMT_Station,
    a.vmt / b.vmt as VMT_Multiplier, n.Station_Count * (a.vmt / b.vmt) as Adt_Curnt_Amt,
    n.Crash_Year::bigint as Adt_Curnt_Year,
    case when n.Station_Count is not null and a.vmt / b.vmt is not null then 'NEAREST_STATION_VMT_NORM' else 'MISSING' end as aadt_match_type
  from near n left join {VMT.format('a')} on a.vmt_year = n.Crash_Year left join {VMT.format('b')} on b.vmt_year = n.Station_Year)"""

INSIDE = "{p}.Longitude > t.x0 and {p}.Longitude < t.x1 and {p}.Latitude > t.y0 and {p}.Latitude < t.y1 and not ({p}.Longitude >= t.xm and {p}.Latitude >= t.ym)"

OUTPUT = f"""output as (
  select a.* exclude (ZIP_Code), t.zip::bigint as ZIP_Code from adjusted a join tiles t on {INSIDE.format(p='a')})"""

CRASH_CTES = [CRASHES_RAW, CRASHES]
STATION_CTES = [STATIONS_RAW, RECORDS, STATIONS]
NEAR_CTES = [*CRASH_CTES, *STATION_CTES, NEAR]
ADJUSTED_CTES = [*NEAR_CTES, ADJUSTED]
OUTPUT_CTES = [*ADJUSTED_CTES, TILES, OUTPUT]


def _with(ctes: list[str], select: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + select


def _r(cols: str, digits: int = 6) -> str:
    return ", ".join(f"round({c.strip()}, {digits}) as {c.strip()}" for c in cols.split(","))


def _histogram(value: str, bins: int, digits: int = 6) -> str:
    return _with([*OUTPUT_CTES, f"v as (select {value} as v from output where {value} is not null)",
                  "ends as (select min(v) as lo, max(v) as hi from v)",
                  f"c as (select least(cast(floor((v - lo) / (hi - lo) * {bins}) as bigint), {bins - 1}) as bin, count(*) as n from v, ends group by 1)"],
                 f"""select b.bin, round(lo + b.bin * ((hi - lo) / {bins}), {digits}) as lower,
  round(lo + (b.bin + 1) * ((hi - lo) / {bins}), {digits}) as upper, coalesce(n, 0) as n
from (select unnest(range({bins})) as bin) b cross join ends left join c on c.bin = b.bin""")


def _bins(op: str) -> str:
    place = " + ".join(f"(Distance_Miles {op} {e}::double)::int" for e in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9))
    return _with([*OUTPUT_CTES, f"c as (select {place} as bin, count(*) as n from output where Adt_Curnt_Amt is not null and Distance_Miles between 0 and 1 group by 1)"],
                 """select b.bin::int as bin, b.bin / 10.0::double as lower, (b.bin + 1) / 10.0::double as upper, coalesce(n, 0) as n
from (select unnest(range(10)) as bin) b left join c on c.bin = b.bin""")


def _fuzzy() -> str:
    rows = [f"('{kind}', '{canon}', {i}, '{v}')" for kind, table in (("master", INCIDENT_NAME_VARIANTS), ("stations", STATION_NAME_VARIANTS))
            for canon, words in table.items() for i, v in enumerate(words)]
    names = HEADER_NAMES_SQL.replace("{words}", HEADER_WORDS).format(part="part", customer="customer")
    plain = lambda x: f"lower(regexp_replace({x}, '[^A-Za-z0-9]', '', 'g'))"
    return f"""with names as (select name, min(position) as position from ({names}) x group by name),
variants(kind, canonical, ord, word) as (values {', '.join(rows)}),
scored as (select kind, canonical, name, position, name = word as exact,
    case when name = word then 100 else cast(floor(100::double * (greatest(length({plain('name')}), length({plain('word')}))
      - levenshtein({plain('name')}, {plain('word')})) / greatest(length({plain('name')}), length({plain('word')}))) as int) end as score,
    case when name = word then 0 else ord end as ord from names cross join variants),
ranked as (select *, row_number() over (partition by kind, canonical order by exact desc, score desc, ord, position) as k from scored)
select kind, canonical, name as actual, score::int as score,
  case when score = 100 then 'exact' when score >= 95 then 'fuzzy' else 'check' end as tag from ranked where k = 1"""


def _validation() -> str:
    n_cols = 19
    facts = f"""facts as (
  select o.Crash_Year::bigint as file_year, count(*) as rows, count(Adt_Curnt_Amt) as filled,
    array_to_string(list_sort(list(distinct Crash_Year)), ', ') as years, count(distinct Crash_Year) as n_years, max(Crash_Year) as the_year,
    count(*) filter (where Latitude is null or Longitude is null) as null_xy,
    count(*) filter (where Latitude < 29 or Latitude > 31 or Longitude < -99 or Longitude > -97) as outside,
    count(*) filter (where Distance_Miles > 1 and Adt_Curnt_Amt is not null) as too_far,
    max(Distance_Miles) filter (where Adt_Curnt_Amt is not null) as farthest,
    count(*) filter (where ZIP_Code is null) as null_zip,
    count(*) filter (where abs(Crash_Year::bigint - Station_Year) <> year_gap) as bad_gap,
    count(*) filter (where VMT_Multiplier is not null and Station_Year is not null
      and (a.vmt / b.vmt is null or abs((a.vmt / b.vmt - VMT_Multiplier) / (a.vmt / b.vmt)) > 1e-9)) as bad_vmt,
    count(*) filter (where abs((Station_Count * VMT_Multiplier - Adt_Curnt_Amt) / Adt_Curnt_Amt) > 1e-6) as bad_amount,
    count(*) filter (where Adt_Curnt_Amt is not null and aadt_match_type <> 'NEAREST_STATION_VMT_NORM') as bad_filled,
    count(*) filter (where Adt_Curnt_Amt is null and aadt_match_type <> 'MISSING') as bad_missing,
    quantile_cont(year_gap, 0.5) as gap_median, quantile_cont(year_gap, 0.9) as gap_p90, max(year_gap) as gap_max, count(year_gap) as gaps,
    count(*) filter (where Adt_Curnt_Amt < 10) as too_low, count(*) filter (where Adt_Curnt_Amt > 500000) as too_high,
    quantile_cont(Adt_Curnt_Amt, 0.05) as p5, quantile_cont(Adt_Curnt_Amt, 0.5) as med, quantile_cont(Adt_Curnt_Amt, 0.95) as p95
  from output o left join {VMT.format('a')} on a.vmt_year = o.Crash_Year left join {VMT.format('b')} on b.vmt_year = o.Station_Year
  group by 1)"""
    whole = lambda x: f"cast(round_even({x}, 0) as bigint)"
    thou = lambda x: f"format('{{:,}}', {x})"
    checks = [
        ("V01 schema", "true", f"'{len(REQUIRED_COLUMNS)}/{len(REQUIRED_COLUMNS)} present, {n_cols} cols total'"),
        ("V02 Crash_Year", "n_years = 1 and the_year = file_year", "concat('distinct values = [', years, ']')"),
        ("V03 bounds", "null_xy = 0 and outside = 0", "concat(null_xy, ' null, ', outside, ' out-of-state')"),
        ("V04 dist cap", "too_far = 0", "concat(too_far, ' violations; max Distance_Miles among filled = ', coalesce(printf('%.4f', round(farthest, 4)), 'none'))"),
        ("V05 ZIP", "null_zip = 0", "concat(null_zip, ' null ZIP rows')"),
        ("V06 year_gap", "bad_gap = 0", "concat(bad_gap, ' mismatches')"),
        ("V07 VMT", "bad_vmt = 0", "concat(bad_vmt, ' mismatches (rtol > 1e-09)')"),
        ("V08 AADT", "bad_amount = 0", "concat(bad_amount, ' mismatches (rtol > 1e-6)')"),
        ("V09 match_type", "bad_filled = 0 and bad_missing = 0", "concat(bad_filled, ' filled+wrong-label, ', bad_missing, ' missing+wrong-label')"),
        ("V12 year_gap dist", "gaps > 0", f"case when gaps = 0 then 'no filled rows' else concat('median=', {whole('gap_median')}, ', p90=', {whole('gap_p90')}, ', max=', gap_max, ', n=', {thou('gaps')}) end"),
        ("V13 AADT range", "filled > 0 and too_low < filled * 0.01 and too_high < filled * 0.01",
         f"case when filled = 0 then 'no filled rows' else concat('median=', {thou(whole('med'))}, ', p5=', {thou(whole('p5'))}, ', p95=', {thou(whole('p95'))}, ', <10: ', too_low, ', >500k: ', too_high) end"),
        ("V14 fill rate", "true", f"concat({thou('filled')}, '/', {thou('rows')}, ' (', printf('%.2f', round(100.0::double * filled / rows, 2)), '%)')"),
    ]
    parts = [f"select file_year, concat('{name} ', file_year) as validation, {ok} as passed, case when {ok} then 'pass' else 'FAIL' end as status, {msg} as msg from facts"
             for name, ok, msg in checks]
    return _with([*OUTPUT_CTES, facts], "\nunion all\n".join(parts))


OUT_COLS = """Crash_ID, Crash_Date, round(Latitude, 6) as Latitude, round(Longitude, 6) as Longitude, Crash_Year, Nearest_Station_LocationId,
  round(Station_Lat, 6) as Station_Lat, round(Station_Lon, 6) as Station_Lon, round(Station_Count, 6) as Station_Count, Station_Year,
  round(Distance_Miles, 6) as Distance_Miles, year_gap, VMT_Crash, VMT_Station, round(VMT_Multiplier, 6) as VMT_Multiplier,
  round(Adt_Curnt_Amt, 6) as Adt_Curnt_Amt, Adt_Curnt_Year, aadt_match_type, ZIP_Code"""

_MIX = "(((Crash_ID % 2147483647) * 48271 + 42) % 2147483647)"

_AUDIT = f"""audit as (
  select c.Crash_ID, c.Nearest_Station_LocationId, c.Distance_Miles, arg_min(s.station_id, ({_steps(_D)}, s.station_id)) as true_id, min({_D}) as true_d
  from (select * from output where Nearest_Station_LocationId is not null
          and Crash_Year = (select max(Crash_Year) from output where Nearest_Station_LocationId is not null)
        order by {_MIX}, Crash_ID limit 1000) c cross join stations s
  group by 1, 2, 3)"""

# The audit of a sample of every year; a match moved to no station counts as matched, as it has an id.
_AUDIT_YEARS = f"""audit as (
  select c.Crash_Year, c.Crash_ID, c.Nearest_Station_LocationId, c.Distance_Miles, arg_min(s.station_id, ({_steps(_D)}, s.station_id)) as true_id, min({_D}) as true_d
  from (select * from output where Nearest_Station_LocationId is not null
        qualify row_number() over (partition by Crash_Year order by {_MIX}, Crash_ID, ZIP_Code) <= 1000) c cross join stations s
  group by 1, 2, 3, 4)"""

_BEST = f"""best as (
  select n.Crash_ID, n.Crash_Year, n.Nearest_Station_LocationId, r.Station_Count, r.Station_Year, abs(n.Crash_Year::bigint - r.Station_Year) as year_gap,
    row_number() over (partition by n.Crash_ID order by abs(n.Crash_Year::bigint - r.Station_Year) asc nulls last, r.Station_Year desc, r.Station_Count desc) as k
  from near n left join records r on r.station_id = n.Nearest_Station_LocationId)"""

# Every tenth match is moved away, and every next one has half a mile too much.
_WRONG = f"""wrong as (
  select c.Crash_ID, case when c.Crash_ID % 10 = 0 then 'nowhere' else c.Nearest_Station_LocationId end as Nearest_Station_LocationId,
    c.Distance_Miles + case when c.Crash_ID % 10 = 1 then 0.5::double else 0::double end as Distance_Miles, c.true_id, c.true_d as true_miles from audit c)"""

_CORNERS = [("x0", "y0"), ("x1", "y0"), ("x1", "ym"), ("xm", "ym"), ("xm", "y1"), ("x0", "y1"), ("x0", "y0")]
_EDGES = "\nunion all\n".join(
    f"select n_nationkey::bigint as polygon_id, zip, {a[0]} as x1, {a[1]} as y1, {b[0]} as x2, {b[1]} as y2 from tiles"
    for a, b in zip(_CORNERS, _CORNERS[1:]))



def _multi_state() -> str:
    other = ", ".join(f"('XX', {y}, {v}::double)" for y, v in OTHER_STATE.vmt.items())
    texas = ", ".join(f"('TX', {y}, {v}::double)" for y, v in TEXAS_VMT.items())
    state = "case when {} % 2 = 0 then 'TX' else 'XX' end"
    ctes = [
        CRASHES_RAW, STATIONS_RAW, TILES, RECORDS, f"vmt(state, vmt_year, vmt) as (values {texas}, {other})",
        STATIONS, f"st as (select *, {state.format('substring(station_id, 2)::bigint')} as state from stations)",
        f"""cr as (select {state.format('Crash_ID')} as state, Crash_ID, Crash_Date, Latitude, Longitude, cast(year(d) as int) as Crash_Year from (
    select *, {DATE} as d, row_number() over (partition by Crash_ID order by Crash_Date asc nulls last,
      Latitude asc nulls last, Longitude asc nulls last, ZIP_Code asc nulls last) as k from crashes_raw) t
  where k = 1 and year(d) between 2015 and 2024 and case when Crash_ID % 2 = 0 then Latitude between 29 and 31 and Longitude between -99 and -97
    else Latitude between 29.5 and 30.5 and Longitude between -98.5 and -97.5 end)""",
        f"""nn as (select * from (select p.*, row_number() over (partition by Crash_ID order by {_steps('dist')}, station_id) as k from (
    select c.Crash_ID, s.*, {_D} as dist from cr c join st s on s.state = c.state
      and s.station_lat between c.Latitude - 0.02 and c.Latitude + 0.02 and s.station_lon between c.Longitude - 0.03 and c.Longitude + 0.03) p
    where dist <= 1) q where k = 1)""",
    ]
    return _with(ctes, f"""select c.state, c.Crash_ID, c.Crash_Date, round(c.Latitude, 6) as Latitude, round(c.Longitude, 6) as Longitude, c.Crash_Year,
  n.station_id as Nearest_Station_LocationId, round(n.station_lat, 6) as Station_Lat, round(n.station_lon, 6) as Station_Lon,
  n.Station_Count, n.Station_Year, round(n.dist, 6) as Distance_Miles, abs(c.Crash_Year::bigint - n.Station_Year) as year_gap,
  a.vmt as VMT_Crash, b.vmt as VMT_Station, round(a.vmt / b.vmt, 6) as VMT_Multiplier, round(n.Station_Count * (a.vmt / b.vmt), 6) as Adt_Curnt_Amt,
  c.Crash_Year::bigint as Adt_Curnt_Year,
  case when n.Station_Count is not null and a.vmt / b.vmt is not null then 'NEAREST_STATION_VMT_NORM' else 'MISSING' end as aadt_match_type,
  t.zip::bigint as ZIP_Code
from cr c join tiles t on {INSIDE.format(p='c')} and {state.format('t.n_nationkey')} = c.state
left join nn n on n.Crash_ID = c.Crash_ID left join vmt a on a.state = c.state and a.vmt_year = c.Crash_Year
left join vmt b on b.state = c.state and b.vmt_year = n.Station_Year""")


def _state_validation() -> str:
    boxes = ", ".join(f"('{s.code}', {s.bbox.lat_min}::double, {s.bbox.lat_max}::double, {s.bbox.lon_min}::double, {s.bbox.lon_max}::double)" for s in (STATE, OTHER_STATE))
    return f"""with m as ({_multi_state()}),
moved as (select * replace (Longitude + case when Crash_ID % 20 < 2 then 1 else 0 end as Longitude) from m),
facts as (
  select m.state, m.Crash_Year::bigint as file_year, count(*) as n, count(Adt_Curnt_Amt) as filled,
    count(*) filter (where Latitude < la or Latitude > lb or Longitude < oa or Longitude > ob) as outside
  from moved m join (values {boxes}) b(state, la, lb, oa, ob) on b.state = m.state group by 1, 2)
select state, file_year, 'V03 bounds ' || file_year as validation, outside = 0 as passed, '0 null, ' || outside || ' out-of-state' as msg from facts
union all select state, file_year, 'V07 VMT ' || file_year, true, '0 mismatches (rtol > 1e-09)' from facts
union all select state, file_year, 'V08 AADT ' || file_year, true, '0 mismatches (rtol > 1e-6)' from facts
union all select state, file_year, 'V14 fill rate ' || file_year, true,
  format('{{:,}}', filled) || '/' || format('{{:,}}', n) || printf(' (%.2f%%)', round(100.0::double * filled / n, 2)) from facts"""


ORACLE: dict[str, str] = {
    "state_validation": _state_validation(),
    "multi_state": _multi_state(),
    "clean_stations": _with(STATION_CTES, "select * from stations"),
    "clean_crashes": _with(CRASH_CTES, "select * from crashes"),
    "distinct_rows": _with([CRASHES_RAW], """select distinct * from (
  select * from crashes_raw union all select * from crashes_raw where ZIP_Code::bigint % 2 = 0) t"""),
    "crash_years": _with([CRASHES_RAW], f"""select cast(year(d) as int) as Crash_Year, count(*) as rows, min(d)::date as first_date, max(d)::date as last_date
from (select {DATE} as d from crashes_raw) t group by 1"""),
    "dup_ids_per_year": _with([CRASHES_RAW], f"""select Crash_Year, cast(sum(n) as bigint) as rows, cast(sum(n - 1) as bigint) as duplicate_ids from (
  select cast(year({DATE}) as int) as Crash_Year, Crash_ID, count(*) as n from crashes_raw group by 1, 2) t group by 1"""),
    "station_profile": _with([STATIONS_RAW], """select cast(sum(n) as bigint) as records, count(*) as station_ids, round(avg(n), 6) as mean, round(stddev_samp(n), 6) as std,
  min(n) as min, round(quantile_cont(n, 0.25), 6) as p25, round(quantile_cont(n, 0.5), 6) as p50, round(quantile_cont(n, 0.75), 6) as p75,
  max(n) as max, count(*) filter (where n > 1) as ids_with_several
from (select TRFC_STATN_ID, count(*) as n from stations_raw where TRFC_STATN_ID is not null group by 1) t"""),
    "station_years": _with([STATIONS_RAW], "select LATEST_AADT_YR as Station_Year, count(*) as records from stations_raw group by 1"),
    "unit_xyz": _with(STATION_CTES, f"""select station_id, round(x, 6) as x, round(y, 6) as y, round(z, 6) as z,
  round(2 * {R} * asin(least(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy) + (z - cz) * (z - cz)) / 2, 1.0::double)), 6) as chord_miles
from (select station_id, cos(radians(station_lat)) * cos(radians(station_lon)) as x, cos(radians(station_lat)) * sin(radians(station_lon)) as y,
  sin(radians(station_lat)) as z, cos(radians(30::double)) * cos(radians(-98::double)) as cx, cos(radians(30::double)) * sin(radians(-98::double)) as cy,
  sin(radians(30::double)) as cz from stations) t"""),
    "haversine_pairs": _with([CRASHES_RAW], f"""select Crash_ID, round({_miles('Latitude', 'Longitude', '30::double', '(-98)::double')}, 6) as miles_to_center,
  round({_miles('Latitude', 'Longitude', '29::double', '(-99)::double')}, 6) as miles_to_corner from crashes_raw"""),
    "nearest_within_radius": _with(NEAR_CTES, f"""select Crash_ID, {_r('Latitude, Longitude')}, Crash_Year, Nearest_Station_LocationId,
  {_r('Station_Lat, Station_Lon, Station_Count')}, Station_Year, {_r('Distance_Miles')} from near"""),
    "nearest_unbounded": _with([*CRASH_CTES, *STATION_CTES, FAR], f"""select Crash_ID, {_r('Latitude, Longitude')}, Crash_Year,
  case when dist <= 1 then station_id end as Nearest_Station_LocationId, round(case when dist <= 1 then station_lat end, 6) as Station_Lat,
  round(case when dist <= 1 then station_lon end, 6) as Station_Lon, case when dist <= 1 then Station_Count end as Station_Count,
  case when dist <= 1 then Station_Year end as Station_Year, round(dist, 6) as Distance_Miles from far"""),
    "best_history_year": _with([*NEAR_CTES, _BEST], f"""select Crash_ID, Crash_Year, Nearest_Station_LocationId, Station_Count, Station_Year, year_gap,
  round(Station_Count * (a.vmt / b.vmt), 6) as Adt_Curnt_Amt
from best left join {VMT.format('a')} on a.vmt_year = Crash_Year left join {VMT.format('b')} on b.vmt_year = Station_Year where k = 1"""),
    "history_every_year": _with([CRASHES_RAW, STATIONS_RAW, RECORDS, f"""asked as (select case when Crash_ID % 3 = 0 then 'S7' else concat('S', Crash_ID % 1000) end as id,
    cast(year({DATE}) + Crash_ID % 61 - 30 as int) as Crash_Year, count(*) as rows from crashes_raw group by 1, 2)""",
    """ranked as (select a.*, r.Station_Count, r.Station_Year, abs(a.Crash_Year::bigint - r.Station_Year) as year_gap,
    row_number() over (partition by a.id, a.Crash_Year order by abs(a.Crash_Year::bigint - r.Station_Year) asc nulls last, r.Station_Year desc, r.Station_Count desc) as k
  from asked a left join records r on r.station_id = a.id and a.Crash_Year is not null)"""],
    "select id as Nearest_Station_LocationId, Crash_Year, Station_Count, Station_Year, year_gap, rows from ranked where k = 1"),
    "volume_adjust": _with(ADJUSTED_CTES, f"""select Crash_ID, Crash_Year, Station_Year, Station_Count, year_gap, VMT_Crash, VMT_Station,
  {_r('VMT_Multiplier, Adt_Curnt_Amt')}, Adt_Curnt_Year, aadt_match_type from adjusted"""),
    "zip_edges": _with([TILES], _EDGES),
    "zip_join": _with([*CRASH_CTES, TILES], f"select c.Crash_ID, c.Latitude, c.Longitude, t.zip::bigint as ZIP_Code from crashes c join tiles t on {INSIDE.format(p='c')}"),
    "fuzzy_match": _fuzzy(),
    "brute_force_audit": _with([*OUTPUT_CTES, _AUDIT], """select count(*) as n, count(*) filter (where true_id = Nearest_Station_LocationId) as agree,
  count(*) filter (where true_id <> Nearest_Station_LocationId) as id_mismatches, count(*) filter (where abs(true_d - Distance_Miles) > 1e-4) as distance_mismatches,
  round(max(abs(true_d - Distance_Miles)), 6) as worst_miles,
  count(*) filter (where true_id <> Nearest_Station_LocationId) = 0 and count(*) filter (where abs(true_d - Distance_Miles) > 1e-4) = 0 as passed from audit"""),
    "enriched_output": _with(OUTPUT_CTES, f"select {OUT_COLS} from output"),
    "write_readback": _with(OUTPUT_CTES, """select Crash_Year::int as file_year, count(*) as rows, count(Adt_Curnt_Amt) as filled, round(sum(Adt_Curnt_Amt), 2) as sum_amt,
  cast(sum(ZIP_Code) as bigint) as sum_zip, min(Crash_Year) as first_year, max(Crash_Year) as last_year from output group by 1"""),
    "union_years": _with(OUTPUT_CTES, f"""select * replace (Crash_ID::varchar as Crash_ID,
  case when Crash_Year % 2 = 1 then aadt_match_type end as aadt_match_type) from (select {OUT_COLS} from output) t"""),
    "final_export": _with(OUTPUT_CTES, f"""select Crash_ID, {_r('Latitude, Longitude')}, ZIP_Code, {_r('Adt_Curnt_Amt, Distance_Miles')}, Station_Year,
  year_gap, aadt_match_type, {_r('VMT_Multiplier')} from output"""),
    "sample_filled": _with(OUTPUT_CTES, f"""select Crash_ID, Crash_Year as crash_year, {_r('Latitude, Longitude')}, ZIP_Code, Nearest_Station_LocationId as station_id,
  Station_Count as raw_aadt, Station_Year, {_r('VMT_Multiplier, Adt_Curnt_Amt')}, year_gap, {_r('Distance_Miles')}, aadt_match_type
from output where Adt_Curnt_Amt is not null order by {_MIX}, Crash_ID, output.ZIP_Code limit 10"""),
    "per_year_summary": _with(OUTPUT_CTES, """select Crash_Year, count(*) as rows, count(Adt_Curnt_Amt) as filled,
  count(distinct Nearest_Station_LocationId) as unique_stations, round(count(Adt_Curnt_Amt)::double / count(*) * 100, 2) as pct from output group by 1"""),
    "missing_reasons": _with(OUTPUT_CTES, """select count(*) as total, count(*) filter (where Adt_Curnt_Amt is null) as missing,
  count(*) filter (where Adt_Curnt_Amt is null and (Latitude is null or Longitude is null)) as no_coords,
  count(*) filter (where Adt_Curnt_Amt is null and Latitude is not null and Longitude is not null and Nearest_Station_LocationId is null) as no_station,
  count(*) filter (where Adt_Curnt_Amt is null and Nearest_Station_LocationId is not null and Station_Year is null) as no_station_year,
  count(*) filter (where Adt_Curnt_Amt is null and Nearest_Station_LocationId is not null and Station_Year is not null and VMT_Multiplier is null) as no_vmt
from output"""),
    "fill_totals": _with(OUTPUT_CTES, """select Crash_Year, count(*) as total, count(Adt_Curnt_Amt) as filled, count(*) - count(Adt_Curnt_Amt) as missing,
  round(count(Adt_Curnt_Amt)::double / count(*) * 100, 2) as fill_pct from output group by rollup (Crash_Year)"""),
    "distance_stats": _with(OUTPUT_CTES, """select count(*) as n, round(avg(Distance_Miles), 6) as mean, round(min(Distance_Miles), 6) as min, round(max(Distance_Miles), 6) as max,
  round(quantile_cont(Distance_Miles, 0.5), 6) as median from output where Adt_Curnt_Amt is not null and Distance_Miles between 0 and 1"""),
    "year_gap_dist": _with(OUTPUT_CTES, """select Crash_Year, round(quantile_cont(year_gap, 0.5), 6) as median, round(quantile_cont(year_gap, 0.9), 6) as p90, max(year_gap) as max,
  count(year_gap) as n from output group by 1"""),
    "volume_range": _with(OUTPUT_CTES, """select Crash_Year, count(*) as n, count(*) filter (where v < 10) as too_low, count(*) filter (where v > 500000) as too_high,
  round(quantile_cont(v, 0.05), 4) as p5, round(quantile_cont(v, 0.5), 4) as median, round(quantile_cont(v, 0.95), 4) as p95,
  count(*) filter (where v < 10) < count(*) * 0.01 and count(*) filter (where v > 500000) < count(*) * 0.01 as passed
from (select Crash_Year, Adt_Curnt_Amt as v from output where Adt_Curnt_Amt is not null) t group by 1"""),
    "hist_year_gap": _with([*OUTPUT_CTES, "c as (select year_gap as bin, count(*) as n from output where year_gap is not null group by 1)"],
                           "select b.bin, coalesce(n, 0) as n from (select unnest(range((select max(bin) + 1 from c))) as bin) b left join c on c.bin = b.bin"),
    "hist_distance": _histogram("Distance_Miles", 50),
    "hist_volume": _histogram("Adt_Curnt_Amt", 60, 4),
    "distance_bins": _bins(">="),
    "distance_bins_right_closed": _bins(">"),
    "validation_report": _validation(),
    "csv_crashes": _with([CRASHES_RAW], f"""select Crash_ID, {NOTE_SQL.format(id='Crash_ID').replace(' as string)', ' as varchar)')} as note, Crash_Date,
  round(Latitude, 6) as Latitude, round(Longitude, 6) as Longitude, ZIP_Code from crashes_raw"""),
    "csv_stations": _with(STATION_CTES, "select * from stations"),
    "validation_from_csv": f"""select case when passed then 'pass' else 'FAIL' end as status, validation, passed, msg from (
  select validation, case when validation in ('V01 schema 2017') then false else passed end as passed,
    case when validation = 'V01 schema 2017' then 'missing [''VMT_Multiplier'']' else msg end as msg from ({_validation()}) v) w""",
    "audit_of_errors": _with([*OUTPUT_CTES, _AUDIT, _WRONG], """select count(*) as n, count(*) filter (where true_id = Nearest_Station_LocationId) as agree,
  count(*) filter (where true_id <> Nearest_Station_LocationId) as id_mismatches, count(*) filter (where abs(true_miles - Distance_Miles) > 1e-4) as distance_mismatches,
  round(max(abs(true_miles - Distance_Miles)), 6) as worst_miles,
  count(*) > 0 and count(*) filter (where true_id <> Nearest_Station_LocationId) = 0 and count(*) filter (where abs(true_miles - Distance_Miles) > 1e-4) = 0 as passed from wrong"""),
    "audit_by_year": _with([*OUTPUT_CTES, _AUDIT_YEARS, _WRONG.replace("select c.Crash_ID", "select c.Crash_Year, c.Crash_ID")], """select Crash_Year, count(*) as n,
  count(*) filter (where true_id = Nearest_Station_LocationId) as agree,
  count(*) filter (where true_id <> Nearest_Station_LocationId) as id_mismatches, count(*) filter (where abs(true_miles - Distance_Miles) > 1e-4) as distance_mismatches,
  round(max(abs(true_miles - Distance_Miles)), 6) as worst_miles,
  count(*) filter (where true_id <> Nearest_Station_LocationId) = 0 and count(*) filter (where abs(true_miles - Distance_Miles) > 1e-4) = 0 as passed from wrong group by 1"""),
    "audit_examples": _with([*OUTPUT_CTES, _AUDIT, _WRONG], """select Crash_ID, Nearest_Station_LocationId, round(Distance_Miles, 6) as Distance_Miles, true_id,
  round(true_miles, 6) as true_miles from wrong where true_id <> Nearest_Station_LocationId or abs(true_miles - Distance_Miles) > 1e-4 order by Crash_ID, Nearest_Station_LocationId limit 5"""),
    "zip_overlaps": _with([*CRASH_CTES, TILES], f"""select c.Crash_ID, t.zip::bigint as ZIP_Code, b.by_line from crashes c join tiles t on {INSIDE.format(p='c')}
join (values (1), (2)) as k(k) on k.k = 1 or t.n_nationkey % 2 = 1 or not (c.Longitude >= t.x0 + 0.05::double and c.Longitude <= t.x0 + 0.1::double
  and c.Latitude >= t.y0 + 0.05::double and c.Latitude <= t.y0 + 0.1::double)
join (values (false), (true)) as b(by_line) on true"""),
    "name_match": """with part_names as (select p_partkey as k, concat_ws(' ', p_name, p_brand, p_type) as name from part),
misspelt as (select distinct case k % 3 when 0 then substr(name, 1, (k % length(name))::int) || substr(name, (k % length(name))::int + 2)
  when 1 then replace(name, 'e', 'a') else upper(name) end as name from part_names),
l as (select name, lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) as plain from misspelt),
r as (select lower(regexp_replace(name, '[^A-Za-z0-9]', '', 'g')) as plain, min(name) as name from part_names group by 1),
scored as (select l.name, r.name as other, floor(100::double * (greatest(length(l.plain), length(r.plain)) - levenshtein(l.plain, r.plain))
  / greatest(length(l.plain), length(r.plain)))::int as score from l, r where l.plain <> '' and r.plain <> ''),
best as (select *, row_number() over (partition by name order by score desc, other) as n from scored where score >= 80)
select l.name, best.other as match, best.score from l left join best on best.name = l.name and best.n = 1""",
}
