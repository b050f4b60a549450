"""Stations, crashes and ZIP tiles derived by Spark from the TPC-H-like tables.

The SQL texts run unchanged in Spark and in an ANSI database, which makes them usable by both
sides of a comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshroad.config import BBox, StateConfig, TEXAS_VMT

BOX = BBox(29.0, 31.0, -99.0, -97.0)
STATE = StateConfig(code="TX", bbox=BOX, vmt=TEXAS_VMT)

STATIONS_SQL = """
select concat(' S', cast(cast(floor(p_partkey/2) as bigint) as string), ' ') as TRFC_STATN_ID,
  case when p_partkey % 41 = 0 then null else cast(29 as double) + cast((cast(floor(p_partkey/2) as bigint)*7919) % 20011 as double)/cast(10000 as double) end as LATITUDE,
  case when p_partkey % 41 = 0 then null else cast(-99 as double) + cast((cast(floor(p_partkey/2) as bigint)*104729) % 20021 as double)/cast(10000 as double) end as LONGITUDE,
  case when p_partkey % 37 = 0 then cast(0 as double) else floor(p_retailprice*10) end as LATEST_AADT_QTY,
  case when p_size = 50 then null else cast(2010 + p_size % 16 as bigint) end as LATEST_AADT_YR
from {part}"""

CRASHES_SQL = """
select l_orderkey as Crash_ID,
  case when l_partkey % 97 = 0 then 'unknown' else concat(lpad(cast(month(l_shipdate) as string),2,'0'), '/', lpad(cast(day(l_shipdate) as string),2,'0'), '/',
    case when l_linenumber % 3 = 0 then substring(cast(year(l_shipdate)+20 as string),3,2) else cast(year(l_shipdate)+20 as string) end) end as Crash_Date,
  case when l_partkey % 53 = 0 then null else cast(28.99 as double) + cast((l_orderkey*15485 + l_linenumber*3245) % 20211 as double)/cast(10000 as double) end as Latitude,
  cast(-99.01 as double) + cast((l_orderkey*27644 + l_linenumber*6793) % 20219 as double)/cast(10000 as double) as Longitude,
  cast(70000 + l_suppkey as string) as ZIP_Code
from {lineitem}"""

TILES_SQL = """
select n_nationkey, cast(78000 + n_nationkey as string) as zip,
  cast(-99 as double) + cast(4000*u+200 as double)/cast(10000 as double) as x0,
  cast(-99 as double) + cast(4000*u+2000 as double)/cast(10000 as double) as xm,
  cast(-99 as double) + cast(4000*u+3800 as double)/cast(10000 as double) as x1,
  cast(29 as double) + cast(4000*v+200 as double)/cast(10000 as double) as y0,
  cast(29 as double) + cast(4000*v+2000 as double)/cast(10000 as double) as ym,
  cast(29 as double) + cast(4000*v+3800 as double)/cast(10000 as double) as y1
from (select n_nationkey, n_nationkey % 5 as u, cast(floor(n_nationkey/5) as bigint) as v from {nation}) t"""


SCHEMAS = {
    "part": "p_partkey bigint, p_size int, p_retailprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int",
    "customer": "c_custkey bigint, c_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns used here, with their types stated rather than looked up in the files."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(STATIONS_SQL, part=table(spark, sf_dir, "part"))


def crashes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CRASHES_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def zip_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TILES_SQL, nation=table(spark, sf_dir, "nation"))


def zip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles as GeoJSON polygon features: `polygon_id`, `zip`, `geometry_type`, `coordinates` text."""
    ring = ("array(array(x0, y0), array(x1, y0), array(x1, ym), array(xm, ym), array(xm, y1), "
            "array(x0, y1), array(x0, y0))")
    return zip_tiles(spark, sf_dir).selectExpr(
        "cast(n_nationkey as bigint) as polygon_id", "zip", "'Polygon' as geometry_type",
        f"to_json(array({ring})) as coordinates")


# A second state over the same area with a mileage index of its own, to run two states as one job.
OTHER_STATE = StateConfig(code="XX", bbox=BBox(29.5, 30.5, -98.5, -97.5), vmt={y: 1000.0 + 10 * (y - 2010) for y in range(2010, 2024)})


def with_state(df: DataFrame, number: str) -> DataFrame:
    """Give every second id to the other state."""
    return df.selectExpr(f"if({number} % 2 = 0, '{STATE.code}', '{OTHER_STATE.code}') as state", "*")


# Column-like names: known spellings with one letter dropped, by part, and the customers' names.
HEADER_NAMES_SQL = """
select name, position from (
  select concat(substring(word, 1, n - 1), substring(word, n + 1)) as name, position
  from (select word, position, 1 + (cast(floor(position / 16) as bigint) % length(word)) as n
        from (select p_partkey as position, split_part('{words}', ',', cast(1 + p_partkey % 16 as int)) as word from {part}) a) b
  union all
  select c_name as name, 1000000000000 + c_custkey as position from {customer}
) t"""
HEADER_WORDS = (
    "IncidentID,CrashDate,Latitude,Longitude,PostalCode,ReportNumber,IncidentDateTime,ZipCode,"
    "LocationId,LATITUDE,LONGITUDE,LastCount_Daily,LastCountYear,AADT_Count,Station_ID,Date"
)


def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = HEADER_NAMES_SQL.replace("{words}", HEADER_WORDS)
    return spark.sql(text, part=table(spark, sf_dir, "part"), customer=table(spark, sf_dir, "customer"))


def crashes_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crashes, those with an even ZIP code twice: full duplicates, as the original files have them."""
    raw = crashes_raw(spark, sf_dir)
    return raw.union(raw.filter("cast(ZIP_Code as bigint) % 2 = 0"))


NOTE_SQL = """concat('said "no, ', cast({id} % 7 as string), '" twice, then ""', cast({id} % 3 as string), '""')"""


def crashes_with_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crashes_raw(spark, sf_dir).selectExpr("*", f"{NOTE_SQL.format(id='Crash_ID')} as note")


def write_csv_text(rows: DataFrame, path: str, preamble: list[str] | None = None) -> None:
    """Rows as CSV lines; with a preamble, each file begins with its lines, and the header is the caller's last one."""
    fields = [F.concat(F.lit('"'), F.replace(F.col(f"`{c}`").cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in rows.columns]
    line = F.concat_ws(",", *[F.coalesce(f, F.lit("")) for f in fields])
    head = preamble or [",".join(rows.columns)]
    # The low 33 bits of the id count the rows of a partition, which is one file.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    with_head = F.when(first, F.array(*map(F.lit, head), line)).otherwise(F.array(line))
    rows.select(F.explode(with_head).alias("value")).write.text(path)


def geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per row: every tile twice, in the second copy of the tiles with even codes with a hole in its lower left part."""
    ring = "array(array(x0, y0), array(x1, y0), array(x1, ym), array(xm, ym), array(xm, y1), array(x0, y1), array(x0, y0))"
    hole = "array(array(x0 + 0.05D, y0 + 0.05D), array(x0 + 0.05D, y0 + 0.1D), array(x0 + 0.1D, y0 + 0.1D), array(x0 + 0.1D, y0 + 0.05D), array(x0 + 0.05D, y0 + 0.05D))"
    tiles = zip_tiles(spark, sf_dir)
    feature = ("to_json(named_struct('type', 'Feature', 'properties', named_struct('ZCTA5CE10', zip), "
               "'geometry', named_struct('type', 'Polygon', 'coordinates', {rings})))")
    return tiles.selectExpr(feature.format(rings=f"array({ring})") + " as value").union(
        tiles.selectExpr(f"if(n_nationkey % 2 = 0, {feature.format(rings=f'array({ring}, {hole})')}, {feature.format(rings=f'array({ring})')}) as value"))
