"""The enrichment job: cleaned crashes in, output rows with volume and ZIP out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from meshroad.config import MAX_STATION_MILES, StateConfig, vmt_table
from meshroad.operators.clean import canonical_stations, clean_crashes, latest_per_station
from meshroad.operators.nearest import nearest_in_radius
from meshroad.operators.polygons import assign_zip, polygon_index
from meshroad.operators.volume import adjust_volume

# Names and types of the output, in its order.
OUTPUT_SCHEMA = {
    "Crash_ID": "string", "Crash_Date": "string", "Latitude": "double", "Longitude": "double", "Crash_Year": "int",
    "Nearest_Station_LocationId": "string", "Station_Lat": "double", "Station_Lon": "double", "Station_Count": "double",
    "Station_Year": "bigint", "Distance_Miles": "double", "year_gap": "bigint", "VMT_Crash": "double", "VMT_Station": "double",
    "VMT_Multiplier": "double", "Adt_Curnt_Amt": "double", "Adt_Curnt_Year": "bigint", "aadt_match_type": "string", "ZIP_Code": "bigint",
}
OUTPUT_COLUMNS = tuple(OUTPUT_SCHEMA)


def match_stations(
    crashes: DataFrame, station_records: DataFrame, state: StateConfig, *,
    radius_miles: float = MAX_STATION_MILES, by: Sequence[str] = (),
) -> DataFrame:
    """Nearest station of each crash, from station-year records (latest year per station)."""
    box = state.bbox
    return nearest_in_radius(
        crashes, latest_per_station(station_records, by), radius_miles=radius_miles, by=by,
        max_abs_lat=max(abs(box.lat_min), abs(box.lat_max)), crowd_bound=station_records,
    )


def enrich(
    crashes_raw: DataFrame, stations_raw: DataFrame, state: StateConfig, *,
    polygons: DataFrame | None = None, states: Sequence[StateConfig] | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Clean, match, scale and, given polygons, assign the ZIP code.

    With `by=("state",)` and `states`, several states run as one job: the state is part of every
    dedupe, cell and mileage key, so a crash only meets stations and polygons of its own state.
    ZIP assignment runs first because it drops rows; it does not depend on the match.
    """
    crashes = clean_crashes(crashes_raw, state, states=states, by=by)
    records = canonical_stations(stations_raw, state, by)
    if polygons is not None:
        crashes = assign_zip(crashes, polygon_index(polygons, by=by))
    matched = match_stations(crashes, records, state, by=by)
    vmt = vmt_table(crashes.sparkSession, states or [state], by_state="state" in by)
    out = adjust_volume(matched, vmt, by)
    return out.select(*by, *[c for c in OUTPUT_COLUMNS if c in out.columns])
