"""Settings of a run: what varies by state, and the fixed values shared by all states."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed values: these must equal the published ones for results to agree ----

EARTH_RADIUS_MILES = 3958.8
MAX_STATION_MILES = 1.0
FIRST_YEAR, LAST_YEAR = 2015, 2024

FILLED_LABEL = "NEAREST_STATION_VMT_NORM"
MISSING_LABEL = "MISSING"

REQUIRED_COLUMNS = (
    "Crash_ID", "Latitude", "Longitude", "ZIP_Code", "Adt_Curnt_Amt",
    "Distance_Miles", "Station_Year", "year_gap", "aadt_match_type", "VMT_Multiplier",
)

# Statewide vehicle miles travelled, in millions of miles per year.
TEXAS_VMT = {
    2015: 258300, 2016: 270700, 2017: 273200, 2018: 282200, 2019: 288400, 2020: 260000,
    2021: 285200, 2022: 291100, 2023: 301500, 2024: 307800, 2025: 307800,
}

# Spellings under which a canonical column is known to appear in state files.
INCIDENT_NAME_VARIANTS = {
    "Crash_ID": ["Crash_ID", "IncidentID", "CrashID", "Case_ID", "CaseNumber", "ReportNumber", "Accident_ID"],
    "Crash_Date": ["Crash_Date", "IncidentDate", "CrashDate", "Accident_Date", "Date", "IncidentDateTime"],
    "Latitude": ["Latitude", "LATITUDE", "LAT", "Lat", "Y"],
    "Longitude": ["Longitude", "LONGITUDE", "LON", "LONG", "Lng", "X"],
    "ZIP_Code": ["ZIP_Code", "ZIP", "Zip", "ZipCode", "PostalCode", "ZCTA5CE10", "ZipCd"],
}
STATION_NAME_VARIANTS = {
    "id": ["TRFC_STATN_ID", "StationID", "Station_ID", "LocationId", "Location_ID", "STATION_ID", "LocID"],
    "lat": ["LATITUDE", "Latitude", "LAT", "Lat", "Y"],
    "lon": ["LONGITUDE", "Longitude", "LON", "Lng", "LONG", "X"],
    "count": ["LATEST_AADT_QTY", "AADT_RPT_QTY", "AADT", "LastCount_Daily", "Count_Daily", "AADT_Count"],
    "year": ["LATEST_AADT_YR", "AADT_RPT_YEAR", "AADT_YEAR", "LastCountYear", "Count_Year"],
}

# Columns that may hold the incident id in an export, in order of preference.
INCIDENT_ID_NAMES = (
    "Crash_ID", "CrashId", "CrashID", "IncidentId", "Incident_ID", "IncidentID",
    "ReportNumber", "CaseNumber", "Case_ID",
)

# ---- Per-state settings ----


@dataclass(frozen=True)
class BBox:
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float

    def contains(self, lat: Column, lon: Column) -> Column:
        """Closed on all four sides; null coordinates give null."""
        return lat.between(self.lat_min, self.lat_max) & lon.between(self.lon_min, self.lon_max)


@dataclass(frozen=True)
class StateConfig:
    """One state's file layout, bounding box and mileage index."""

    code: str
    bbox: BBox
    vmt: Mapping[int, float]
    incident_columns: Mapping[str, str | None] = field(default_factory=lambda: {
        "Crash_ID": "Crash_ID", "Crash_Date": "Crash_Date", "Latitude": "Latitude",
        "Longitude": "Longitude", "ZIP_Code": "ZIP_Code",
    })
    station_columns: Mapping[str, str] = field(default_factory=lambda: {
        "id": "TRFC_STATN_ID", "lat": "LATITUDE", "lon": "LONGITUDE",
        "count": "LATEST_AADT_QTY", "year": "LATEST_AADT_YR",
    })
    zip_attribute: str = "ZCTA5CE10"
    date_patterns: tuple[str, ...] = ("M/d/yyyy", "M/d/yy")
    preamble_lines: int = 0
    bad_lines: str = "null"


TEXAS = StateConfig(code="TX", bbox=BBox(25.8, 36.5, -106.6, -93.5), vmt=TEXAS_VMT)
STATES = {"TX": TEXAS}


def vmt_table(spark: SparkSession, states: Iterable[StateConfig], by_state: bool = False) -> DataFrame:
    """Mileage index as a dimension table; its size is the settings' size, years times states."""
    rows = ", ".join(f"('{s.code}', {int(y)}, {float(v)!r}D)" for s in states for y, v in s.vmt.items())
    df = spark.sql(f"select * from values {rows} as t(state, vmt_year, vmt)")
    return df if by_state else df.drop("state")


def in_any_bbox(states: Iterable[StateConfig], lat: Column, lon: Column, state: Column | None = None) -> Column:
    """Bounding-box test for one state, or for each row's own state when `state` is given."""
    states = list(states)
    if state is None:
        (only,) = states
        return only.bbox.contains(lat, lon)
    test = F.lit(False)
    for s in states:
        test = test | ((state == s.code) & s.bbox.contains(lat, lon))
    return test
