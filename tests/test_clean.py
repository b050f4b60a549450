from meshroad.config import BBox, StateConfig, TEXAS
from meshroad.operators import clean

import pytest


def stations(spark, rows):
    cols = "TRFC_STATN_ID string, LATITUDE string, LONGITUDE string, LATEST_AADT_QTY string, LATEST_AADT_YR string"
    return clean.clean_stations(spark.createDataFrame(rows, cols), TEXAS).orderBy("station_id").collect()


def test_station_rows_without_position_or_count_go(spark):
    rows = [(" A ", "30", "-97", "10", "2016"), ("B", "NaN", "-97", "10", "2016"), ("C", "30", None, "10", "2016"),
            ("D", "30", "-97", "0", "2016"), ("E", "30", "-97", "-3", "2016"), ("F", "30", "-97", "n/a", "2016"),
            ("G", "30", "-97", None, "2016"), ("H", "30", "-97", "5", "2016.0"), ("I", "30", "-97", "5", "x")]
    got = stations(spark, rows)
    assert [(r.station_id, r.Station_Year) for r in got] == [("A", 2016), ("H", 2016), ("I", None)]


def test_latest_year_wins_and_missing_year_loses(spark):
    rows = [("A", "30", "-97", "1", None), ("A ", "31", "-97", "2", "2016"), ("A", "32", "-97", "3", "2019"),
            ("A", "33", "-97", "9", "2019"), (None, "30", "-97", "1", "2016"), (None, "30", "-97", "1", "2017")]
    got = {r.station_id: (r.Station_Year, r.Station_Count) for r in stations(spark, rows)}
    assert got == {"A": (2019, 9.0), None: (2017, 1.0)}


def crashes(spark, rows, state=TEXAS):
    cols = "Crash_ID string, Crash_Date string, Latitude string, Longitude string, ZIP_Code string"
    return clean.clean_crashes(spark.createDataFrame(rows, cols), state).collect()


def test_dates_in_both_styles(spark):
    rows = [("1", "06/07/2023", "30", "-97", None), ("2", "6/7/23", "30", "-97", None), ("3", "13/45/2023", "30", "-97", None),
            ("4", "", "30", "-97", None), ("5", "01/01/2014", "30", "-97", None), ("6", "01/01/2025", "30", "-97", None),
            ("7", "12/31/15", "30", "-97", None)]
    assert {r.Crash_ID: r.Crash_Year for r in crashes(spark, rows)} == {"1": 2023, "2": 2023, "7": 2015}


def test_box_is_closed(spark):
    box = TEXAS.bbox
    edges = [(box.lat_min, box.lon_min), (box.lat_max, box.lon_max), (box.lat_min - 1e-9, -97), (30, box.lon_max + 1e-9)]
    rows = [(str(i), "1/1/2020", repr(float(a)), repr(float(o)), None) for i, (a, o) in enumerate(edges)]
    assert sorted(r.Crash_ID for r in crashes(spark, rows)) == ["0", "1"]


def test_dedupe_comes_before_the_filters(spark):
    # The copy that sorts first has bad coordinates, so the crash is lost, as for any copy kept blindly.
    rows = [("1", "1/1/2020", "0", "-97", None), ("1", "1/1/2020", "30", "-97", None),
            ("2", "1/1/2020", None, "-97", None), ("2", "1/1/2020", "30", "-97", None),
            (None, "1/1/2020", "30", "-97", "a"), (None, "1/1/2020", "30", "-97", "b")]
    got = {r.Crash_ID: r.ZIP_Code for r in crashes(spark, rows)}
    assert got == {"2": None, None: "a"}


def test_dedupe_does_not_depend_on_order_or_partitions(spark):
    rows = [(str(i % 7), f"1/{1 + i % 5}/2020", str(30 + i % 3), "-97", str(i)) for i in range(200)]
    cols = "Crash_ID string, Crash_Date string, Latitude string, Longitude string, ZIP_Code string"
    a = clean.dedupe_crashes(spark.createDataFrame(rows, cols).repartition(1))
    b = clean.dedupe_crashes(spark.createDataFrame(rows[::-1], cols).repartition(13))
    assert sorted(a.collect()) == sorted(b.collect())


def test_missing_columns_are_reported(spark):
    with pytest.raises(ValueError, match="LATITUDE"):
        clean.canonical_stations(spark.createDataFrame([("a",)], "TRFC_STATN_ID string"), TEXAS)


def test_rename_maps_source_names_and_skips_absent(spark):
    df = spark.createDataFrame([("7", "x", "y")], "IncidentID string, `When It Was` string, other string")
    got = clean.rename_columns(df, {"Crash_ID": "IncidentID", "Crash_Date": "When It Was", "ZIP_Code": None})
    assert got.columns == ["Crash_ID", "Crash_Date"] and tuple(got.first()) == ("7", "x")


def test_several_states_in_one_run(spark):
    other = StateConfig(code="XX", bbox=BBox(10, 11, 10, 11), vmt={2020: 1})
    cols = "state string, Crash_ID string, Crash_Date string, Latitude string, Longitude string, ZIP_Code string"
    df = spark.createDataFrame([("TX", "1", "1/1/2020", "30", "-97", None), ("XX", "1", "1/1/2020", "10.5", "10.5", None),
                                ("XX", "2", "1/1/2020", "30", "-97", None)], cols)
    got = clean.clean_crashes(df, TEXAS, states=[TEXAS, other], by=["state"])
    assert sorted((r.state, r.Crash_ID) for r in got.collect()) == [("TX", "1"), ("XX", "1")]
