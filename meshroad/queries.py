"""Registered queries: each takes (spark, sf_dir), reads the given tables whole and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshroad.config import INCIDENT_NAME_VARIANTS, STATION_NAME_VARIANTS, vmt_table
from meshroad.functions import geo
from meshroad.operators import clean, match, nearest, polygons, volume
from meshroad.operators.joins import union_all
from meshroad.plans import reports, validate
from meshroad.plans.enrich import enrich, match_stations
from meshroad.session import materialize, new_table_path
from meshroad.sources import csv, geojson, sinks, testdata
from meshroad.sources.geojson import polygons_from_features
from meshroad.sources.testdata import BOX, STATE

CENTER = (30.0, -98.0)

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded, so that two engines' trigonometry can be compared."""
    return df.selectExpr(*[f"round(`{c}`, {special.get(c, digits)}) as `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes])


def _crashes(spark, d):
    return clean.clean_crashes(testdata.crashes_raw(spark, d), STATE)


def _records(spark, d):
    return clean.canonical_stations(testdata.stations_raw(spark, d), STATE)


def _zips(spark, d):
    return polygons_from_features(testdata.zip_features(spark, d))


def _matched(spark, d):
    return match_stations(_crashes(spark, d), _records(spark, d), STATE)


def _output(spark, d):
    return enrich(testdata.crashes_raw(spark, d), testdata.stations_raw(spark, d), STATE, polygons=_zips(spark, d))


def _written(spark, d):
    """The output written by year to the shared folder and read back."""
    path = new_table_path(spark, "output")
    sinks.write_yearly(_output(spark, d), path)
    return sinks.read_yearly(spark, path)


# ---- cleaning and profiles ----


def clean_stations(spark, d):
    return clean.clean_stations(testdata.stations_raw(spark, d), STATE)


def clean_crashes(spark, d):
    return _crashes(spark, d)


def distinct_rows(spark, d):
    """Distinct rows of a table that holds every crash of an even supplier twice."""
    return testdata.crashes_twice(spark, d).distinct()


def crash_years(spark, d):
    return reports.rows_per_year(testdata.crashes_raw(spark, d), STATE)


def dup_ids_per_year(spark, d):
    return reports.duplicate_ids_per_year(testdata.crashes_raw(spark, d), STATE)


def station_profile(spark, d):
    return _round(reports.station_profile(testdata.stations_raw(spark, d), STATE))


def station_years(spark, d):
    return reports.station_years(testdata.stations_raw(spark, d), STATE)


# ---- geometry ----


def unit_xyz(spark, d):
    here = geo.unit_xyz("station_lat", "station_lon")
    there = geo.unit_xyz(*map(geo.num, CENTER))
    x, y, z = here
    miles = geo.chord_to_miles(geo.chord(here, there))
    return _round(clean_stations(spark, d).selectExpr("station_id", f"{x} as x", f"{y} as y", f"{z} as z", f"{miles} as chord_miles"))


def haversine_pairs(spark, d):
    c = testdata.crashes_raw(spark, d)
    to = lambda lat, lon: geo.haversine_miles("Latitude", "Longitude", geo.num(lat), geo.num(lon))
    return _round(c.selectExpr("Crash_ID", f"{to(*CENTER)} as miles_to_center",
                               f"{to(BOX.lat_min, BOX.lon_min)} as miles_to_corner"))


# ---- joins ----


def nearest_within_radius(spark, d):
    return _round(_matched(spark, d).drop("Crash_Date", "ZIP_Code"))


def nearest_unbounded(spark, d):
    index = nearest.unbounded_index(clean_stations(spark, d), BOX)
    found = nearest.nearest_unbounded(_crashes(spark, d), index)
    return _round(found.drop("Crash_Date", "ZIP_Code"))


def best_history_year(spark, d):
    found = nearest.best_history(_matched(spark, d), _records(spark, d))
    adjusted = volume.adjust_volume(found, vmt_table(spark, [STATE]))
    return _round(adjusted.select(
        "Crash_ID", "Crash_Year", "Nearest_Station_LocationId", "Station_Count", "Station_Year", "year_gap", "Adt_Curnt_Amt"))


def history_every_year(spark, d):
    """Best record for each station and year that is asked for, far outside the processed years too; a third of the rows ask one station."""
    asked = clean.with_crash_year(testdata.crashes_raw(spark, d), STATE).selectExpr(
        "case when Crash_ID % 3 = 0 then 'S7' else concat('S', Crash_ID % 1000) end as Nearest_Station_LocationId",
        "cast(Crash_Year + Crash_ID % 61 - 30 as int) as Crash_Year", "cast(null as double) as Station_Count", "cast(null as bigint) as Station_Year")
    found = nearest.best_history(asked, _records(spark, d))
    return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("rows"))


def volume_adjust(spark, d):
    adjusted = volume.adjust_volume(_matched(spark, d), vmt_table(spark, [STATE]))
    return _round(adjusted.select(
        "Crash_ID", "Crash_Year", "Station_Year", "Station_Count", "year_gap", "VMT_Crash", "VMT_Station",
        "VMT_Multiplier", "Adt_Curnt_Amt", "Adt_Curnt_Year", "aadt_match_type"))


def zip_edges(spark, d):
    return polygons.polygon_edges(_zips(spark, d)).drop("polygon_y_min")


def zip_join(spark, d):
    index = polygons.polygon_index(_zips(spark, d))
    return polygons.assign_zip(_crashes(spark, d), index).select("Crash_ID", "Latitude", "Longitude", "ZIP_Code")


def fuzzy_match(spark, d):
    names = testdata.header_names(spark, d)
    kinds = [("master", INCIDENT_NAME_VARIANTS), ("stations", STATION_NAME_VARIANTS)]
    found = [match.propose_names(names, v).withColumn("kind", F.lit(k)) for k, v in kinds]
    return found[0].unionByName(found[1])


def brute_force_audit(spark, d):
    audit = validate.nearest_audit(_output(spark, d), clean_stations(spark, d))
    return _round(audit)


def multi_state(spark, d):
    """Two states in one job: boxes, mileage, stations and tiles are each state's own."""
    crashes = testdata.with_state(testdata.crashes_raw(spark, d), "Crash_ID")
    stations = testdata.with_state(testdata.stations_raw(spark, d), "cast(substring(trim(TRFC_STATN_ID), 2) as bigint)")
    zips = testdata.with_state(_zips(spark, d), "polygon_id")
    return _round(_two_states(crashes, stations, zips))


def _two_states(crashes, stations, zips):
    return enrich(crashes, stations, STATE, polygons=zips, states=[STATE, testdata.OTHER_STATE], by=["state"])


def state_validation(spark, d):
    """Checks by state and year of the two-state output, some rows of which are moved east, out of one state's box or of both."""
    crashes = testdata.with_state(testdata.crashes_raw(spark, d), "Crash_ID")
    stations = testdata.with_state(testdata.stations_raw(spark, d), "cast(substring(trim(TRFC_STATN_ID), 2) as bigint)")
    out = materialize(_two_states(crashes, stations, testdata.with_state(_zips(spark, d), "polygon_id")), "two-states")
    moved = out.withColumn("Longitude", F.col("Longitude") + F.when(F.col("Crash_ID") % 20 < 2, 1.0).otherwise(0.0)).withColumn("file_year", F.col("Crash_Year"))
    results = validate.validate(moved, STATE, states=[STATE, testdata.OTHER_STATE])
    return results.filter(F.substring("validation", 1, 3).isin("V03", "V07", "V08", "V14")).select("state", "file_year", "validation", "passed", "msg")


# ---- output and reports over it ----


def enriched_output(spark, d):
    return _round(_output(spark, d))


def write_readback(spark, d):
    return _written(spark, d).groupBy(F.col("file_year").cast("int").alias("file_year")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("Adt_Curnt_Amt").alias("filled"),
        F.round(F.sum("Adt_Curnt_Amt"), 2).alias("sum_amt"), F.sum("ZIP_Code").alias("sum_zip"),
        F.min("Crash_Year").alias("first_year"), F.max("Crash_Year").alias("last_year"))


def union_years(spark, d):
    """The years read one folder each and put together again; every second one has its station years as text and no labels."""
    path = new_table_path(spark, "output")
    sinks.write_yearly(_output(spark, d), path)
    years = sorted({r.file_year for r in sinks.yearly_columns(spark, path).collect()})
    slices = []
    for y in years:
        rows = spark.read.parquet(f"{path}/file_year={y}")
        slices.append(rows if y % 2 else rows.withColumn("Station_Year", F.col("Station_Year").cast("string")).drop("aadt_match_type"))
    return _round(sinks.typed_output(union_all(slices).withColumn("Crash_ID", F.col("Crash_ID").cast("string"))))


def final_export(spark, d):
    return _round(reports.final_export(_output(spark, d)))


def sample_filled(spark, d):
    return _round(reports.sample_filled(_output(spark, d)))


def per_year_summary(spark, d):
    return reports.per_year_summary(_output(spark, d))


def missing_reasons(spark, d):
    return reports.missing_reasons(_output(spark, d))


def fill_totals(spark, d):
    return reports.fill_totals(_output(spark, d))


def distance_stats(spark, d):
    return _round(reports.distance_stats(_output(spark, d)))


def year_gap_dist(spark, d):
    return _round(reports.year_gap_distribution(_output(spark, d)))


def volume_range(spark, d):
    return _round(reports.volume_range(_output(spark, d)), 4)


def hist_year_gap(spark, d):
    return reports.unit_histogram(_output(spark, d), "year_gap")


def hist_distance(spark, d):
    return _round(reports.equal_width_histogram(_output(spark, d), "Distance_Miles", 50))


def hist_volume(spark, d):
    return _round(reports.equal_width_histogram(_output(spark, d), "Adt_Curnt_Amt", 60), 4)


def distance_bins(spark, d):
    return reports.distance_bins(_output(spark, d))


def distance_bins_right_closed(spark, d):
    return reports.distance_bins(_output(spark, d), closed="right")


def validation_report(spark, d):
    return validate.validate(_written(spark, d), STATE)


# ---- files ----


def csv_crashes(spark, d):
    """Crashes written as CSV, two column orders, a preamble, a note with commas and quotes, and read back."""
    raw = testdata.crashes_with_notes(spark, d)
    path = new_table_path(spark, "crash-csv")
    orders = (["Crash_ID", "note", "Crash_Date", "Latitude", "Longitude", "ZIP_Code"], ["ZIP_Code", "Longitude", "Latitude", "Crash_Date", "note", "Crash_ID"])
    for k, columns in enumerate(orders):
        rows = raw.filter(F.col("Crash_ID") % 2 == k).select(*columns)
        testdata.write_csv_text(rows, f"{path}/{k}", preamble=[f"export {k}", "columns, as follows", ",".join(columns)])
    back = csv.read_csv_text(spark, [f"{path}/0", f"{path}/1"], preamble_lines=2)
    return _round(back.select(F.col("Crash_ID").try_cast("bigint").alias("Crash_ID"), "note", "Crash_Date", F.col("Latitude").try_cast("double").alias("Latitude"),
                              F.col("Longitude").try_cast("double").alias("Longitude"), "ZIP_Code"))


def csv_stations(spark, d):
    """Stations written as CSV with a header with spaces, a blank name and a column too many, read back and cleaned."""
    path = new_table_path(spark, "station-csv")
    raw = testdata.stations_raw(spark, d).select(F.lit("x").alias(""), F.col("TRFC_STATN_ID").alias(" TRFC_STATN_ID "), "LATITUDE", "LONGITUDE",
                                                 "LATEST_AADT_QTY", F.col("LATEST_AADT_YR").alias("LATEST_AADT_YR "))
    testdata.write_csv_text(raw, path)
    return clean.clean_stations(csv.read_stations(spark, path, STATE), STATE)


def validation_from_csv(spark, d):
    """Yearly CSV files, one year without a required column and one in another order, read back and validated."""
    out, path = _output(spark, d), new_table_path(spark, "output-csv")
    out = out.withColumn("Crash_ID", F.col("Crash_ID").cast("string")).withColumn("year_tag", F.col("Crash_Year"))
    out = materialize(out, "output")
    sinks.write_yearly(out.filter("year_tag not in (2017, 2018)").drop("year_tag"), path, fmt="csv")
    sinks.write_yearly(out.filter("year_tag = 2017").drop("year_tag", "VMT_Multiplier"), path, fmt="csv")
    sinks.write_yearly(out.filter("year_tag = 2018").select(*reversed(out.drop("year_tag").columns)), path, fmt="csv")
    results = validate.validate(sinks.read_yearly(spark, path, fmt="csv"), STATE, present=sinks.yearly_columns(spark, path, "csv"))
    where = new_table_path(spark, "results")
    sinks.write_validation(results, where)
    return sinks.read_validation(spark, where).select("status", "validation", "passed", "msg")


def _misplaced(spark, d):
    """The output with every tenth match moved to a station that does not exist or a wrong distance."""
    return _output(spark, d).withColumns({
        "Nearest_Station_LocationId": F.when((F.col("Crash_ID") % 10 == 0) & F.col("Nearest_Station_LocationId").isNotNull(), "nowhere").otherwise(F.col("Nearest_Station_LocationId")),
        "Distance_Miles": F.when(F.col("Crash_ID") % 10 == 1, F.col("Distance_Miles") + 0.5).otherwise(F.col("Distance_Miles"))})


def audit_of_errors(spark, d):
    return _round(validate.nearest_audit(_misplaced(spark, d), clean_stations(spark, d)))


def audit_by_year(spark, d):
    return _round(validate.audit_by_year(_misplaced(spark, d), clean_stations(spark, d)))


def audit_examples(spark, d):
    return _round(validate.audit_examples(_misplaced(spark, d), clean_stations(spark, d)))


def name_match(spark, d):
    """Part names with a letter left out, and some with another one in place, matched to the right ones."""
    part = spark.read.parquet(f"{d}/part.parquet").selectExpr("p_partkey as k", "concat_ws(' ', p_name, p_brand, p_type) as name")
    misspelt = part.selectExpr("case k % 3 when 0 then concat(substr(name, 1, cast(k % length(name) as int)), substr(name, cast(k % length(name) as int) + 2)) "
                               "when 1 then replace(name, 'e', 'a') else upper(name) end as name")
    return match.match_names(misspelt, part)


def zip_overlaps(spark, d):
    """Tiles, each a second time under the same code, and one with a hole, read from GeoJSON in both layouts."""
    document, lines = (new_table_path(spark, f"geojson-{k}") for k in ("document", "lines"))
    features = testdata.geojson_features(spark, d)
    features.write.text(lines)
    features.groupBy().agg(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), F.array_join(F.collect_list("value"), ","), F.lit("]}")).alias("value")).write.text(document)
    parts = []
    for path, by_line in ((document, False), (lines, True)):
        index = polygons.polygon_index(geojson.read_zip_polygons(spark, path, line_delimited=by_line))
        parts.append(polygons.assign_zip(_crashes(spark, d), index).select("Crash_ID", "ZIP_Code").withColumn("by_line", F.lit(by_line)))
    return parts[0].union(parts[1])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_stations, clean_crashes, distinct_rows, crash_years, dup_ids_per_year, station_profile, station_years,
        unit_xyz, haversine_pairs, nearest_within_radius, nearest_unbounded, best_history_year, volume_adjust, zip_edges,
        zip_join, fuzzy_match, brute_force_audit, multi_state, enriched_output, write_readback, union_years, final_export,
        sample_filled, per_year_summary, missing_reasons, fill_totals, distance_stats, year_gap_dist, volume_range,
        hist_year_gap, hist_distance, hist_volume, distance_bins, distance_bins_right_closed, validation_report,
        csv_crashes, csv_stations, validation_from_csv, audit_of_errors, audit_examples, zip_overlaps, name_match, audit_by_year,
        state_validation, history_every_year,
    )
}
