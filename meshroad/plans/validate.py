"""Data-quality checks over the yearly output: one aggregate per year, one result row per check."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshroad.config import (EARTH_RADIUS_MILES, FILLED_LABEL, MAX_STATION_MILES, MISSING_LABEL, REQUIRED_COLUMNS,
                             StateConfig, vmt_table)
from meshroad.functions.geo import haversine_miles, num
from meshroad.operators.nearest import TIE_STEPS_PER_MILE
from meshroad.operators.quantiles import exact_quantiles
from meshroad.operators.volume import with_vmt
from meshroad.plans.reports import shuffled_order
from meshroad.session import BROADCAST_BYTES, materialize

VMT_TOLERANCE = 1e-9
AMOUNT_TOLERANCE = 1e-6
DISTANCE_TOLERANCE = 1e-4


def _thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def _whole(x: Column) -> Column:
    return F.bround(x, 0).cast("bigint")


def validate(out: DataFrame, state: StateConfig, year: str = "file_year", *, present: DataFrame | None = None,
             radius_miles: float = MAX_STATION_MILES, states: Sequence[StateConfig] = ()) -> DataFrame:
    """Checks V01 to V09 and V12 to V14 for each value of `year`, the tag of the file a row is from.

    With `states` the output has a `state` column, and there is a result for each state and year: box and mileage are
    those of the row's state, joined from a table of the settings. A state without settings has no box to be in.

    `present` (`file_year`, `column`) holds the columns of each year's own file, for V01; without it all years
    have the columns of `out`. A year with a header and no row has no result. `radius_miles` is that of the run.

    Returns `file_year`, `validation`, `passed`, `status`, `msg`. All checks share one scan, except
    the volume quantiles, which are exact on groups of any size and therefore take their own.
    """
    columns = [c for c in out.columns if c != year]
    have = lambda c: F.col(c) if c in out.columns else F.lit(None).cast("double")
    lat, lon, amount, dist = have("Latitude"), have("Longitude"), have("Adt_Curnt_Amt"), have("Distance_Miles")
    multiplier, station_year, gap, label = have("VMT_Multiplier"), have("Station_Year"), have("year_gap"), have("aadt_match_type")
    by = ["state"] if states else []
    group = [*by, "file_year"]
    filled = amount.isNotNull()

    base = out.withColumns({c: have(c) for c in ("Crash_Year", "Station_Year") if c not in out.columns})
    settings = list(states) or [state]
    vmt = vmt_table(out.sparkSession, settings, by_state=bool(by))
    base = with_vmt(with_vmt(base, vmt, "Crash_Year", "_vmt_crash", by), vmt, "Station_Year", "_vmt_station", by)
    sides = ("lat_min", "lat_max", "lon_min", "lon_max")
    boxes = out.sparkSession.createDataFrame(  # one row for each state of the settings
        [(s.code, *(float(getattr(s.bbox, x)) for x in sides)) for s in settings], "state string, " + ", ".join(f"_{x} double" for x in sides))
    base = base.join(F.broadcast(boxes), "state", "left") if by else base.withColumns(
        {f"_{x}": F.lit(float(getattr(state.bbox, x))) for x in sides})
    expected = F.try_divide("_vmt_crash", "_vmt_station")
    vmt_wrong = expected.isNull() | (F.abs(F.try_divide(expected - multiplier, expected)) > VMT_TOLERANCE)
    product = have("Station_Count") * multiplier
    # A zero amount cannot be compared in relative terms: it is right only if the product is zero.
    amount_wrong = F.when(amount == 0, product != 0).otherwise(F.abs((product - amount) / amount) > AMOUNT_TOLERANCE)
    count_if = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))

    outside = F.col("_lat_min").isNull() | (lat < F.col("_lat_min")) | (lat > F.col("_lat_max")) | (lon < F.col("_lon_min")) | (lon > F.col("_lon_max"))
    facts = base.groupBy(*by, F.col(year).cast("bigint").alias("file_year")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(amount).alias("filled"),
        F.min("Crash_Year").alias("first_year"), F.max("Crash_Year").alias("last_year"),
        count_if(lat.isNull() | lon.isNull()).alias("null_xy"),
        count_if(outside).alias("outside"),
        count_if(filled & (dist > radius_miles)).alias("too_far"), F.max(F.when(filled, dist)).alias("farthest"),
        count_if(have("ZIP_Code").isNull()).alias("null_zip"),
        count_if(station_year.isNotNull() & gap.isNotNull()
                 & (F.abs(F.col("Crash_Year").cast("bigint") - station_year) != gap)).alias("bad_gap"),
        count_if(multiplier.isNotNull() & station_year.isNotNull() & vmt_wrong).alias("bad_vmt"),
        count_if(filled & amount_wrong).alias("bad_amount"),
        count_if(filled & (label != FILLED_LABEL)).alias("bad_filled"),
        count_if(~filled & (label != MISSING_LABEL)).alias("bad_missing"),
        F.percentile(gap, F.lit(0.5)).alias("gap_median"), F.percentile(gap, F.lit(0.9)).alias("gap_p90"),
        F.max(gap).cast("bigint").alias("gap_max"), F.count(gap).alias("gaps"),
        count_if(amount < 10).alias("too_low"), count_if(amount > 500_000).alias("too_high"),
    )
    spread = exact_quantiles(out.select(*by, F.col(year).cast("bigint").alias("file_year"), amount.alias("v")), "v",
                             {"p5": 0.05, "median": 0.5, "p95": 0.95}, by=group)
    facts = facts.join(F.broadcast(spread), group, "left")  # one row per state and year

    if present is None:
        facts = facts.withColumn("columns", F.array(*map(F.lit, columns)))
    else:  # at most the names of one file in a row
        named = present.groupBy(F.col("file_year").cast("bigint").alias("file_year")).agg(F.collect_set("column").alias("columns"))
        facts = facts.join(F.broadcast(named), "file_year", "left").withColumn("columns", F.coalesce("columns", F.array().cast("array<string>")))
    facts = facts.withColumn("absent", F.array_except(F.array(*map(F.lit, REQUIRED_COLUMNS)), "columns"))

    c = F.col
    required = len(REQUIRED_COLUMNS)
    schema_msg = F.when(F.size("absent") > 0, F.concat(F.lit("missing ['"), F.array_join("absent", "', '"), F.lit("']"))).otherwise(
        F.concat(F.lit(f"{required}/{required} present, "), F.size("columns").cast("string"), F.lit(" cols total")))
    one_year = c("first_year") == c("last_year")
    in_tail = lambda n: c(n) < c("filled") * 0.01
    pct = F.round(F.when(c("rows") > 0, F.lit(100.0) * c("filled") / c("rows")).otherwise(0.0), 2)
    checks = [
        ("V01 schema", F.size("absent") == 0, schema_msg),
        ("V02 Crash_Year", one_year & (c("first_year").cast("bigint") == c("file_year")),
         F.concat(F.lit("distinct values = ["), F.when(one_year, c("first_year").cast("string")).when(
             c("first_year").isNull(), "").otherwise(F.concat_ws(" to ", "first_year", "last_year")), F.lit("]"))),
        ("V03 bounds", (c("null_xy") == 0) & (c("outside") == 0),
         F.format_string("%d null, %d out-of-state", "null_xy", "outside")),
        ("V04 dist cap", c("too_far") == 0,
         F.concat(F.format_string("%d violations; max Distance_Miles among filled = ", "too_far"),
                  F.coalesce(F.when(c("farthest").isNotNull(), F.format_string("%.4f", F.round("farthest", 4))), F.lit("none")))),
        ("V05 ZIP", c("null_zip") == 0, F.format_string("%d null ZIP rows", "null_zip")),
        ("V06 year_gap", c("bad_gap") == 0, F.format_string("%d mismatches", "bad_gap")),
        ("V07 VMT", c("bad_vmt") == 0, F.format_string("%d mismatches (rtol > 1e-09)", "bad_vmt")),
        ("V08 AADT", c("bad_amount") == 0, F.format_string("%d mismatches (rtol > 1e-6)", "bad_amount")),
        ("V09 match_type", (c("bad_filled") == 0) & (c("bad_missing") == 0),
         F.format_string("%d filled+wrong-label, %d missing+wrong-label", "bad_filled", "bad_missing")),
        ("V12 year_gap dist", c("gaps") > 0,
         F.when(c("gaps") == 0, "no filled rows").otherwise(F.concat(
             F.format_string("median=%d, p90=%d, max=%d, n=", _whole(c("gap_median")), _whole(c("gap_p90")), c("gap_max")),
             _thousands(c("gaps"))))),
        ("V13 AADT range", (c("filled") > 0) & in_tail("too_low") & in_tail("too_high"),
         F.when(c("filled") == 0, "no filled rows").otherwise(F.concat(
             F.lit("median="), _thousands(_whole(c("median"))), F.lit(", p5="), _thousands(_whole(c("p5"))),
             F.lit(", p95="), _thousands(_whole(c("p95"))),
             F.format_string(", <10: %d, >500k: %d", "too_low", "too_high")))),
        ("V14 fill rate", F.lit(True),
         F.concat(_thousands(c("filled")), F.lit("/"), _thousands(c("rows")), F.format_string(" (%.2f%%)", pct))),
    ]
    rows = F.explode(F.array(*[
        F.struct(F.concat(F.lit(name + " "), c("file_year").cast("string")).alias("validation"),
                 F.coalesce(passed, F.lit(False)).alias("passed"), msg.alias("msg"))
        for name, passed, msg in checks]))
    return facts.select(*group, rows.alias("r")).select(
        *group, "r.validation", "r.passed", F.when(c("r.passed"), "pass").otherwise("FAIL").alias("status"), "r.msg")


def totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count_if("passed").alias("n_pass"), F.count_if(~F.col("passed")).alias("n_fail"))


def _audited(out: DataFrame, stations: DataFrame, n: int, seed: int, radius_miles: float, each_year: bool = False) -> DataFrame:
    """Up to `n` sampled matched crashes of the last year, or of each year, with the truly nearest station within reach.

    Independent of the grid index: every station whose latitude is within the radius is tried. No station outside
    that belt can beat a match within the radius. A crash with no station in reach has none, so its match is wrong.
    The sample is the broadcast side, at most three rows per sampled crash; the stations are only streamed through.
    """
    matched = out.filter(F.col("Nearest_Station_LocationId").isNotNull()).select(
        "Crash_ID", "Crash_Year", "Latitude", "Longitude", "Nearest_Station_LocationId", "Distance_Miles")
    order = shuffled_order(F.col("Crash_ID"), seed) if dict(out.dtypes)["Crash_ID"] in ("bigint", "int") else F.xxhash64("Crash_ID", F.lit(seed))
    ordered = matched.withColumn("_order", order)
    if each_year:
        # Every task keeps its first n rows of each year before they are sent to one place.
        first = Window.partitionBy("Crash_Year").orderBy("_order", "Crash_ID")
        sample = materialize(ordered.withColumn("_k", F.row_number().over(first)).filter(F.col("_k") <= n).drop("_k", "_order"), "sample")
    else:
        top = materialize(ordered.orderBy(F.col("Crash_Year").desc(), "_order", "Crash_ID").limit(n), "sample")
        last = top.groupBy().agg(F.max("Crash_Year").alias("Crash_Year"))
        sample = top.join(F.broadcast(last), "Crash_Year").drop("_order")
    belt = lambda lat: f"floor({lat} / {num(math.degrees(radius_miles / EARTH_RADIUS_MILES) * 1.000001)})"
    asked = sample.filter("abs(Latitude) <= 90").select("Crash_ID", "Latitude", "Longitude").distinct().selectExpr(
        "*", f"explode(sequence({belt('Latitude')} - 1, {belt('Latitude')} + 1)) as _belt")
    belts = stations.filter("abs(station_lat) <= 90").selectExpr("*", f"{belt('station_lat')} as _belt")
    small = not each_year or sample.count() * 3 * 64 <= BROADCAST_BYTES
    tried = belts.join(F.broadcast(asked) if small else asked.hint("shuffle_merge"), "_belt")
    d = F.expr(haversine_miles("Latitude", "Longitude", "station_lat", "station_lon"))
    steps = F.floor(d * F.lit(TIE_STEPS_PER_MILE) + F.lit(0.5))
    found = tried.groupBy("Crash_ID", "Latitude", "Longitude").agg(
        F.min(F.struct(steps.alias("steps"), F.col("station_id").alias("id"), d.alias("d"))).alias("best"))
    joined = sample.join(found, ["Crash_ID", "Latitude", "Longitude"], "left")
    near = F.col("best.d") <= radius_miles
    return joined.select(
        *sample.columns, F.when(near, F.col("best.id")).alias("true_id"), F.when(near, F.col("best.d")).alias("true_miles")).withColumns({
            "same_id": F.coalesce(F.col("true_id") == F.col("Nearest_Station_LocationId"), F.lit(False)),
            "miles_off": F.abs(F.col("true_miles") - F.col("Distance_Miles"))})


def nearest_audit(out: DataFrame, stations: DataFrame, *, n: int = 1000, seed: int = 42, radius_miles: float = MAX_STATION_MILES) -> DataFrame:
    """V10: recompute the nearest station of sampled crashes. An audit of no crash does not pass."""
    rows = _audited(out, stations, n, seed, radius_miles)
    far = ~F.coalesce(F.col("miles_off") <= DISTANCE_TOLERANCE, F.lit(False))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("same_id").alias("agree"), F.count_if(~F.col("same_id")).alias("id_mismatches"),
        F.count_if(far).alias("distance_mismatches"), F.max("miles_off").alias("worst_miles"),
    ).withColumn("passed", (F.col("n") > 0) & (F.col("id_mismatches") == 0) & (F.col("distance_mismatches") == 0))


def audit_by_year(out: DataFrame, stations: DataFrame, *, n: int = 1000, seed: int = 42, radius_miles: float = MAX_STATION_MILES) -> DataFrame:
    """V10 for every year that has a match: the audit of up to `n` crashes of each, in one pass over the stations."""
    rows = _audited(out, stations, n, seed, radius_miles, each_year=True)
    far = ~F.coalesce(F.col("miles_off") <= DISTANCE_TOLERANCE, F.lit(False))
    return rows.groupBy("Crash_Year").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("same_id").alias("agree"), F.count_if(~F.col("same_id")).alias("id_mismatches"),
        F.count_if(far).alias("distance_mismatches"), F.max("miles_off").alias("worst_miles"),
    ).withColumn("passed", (F.col("id_mismatches") == 0) & (F.col("distance_mismatches") == 0))


def audit_examples(out: DataFrame, stations: DataFrame, *, n: int = 1000, seed: int = 42, radius_miles: float = MAX_STATION_MILES,
                   show: int = 5) -> DataFrame:
    """The first `show` wrong matches of the audit's sample, by id, with the station that should be there."""
    far = ~F.coalesce(F.col("miles_off") <= DISTANCE_TOLERANCE, F.lit(False))
    return _audited(out, stations, n, seed, radius_miles).filter(~F.col("same_id") | far).orderBy(
        "Crash_ID", "Nearest_Station_LocationId").limit(show).select(
            "Crash_ID", "Nearest_Station_LocationId", "Distance_Miles", "true_id", "true_miles")
