"""Coverage reports, distributions and profiles. Each is one aggregate over its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshroad.config import INCIDENT_ID_NAMES, REQUIRED_COLUMNS, StateConfig
from meshroad.functions.parsing import parse_date
from meshroad.operators.quantiles import exact_quantiles
from meshroad.session import materialize


def _filled() -> Column:
    return F.col("Adt_Curnt_Amt").isNotNull()


# ---- profiles of the inputs ----


def rows_per_year(crashes_raw: DataFrame, state: StateConfig) -> DataFrame:
    """Rows and date range per crash year, the null year and years outside the scope included."""
    dated = crashes_raw.select(parse_date(F.col("Crash_Date"), state.date_patterns).alias("d"))
    return dated.groupBy(F.year("d").alias("Crash_Year")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("d").alias("first_date"), F.max("d").alias("last_date"),
    ).orderBy("Crash_Year")


def duplicate_ids_per_year(crashes_raw: DataFrame, state: StateConfig) -> DataFrame:
    """Rows that repeat an id already seen in their year; a missing id counts as an id."""
    year = F.year(parse_date(F.col("Crash_Date"), state.date_patterns))
    per_id = crashes_raw.groupBy(year.alias("Crash_Year"), "Crash_ID").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("Crash_Year").agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicate_ids"))


def station_profile(stations_raw: DataFrame, state: StateConfig) -> DataFrame:
    """Distinct ids and the spread of records per id, before any cleaning."""
    sid = state.station_columns["id"]
    per_id = stations_raw.filter(F.col(sid).isNotNull()).groupBy(sid).agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("station_ids"), F.avg("n").alias("mean"),
        F.stddev("n").alias("std"), F.min("n").alias("min"), F.percentile("n", F.lit(0.25)).alias("p25"),
        F.percentile("n", F.lit(0.5)).alias("p50"), F.percentile("n", F.lit(0.75)).alias("p75"),
        F.max("n").alias("max"), F.count_if(F.col("n") > 1).alias("ids_with_several"),
    )


def station_years(stations_raw: DataFrame, state: StateConfig) -> DataFrame:
    year = F.col(state.station_columns["year"])
    return stations_raw.groupBy(year.alias("Station_Year")).agg(F.count(F.lit(1)).alias("records")).orderBy("Station_Year")


# ---- reports over the output ----


def per_year_summary(out: DataFrame) -> DataFrame:
    """Rows, filled rows, distinct matched stations (nulls not counted) and fill percentage."""
    return out.groupBy("Crash_Year").agg(
        F.count(F.lit(1)).alias("rows"), F.count("Adt_Curnt_Amt").alias("filled"),
        F.count_distinct("Nearest_Station_LocationId").alias("unique_stations"),
    ).withColumn("pct", F.round(F.col("filled") / F.col("rows") * 100, 2)).orderBy("Crash_Year")


def missing_reasons(out: DataFrame) -> DataFrame:
    """Why volumes are missing; the four reasons exclude each other."""
    missing = ~_filled()
    no_xy = F.col("Latitude").isNull() | F.col("Longitude").isNull()
    matched = F.col("Nearest_Station_LocationId").isNotNull()
    dated = F.col("Station_Year").isNotNull()
    return out.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(missing).alias("missing"),
        F.count_if(missing & no_xy).alias("no_coords"),
        F.count_if(missing & ~no_xy & ~matched).alias("no_station"),
        F.count_if(missing & matched & ~dated).alias("no_station_year"),
        F.count_if(missing & matched & dated & F.col("VMT_Multiplier").isNull()).alias("no_vmt"),
    )


def fill_totals(out: DataFrame) -> DataFrame:
    """Totals per year and, with a null year, over all years."""
    return out.rollup("Crash_Year").agg(
        F.count(F.lit(1)).alias("total"), F.count("Adt_Curnt_Amt").alias("filled"),
        F.count_if(~_filled()).alias("missing"),
    ).withColumn("fill_pct", F.round(F.col("filled") / F.col("total") * 100, 2))


def distance_stats(out: DataFrame, max_miles: float = 1.0) -> DataFrame:
    """Mean, median, min and max distance of filled rows within the radius."""
    kept = F.when(_filled() & F.col("Distance_Miles").between(0.0, max_miles), F.col("Distance_Miles"))
    dist = materialize(out.select(kept.alias("d")).filter(F.col("d").isNotNull()), "distances")
    basic = dist.agg(F.count("d").alias("n"), F.avg("d").alias("mean"), F.min("d").alias("min"), F.max("d").alias("max"))
    median = exact_quantiles(dist, "d", {"median": 0.5})
    one = F.lit(1).alias("_one")
    return basic.select("*", one).join(F.broadcast(median.select("*", one)), "_one", "left").drop("_one")


def year_gap_distribution(out: DataFrame) -> DataFrame:
    """Median, 90th percentile and maximum gap per year. Gaps have few distinct values."""
    return out.groupBy("Crash_Year").agg(
        F.percentile("year_gap", F.lit(0.5)).alias("median"), F.percentile("year_gap", F.lit(0.9)).alias("p90"),
        F.max("year_gap").alias("max"), F.count("year_gap").alias("n"),
    )


def volume_range(out: DataFrame, low: float = 10, high: float = 500_000) -> DataFrame:
    """Spread of volumes per year; passes when under 1% lie below `low` and under 1% above `high`."""
    amounts = materialize(out.select("Crash_Year", F.col("Adt_Curnt_Amt").alias("v")).filter(F.col("v").isNotNull()), "volumes")
    spread = exact_quantiles(amounts, "v", {"p5": 0.05, "median": 0.5, "p95": 0.95}, by=["Crash_Year"])
    tails = amounts.groupBy("Crash_Year").agg(
        F.count("v").alias("n"), F.count_if(F.col("v") < low).alias("too_low"), F.count_if(F.col("v") > high).alias("too_high"))
    ok = (F.col("too_low") < F.col("n") * 0.01) & (F.col("too_high") < F.col("n") * 0.01)
    return tails.join(spread, "Crash_Year").withColumn("passed", ok)


def unit_histogram(out: DataFrame, value: str) -> DataFrame:
    """Counts of the whole numbers 0 to the maximum, empty ones included."""
    counts = out.filter(F.col(value).isNotNull()).groupBy(F.floor(value).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "histogram")
    top = counts.agg(F.max("bin").alias("top")).first().top
    bins = out.sparkSession.range(0 if top is None else top + 1).select(F.col("id").alias("bin"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n")).orderBy("bin")


def equal_width_histogram(out: DataFrame, value: str, bins: int) -> DataFrame:
    """`bins` equal bins over [min, max], the last one closed; a constant gets a range of one."""
    values = materialize(out.select(F.col(value).alias("v")).filter(F.col("v").isNotNull()), "histogram")
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = (ends.lo, ends.hi) if ends.lo is not None else (0.0, 1.0)
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    place = F.least(F.floor((F.col("v") - lo) / F.lit(hi - lo) * bins), F.lit(bins - 1).cast("bigint"))
    counts = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return (
        out.sparkSession.range(bins).select(F.col("id").alias("bin"))
        .join(F.broadcast(counts), "bin", "left")  # at most `bins` rows
        .select("bin", (F.lit(lo) + F.col("bin") * width).alias("lower"),
                (F.lit(lo) + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))
    )


BIN_EDGES = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def distance_bins(out: DataFrame, closed: str = "left") -> DataFrame:
    """Filled rows per tenth of a mile. `closed` tells which end belongs to a bin; 0 and 1 always count."""
    d = F.col("Distance_Miles")
    inner = BIN_EDGES[1:-1]
    passed = [(d >= e) if closed == "left" else (d > e) for e in inner]
    place = sum((p.cast("int") for p in passed[1:]), passed[0].cast("int"))
    bin_no = F.when(_filled() & d.between(0.0, 1.0), place)
    counts = out.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("bin").isNotNull())
    rows = ", ".join(f"({i}, {BIN_EDGES[i]}D, {BIN_EDGES[i + 1]}D)" for i in range(10))
    labels = out.sparkSession.sql(f"select * from values {rows} as t(bin, lower, upper)")
    return labels.join(F.broadcast(counts), "bin", "left").select("bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n"))


# ---- samples and exports ----

SAMPLE_COLUMNS = {
    "Crash_Year": "crash_year", "Latitude": "Latitude", "Longitude": "Longitude", "ZIP_Code": "ZIP_Code",
    "Nearest_Station_LocationId": "station_id", "Station_Count": "raw_aadt", "Station_Year": "Station_Year",
    "VMT_Multiplier": "VMT_Multiplier", "Adt_Curnt_Amt": "Adt_Curnt_Amt", "year_gap": "year_gap",
    "Distance_Miles": "Distance_Miles", "aadt_match_type": "aadt_match_type",
}


def incident_id(df: DataFrame) -> Column:
    """The first known id column, or a fingerprint of the row where there is none."""
    present = [c for c in INCIDENT_ID_NAMES if c in df.columns]
    return F.col(present[0]) if present else F.xxhash64(*[F.col(c) for c in df.columns])


def shuffled_order(col: Column, seed: int) -> Column:
    """A repeatable pseudo-random order of whole-number ids."""
    return F.pmod(F.pmod(col.cast("bigint"), F.lit(2147483647)) * 48271 + seed, F.lit(2147483647))


def sample_filled(out: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """`n` filled rows, the same ones under any partitioning, with report names."""
    key = incident_id(out)
    order = shuffled_order(key, seed) if dict(out.dtypes).get("Crash_ID") in ("bigint", "int") else F.xxhash64(key, F.lit(seed))
    rows = out.filter(_filled()).withColumn("_order", order).withColumn("_id", key)
    ties = [F.col(c).asc() for c in ("_order", "_id", "ZIP_Code") if c in rows.columns]
    return rows.orderBy(*ties).limit(n).select(
        F.col("_id").alias("Crash_ID"), *[F.col(c).alias(a) for c, a in SAMPLE_COLUMNS.items() if c in out.columns])


def final_export(out: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the required columns, absent ones as nulls."""
    types = {"Crash_ID": "string", "aadt_match_type": "string", "ZIP_Code": "bigint", "Station_Year": "bigint", "year_gap": "bigint"}
    cols = [F.col(c) if c in out.columns else F.lit(None).cast(types.get(c, "double")).alias(c) for c in REQUIRED_COLUMNS]
    return out.select(*keep, *cols)

