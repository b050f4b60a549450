"""Cleaning and deduplication of stations and incidents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meshroad.config import FIRST_YEAR, LAST_YEAR, StateConfig, in_any_bbox
from meshroad.functions.parsing import parse_year, to_double, to_id, to_long


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def rename_columns(df: DataFrame, mapping: dict[str, str | None], keep: Sequence[str] = ()) -> DataFrame:
    """Canonical name -> source name; canonicals mapped to None are left out."""
    require_columns(df, [src for src in mapping.values() if src is not None])
    return df.select(*[F.col(f"`{src}`").alias(canon) for canon, src in mapping.items() if src is not None],
                     *[F.col(c) for c in keep])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, null keys forming one group.

    The rank-one filter lets Spark keep a single row per key and task before the shuffle, so a key
    that holds much of the table costs no more than any other.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def on_globe(lat: str, lon: str) -> Column:
    """True for a latitude within 90 and a longitude within 180 degrees; null, infinite and other values give false."""
    return F.coalesce((F.abs(F.col(lat)) <= 90) & (F.abs(F.col(lon)) <= 180), F.lit(False))


def canonical_stations(raw: DataFrame, state: StateConfig, by: Sequence[str] = ()) -> DataFrame:
    """Typed station-year records; rows without a position on the globe or a positive count are dropped."""
    c = state.station_columns
    require_columns(raw, list(c.values()))
    typed = raw.select(
        *[F.col(b) for b in by],
        to_id(F.col(c["id"])).alias("station_id"),
        to_double(F.col(c["lat"])).alias("station_lat"),
        to_double(F.col(c["lon"])).alias("station_lon"),
        to_double(F.col(c["count"])).alias("Station_Count"),
        to_long(F.col(c["year"])).alias("Station_Year"),
    )
    return typed.filter(on_globe("station_lat", "station_lon") & (F.col("Station_Count") > 0))


def latest_per_station(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The latest year's record per station; a total order makes the choice repeatable."""
    return first_per_key(records, [*by, "station_id"], [
        F.col("Station_Year").desc_nulls_last(), F.col("Station_Count").desc(),
        F.col("station_lat").asc(), F.col("station_lon").asc(),
    ])


def clean_stations(raw: DataFrame, state: StateConfig, by: Sequence[str] = ()) -> DataFrame:
    return latest_per_station(canonical_stations(raw, state, by), by)


def dedupe_crashes(raw: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per Crash_ID, the first in the order of all other columns, nulls last.

    A minimum over the row combines before the shuffle like any aggregate, and sorts on the id
    alone, which makes it cheaper than ranking. Structs compare nulls first, hence the null flags.
    """
    keys = [*by, "Crash_ID"]
    rest = [c for c in raw.columns if c not in keys]
    ordered = [x for c in rest for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    firsts = raw.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_first"))
    return firsts.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in raw.columns])


def with_crash_year(df: DataFrame, state: StateConfig) -> DataFrame:
    return df.withColumn("Crash_Year", parse_year(F.col("Crash_Date"), state.date_patterns))


def clean_crashes(
    raw: DataFrame, state: StateConfig, *, states: Sequence[StateConfig] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Dedupe on Crash_ID, then keep rows in the bounding box and in the processed years.

    The filters come after the dedupe on purpose: a copy with bad coordinates may be the one kept.
    `states` gives the boxes of a run over several states, told apart by a `state` column.
    """
    box = in_any_bbox(states or [state], F.col("Latitude"), F.col("Longitude"),
                      F.col("state") if "state" in by else None)
    typed = with_crash_year(dedupe_crashes(raw, by), state).select(
        *[F.col(b) for b in by],
        "Crash_ID", "Crash_Date", to_double(F.col("Latitude")).alias("Latitude"),
        to_double(F.col("Longitude")).alias("Longitude"), "Crash_Year",
        F.col("ZIP_Code") if "ZIP_Code" in raw.columns else F.lit(None).cast("string").alias("ZIP_Code"),
    )
    # A list test mentions the parsed year once, a range test would parse the date twice.
    return typed.filter(box & F.col("Crash_Year").isin(*range(FIRST_YEAR, LAST_YEAR + 1)))
