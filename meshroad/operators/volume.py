"""Scale a station's yearly count to the crash year with the mileage index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.config import FILLED_LABEL, MISSING_LABEL


def with_vmt(df: DataFrame, vmt: DataFrame, year: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Look the year up in the mileage table, which is as small as the settings it comes from."""
    dim = vmt.selectExpr(*by, "cast(vmt_year as bigint) as _year", f"vmt as {name}")
    joined = df.selectExpr("*", f"cast(`{year}` as bigint) as _year")
    return joined.join(F.broadcast(dim), [*by, "_year"], "left").drop("_year")


def vmt_multiplier(df: DataFrame, vmt: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds VMT_Crash, VMT_Station and their ratio; null for unknown years and zero mileage."""
    both = with_vmt(with_vmt(df, vmt, "Crash_Year", "VMT_Crash", by), vmt, "Station_Year", "VMT_Station", by)
    return both.selectExpr("*", "case when VMT_Station > 0 then VMT_Crash / VMT_Station end as VMT_Multiplier")


def adjust_volume(df: DataFrame, vmt: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds the columns from year_gap to aadt_match_type."""
    kept = [f"`{c}`" for c in df.columns if c != "year_gap"]
    gap = df.selectExpr(*kept, "abs(cast(Crash_Year as bigint) - Station_Year) as year_gap")
    return vmt_multiplier(gap, vmt, by).selectExpr(
        "*", "Station_Count * VMT_Multiplier as Adt_Curnt_Amt", "cast(Crash_Year as bigint) as Adt_Curnt_Year",
        f"case when Station_Count is not null and VMT_Multiplier is not null then '{FILLED_LABEL}' "
        f"else '{MISSING_LABEL}' end as aadt_match_type")
