"""Tolerant conversions: a bad value becomes null and never fails the job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(col: Column) -> Column:
    """Number or null; the text 'NaN' is treated as null, since NaN would pass comparisons."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def to_long(col: Column) -> Column:
    """Whole number or null, accepting decimal spellings such as '2016.0'."""
    return F.coalesce(col.try_cast("bigint"), to_double(col).try_cast("bigint"))


def to_id(col: Column) -> Column:
    return F.trim(col.cast("string"))


def parse_date(col: Column, patterns: Sequence[str]) -> Column:
    """First pattern that fits; columns may mix two- and four-digit years."""
    return F.coalesce(*[F.try_to_date(col, p) for p in patterns])


def parse_year(col: Column, patterns: Sequence[str]) -> Column:
    return F.year(parse_date(col, patterns))
