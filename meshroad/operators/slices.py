"""Ordered work over groups of any size: rows are cut into slices by order, and little is carried from slice to slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meshroad.session import materialize

# Rows of one group that a single task may hold.
SLICE_ROWS = 1_000_000


def in_slices(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds `_slice`, a number that grows with (by, order); no slice holds many more than `slice_rows` of the `n` rows.

    Rows equal in all of `by` and `order` stay in one slice, so these must tell rows apart. A group lies in neighbouring
    slices, and each slice but the first of a group begins with it: at most one group goes on from one slice to the next.
    The numbers are written, since the bounds of the ranges come from a sample.
    """
    if n <= slice_rows:
        return df.withColumn("_slice", F.lit(0))
    parts = -(-n // slice_rows) * 2  # the sampled bounds are not exact
    return materialize(df.repartitionByRange(parts, *by, *order).withColumn("_slice", F.spark_partition_id()), "slices")


def within(by: Sequence[str], *order: Column | str) -> WindowSpec:
    """The rows of a group in one slice, from the first in order to the current one."""
    return Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def spread_groups(sliced: DataFrame, by: Sequence[str], *facts: Column) -> DataFrame:
    """`facts` of each slice of the groups that lie in several; at most two rows for each slice, so small enough to be broadcast."""
    per_slice = sliced.groupBy(*by, "_slice").agg(*facts)
    return per_slice.withColumn("_slices", F.count(F.lit(1)).over(Window.partitionBy(*by))).filter("_slices > 1").drop("_slices")


def attach_carry(sliced: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    """Joins what `spread_groups` gave onto the rows of each slice; a null group value is a value like others."""
    names = [f"_by{i}" for i in range(len(by))]
    carry = F.broadcast(carry.withColumnsRenamed({**dict(zip(by, names)), "_slice": "_of"}))
    same = F.col("_slice") == F.col("_of")
    for c, name in zip(by, names):
        same = same & F.col(c).eqNullSafe(F.col(name))
    return sliced.join(carry, same, "left").drop(*names, "_of")
