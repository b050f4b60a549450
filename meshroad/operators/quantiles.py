"""Exact quantiles (linear interpolation) of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshroad.operators.slices import attach_carry, in_slices, spread_groups, within
from meshroad.session import materialize

# Distinct values of one group that a single task may hold.
TASK_VALUES = 1_000_000


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], *, by: Sequence[str] = (), task_values: int = TASK_VALUES,
) -> DataFrame:
    """One row per group, one column per named probability; nulls are ignored.

    Equal values are first combined to (value, count). When every group has few distinct values the
    built-in aggregate takes the counts. Otherwise groups are cut into slices by value, and running
    counts, carried from slice to slice, tell where each wanted rank lies.
    """
    by = list(by)
    counts = materialize(
        df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c")), "value-counts")
    most = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    if most <= task_values:
        return counts.groupBy(*by).agg(*[F.percentile("_v", F.lit(p), F.col("_c")).alias(name) for name, p in probs.items()])

    # Each group has slices of neighbouring values; the rows below a slice are carried into it, so each wanted
    # rank is found in one slice.
    sliced = in_slices(counts, by, ["_v"], counts.count(), task_values)
    spread = spread_groups(sliced, by, F.sum("_c").alias("_sum"))
    below = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = spread.select(*by, "_slice", F.coalesce(F.sum("_sum").over(below), F.lit(0)).alias("_below"),
                          F.sum("_sum").over(Window.partitionBy(*by)).alias("_all"))
    ranked = attach_carry(sliced.withColumns({
        "_upto": F.sum("_c").over(within(by, "_v")), "_n": F.sum("_c").over(Window.partitionBy("_slice", *by))}), carry, by)
    ranked = ranked.withColumns({"_upto": F.col("_upto") + F.coalesce("_below", F.lit(0)), "_n": F.coalesce("_all", "_n")})
    at = lambda p: F.lit(float(p)) * (F.col("_n") - 1)
    holds = lambda rank: (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))
    ends = ranked.groupBy(*by).agg(F.max("_n").alias("_n"), *[
        F.max(F.when(holds(f(at(p))), F.col("_v"))).alias(f"_{side}{i}") for i, p in enumerate(probs.values()) for side, f in (("lo", F.floor), ("hi", F.ceil))])
    line = lambda i, p: F.col(f"_lo{i}") + (at(p) - F.floor(at(p))) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
    return ends.select(*by, *[line(i, p).alias(name) for i, (name, p) in enumerate(probs.items())])
