"""The record closest in time, before or after, for any range of times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meshroad.operators.slices import SLICE_ROWS, attach_carry, in_slices, spread_groups, within
from meshroad.session import materialize

# Bytes of a broadcast row, its key text apart.
ROW_BYTES = 160


def closest_in_time(
    asked: DataFrame, records: DataFrame, *, by: Sequence[str], asked_time: str, record_time: str, order: str, payload: Sequence[str],
    slice_rows: int = SLICE_ROWS,
) -> tuple[DataFrame, int]:
    """For each distinct (`by`, `asked_time`) of `asked` its best record in `_best`, and a bound of the result's bytes.

    Times are whole numbers. The best record has the smallest gap, then the later time, then the least `order` (SQL text
    over the columns of `records`), then the least payload. A record without a time counts only where its group has no other,
    and has no gap. Asked rows without a group value or time get nothing.

    Both sides are put together and sorted: the best record lies next before or next after. Records of one time are reduced
    before the sort, and asked times combined, so a group with very many rows has no more than its distinct times; if these are
    many, too, they are cut into slices, and the last and the first record of a slice are carried to its neighbours.
    """
    by = list(by)
    known = " and ".join(f"`{c}` is not null" for c in by)
    best = (records.filter(known).selectExpr(*by, f"cast({record_time} as bigint) as _t", f"struct({order} as o, struct({', '.join(payload)}) as p) as _r")
            .groupBy(*by, "_t").agg(F.min("_r").alias("_r")).withColumn("_ask", F.lit(0)))
    times = asked.filter(known).selectExpr(*by, f"cast({asked_time} as bigint) as _t").filter("_t is not null").distinct().withColumn("_ask", F.lit(1))
    # Records of groups that nobody asks for are of no use, but finding that out costs as much as carrying them along.
    events = materialize(best.unionByName(times, allowMissingColumns=True), "events")
    size = events.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_ask") == 1).alias("asked"),
                      F.max(F.length(F.concat_ws("", *[F.col(c).cast("string") for c in by]))).alias("key")).first()
    sliced = in_slices(events, by, ["_t", "_ask"], size.n, slice_rows)
    # A record is (time, its rank and payload); those without a time come first and are the last one only if there is no other.
    sliced = sliced.withColumn("_e", F.when(F.col("_ask") == 0, F.struct("_t", "_r")))
    timed = F.when(F.col("_t").isNotNull(), F.col("_e"))
    last = lambda e: F.last(e, ignorenulls=True)
    found = sliced.withColumns({
        "_before": last(F.col("_e")).over(within(by, F.col("_t").asc_nulls_first(), "_ask")),
        "_after": last(timed).over(within(by, F.col("_t").desc_nulls_last(), F.col("_ask").asc()))}).filter("_ask = 1")
    if size.n > slice_rows:
        ends = spread_groups(sliced, by, F.max_by("_e", F.when(F.col("_e").isNotNull(), F.coalesce("_t", F.lit(-(1 << 63))))).alias("_last"),
                             F.min_by(timed, F.when(timed.isNotNull(), F.col("_t"))).alias("_first"))
        to_here = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        from_here = Window.partitionBy(*by).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*by, "_slice", last("_last").over(to_here).alias("_carry_before"), last("_first").over(from_here).alias("_carry_after"))
        found = attach_carry(found, carry, by).withColumns({
            "_before": F.coalesce("_before", "_carry_before"), "_after": F.coalesce("_after", "_carry_after")})
    ranked = lambda e: (f"if({e} is null, null, struct({e}._t is null as no_time, abs(_t - {e}._t) as gap, -{e}._t as later, {e}._r as r, {e}._t as time))")
    best = F.expr(f"array_min(array({ranked('_before')}, {ranked('_after')}))")
    out = found.withColumn("_b", best).filter("_b is not null").selectExpr(*by, f"_t as `{asked_time}`", "struct(_b.gap as gap, _b.time as time, _b.r.p.*) as _best")
    return out, (size.asked or 0) * (ROW_BYTES + 4 * (size.key or 0))
