"""Lookup joins that stay whole and balanced when the probing side is skewed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.session import materialize

# Rows of one key that a single task may get; hotter keys are cut into slices of about this size.
SLICE_ROWS = 2_000_000


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    broadcastable: bool,
    slice_rows: int = SLICE_ROWS,
    how: str = "left",
    most: int | None = None,
) -> DataFrame:
    """Join `right`, which has at most one row per key, onto `left`.

    With a right side of proven small size this is a broadcast join and `left` is not shuffled.
    Otherwise both sides are shuffled on the key plus a slice number. A key with n rows on the
    left gets ceil(n / slice_rows) slices, and its one right row is copied to each of them. `most` tells the largest n
    where it is known, so that it need not be counted.
    """
    on = list(on)
    if broadcastable:
        return left.join(F.broadcast(right), on, how)
    if most is not None and most <= slice_rows:
        return left.join(right.hint("shuffle_merge"), on, how)
    # At most total_rows / slice_rows keys are hot, so this table stays small. It is written out, as
    # a plan that held `left` three times would triple with every further join.
    hot = materialize(
        left.select(*on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows)
        .select(*on, F.ceil(F.col("_n") / slice_rows).cast("int").alias("_slices")), "hot-keys")
    if hot.isEmpty():
        return left.join(right.hint("shuffle_merge"), on, how)
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    # Rows without a key match nothing, so they may be spread at will.
    slice_no = (
        F.when(no_key, F.pmod(row_hash, F.lit(4096)))
        .otherwise(F.pmod(row_hash, F.coalesce("_slices", F.lit(1)).cast("bigint"))).cast("int")
    )
    sliced_left = left.join(F.broadcast(hot), on, "left").withColumn("_slice", slice_no).drop("_slices")
    sliced_right = (
        right.join(F.broadcast(hot), on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
        .drop("_slices")
    )
    return sliced_left.join(sliced_right.hint("shuffle_merge"), [*on, "_slice"], how).drop("_slice")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; types widen, and columns missing in a frame become nulls."""
    together = frames[0]
    for more in frames[1:]:
        together = together.unionByName(more, allowMissingColumns=True)
    return together
