"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are put into a shuffled order that depends on the ids only. A document's virtual finish
time is the source's words up to and including it, divided by the source's target; the further passes over a
source follow the first. All entries are ordered by virtual finish time and taken until the total budget is used,
so every source comes within about one document of its target.

The entries of one bin of virtual time, about `SLICE_ROWS` documents, are the most that one task sorts.

No source is handled in one task: its order is cut into slices by the shuffle key, whose sums are added up first.
The entries are cut into bins of virtual time in the same way.

Defined results: a null text has size 0; a null source is a source of its own, the last one; documents of size 0
take no words. Rows with the same id are separate documents; equal rows may swap places. With no words at all,
every target and every count is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meshroad.llm.common import BROADCAST_ROWS, WORD, materialize

WEIGHTS = (5.0, 2.0, 1.0)
MOST_PASSES = 3
SLICE_ROWS = 2_000
SEED = "mix-1:"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Per source (`_source`, `source_size`) the words it should give: its share of all words by weight, at most
    `most` times its size, the excess shared again by weight until no source is above its limit.

    Sources in the order of their share limit are full from the front: source k is full if the words left by those
    before it, shared by weight among it and those after it, exceed its limit. One row for each source.
    """
    by_name = W.orderBy(F.col("_source").asc_nulls_last())
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                 ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("_limit", F.col("source_size") * F.lit(most))
    by_limit = W.orderBy((F.col("_limit") / F.col("weight")).asc(), F.col("_source").asc_nulls_last())
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (s.withColumn("_total", F.sum("source_size").over(everything))
         .withColumn("_weights", F.sum("weight").over(everything))
         .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_limit").over(before), F.lit(0)))
                     / (F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
         .withColumn("_full", F.col("_limit") <= F.col("_level") * F.col("weight"))
         .withColumn("_free_level", F.min(F.when(~F.col("_full"), F.struct(F.col("_limit") / F.col("weight"), "_level")))
                     .over(everything)["_level"]))
    target = F.when(F.col("_full"), F.col("_limit").cast("double")).otherwise(F.col("_free_level") * F.col("weight"))
    return s.select("_source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *,
        weights: tuple[float, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Each document's id with `size`, `source_size`, `target` (of its source), `copies` and `taken` (words in the mix)."""
    d = _taken(docs, doc_id, text, source, weights, most)
    return d.select(F.col("_id").alias(doc_id), F.col("_size").alias("size"), "source_size", "target", "copies",
                    (F.col("_size") * F.col("copies")).cast("long").alias("taken"))


def _order(doc_id: str, text: str) -> Column:
    """Place of a document in its source's shuffled order."""
    number = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    return F.struct(F.md5(F.concat(F.lit(SEED), number).cast("binary")).alias("key"), word_count(F.col(f"`{text}`")).alias("size"))


def _taken(docs, doc_id, text, source, weights, most) -> DataFrame:
    d = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{source}`").alias("_source"), _order(doc_id, text).alias("_order"))
    d = materialize(d.select("_id", "_source", "_order", F.col("_order.size").alias("_size")), "mix-sizes")
    by_source = d.groupBy("_source").agg(F.sum("_size").alias("source_size"),
                                         F.ceil(F.count(F.lit(1)) / SLICE_ROWS).alias("_slices"))
    by_source = materialize(by_source, "mix-sources")
    goal = targets(by_source.drop("_slices"), weights, most)
    goal = goal.join(by_source.select(F.col("_source").alias("_src"), "_slices"), F.col("_source").eqNullSafe(F.col("_src"))).drop("_source")
    goal = materialize(goal, "mix-targets")

    # Words of the source before each document: those of earlier slices plus those before it in its slice.
    d = d.join(goal, d["_source"].eqNullSafe(goal["_src"])).drop("_src")
    share = F.conv(F.substring("_order.key", 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))
    d = d.withColumn("_slice", F.floor(share * F.col("_slices")))
    slices = d.groupBy("_source", "_slice").agg(F.sum("_size").alias("_words"))
    earlier = W.partitionBy("_source").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.select(F.col("_source").alias("_src"), F.col("_slice").alias("_sl"),
                           F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base"))
    d = d.join(slices, d["_source"].eqNullSafe(slices["_src"]) & (d["_slice"] == slices["_sl"])).drop("_src", "_sl")
    inside = W.partitionBy("_source", "_slice").orderBy("_order", "_id").rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("_upto", F.col("_base") + F.sum("_size").over(inside)).drop("_base", "_slice", "_slices")
    d = materialize(d, "mix-order")

    time, place = _end_of_budget(d, most)
    copies = F.lit(0)
    for k in range(most):
        entry = F.struct(_finish(k), *_place(k))
        last = F.struct(F.lit(time), *[F.lit(x) for x in place[:-1]], F.lit(place[-1]).cast("long"))
        copies = copies + F.coalesce(entry <= last, F.lit(False)).cast("int")
    return d.withColumn("copies", F.when(F.col("target") > 0, copies).otherwise(0))


def _finish(k: int) -> Column:
    """Virtual finish time of pass k; null without a target."""
    return F.when(F.col("target") > 0, (F.col("source_size") * k + F.col("_upto")) / F.col("target"))


def _place(k: int) -> list[Column]:
    """Order of the entries of one virtual time."""
    return [F.coalesce("_source", F.lit("\U0010ffff")), F.lit(k), F.col("_order.key"), F.col("_size")]


def _end_of_budget(d: DataFrame, most: int) -> tuple[float, tuple]:
    """Virtual time and place of the last entry within the budget, which is the number of all words."""
    total = d.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_size"), F.lit(0)).alias("words")).first()
    bins = max(1, total.rows // SLICE_ROWS)
    entries = d.select(F.explode(F.array(*[
        F.struct(_finish(k).alias("t"), F.struct(*[c.alias(n) for c, n in zip(_place(k), "abcd")]).alias("p"), F.col("_size").alias("w"))
        for k in range(most)])).alias("e")).select("e.*").filter("t is not null")
    entries = entries.withColumn("_bin", F.floor(F.col("t") * bins))
    upto = W.orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)  # one row for each bin
    sums = entries.groupBy("_bin").agg(F.sum("w").alias("_w")).withColumn("_end", F.sum("_w").over(upto))
    last = sums.filter(F.col("_end") - F.col("_w") <= total.words).orderBy(F.col("_bin").desc()).limit(1).collect()
    nothing = ("", -1, "", -1)
    if not last:
        return -1.0, nothing
    number, before = last[0]["_bin"], last[0]["_end"] - last[0]["_w"]
    inside = W.orderBy("t", "p").rowsBetween(W.unboundedPreceding, 0)  # the entries of one bin
    best = (entries.filter(F.col("_bin") == number).withColumn("_sum", F.lit(before) + F.sum("w").over(inside))
            .filter(F.col("_sum") <= total.words).agg(F.max(F.struct("t", "p")).alias("m")).first().m)
    return (best.t, tuple(best.p)) if best else (number / bins, nothing)


def mixed_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", *,
               weights: tuple[float, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `docs`.

    In each source, the documents up to some place of the shuffled order are taken once more than those after it,
    so one row for each source says how often to take a document, and no text is shuffled. Equal rows are taken
    equally often here.
    """
    cuts = (_taken(docs, doc_id, text, source, weights, most).groupBy("_source")
            .agg(F.max(F.struct("copies", "_order")).alias("_cut")))
    cuts = materialize(cuts.select(F.col("_source").alias("_mix_src"), "_cut"), "mix-cuts")
    joined = docs.join(F.broadcast(cuts) if cuts.count() <= BROADCAST_ROWS else cuts,
                       F.col(f"`{source}`").eqNullSafe(F.col("_mix_src")))
    times = F.col("_cut.copies") - F.when(_order(doc_id, text) <= F.col("_cut._order"), 0).otherwise(1)
    joined = joined.withColumn("_mix_times", times).filter("_mix_times > 0")
    joined = joined.withColumn("_mix_pass", F.explode(F.sequence(F.lit(1), F.col("_mix_times"))))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
