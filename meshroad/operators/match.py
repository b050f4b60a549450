"""Match names by spelling: a table's names to a few canonical ones, and the names of one table to those of another."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.operators.joins import union_all
from meshroad.session import BROADCAST_BYTES, materialize

# By how much the score falls from one round to the next.
STEP = 5


def _plain(word: str) -> str:
    return re.sub("[^A-Za-z0-9]", "", word).lower()


def propose_names(
    names: DataFrame, variants: Mapping[str, Sequence[str]], *, name: str = "name", position: str = "position"
) -> DataFrame:
    """Best name per canonical name: `canonical`, `actual`, `score`, `tag`.

    A name that equals a known variant wins with score 100 (the first by position). Otherwise the
    score is 100 * (1 - edit distance / longer length) on lower-cased letters and digits, best
    first, ties to the earlier variant and then the earlier position. The variants are settings,
    a few dozen words, so every distinct name is scored against them in place, without a join.
    """
    distinct = names.groupBy(F.col(name).alias("name")).agg(F.min(position).alias("position")).selectExpr(
        "name", "position", "lower(regexp_replace(name, '[^A-Za-z0-9]', '')) as plain")

    def scored(canonical: str, words: Sequence[str]) -> str:
        tries = []
        for order, word in enumerate(words):
            longer = f"greatest(length(plain), {len(_plain(word))})"
            score = f"cast(floor(100D * ({longer} - levenshtein(plain, '{_plain(word)}')) / {longer}) as int)"
            tries.append(f"struct({score} as score, {-order} as earlier)")
        listed = ", ".join(f"'{w}'" for w in words)
        return (f"struct('{canonical}' as canonical, name in ({listed}) as exact, "
                f"if(name in ({listed}), struct(100 as score, 0 as earlier), array_max(array({', '.join(tries)}))) as m)")

    rows = distinct.selectExpr("name", "position", f"inline(array({', '.join(scored(c, v) for c, v in variants.items())}))")
    best = rows.groupBy("canonical").agg(F.expr(
        "max(struct(exact, m.score as score, m.earlier as earlier, -position as first, name))").alias("best"))
    return best.selectExpr(
        "canonical", "best.name as actual", "best.score as score",
        "case when best.score = 100 then 'exact' when best.score >= 95 then 'fuzzy' else 'check' end as tag")


def _segments(names: DataFrame, least: int) -> DataFrame:
    """Each name (`_r`) cut into as many segments of about one length as a pair with it may have edits, and one more."""
    most = f"cast(floor(length(_r) * {100 - least} / {least} + 1e-9D) as bigint) + 1"
    cut = names.selectExpr("plain as _r", "length(plain) as size").selectExpr("_r", "size", f"{most} as parts")
    each = cut.selectExpr("_r", "size", "parts", "explode(sequence(0L, parts - 1)) as part").selectExpr(
        "_r", "size", "part", "part * size div parts as start", "(part + 1) * size div parts as stop")
    return each.selectExpr("_r", "cast(size as int) as size", "cast(part as int) as part", "substr(_r, cast(start + 1 as int), cast(stop - start as int)) as piece")


def _places(names: DataFrame, sizes: DataFrame, least: int) -> DataFrame:
    """The pieces of each name (`_l`) that can be a segment of a name of each length.

    Counted from the left, some unchanged segment has no more edits before it than segments, and no more behind it than
    segments; the edits on both sides are at most those of the pair.
    """
    own = names.selectExpr("plain as _l", "length(plain) as own", f"explode(sequence(cast(ceil(length(plain) * {least} / 100 - 1e-9D) as int), "
                           f"cast(floor(length(plain) * 100 / {least} + 1e-9D) as int))) as size")
    near = own.join(F.broadcast(sizes), "size").selectExpr(
        "_l", "size", "own", f"cast(floor(greatest(own, size) * {100 - least} / 100 + 1e-9D) as bigint) as edits",
        f"cast(floor(size * {100 - least} / {least} + 1e-9D) as bigint) as most", "cast(own - size as bigint) as extra")
    near = near.selectExpr("*", "explode(sequence(0L, most)) as part").selectExpr(
        "*", "part * size div (most + 1) as start", "(part + 1) * size div (most + 1) as stop")
    near = near.selectExpr(
        "_l", "size", "cast(part as int) as part", "cast(stop - start as int) as n",
        "greatest(start - least((edits - extra) div 2, part, most - part - extra), 0L) as low",
        "least(start + least((edits + extra) div 2, part, most - part + extra), own - (stop - start)) as high").filter("low <= high")
    return near.selectExpr("_l", "size", "part", "n", "explode(sequence(low, high)) as at").selectExpr(
        "_l", "size", "part", "substr(_l, cast(at + 1 as int), n) as piece")


def candidate_pairs(left: DataFrame, right: DataFrame, least: int, *, broadcastable: bool = False) -> DataFrame:
    """Pairs `_l`, `_r` of names (`plain`) that may reach the score `least`, those that do among them; some come several times.

    Of the segments of the one name, one more than there may be edits, at least one stands unchanged in the other, moved by no
    more than the edits left of it and the difference in length that those right of it can make up for.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = right.selectExpr("length(plain) as size").distinct()
    on = ["size", "part", "piece"]
    # A fixed number of tasks: the pairs are many times what is read.
    ours, theirs = _places(left.repartition(tasks, "plain"), sizes, least), _segments(right, least)
    if broadcastable:
        return ours.join(F.broadcast(theirs), on).select("_l", "_r")
    return ours.repartition(tasks, *on).join(theirs.repartition(tasks, *on).hint("merge"), on).select("_l", "_r")


def match_names(left: DataFrame, right: DataFrame, *, name: str = "name", least: int = 80, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For every different name of `left` its best name of `right`: `name`, `match`, `score` (null below `least`).

    The score is 100 * (1 - edit distance / longer length), rounded down, on lower-cased letters and digits; ties go to the
    smaller name. An empty or null name matches nothing.

    Equal names are joined first. The others go through rounds with falling scores: a round finds all pairs of its score or
    more, so a name that has one is done, and only the names without one need the next round, whose shorter
    segments are met more often. `least` must be above 67, as the segments need names that share something.
    """
    if not 67 < least <= 100:
        raise ValueError("least must be above 67 and at most 100")
    plain = "lower(regexp_replace({0}, '[^A-Za-z0-9]', ''))"
    ours, theirs = [materialize(df.selectExpr(f"`{name}` as name", f"{plain.format(f'`{name}`')} as plain").groupBy("plain").agg(
        F.min("name").alias("name")).filter("plain <> ''"), side) for df, side in ((left, "left-names"), (right, "right-names"))]
    found = [ours.select("plain").join(theirs.hint("merge"), "plain").selectExpr("plain", "name as match", "100 as score")]
    rest = materialize(ours.select("plain").join(theirs.select("plain").hint("merge"), "plain", "left_anti"), "names-left")
    size = theirs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("plain")).alias("letters")).first()
    longer = "greatest(length(_l), length(_r))"
    for step in [*range(95, least, -STEP), least]:
        if step == 100 or not size.n or rest.isEmpty():
            break
        # A name has at most a segment for each edit and one more, with the whole name beside it.
        bound = size.n * 64 + size.letters * (1 + 2 * (100 - step) / step)
        bound += (size.letters * (100 - step) / step + size.n) * (96 + 2 * size.letters / size.n)
        pairs = candidate_pairs(rest, theirs, step, broadcastable=bound <= broadcast_bytes)
        scored = pairs.selectExpr("_l", "_r", f"cast(floor(100D * ({longer} - levenshtein(_l, _r)) / {longer}) as int) as score").filter(F.col("score") >= step)
        named = scored.distinct().join(theirs.select(F.col("plain").alias("_r"), F.col("name").alias("match")).hint("merge"), "_r")
        best = named.groupBy("_l").agg(F.min(F.struct((-F.col("score")).alias("s"), "match")).alias("b"))
        best = materialize(best.selectExpr("_l as plain", "b.match", "-b.s as score"), "best-names")
        found.append(best)
        if step > least:
            rest = materialize(rest.join(best.select("plain").hint("merge"), "plain", "left_anti"), "names-left")
    names = left.selectExpr(f"`{name}` as name").distinct().selectExpr("name", f"{plain.format('name')} as plain")
    return names.join(union_all(found).hint("merge"), "plain", "left").select("name", "match", "score")
