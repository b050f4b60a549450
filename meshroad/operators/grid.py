"""A latitude/longitude grid whose crowded cells are divided, and lookups of a point's cell.

Cells of level k are those of level 0 cut in four, k times, in each direction. An index over the grid is
a table with one row per leaf cell, plus the set of cells that were split further.
Expressions are SQL text, as in `functions.geo`; a level is a number, or SQL text where cells of several levels are handled together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.config import EARTH_RADIUS_MILES
from meshroad.functions.geo import num
from meshroad.operators.joins import SLICE_ROWS, lookup_join
from meshroad.session import BROADCAST_BYTES, materialize

SPLIT = 4  # a crowded cell becomes SPLIT * SPLIT cells
# Cutting a cell of one mile in four 7 times gives about 10 cm, finer than any recorded coordinate.
MAX_LEVEL = 7
# Slack for rounding in cell arithmetic: 1e-9 degrees is a tenth of a millimetre.
EPS_DEGREES = 1e-9
EPS_MILES = 1e-7

# Levels whose splits below one cell are packed in one row: 1 + 16 + 256 + 4096 bits.
TREE_LEVELS = 4
# Entries that a row of a leaf with several rows has, about.
WIDE_ENTRIES = 1024
# Bits of a rank that hold the place in a leaf's list.
PLACE_BITS = 18
# Entries of a leaf's list that are ranked in one row: as many as stay short enough to be compiled.
RUN = 8

# The parts of a crowded cell, to be exploded.
PARTS = f"transform(sequence(0L, {SPLIT * SPLIT - 1}L), i -> struct(i div {SPLIT} as r, i % {SPLIT} as c))"


@dataclass(frozen=True)
class Grid:
    height: float  # degrees of latitude per level-0 row
    columns: int  # level-0 columns around the globe

    @property
    def width(self) -> float:
        return 360.0 / self.columns

    @classmethod
    def of_size(cls, height: float, width: float) -> Grid:
        return cls(height, max(1, math.floor(360.0 / width)))

    @classmethod
    def for_radius(cls, miles: float, max_abs_lat: float) -> Grid:
        """Cells a little larger than the radius at the given latitude; this only tunes speed."""
        r = miles / EARTH_RADIUS_MILES
        reach = math.sin(r) / max(math.cos(math.radians(min(max_abs_lat, 89.0))), math.sin(r))
        return cls.of_size(math.degrees(r) * 1.01, math.degrees(math.asin(min(1.0, reach))) * 1.01)

    def row(self, lat: str, level: int | str = 0) -> str:
        return f"floor(({lat} + 90D) / {num(self.height)} * {_scale(level)})"

    def col(self, lon: str, level: int | str = 0) -> str:
        """Not yet wrapped around the globe."""
        return f"floor(({lon} + 180D) / {num(self.width)} * {_scale(level)})"

    def around(self, level: int | str = 0) -> str:
        """Columns around the globe."""
        return f"({self.columns}L * {_parts(level)})"

    def wrap(self, col: str, level: int | str = 0) -> str:
        return f"pmod({col}, {self.around(level)})"

    def cell(self, row: str, col: str, level: int | str = 0) -> str:
        """One number that tells row, column and level."""
        return f"(({row} * {self.around(level)} + {self.wrap(col, level)}) * 16L + {level})"

    def cell_of(self, lat: str, lon: str, level: int | str = 0) -> str:
        return self.cell(self.row(lat, level), self.col(lon, level), level)

    def place(self, cell: str) -> dict[str, str]:
        """Level, row and column that a cell's number tells."""
        level = f"cast({cell} % 16 as int)"
        return {"_level": level, "_row": f"({cell} div 16) div {self.around(level)}", "_col": f"({cell} div 16) % {self.around(level)}"}

    def bottom(self, row: str, level: int | str = 0) -> str:
        return f"(({row}) * ({num(self.height)} / {_scale(level)}) - 90D)"

    def left(self, col: str, level: int | str = 0) -> str:
        return f"(({col}) * ({num(self.width)} / {_scale(level)}) - 180D)"

    def center(self, row: str, col: str, level: int | str = 0) -> tuple[str, str]:
        return self.bottom(f"{row} + 0.5D", level), self.left(f"{col} + 0.5D", level)

    def half_diagonal_miles(self, row: str, level: int | str = 0) -> str:
        """Upper bound on the distance from the centre of a cell to any point in it."""
        along_col, along_row = self._half_sides(row, level)
        return f"({num(EARTH_RADIUS_MILES)} * ({along_col} + {along_row}) + {num(EPS_MILES)})"

    def half_chord_miles(self, row: str, level: int | str = 0) -> str:
        """Upper bound on the straight line from the centre of a cell to any point in it.

        The square of a chord is 4 (sin2(dlat / 2) + cos(lat1) cos(lat2) sin2(dlon / 2)), no more than the squared sides.
        """
        along_col, along_row = self._half_sides(row, level)
        return f"({num(EARTH_RADIUS_MILES)} * sqrt(pow({along_col}, 2D) + pow({along_row}, 2D)) + {num(EPS_MILES)})"

    def _half_sides(self, row: str, level: int | str) -> tuple[str, str]:
        """Half a cell's height, and half its width where it is widest, as angles."""
        dlat, dlon = (num(math.radians(size) / 2) for size in (self.height, self.width))
        mid = self.bottom(f"{row} + 0.5D", level)
        nearest_equator = f"greatest(abs({mid}) - {num(self.height / 2)} / {_scale(level)}, 0D)"
        return f"{dlat} / {_scale(level)}", f"{dlon} / {_scale(level)} * cos(radians({nearest_equator}))"

    def with_reach(self, df: DataFrame, lat: str, lon: str, miles: float) -> DataFrame:
        """Adds `_r0`, `_r1`, `_c0`, `_c1`: the level-0 rows and columns a circle can reach.

        The circle's own longitude extent is used, so it holds at any latitude and across the
        antimeridian; a circle around a pole reaches every column. Columns are not wrapped yet.
        A centre that is not on the globe reaches nothing: its row is left out.
        """
        df = df.filter(f"abs({lat}) <= 90D and abs({lon}) <= 180D")
        r = miles / EARTH_RADIUS_MILES
        r_deg, eps = num(math.degrees(r) + EPS_DEGREES), num(EPS_DEGREES)
        extent = (
            f"case when abs({lat}) + {r_deg} < 90D "
            f"then degrees(asin(least({num(math.sin(r))} / cos(radians({lat})), 1D))) + {eps} else 180D end"
        )
        first = self.col(f"{lon} - ({extent})")
        return df.selectExpr(
            "*",
            f"{self.row(f'greatest({lat} - {r_deg}, -90D)')} as _r0", f"{self.row(f'least({lat} + {r_deg}, 90D)')} as _r1",
            f"{first} as _c0", f"least({self.col(f'{lon} + ({extent})')}, {first} + {self.columns - 1}L) as _c1",
        )

    def explode_reach(self, df: DataFrame) -> DataFrame:
        """One row per cell of `with_reach`, in `_row` and `_col`."""
        plain = [f"`{c}`" for c in df.columns if c not in ("_r0", "_r1", "_c0", "_c1")]
        rows = df.selectExpr(*plain, "_c0", "_c1", "explode(sequence(_r0, _r1)) as _row")
        cols = rows.selectExpr(*plain, "_row", "explode(sequence(_c0, _c1)) as _col")
        return cols.selectExpr(*plain, "_row", f"{self.wrap('_col')} as _col")


def _parts(level: int | str) -> str:
    """Cells of a level along one side of a cell of level 0; `level` is a number or SQL text."""
    return f"{SPLIT**level}L" if isinstance(level, int) else f"shiftleft(1L, 2 * {level})"


def _scale(level: int | str) -> str:
    return num(SPLIT**level) if isinstance(level, int) else f"cast({_parts(level)} as double)"


def _tree_place(row: str, col: str, depth: int) -> str:
    """Where the bit of a cell stands in the tree of the cell `depth` levels above it."""
    side = SPLIT**depth
    return f"({(side * side - 1) // (SPLIT * SPLIT - 1)}L + pmod({row}, {side}L) * {side}L + pmod({col}, {side}L))"


def split_trees(grid: Grid, splits: DataFrame, by: Sequence[str], top: int, levels: int) -> DataFrame:
    """The split cells of `levels` levels from `top` on, as one bit map (`tree`) for each cell of level `top` that holds some."""
    words = (SPLIT ** (2 * levels) // (SPLIT * SPLIT - 1) + 63) // 64
    placed = splits.selectExpr(*by, *[f"{v} as {k}" for k, v in grid.place("cell").items()]).filter(f"_level between {top} and {top + levels - 1}")
    place = "case _level - {} {} end".format(top, " ".join(f"when {d} then {_tree_place('_row', '_col', d)}" for d in range(levels)))
    side = f"shiftleft(1L, 2 * (_level - {top}))"
    bits = placed.selectExpr(*by, f"{grid.cell(f'(_row div {side})', f'(_col div {side})', top)} as cell", f"{place} as _place").groupBy(
        *by, "cell", F.expr("cast(_place div 64 as int)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(_place % 64 as int)))").alias("bits"))
    trees = bits.groupBy(*by, "cell").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))  # `words` entries at most
    return trees.selectExpr(*by, "cell", f"transform(sequence(0, {words - 1}), i -> coalesce(m[i], 0L)) as tree")


@dataclass(frozen=True)
class CellIndex:
    """Leaf cells with a payload, and the cells that were split further.

    Most leaves are one row. A cell that cannot be split and has too much for one row has several in `wide`.
    """

    grid: Grid
    leaves: DataFrame  # by..., cell, payload columns; one row per leaf
    splits: DataFrame | None  # by..., cell; every cell that was split
    depth: int = 0  # levels with split cells
    by: tuple[str, ...] = ()
    broadcastable: bool = False
    splits_broadcastable: bool = False
    wide: DataFrame | None = None  # by..., cell, payload columns; several rows per leaf
    wide_broadcastable: bool = False

    def _located(self, points: DataFrame, lat: str, lon: str) -> DataFrame:
        """Adds `cell`, the leaf that each point lies in.

        The splits below a cell are bits of one row, so the way down `TREE_LEVELS` levels takes one join.
        """
        keys, grid = [*self.by, "cell"], self.grid
        found, tests = points, []
        for top in range(0, self.depth, TREE_LEVELS):
            levels = min(TREE_LEVELS, self.depth - top)
            trees = split_trees(grid, self.splits, self.by, top, levels).withColumnRenamed("tree", f"_tree{top}")
            found = lookup_join(found.selectExpr("*", f"{grid.cell_of(lat, lon, top)} as cell"), trees, keys,
                                broadcastable=self.splits_broadcastable).drop("cell")
            for level in range(top, top + levels):
                place = _tree_place(grid.row(lat, level), grid.wrap(grid.col(lon, level), level), level - top)
                bit = f"bit_get(element_at(_tree{top}, cast({place} div 64 as int) + 1), cast({place} % 64 as int))"
                tests.append(f"when coalesce({bit}, 0) = 0 then {grid.cell_of(lat, lon, level)}")
        deepest = grid.cell_of(lat, lon, self.depth)
        leaf = f"case {' '.join(tests)} else {deepest} end" if tests else deepest
        return found.selectExpr(*[f"`{c}`" for c in points.columns], f"{leaf} as cell")

    def attach(self, points: DataFrame, lat: str, lon: str, value: str, merge: str, given: Sequence[str] = (),
               least: tuple[str, Callable[[str], str], str] | None = None) -> DataFrame:
        """Adds `_value`, computed from the point and the payload of its leaf (null without one).

        `value` is SQL text over the payload and the coordinates, `given` are columns that it shares. In a leaf of several
        rows each row gives a value, and `merge` is the aggregate that makes one of them.

        `least` says the same of a value that is made of the list's entry of smallest rank, the first of equal ones: the list, the
        rank of an entry (a whole number below 2^45), and the value of the entry `s` and `_rank`. It is used where points and leaves meet by a shuffle.
        """
        keys = [*self.by, "cell"]
        again = not self.broadcastable or self.wide is not None
        if again and self.depth and not self.splits_broadcastable:
            # The work so far should not be repeated for what is counted or looked up again.
            points = materialize(points, "points")
        plain = [f"`{c}`" for c in points.columns]
        payload = [c for c in self.leaves.columns if c not in keys]
        found = self._located(points, lat, lon)
        if again:
            found = materialize(found, "located")
        if least is not None and not self.broadcastable:
            out = self._least(found, plain, given, *least)
        else:
            hit = lookup_join(found, self.leaves, keys, broadcastable=self.broadcastable)
            out = hit.selectExpr(*plain, "cell", *payload, *given).selectExpr(*plain, "cell", f"{value} as _value")
        if self.wide is None:
            return out.drop("cell")
        # Points at one place have one value. Their number is bounded by the size of a cell that cannot be split.
        wide = self.wide.hint("broadcast") if self.wide_broadcastable else self.wide.hint("shuffle_merge")
        at = [*keys, lat.strip("`"), lon.strip("`")]
        places = found.select(*at).join(self.wide.select(*keys).distinct(), keys, "left_semi").distinct()
        each = places.join(wide, keys).selectExpr(*[f"`{c}`" for c in at], *payload, *given).selectExpr(*[f"`{c}`" for c in at], f"{value} as _value")
        merged = materialize(each.groupBy(*at).agg(F.expr(merge).alias("_merged")), "wide-values")
        small = merged.count() * 256 <= BROADCAST_BYTES
        return lookup_join(out, merged, at, broadcastable=small).selectExpr(*plain, "coalesce(_merged, _value) as _value")

    def _least(self, found: DataFrame, plain: Sequence[str], given: Sequence[str], entries: str,
               rank: Callable[[str], str], value: str) -> DataFrame:
        """`_value` of the entry of smallest rank in each point's leaf, by a row for each run of `RUN` entries and a minimum.

        The leaves are cut in runs before they meet the points. These steps are compiled, a lambda over the list is interpreted and
        takes about ten times as long for an entry. Points stay in the tasks that the join on the cell put them in. Equal points are one group, and come as often as they were.
        """
        keys = [*self.by, "cell"]
        most = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        at = self.leaves.filter(f"size({entries}) > 0").selectExpr(*keys, entries, f"posexplode(sequence(0, size({entries}) - 1, {RUN})) as (_run, _at)")
        runs = at.selectExpr(*keys, "_run", f"slice({entries}, _at + 1, {RUN}) as _s")
        names = [g.rsplit(" as ", 1)[1] for g in given]
        each = lookup_join(found, runs, keys, broadcastable=False, most=most).selectExpr(*plain, "cell", "_run", "_s", *given)
        codes = ", ".join(f"shiftleft({rank(f'get(_s, {i})')}, {PLACE_BITS}) | (_run * {RUN} + {i})" for i in range(RUN))
        ranked = each.selectExpr(*plain, "cell", f"least({codes}) as _code", "if(coalesce(_run, 0) = 0, 1, null) as _one")
        firsts = ranked.groupBy(*[c.strip("`") for c in plain], "cell").agg(F.min("_code").alias("_code"), F.count("_one").alias("_copies"))
        if most > SLICE_ROWS:
            firsts = materialize(firsts, "least")
        best = lookup_join(firsts, self.leaves, keys, broadcastable=False, most=most).selectExpr(
            *plain, "cell", "_copies", f"shiftright(_code, {PLACE_BITS}) as _rank", f"{entries}[cast(_code & {2**PLACE_BITS - 1}L as int)] as s")
        best = best.selectExpr(*plain, "cell", "_copies", f"if(_rank is null, null, {value}) as _value")
        return best.selectExpr(*plain, "cell", "_value", "explode(array_repeat(0, cast(_copies as int))) as _copy").drop("_copy")
