"""Point-in-polygon join with the points strictly inside (a point on the boundary is outside).

The index is a table: grid cell -> polygons meeting it, each with only the edges near the cell and
one bit telling whether the cell's upper right corner is inside. Whether a point is inside follows
from that bit and the edges crossed on the way from the point to the right border and up to the
corner. Cells without edges need the bit alone; cells with many edges are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.functions.geo import num
from meshroad.operators.grid import EPS_DEGREES, MAX_LEVEL, PARTS, SPLIT, WIDE_ENTRIES, CellIndex, Grid
from meshroad.operators.joins import lookup_join, union_all
from meshroad.operators.nearest import TREE_BYTES
from meshroad.session import BROADCAST_BYTES, materialize

MAX_EDGES = 64
# Upper bound of what an edge, or a polygon in a cell without edges, takes in the index as it is broadcast, in bytes.
EDGE_BYTES = 256


def polygon_edges(polygons: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Edges of all rings. Input: `polygon_id`, `zip`, `mp` = polygon -> ring -> vertex -> [x, y].

    Rings of holes need no special care under the even-odd rule.
    """
    own = [*by, "polygon_id", "zip", "polygon_y_min"]
    rings = polygons.selectExpr(
        *own[:-1], "array_min(transform(flatten(flatten(mp)), v -> v[1])) as polygon_y_min", "explode(flatten(mp)) as ring")
    ends = ("zip_with(slice(ring, 1, size(ring) - 1), slice(ring, 2, size(ring) - 1), "
            "(a, b) -> struct(a[0] as x1, a[1] as y1, b[0] as x2, b[1] as y2))")
    return rings.filter("size(ring) > 1").selectExpr(*own, f"explode({ends}) as e").select(*own, "e.x1", "e.y1", "e.x2", "e.y2")


# Predicates on an edge e, from (x1, y1) to (x2, y2), as SQL text. Each side test uses the sign of one
# cross product, so that two tests at the same corner can never contradict each other by rounding.


def _cross(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"


def _spans(e: str, axis: str, at: str) -> str:
    return f"(({e}.{axis}1 > {at}) <> ({e}.{axis}2 > {at}))"


def _below(e: str, x: str, y: str) -> str:
    """(x, y) lies strictly below an edge that spans x."""
    return f"(if({e}.x2 > {e}.x1, {_cross(e, x, y)} < 0D, {_cross(e, x, y)} > 0D))"


def _left_of(e: str, x: str, y: str) -> str:
    """(x, y) lies strictly left of an edge that spans y."""
    return f"(if({e}.y2 > {e}.y1, {_cross(e, x, y)} > 0D, {_cross(e, x, y)} < 0D))"


def _crossings(e: str, x: str, y: str, right: str, top: str) -> str:
    """Times (0 to 2) the edge is crossed going from (x, y) to (right, y) and on to (right, top)."""
    sideways = f"({_spans(e, 'y', y)} and {_left_of(e, x, y)} <> {_left_of(e, right, y)})"
    upwards = f"({_spans(e, 'x', right)} and {_below(e, right, y)} <> {_below(e, right, top)})"
    return f"(cast({sideways} as int) + cast({upwards} as int))"


def _touches(e: str, x: str, y: str) -> str:
    return (
        f"({x} between least({e}.x1, {e}.x2) and greatest({e}.x1, {e}.x2) "
        f"and {y} between least({e}.y1, {e}.y2) and greatest({e}.y1, {e}.y2) and {_cross(e, x, y)} = 0D)"
    )


def _borders(grid: Grid, level: int) -> list[str]:
    """Columns for the borders of the cell (_row, _col), which the tests below mention by name."""
    return [f"{grid.left('_col', level)} as _x0", f"{grid.left('_col + 1', level)} as _x1",
            f"{grid.bottom('_row', level)} as _y0", f"{grid.bottom('_row + 1', level)} as _y1"]


def _meets(e: str) -> str:
    """The edge meets the cell: their boxes meet and the cell's corners are not all on one side.

    Widened against rounding, so that an edge which is left out keeps a clear distance.
    """
    eps = num(EPS_DEGREES)
    sides = ", ".join(_cross(e, x, y) for x in ("_x0", "_x1") for y in ("_y0", "_y1"))
    slack = f"{eps} * (abs({e}.x2 - {e}.x1) + abs({e}.y2 - {e}.y1))"
    return (
        f"(least({e}.x1, {e}.x2) <= _x1 + {eps} and greatest({e}.x1, {e}.x2) >= _x0 - {eps} "
        f"and least({e}.y1, {e}.y2) <= _y1 + {eps} and greatest({e}.y1, {e}.y2) >= _y0 - {eps} "
        f"and least({sides}) <= {slack} and greatest({sides}) >= -({slack}))"
    )


# Keeps an edge where it meets the cell, and a bare flip where it only turns the corner's bit. A generator
# rather than a filter, since a filter would be moved down and evaluate the tests a second time.
_KEEP = "inline(if(_near or _flips > 0, array(struct(if(_near, edge, null) as edge, _flips as flips)), array()))"


def _first_level(edges: DataFrame, grid: Grid, by: Sequence[str]) -> DataFrame:
    """Rows (row, col, polygon, edge or null, flips): edges near a cell, and edges above its corner.

    An edge within one column concerns only the cells it meets. One that spans a column border also
    concerns the cells below it, down to the polygon's lowest row.
    """
    own, eps = [*by, "polygon_id", "zip"], num(EPS_DEGREES)
    reach = edges.selectExpr(
        *own, "polygon_y_min", "struct(x1, y1, x2, y2) as edge",
        f"{grid.col(f'least(x1, x2) - {eps}')} as _c0", f"{grid.col(f'greatest(x1, x2) + {eps}')} as _c1")
    lowest = f"if(_c0 = _c1, least(edge.y1, edge.y2), polygon_y_min) - {eps}"
    cells = reach.selectExpr(
        *own, "edge", "_c0", "_c1",
        f"explode(sequence({grid.row(lowest)}, {grid.row(f'greatest(edge.y1, edge.y2) + {eps}')})) as _row",
    ).selectExpr(*own, "edge", "_row", "explode(sequence(_c0, _c1)) as _col")
    return cells.selectExpr("*", *_borders(grid, 0)).selectExpr(
        *own, "edge", "_row", "_col", f"coalesce({_meets('edge')}, false) as _near",
        f"cast({_spans('edge', 'x', '_x1')} and {_below('edge', '_x1', '_y1')} as int) as _flips",
    ).selectExpr(*own, "_row", "_col", _KEEP)


def _children(cells: DataFrame, grid: Grid, by: Sequence[str], level: int) -> DataFrame:
    """Rows of the parts of each cell of `level`."""
    own = [*by, "polygon_id", "zip"]
    # The parent's corner bit passes to every part as one edgeless row per polygon.
    corner = cells.groupBy(*own, "_row", "_col").agg((F.sum("flips") % 2).cast("int").alias("bit")).selectExpr(
        *own, "_row", "_col", "cast(null as struct<x1:double,y1:double,x2:double,y2:double>) as edge", "bit")
    rows = cells.filter("edge is not null").selectExpr(*own, "_row", "_col", "edge", "cast(null as int) as bit")
    rows = rows.unionByName(corner).selectExpr(
        *own, "edge", "bit", f"{grid.left('_col + 1', level)} as _right", f"{grid.bottom('_row + 1', level)} as _top",
        "_row", "_col", f"explode({PARTS}) as _q",
    ).selectExpr(*own, "edge", "bit", "_right", "_top", f"_row * {SPLIT} + _q.r as _row", f"_col * {SPLIT} + _q.c as _col")
    # A part's corner is a point of the parent cell, so its bit follows from the parent's edges.
    turned = _crossings("edge", "_x1", "_y1", "_right", "_top")
    return rows.selectExpr("*", *_borders(grid, level + 1)).selectExpr(
        *own, "edge", "_row", "_col", f"coalesce({_meets('edge')}, false) as _near", f"coalesce(bit, {turned} % 2, 0) as _flips",
    ).selectExpr(*own, "_row", "_col", _KEEP)


def _per_polygon(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per cell and polygon: its corner bit and its edges in the cell, at most those of its own input row."""
    keys = [*by, "cell", "right", "top"]
    return cells.groupBy(*keys, "polygon_id", "zip").agg(
        (F.sum("flips") % 2).cast("int").alias("corner"), F.collect_list("edge").alias("edges")).filter("corner > 0 or size(edges) > 0")


def _gather(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.collect_list(F.struct("polygon_id", "zip", "corner", "edges")).alias("polygons"))


def polygon_index(
    polygons: DataFrame,
    *,
    cell_degrees: float = 0.1,
    by: Sequence[str] = (),
    max_edges: int = MAX_EDGES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> CellIndex:
    by = tuple(by)
    keys = [*by, "cell"]
    grid = Grid.of_size(cell_degrees, cell_degrees)

    def keyed(cells: DataFrame, level: int) -> DataFrame:
        return cells.selectExpr("*", f"{grid.cell('_row', '_col', level)} as cell",
                                f"{grid.left('_col + 1', level)} as right", f"{grid.bottom('_row + 1', level)} as top")

    cells = keyed(_first_level(polygon_edges(polygons, by), grid, by), 0)
    leaves, splits, n_split, level = [], [], 0, 0
    while True:
        cells = materialize(cells, "polygon-edges")
        crowded = cells.groupBy(*keys).agg(F.count("edge").alias("_n")).filter(F.col("_n") > max_edges).select(*keys)
        crowded = materialize(crowded, "crowded") if level < MAX_LEVEL else None
        n_crowded = crowded.count() if crowded is not None else 0
        if not n_crowded:
            leaves.append(cells)
            break
        n_split += n_crowded
        marked = lookup_join(cells, crowded.withColumn("_crowded", F.lit(True)), keys,
                             broadcastable=n_crowded * 64 <= broadcast_bytes)
        leaves.append(marked.filter(F.col("_crowded").isNull()).drop("_crowded"))
        splits.append(crowded)
        cells = keyed(_children(marked.filter(F.col("_crowded")), grid, by, level), level + 1)
        level += 1
    # Cells with too much for one row, by edges or by polygons that cover them whole: several rows, by polygon.
    rows = materialize(_per_polygon(union_all(leaves), by), "cell-polygons")
    weight = F.lit(1) + F.size("edges")
    sizes = rows.groupBy(*keys).agg(F.sum(weight).alias("_all"))
    total = sizes.agg(F.sum("_all").alias("entries"), F.count_if(F.col("_all") > WIDE_ENTRIES).alias("wide")).first()
    small = lambda n: n * EDGE_BYTES <= broadcast_bytes
    own, wide, wide_entries = [*keys, "right", "top"], None, 0
    if total.wide:
        full = materialize(sizes.filter(F.col("_all") > WIDE_ENTRIES), "wide")
        marked = lookup_join(rows, full, keys, broadcastable=small(total.wide))
        part = F.pmod(F.xxhash64("polygon_id"), F.ceil(F.col("_all") / (WIDE_ENTRIES // 2))).alias("_part")
        wide = _gather(marked.filter("_all is not null").select("*", part), [*own, "_part"]).drop("_part")
        wide, wide_entries = materialize(wide, "wide-cells"), full.agg(F.sum("_all")).first()[0]
        rows = marked.filter("_all is null").drop("_all")
    table = materialize(_gather(rows, own), "polygon-cells")
    found = union_all(splits) if splits else None
    return CellIndex(grid, table, found, level, by, small(total.entries or 0), n_split * TREE_BYTES <= broadcast_bytes, wide, small(wide_entries))


def containing_zips(points: DataFrame, index: CellIndex, lat: str = "Latitude", lon: str = "Longitude") -> DataFrame:
    """Adds `zips`, the array of the `zip` of every polygon the point is strictly inside of."""
    x, y = f"`{lon}`", f"`{lat}`"
    turns = f"aggregate(g.edges, g.corner, (n, e) -> n + {_crossings('e', x, y, 'right', 'top')})"
    inside = f"({turns} % 2 = 1 and not exists(g.edges, e -> {_touches('e', x, y)}))"
    # Most points lie in cells without edges, where the corner bit answers alone.
    hits = f"filter(polygons, g -> if(size(g.edges) = 0, g.corner = 1, {inside}))"
    return index.attach(points, y, x, f"transform({hits}, g -> g.zip)", "flatten(collect_list(_value))").selectExpr(
        *[f"`{c}`" for c in points.columns], "_value as zips")


def assign_zip(
    points: DataFrame, index: CellIndex, *, lat: str = "Latitude", lon: str = "Longitude",
    keep_outside: bool = False, overlaps: str = "all",
) -> DataFrame:
    """Replace ZIP_Code by the containing polygon's code as a number.

    Overlapping polygons give one row each (`overlaps="all"`) or the smallest code only
    (`"smallest"`). Points outside all polygons, or whose code is not a number, are dropped unless
    `keep_outside`. Leading zeros are lost, as the code is a number.
    """
    bare = points.drop("ZIP_Code")
    found = containing_zips(bare, index, lat, lon)
    codes = "transform(zips, z -> try_cast(z as bigint))"
    pick = "array_min" if overlaps == "smallest" else "explode_outer" if keep_outside else "explode"
    out = found.selectExpr(*[f"`{c}`" for c in bare.columns], f"{pick}({codes}) as ZIP_Code")
    return out if keep_outside else out.filter(F.col("ZIP_Code").isNotNull())
