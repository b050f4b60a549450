"""Nearest station of every point: within a radius, without one, and from a station's history.

Spark has no spatial index, so the index is a table: grid cell -> the stations that can be the
nearest one for some point of the cell. A station s can be that only if
    d(centre, s) <= min over stations of d(centre, .) + 2 * half diagonal,
by the triangle inequality, and if it beats the centre's nearest station at some corner. Cells that keep too many stations are split and pruned again,
so no cell's list grows with the data, however dense the stations are in one place. The points
then need one equi join on the cell. Pruning compares chords, which need no inverse functions: they obey the triangle
inequality too, and none is longer than its arc.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from meshroad.config import BBox, EARTH_RADIUS_MILES, MAX_STATION_MILES
from meshroad.functions.geo import chord, chord_miles, haversine_miles, num, unit_xyz
from meshroad.operators.asof import closest_in_time
from meshroad.operators.clean import first_per_key
from meshroad.operators.grid import EPS_DEGREES, EPS_MILES, MAX_LEVEL, PARTS, SPLIT, TREE_LEVELS, WIDE_ENTRIES, CellIndex, Grid
from meshroad.operators.joins import lookup_join, union_all
from meshroad.operators.slices import SLICE_ROWS
from meshroad.session import BROADCAST_BYTES, materialize

# Lists up to this length are taken as they come; beyond it cells are split.
MAX_CANDIDATES = 128
# Length up to which a cell is not split further where the index is broadcast. One that is shuffled stays smaller with longer
# lists, and its lists are read faster (`CellIndex.attach`).
SPLIT_ABOVE, SPLIT_SHUFFLED_ABOVE = 32, 128
# Upper bound of one station entry in the index, in bytes.
ENTRY_BYTES = 128
# Upper bound of the splits below one cell in the index, a bit map of 69 words.
TREE_BYTES = 69 * 8 + 64
# Upper bound of a cell's closest station as it is broadcast, in bytes.
CLOSEST_BYTES = 256
# Levels that box cells and station cells go down together, at most.
COARSE_LEVELS = 6
# Box cells go down with station cells while they have so many times the wanted candidates; below that stations cost less.
COARSE_ABOVE = 64
# A cell of so many stations stays whole if its parts together have so many times its entries.
STUCK_ABOVE, STUCK_GROWTH = 1024, 3
# Where stations are dense, points are first matched within a radius whose square has so many stations on average. Of points among
# stations strewn evenly, one in 300,000 then has none within it.
NEAR_STATIONS = 4
# Distances are compared in steps of 1e-9 mile, so that rounding noise cannot break a tie.
TIE_STEPS_PER_MILE = 1e9


def _gather(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per cell, its stations by id; the lists are bounded because crowded cells were split before."""
    x, y, z = unit_xyz("station_lat", "station_lon")
    entry = F.expr(
        f"struct(station_id as id, {x} as x, {y} as y, {z} as z, station_lat as lat, station_lon as lon, "
        "Station_Count as count, Station_Year as year)")
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("stations"))


def _one_per_place(stations: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of stations at the same coordinates only the first by id can win a tie."""
    return first_per_key(stations, [*by, "station_lat", "station_lon"], [F.col("station_id").asc_nulls_last()])


def _crowd(stations: DataFrame, grid: Grid, by: Sequence[str], radius_miles: float) -> Row:
    """Most stations of a cell (`n`), cells that hold some, and (cell, station) pairs within the radius, at most."""
    spread = grid.with_reach(stations, "station_lat", "station_lon", radius_miles)
    cells = spread.selectExpr(*by, f"{grid.cell_of('station_lat', 'station_lon')} as cell", "(_r1 - _r0 + 1) * (_c1 - _c0 + 1) as copies").groupBy(
        *by, "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"))
    return cells.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("cells"), F.sum("copies").alias("copies")).first()


def radius_index(
    stations: DataFrame,
    *,
    radius_miles: float = MAX_STATION_MILES,
    max_abs_lat: float = 45.0,
    by: Sequence[str] = (),
    crowd_bound: DataFrame | None = None,
    max_candidates: int = MAX_CANDIDATES,
    broadcast_bytes: int = BROADCAST_BYTES,
    crowd: Row | None = None,
    only: DataFrame | None = None,
) -> CellIndex:
    """Index for "nearest station within `radius_miles`".

    `crowd_bound` may name a superset of the stations that is cheaper to scan (the records before
    they are reduced to one per station); it is used only to bound list lengths and table size. `crowd` tells
    what was found in it before. `only` names the cells of level 0 in which points will be asked for, as a written table.
    """
    by = tuple(by)
    grid = Grid.for_radius(radius_miles, max_abs_lat)
    spread = lambda df: grid.with_reach(df, "station_lat", "station_lon", radius_miles)

    if crowd is None:
        crowd = _crowd(crowd_bound if crowd_bound is not None else stations, grid, by, radius_miles)
    # A circle of the cells' own size touches at most nine of them, away from the poles.
    if only is None and 9 * (crowd.n or 0) <= max_candidates:
        pairs = grid.explode_reach(spread(stations))
        leaves = _gather(pairs.withColumn("cell", F.expr(grid.cell("_row", "_col"))), [*by, "cell"])
        fits = (crowd.copies or 0) * ENTRY_BYTES <= broadcast_bytes
        return CellIndex(grid, leaves if fits else materialize(leaves, "station-cells"), None, 0, by, fits)
    pairs = grid.explode_reach(spread(materialize(_one_per_place(stations, by), "places")))
    if only is not None:
        pairs = lookup_join(pairs.withColumn("cell", F.expr(grid.cell("_row", "_col"))), only, [*by, "cell"],
                            broadcastable=only.count() * 64 <= broadcast_bytes, how="left_semi").drop("cell")
    return _refine(pairs.selectExpr("*", "0 as _level"), grid, by, radius_miles, max_candidates, broadcast_bytes)


def nearest_in_radius(
    points: DataFrame,
    stations: DataFrame,
    *,
    radius_miles: float = MAX_STATION_MILES,
    max_abs_lat: float = 45.0,
    by: Sequence[str] = (),
    crowd_bound: DataFrame | None = None,
    max_candidates: int = MAX_CANDIDATES,
    broadcast_bytes: int = BROADCAST_BYTES,
    near_stations: int = NEAR_STATIONS,
    lat: str = "Latitude",
    lon: str = "Longitude",
) -> DataFrame:
    """`nearest_within` of a `radius_index`, where stations are dense in two steps.

    Most points then have a station within a small part of the radius. A grid as fine as that finds it from lists that need no
    pruning and no splits. Points without one, and those of cells with too many stations, are matched by the whole index,
    which is made only for the cells they lie in.
    """
    by = tuple(by)
    grid = Grid.for_radius(radius_miles, max_abs_lat)
    crowd = _crowd(crowd_bound if crowd_bound is not None else stations, grid, by, radius_miles)
    matched = lambda df, index: nearest_within(df, index, radius_miles=radius_miles, lat=lat, lon=lon)
    index = lambda df, **kw: radius_index(
        df, radius_miles=radius_miles, max_abs_lat=max_abs_lat, by=by, max_candidates=max_candidates, broadcast_bytes=broadcast_bytes, crowd=crowd, **kw)
    if 9 * (crowd.n or 0) <= max_candidates:
        return matched(points, index(stations))
    places = materialize(_one_per_place(stations, by), "places")
    near_miles = radius_miles * math.sqrt(near_stations * crowd.cells / max(1, places.count()))
    if near_miles >= radius_miles:
        return matched(points, index(places))
    fine = Grid.for_radius(near_miles, max_abs_lat)
    keys = [*by, "cell"]
    pairs = fine.explode_reach(fine.with_reach(places, "station_lat", "station_lon", near_miles)).withColumn("cell", F.expr(fine.cell("_row", "_col")))
    full = materialize(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_candidates).select(*keys), "crowded")
    n_full = full.count()
    if n_full:
        pairs = lookup_join(pairs, full, keys, broadcastable=n_full * 64 <= broadcast_bytes, how="left_anti")
    leaves = materialize(_gather(pairs, keys), "near-cells")
    found = materialize(_best_station(points, CellIndex(fine, leaves, None, 0, by), lat, lon), "near")
    # A distance that is shorter than the small radius by more than a tie is the shortest of all.
    settled = F.expr(f"coalesce(_miles < {num(near_miles)} - {num(EPS_MILES)}, false)")
    here = _station_columns(points, found.filter(settled), radius_miles, f"case when _miles <= {num(radius_miles)} then _miles end")
    rest = found.filter(~settled).select(*points.columns)
    only = materialize(rest.selectExpr(*by, f"{grid.cell_of(f'`{lat}`', f'`{lon}`')} as cell").distinct(), "open-cells")
    if only.isEmpty():
        return here
    return here.unionByName(matched(rest, index(places, only=only)))


def unbounded_index(
    stations: DataFrame,
    box: BBox,
    *,
    by: Sequence[str] = (),
    max_candidates: int = MAX_CANDIDATES,
    broadcast_bytes: int = BROADCAST_BYTES,
    roots_per_side: int = 4,
) -> CellIndex:
    """Index for "nearest station at any distance" of points inside `box`.

    Two trees of cells go down together: cells of the box, and cells that hold stations, with their number and one station
    of each. That station bounds a box cell's distance from above, so far cells of stations drop out before any of their
    stations is paired. A box cell with few stations left is paired with them one by one.
    """
    by = tuple(by)
    grid = Grid.of_size(max((box.lat_max - box.lat_min) / roots_per_side, 1e-3),
                        max((box.lon_max - box.lon_min) / roots_per_side, 1e-3))
    bounds = {"_r0": math.floor((box.lat_min + 90) / grid.height), "_r1": math.floor((box.lat_max + 90) / grid.height),
              "_c0": math.floor((box.lon_min + 180) / grid.width), "_c1": math.floor((box.lon_max + 180) / grid.width)}
    places = materialize(_one_per_place(stations, by), "places")
    wanted = min(max_candidates, SPLIT_ABOVE)
    depth = min(COARSE_LEVELS, max(0, math.ceil(math.log(max(1, places.count()) / wanted, SPLIT * SPLIT))))
    pairs, splits = _descend(places, grid, by, bounds, depth, wanted, broadcast_bytes)
    return _refine(pairs, grid, by, None, max_candidates, broadcast_bytes, splits)


def _station_cells(places: DataFrame, grid: Grid, by: tuple[str, ...], depth: int) -> DataFrame:
    """Cells of all levels down to `depth` that hold stations: level, row, column, number of stations, one of them."""
    levels = f"explode(sequence(0, {depth})) as _l"
    cells = places.selectExpr(*by, "struct(station_lat as lat, station_lon as lon) as one", levels).selectExpr(
        *by, "_l", f"{grid.row('one.lat', '_l')} as _sr", f"{grid.wrap(grid.col('one.lon', '_l'), '_l')} as _sc", "one")
    return materialize(cells.groupBy(*by, "_l", "_sr", "_sc").agg(F.count(F.lit(1)).alias("n"), F.min("one").alias("one")), "station-tree")


def _descend(places: DataFrame, grid: Grid, by: tuple[str, ...], bounds: dict[str, int], depth: int, max_candidates: int, broadcast_bytes: int
             ) -> tuple[DataFrame, list[DataFrame]]:
    """(box cell, station) pairs that may be nearest ones, box cells of several levels, and the box cells that were split."""
    tree = _station_cells(places, grid, by, depth)
    keys, ready, splits = [*by, "_row", "_col"], [], []
    here = [*keys, "_level", "_sr", "_sc", "n", "one"]
    pairs = grid.explode_reach(tree.filter("_l = 0").selectExpr("*", *[f"{v}L as {c}" for c, v in bounds.items()])).withColumnRenamed("_l", "_level")
    for level in range(depth + 1):
        # Written, and measured by chords in small steps, so that the JVM can compile them: see `_corners`.
        pairs = materialize(pairs.select(*here), "box-pairs")
        ones = _scored(pairs.selectExpr(*keys, "_level", "one.lat as station_lat", "one.lon as station_lon"), grid, by)
        reach = f"_u + 2D * {grid.half_chord_miles('_row', level)} + {num(EPS_MILES)}"
        least = ones.groupBy(*keys).agg(F.min("_d").alias("_u"), F.count(F.lit(1)).alias("_rows"))
        least = materialize(least.selectExpr(*keys, f"{reach} as _reach", "_rows"), "least")
        cells = least.agg(F.count(F.lit(1)).alias("n"), F.max("_rows").alias("most")).first()
        c = grid.center("_sr", "_sc", level)
        scored = _scored(pairs.selectExpr(*here, f"{c[0]} as station_lat", f"{c[1]} as station_lon"), grid, [*by, "_sr", "_sc", "n", "one"])
        near = lookup_join(scored, least.drop("_rows"), keys, broadcastable=cells.n * CLOSEST_BYTES <= broadcast_bytes, how="inner", most=cells.most).filter(
            f"_d - {grid.half_chord_miles('_sr', level)} <= _reach")
        kept = materialize(near.select(*here), "cell-pairs")
        sizes = kept.groupBy(*keys).agg(F.sum("n").alias("_all"))
        crowded = materialize(sizes.filter(F.col("_all") > COARSE_ABOVE * max_candidates).select(*keys), "crowded") if level < depth else None
        n_crowded = crowded.count() if crowded is not None else 0
        if not n_crowded:
            ready.append(kept)
            break
        marked = lookup_join(kept, crowded.withColumn("_crowded", F.lit(True)), keys, broadcastable=n_crowded * 64 <= broadcast_bytes)
        ready.append(marked.filter("_crowded is null").drop("_crowded"))
        splits.append(crowded.selectExpr(*by, f"{grid.cell('_row', '_col', level)} as cell"))
        # Parts of the box cell, with the parts of the station cell that hold stations.
        finer = tree.filter(f"_l = {level + 1}").selectExpr(
            *by, "_sr as _fr", "_sc as _fc", "n as _fn", "one as _fone", f"_sr div {SPLIT} as _sr", f"_sc div {SPLIT} as _sc")
        parts = marked.filter("_crowded").select(*keys, "_sr", "_sc").join(finer.hint("shuffle_merge"), [*by, "_sr", "_sc"])
        pairs = parts.selectExpr(*by, "_row", "_col", "_fr", "_fc", "_fn", "_fone", f"explode({PARTS}) as _q").selectExpr(
            *by, f"_row * {SPLIT} + _q.r as _row", f"_col * {SPLIT} + _q.c as _col", f"{level + 1} as _level",
            "_fr as _sr", "_fc as _sc", "_fn as n", "_fone as one")
    out = []
    for level, cells in enumerate(ready):
        at = places.selectExpr("*", f"{grid.row('station_lat', level)} as _sr", f"{grid.wrap(grid.col('station_lon', level), level)} as _sc")
        out.append(at.join(cells.select(*keys, "_level", "_sr", "_sc").hint("shuffle_merge"), [*by, "_sr", "_sc"]).select(*places.columns, "_row", "_col", "_level"))
    return union_all(out), splits


def _corners(closest: DataFrame, grid: Grid, keep: Sequence[str], reach: str) -> DataFrame:
    """Sines and cosines of each cell's borders, how much the cell bulges out of its corners, for `_BEATEN`, and `reach`.

    Made once per cell, and in small steps, as a method that is too long is not compiled by the JVM and runs many times slower.
    """
    degrees = {"_s": grid.bottom("_row", "_level"), "_n": grid.bottom("_row + 1", "_level"),
               "_w": grid.left("_col", "_level"), "_e": grid.left("_col + 1", "_level")}
    steps = closest.selectExpr(*keep, f"{grid.half_diagonal_miles('_row', '_level')} / {num(EARTH_RADIUS_MILES)} as _angle",
                               f"{grid.half_chord_miles('_row', '_level')} as _h", *[f"radians({v}) as {k}" for k, v in degrees.items()])
    steps = steps.selectExpr(*keep, "_angle", "_h", *[f"{f}({v}) as {f}{v}" for v in degrees for f in ("sin", "cos")])
    return steps.selectExpr(*[c for c in keep if c != "_least"], f"{reach} as _reach", *[f"{f}{v}" for v in degrees for f in ("sin", "cos")],
                            "if(least(cos_s, cos_n) > 0.01D, _angle * _angle * (1D + 1D / least(cos_s, cos_n)), 1e9D) as _bulge")


# The cell's closest station, at c, is nearer than the station, at p, to every point of the cell. A point q is nearer to c
# where q . (c - p) > 0. That is linear in q, so the four corners decide, up to the little that a cell on the sphere bulges
# out of its corners' flat hull. Near the poles the bulge is given as so large that nothing is left out. Of two corners on one parallel the same one is the
# lower for both parallels, as cosines of latitudes are positive. This is short on purpose: see `_corners`.
_SIDE = "least({})".format(", ".join(f"cos_{o} * (_cx - _px) + sin_{o} * (_cy - _py)" for o in "we"))
_BEATEN = "least({}) > {} * _bulge + 1e-15D".format(
    ", ".join(f"cos_{a} * {_SIDE} + sin_{a} * (_cz - _pz)" for a in "sn"), chord(("_cx", "_cy", "_cz"), ("_px", "_py", "_pz")))


def _spread(before: DataFrame, grid: Grid, by: tuple[str, ...], station_cols: Sequence[str], broadcast_bytes: int) -> DataFrame:
    """(part, station) pairs of cells that are split, those parts left out that are clearly too far from the station.

    The stations inside a cell bound the distance from the centre of each of its parts, so a station matters only to
    parts near it. In a cell without a station of its own all pairs are made.
    """
    keys, cell = [*by, "cell"], ["_row", "_col", "_level"]
    inside = f"_row = {grid.row('station_lat', '_level')} and _col = {grid.wrap(grid.col('station_lon', '_level'), '_level')}"
    parts = before.filter(inside).selectExpr(*keys, "station_lat", "station_lon", *cell, f"explode({PARTS}) as _q").selectExpr(
        *keys, "station_lat", "station_lon", f"_row * {SPLIT} + _q.r as _row", f"_col * {SPLIT} + _q.c as _col", "_level + 1 as _level")
    bounds = _scored(parts, grid, keys).groupBy(*keys, "_row", "_col").agg(F.min("_d").alias("_d")).groupBy(*keys).agg(F.max("_d").alias("_far"))
    bounds = materialize(bounds, "reach")
    near = lookup_join(before, bounds, keys, broadcastable=bounds.count() * CLOSEST_BYTES <= broadcast_bytes)
    # Half the diagonal of the whole is twice that of a part. An angle as wide as the chord, and its extent in longitude.
    miles = f"(_far + {grid.half_chord_miles('_row', '_level')} / 2D + {num(3 * EPS_MILES)})"
    near = near.selectExpr(*station_cols, *cell, f"2D * asin(least({miles} / {num(2 * EARTH_RADIUS_MILES)}, 1D)) as _angle")
    near = near.selectExpr(*station_cols, *cell, "degrees(_angle) as _north",
                           "case when abs(station_lat) + degrees(_angle) < 89.9D then degrees(asin(least(sin(_angle) / cos(radians(station_lat)), 1D))) end as _east")
    # Columns are not cut where the extent is unknown or crosses the antimeridian. Small steps, so that the JVM can compile them.
    near = near.selectExpr(*station_cols, "_row", "_col", "_level + 1 as _level", "_north", "_east",
                           "(_east is not null and station_lon - _east > -179.9D and station_lon + _east < 179.9D) as _cut")
    ends = [("_r0", "_row", "_north is not null", grid.row(f"(station_lat - _north - {num(EPS_DEGREES)})", "_level"), 0),
            ("_r1", "_row", "_north is not null", grid.row(f"(station_lat + _north + {num(EPS_DEGREES)})", "_level"), SPLIT - 1),
            ("_c0", "_col", "_cut", grid.col(f"(station_lon - _east - {num(EPS_DEGREES)})", "_level"), 0),
            ("_c1", "_col", "_cut", grid.col(f"(station_lon + _east + {num(EPS_DEGREES)})", "_level"), SPLIT - 1)]
    near = near.selectExpr(*station_cols, "_row", "_col", "_level", *[f"if({known}, {at}, null) as {name}" for name, _, known, at, _ in ends])
    near = near.selectExpr(*station_cols, "_level", *[
        f"{'least' if last else 'greatest'}({whole} * {SPLIT} + {last}, {name}) as {name}" for name, whole, _, _, last in ends])
    span = lambda a, b: f"if({a} <= {b}, sequence({a}, {b}), array())"
    near = near.selectExpr(*station_cols, "_level", "_c0", "_c1", f"explode({span('_r0', '_r1')}) as _row")
    return near.selectExpr(*station_cols, "_row", f"explode({span('_c0', '_c1')}) as _col", "_level")


def _scored(pairs: DataFrame, grid: Grid, keep: Sequence[str]) -> DataFrame:
    """Adds the station's position (`_px`, `_py`, `_pz`) and its chord from the cell's centre in miles (`_d`)."""
    station = unit_xyz("station_lat", "station_lon")
    center = grid.center("_row", "_col", "_level")
    steps = pairs.selectExpr(*keep, "_row", "_col", "_level", *[f"{v} as _p{c}" for c, v in zip("xyz", station)], f"{center[0]} as _qa", f"{center[1]} as _qo")
    steps = steps.selectExpr(*keep, "_row", "_col", "_level", "_px", "_py", "_pz", *[f"{v} as _q{c}" for c, v in zip("xyz", unit_xyz("_qa", "_qo"))])
    return steps.selectExpr(*keep, "_row", "_col", "_level", "_px", "_py", "_pz", f"{chord_miles(('_px', '_py', '_pz'), ('_qx', '_qy', '_qz'))} as _d")


def _refine(
    pairs: DataFrame, grid: Grid, by: tuple[str, ...], radius: float | None,
    max_candidates: int, broadcast_bytes: int, splits: Sequence[DataFrame] = (),
) -> CellIndex:
    """Prune (cell, station) pairs and split crowded cells until every list is short.

    The pairs may be of cells of several levels (`_level`). The loop runs on the driver; the pairs stay in tables in the
    shared folder. `splits` are the cells split before. Cells whose
    parts do not get shorter lists, and those of the last level that are still too long, get several rows.
    """
    keys = [*by, "cell"]
    cell = ["_row", "_col", "_level"]
    station_cols = [c for c in pairs.columns if c not in cell]
    leaves, splits, wide, entries, n_wide = [], list(splits), [], 0, 0
    # The parts that are written have their cell's number beside them, as what follows is then short enough to be compiled.
    numbered = lambda df: df.withColumn("cell", F.expr(grid.cell("_row", "_col", "_level")))
    pairs = numbered(pairs)
    reach = f"_least + 2D * _h + {num(EPS_MILES)}"
    reach = reach if radius is None else f"least({reach}, {num(radius)} + _h)"
    before = None  # rows of the cells that were split last
    longest = sorted({min(max_candidates, SPLIT_ABOVE), min(max_candidates, SPLIT_SHUFFLED_ABOVE)})
    parent = grid.cell(f"(_row div {SPLIT})", f"(_col div {SPLIT})", "(_level - 1)")
    while True:
        scored = _scored(pairs, grid, [*station_cols, "cell"])
        closest = scored.groupBy(*keys).agg(
            F.min("_d").alias("_least"), *[F.min_by(f"_p{c}", "_d").alias(f"_c{c}") for c in "xyz"], F.count(F.lit(1)).alias("_rows"))
        closest = closest.selectExpr("*", *[f"{v} as {k}" for k, v in grid.place("cell").items()])
        closest = materialize(_corners(closest, grid, [*keys, "_least", "_cx", "_cy", "_cz", "_rows"], reach), "closest")
        cells = closest.agg(F.count(F.lit(1)).alias("n"), F.max("_rows").alias("most")).first()
        near = lookup_join(scored, closest.drop("_rows"), keys, broadcastable=cells.n * CLOSEST_BYTES <= broadcast_bytes, how="inner", most=cells.most)
        kept = materialize(near.filter("_d <= _reach").filter(f"not ({_BEATEN})").select(*station_cols, *cell, "cell"), "candidates")
        if before is not None:
            # Where the parts together have much more than the whole had, splitting does not shorten the lists fast enough
            # (stations around a circle, seen from near its centre): the whole stays, in several rows.
            sums = kept.selectExpr(*by, f"{parent} as cell").groupBy(*keys).agg(F.count(F.lit(1)).alias("_parts"))
            full = before.select(*keys, "_n").filter(F.col("_n") >= STUCK_ABOVE).distinct()
            stuck = materialize(full.join(sums.hint("shuffle_merge"), keys).filter(f"_parts > {STUCK_GROWTH} * _n").select(*keys), "stuck")
            n_stuck = stuck.count()
            if n_stuck:
                small = dict(broadcastable=n_stuck * 64 <= broadcast_bytes)
                wide.append(lookup_join(before, stuck, keys, how="left_semi", **small))
                splits[-1] = lookup_join(splits[-1], stuck, keys, how="left_anti", **small)
                parts = lookup_join(kept.withColumnRenamed("cell", "_cell").withColumn("cell", F.expr(parent)), stuck, keys, how="left_anti", **small)
                kept = materialize(parts.drop("cell").withColumnRenamed("_cell", "cell"), "candidates")
        sizes = kept.groupBy(*keys, "_level").agg(F.count(F.lit(1)).alias("_n"))
        last = F.col("_level") >= MAX_LEVEL
        counts = [c for n in longest for c in (F.count_if((F.col("_n") > n) & ~last).alias(f"crowded{n}"), F.count_if((F.col("_n") > n) & last).alias(f"last{n}"))]
        total = sizes.agg(F.sum("_n").alias("entries"), *counts).first()
        entries += total.entries or 0  # an upper bound: entries of split cells count again below
        max_candidates = longest[0] if entries * ENTRY_BYTES <= broadcast_bytes else longest[-1]
        crowded, at_end = total[f"crowded{max_candidates}"], total[f"last{max_candidates}"]
        if not crowded and not at_end:
            leaves.append(kept)
            break
        full = materialize(sizes.filter(F.col("_n") > max_candidates).select(*keys, "_n"), "crowded")
        marked = lookup_join(kept, full, keys, broadcastable=(crowded + at_end) * 64 <= broadcast_bytes)
        leaves.append(marked.filter("_n is null").drop("_n"))
        if at_end:
            wide.append(marked.filter(f"_n is not null and _level >= {MAX_LEVEL}"))
        if not crowded:
            break
        splits.append(full.filter(f"cell % 16 < {MAX_LEVEL}").select(*keys))
        before = marked.filter(f"_n is not null and _level < {MAX_LEVEL}")
        pairs = materialize(numbered(_spread(before, grid, by, station_cols, broadcast_bytes)), "parts")
    several = None
    if wide:
        part = f"cast(pmod(xxhash64(station_id, station_lat, station_lon), ceil(_n / {WIDE_ENTRIES})) as int) as _part"
        several = materialize(_gather(union_all(wide).selectExpr("*", part), [*keys, "_part"]).drop("_part"), "wide-cells")
        n_wide = several.agg(F.sum(F.size("stations"))).first()[0] or 0
    table = _gather(union_all(leaves), keys)
    fits = entries * ENTRY_BYTES <= broadcast_bytes
    if not splits:
        table = table if fits else materialize(table, "station-cells")
        return CellIndex(grid, table, None, 0, by, fits, wide=several, wide_broadcastable=n_wide * ENTRY_BYTES <= broadcast_bytes)
    found = materialize(union_all(splits).withColumn("_level", F.expr("cell % 16")), "split-cells")
    # A bit map belongs to a split cell of every fourth level.
    size = found.agg(F.count_if(F.col("_level") % TREE_LEVELS == 0).alias("trees"), F.max("_level").alias("deepest")).first()
    return CellIndex(grid, materialize(table, "station-cells"), found.drop("_level"), 0 if size.deepest is None else size.deepest + 1, by, fits,
                     size.trees * TREE_BYTES <= broadcast_bytes, several, n_wide * ENTRY_BYTES <= broadcast_bytes)


def _best_station(points: DataFrame, index: CellIndex, lat: str, lon: str) -> DataFrame:
    """Adds `_best`, the nearest station's entry (ties by id), and `_miles`, its distance."""
    plain = [f"`{c}`" for c in points.columns]
    x, y, z = unit_xyz(f"`{lat}`", f"`{lon}`")
    steps = lambda s: f"floor({chord((f'{s}.x', f'{s}.y', f'{s}.z'), ('_x', '_y', '_z'))} * {num(EARTH_RADIUS_MILES * TIE_STEPS_PER_MILE)} + 0.5D)"
    ranked = f"array_min(transform(stations, s -> struct({steps('s')} as steps, s.id as id, s as s)))"
    # A leaf's stations come by id, so the first of the nearest ones has the smallest.
    least = ("stations", steps, "struct(_rank as steps, s.id as id, s as s)")
    found = index.attach(points, f"`{lat}`", f"`{lon}`", ranked, "min(_value)", [f"{x} as _x", f"{y} as _y", f"{z} as _z"], least)
    return found.selectExpr(*plain, "_value.s as _best").selectExpr(
        *plain, "_best", f"{haversine_miles(f'`{lat}`', f'`{lon}`', '_best.lat', '_best.lon')} as _miles")


def _station_columns(points: DataFrame, found: DataFrame, radius_miles: float, miles: str) -> DataFrame:
    near = lambda value, name: f"case when _miles <= {num(radius_miles)} then {value} end as {name}"
    return found.selectExpr(
        *[f"`{c}`" for c in points.columns], near("_best.id", "Nearest_Station_LocationId"),
        near("_best.lat", "Station_Lat"), near("_best.lon", "Station_Lon"),
        near("_best.count", "Station_Count"), near("_best.year", "Station_Year"), f"{miles} as Distance_Miles")


def nearest_within(
    points: DataFrame, index: CellIndex, *, radius_miles: float = MAX_STATION_MILES,
    lat: str = "Latitude", lon: str = "Longitude",
) -> DataFrame:
    """Left semantics: every point once, station columns null when none is within the radius."""
    found = _best_station(points, index, lat, lon)
    return _station_columns(points, found, radius_miles, f"case when _miles <= {num(radius_miles)} then _miles end")


def nearest_unbounded(
    points: DataFrame, index: CellIndex, *, radius_miles: float = MAX_STATION_MILES,
    lat: str = "Latitude", lon: str = "Longitude",
) -> DataFrame:
    """Distance to the nearest station at any distance; its columns only when within the radius."""
    return _station_columns(points, _best_station(points, index, lat, lon), radius_miles, "_miles")


def best_history(
    matched: DataFrame, records: DataFrame, *, by: Sequence[str] = (), broadcast_bytes: int = BROADCAST_BYTES, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Replace count and year by the matched station's record closest to the crash year, whatever the years.

    Order: smaller gap, missing year last, later year, larger count.
    """
    keys = [*by, "Nearest_Station_LocationId", "Crash_Year"]
    named = records.withColumnRenamed("station_id", "Nearest_Station_LocationId")
    table, size = closest_in_time(
        matched, named, by=keys[:-1], asked_time="Crash_Year", record_time="Station_Year", order="-Station_Count", payload=["Station_Count as count"],
        slice_rows=slice_rows)
    joined = lookup_join(matched, table, keys, broadcastable=size <= broadcast_bytes)
    renamed = {"Station_Count": "_best.count", "Station_Year": "_best.time"}
    columns = [F.col(renamed.get(c, c)).alias(c) for c in matched.columns if c != "year_gap"]
    return joined.select(*columns, F.col("_best.gap").alias("year_gap"))
