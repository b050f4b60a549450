import math
import random

import numpy as np
import pytest

from meshroad.config import BBox, EARTH_RADIUS_MILES as R
from meshroad.operators import nearest
from meshroad.operators.nearest import nearest_in_radius, nearest_unbounded, nearest_within, radius_index, unbounded_index

DLAT = math.degrees(1 / R)


def miles(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(np.asarray(lon2) - lon1) / 2) ** 2
    return 2 * R * np.arcsin(np.minimum(np.sqrt(a), 1))


def frames(spark, points, stations):
    p = spark.createDataFrame([(i, float(a), float(o)) for i, (a, o) in enumerate(points)], "Crash_ID long, Latitude double, Longitude double")
    s = spark.createDataFrame([(f"s{i:05d}", float(a), float(o), float(i + 1), 2000 + i % 20) for i, (a, o) in enumerate(stations)],
                              "station_id string, station_lat double, station_lon double, Station_Count double, Station_Year long")
    return p, s


def brute(points, stations):
    if not len(stations):
        return {i: (None, None) for i in range(len(points))}
    st = np.array(stations, dtype=float)
    out = {}
    for i, (a, o) in enumerate(points):
        d = miles(a, o, st[:, 0], st[:, 1])
        steps = np.floor(d * 1e9 + 0.5)
        j = int(np.flatnonzero(steps == steps.min())[0])
        out[i] = (f"s{j:05d}", float(d[j]))
    return out


def check(found, points, stations, cap=None, keep_distance=False):
    want, rows = brute(points, stations), found.collect()
    assert sorted(r.Crash_ID for r in rows) == list(range(len(points)))
    for r in rows:
        sid, d = want[r.Crash_ID]
        hit = d is not None and (cap is None or d <= cap)
        assert r.Nearest_Station_LocationId == (sid if hit else None), (r, sid, d)
        if hit or (keep_distance and d is not None):
            assert r.Distance_Miles == pytest.approx(d, abs=1e-7)
        else:
            assert r.Distance_Miles is None
        assert (r.Station_Count is None) == (not hit)


def cloud(n, seed, lat=(29, 31), lon=(-99, -97)):
    rnd = random.Random(seed)
    return [(rnd.uniform(*lat), rnd.uniform(*lon)) for _ in range(n)]


PATHS = [dict(), dict(broadcast_bytes=0), dict(max_candidates=8), dict(max_candidates=16, broadcast_bytes=0)]


@pytest.mark.parametrize("how", PATHS, ids=["plain", "shuffle", "split", "split-shuffle"])
def test_random_and_dense_places(spark, how):
    points = cloud(300, 1, (29.9, 30.1), (-98.1, -97.9)) + cloud(100, 2, (30.0, 30.003), (-98.0, -97.997))
    stations = cloud(60, 3, (29.9, 30.1), (-98.1, -97.9)) + cloud(150, 4, (30.0, 30.004), (-98.0, -97.996))
    stations += [stations[70]] * 40  # many stations at one place
    p, s = frames(spark, points, stations)
    check(nearest_within(p, radius_index(s, max_abs_lat=31, **how)), points, stations, cap=1.0)


def test_split_lists_are_short(spark):
    stations = cloud(500, 5, (30.0, 30.002), (-98.0, -97.998)) + cloud(20, 6)
    _, s = frames(spark, [(30, -98)], stations)
    index = radius_index(s, max_candidates=8)
    assert index.splits
    assert index.leaves.selectExpr("max(size(stations)) as n").first().n <= 8


def test_no_stations(spark):
    p, s = frames(spark, [(30, -98)], [])
    check(nearest_within(p, radius_index(s)), [(30, -98)], [], cap=1.0)


@pytest.mark.parametrize("lat", [26.0, 36.0])
def test_radius_is_closed_and_tight_on_each_axis(spark, lat):
    dlon = 2 * math.degrees(math.asin(math.sin(1 / R / 2) / math.cos(math.radians(lat))))
    points = [(lat, -98.0), (lat, -96.0), (lat, -94.0), (lat, -92.0)]
    stations = [(lat + DLAT * 0.999999, -98.0), (lat + DLAT * 1.000001, -96.0), (lat, -94.0 + dlon * 0.999999), (lat, -92.0 - dlon * 1.000001)]
    p, s = frames(spark, points, stations)
    found = nearest_within(p, radius_index(s, max_abs_lat=lat))
    check(found, points, stations, cap=1.0)
    assert [r.Nearest_Station_LocationId is not None for r in found.orderBy("Crash_ID").collect()] == [True, False, True, False]


def test_same_place_and_ties_go_to_the_smaller_id(spark):
    points = [(30.0, -98.0), (0.0, 0.0)]
    stations = [(30.0, -98.0), (30.0, -98.0), (0.005, 0.0), (-0.005, 0.0)]
    p, s = frames(spark, points, stations)
    got = [(r.Nearest_Station_LocationId, r.Distance_Miles) for r in nearest_within(p, radius_index(s)).orderBy("Crash_ID").collect()]
    assert got[0] == ("s00000", 0.0) and got[1][0] == "s00002"


@pytest.mark.parametrize("center", [(0, 180), (0, -180), (52, 179.999), (89.999, 10), (-89.995, -170), (0.0, 0.0)])
def test_antimeridian_poles_and_equator(spark, center):
    rnd = random.Random(7)

    def near():
        lat = max(-90, min(90, center[0] + rnd.uniform(-0.02, 0.02)))
        spread = min(180, 0.02 / max(1e-4, math.cos(math.radians(lat))))
        return lat, (center[1] + rnd.uniform(-spread, spread) + 180) % 360 - 180

    points, stations = [near() for _ in range(80)], [near() for _ in range(40)]
    p, s = frames(spark, points, stations)
    check(nearest_within(p, radius_index(s, max_abs_lat=60)), points, stations, cap=1.0)


def test_cell_borders_and_negative_coordinates(spark):
    grid = radius_index(frames(spark, [(0, 0)], [(0, 0)])[1], max_abs_lat=30).grid
    points, stations = [], []
    for i in range(-3, 4):
        for j in range(-3, 4):
            points.append((-30 + i * grid.height, -0.5 + j * grid.width))
            stations.append((-30 + i * grid.height + 0.3 * DLAT, -0.5 + j * grid.width - 0.3 * DLAT))
    p, s = frames(spark, points, stations)
    check(nearest_within(p, radius_index(s, max_abs_lat=30)), points, stations, cap=1.0)


def test_other_radius(spark):
    points, stations = cloud(200, 8), cloud(40, 9)
    p, s = frames(spark, points, stations)
    check(nearest_within(p, radius_index(s, radius_miles=12.5, max_candidates=8), radius_miles=12.5), points, stations, cap=12.5)


@pytest.mark.parametrize("how", [dict(), dict(broadcast_bytes=0), dict(max_candidates=3)], ids=["plain", "shuffle", "split"])
def test_unbounded_keeps_the_distance_of_far_matches(spark, how):
    points = cloud(250, 10)
    stations = cloud(15, 11) + cloud(80, 12, (30.0, 30.01), (-98.0, -97.99)) + [(45.0, -60.0)]
    p, s = frames(spark, points, stations)
    found = nearest_unbounded(p, unbounded_index(s, BBox(29, 31, -99, -97), **how))
    check(found, points, stations, cap=1.0, keep_distance=True)


def test_result_does_not_depend_on_partitions(spark):
    points, stations = cloud(200, 13, (30, 30.1), (-98.1, -98)), cloud(50, 14, (30, 30.1), (-98.1, -98))
    p, s = frames(spark, points, stations)
    a = nearest_within(p.repartition(1), radius_index(s.repartition(7)))
    b = nearest_within(p.repartition(11), radius_index(s.repartition(1)))
    assert sorted(a.collect()) == sorted(b.collect())


def test_plan_is_an_equi_join_and_small_index_is_not_shuffled_to(spark):
    p, s = frames(spark, cloud(10, 15), cloud(10, 16))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = plan(nearest_within(p, radius_index(s)))
    large = plan(nearest_within(p, radius_index(s, broadcast_bytes=0)))
    assert "BroadcastHashJoin" in small and "NestedLoop" not in small and "Cartesian" not in small
    assert "SortMergeJoin" in large and "NestedLoop" not in large and "Cartesian" not in large


def test_best_history(spark):
    rec = spark.createDataFrame(
        [("a", 10.0, 2016), ("a", 20.0, 2019), ("a", 21.0, 2019), ("a", 5.0, None), ("b", 7.0, None), ("c", 1.0, 2015), ("c", 2.0, 2021)],
        "station_id string, Station_Count double, Station_Year long")
    m = spark.createDataFrame(
        [(1, 2016, "a"), (2, 2018, "a"), (3, 2020, "b"), (4, 2018, "c"), (5, 2018, None)],
        "Crash_ID long, Crash_Year int, Nearest_Station_LocationId string").selectExpr(
        "*", "cast(null as double) as Station_Count", "cast(null as bigint) as Station_Year")
    want = {1: (10.0, 2016, 0), 2: (21.0, 2019, 1), 3: (7.0, None, None), 4: (2.0, 2021, 3), 5: (None, None, None)}
    for bytes_, rows in ((nearest.BROADCAST_BYTES, 10**6), (0, 10**6), (0, 2)):
        found = nearest.best_history(m, rec, broadcast_bytes=bytes_, slice_rows=rows)
        assert {r.Crash_ID: (r.Station_Count, r.Station_Year, r.year_gap) for r in found.collect()} == want


def test_the_way_down_several_levels_takes_one_join(spark):
    stations = cloud(400, 20, (30.0, 30.0002), (-98.0, -97.9998)) + cloud(40, 21, (30.0, 30.01), (-98.0, -97.99))
    points = cloud(200, 22, (30.0, 30.0003), (-98.0, -97.9997)) + cloud(30, 23, (29.98, 30.02), (-98.02, -97.98))
    p, s = frames(spark, points, stations)
    for how, join in ((dict(), "BroadcastHashJoin"), (dict(broadcast_bytes=0), "SortMergeJoin")):
        index = radius_index(s, max_candidates=8, **how)
        assert 3 <= index.depth <= 8
        found = nearest_within(p, index)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        # One join for each four levels, and one with the leaves (the work before a shuffle join is written first).
        assert plan.count("Join ") <= 1 + -(-index.depth // 4), plan
        assert join in found._jdf.queryExecution().executedPlan().toString()
        check(found, points, stations, cap=1.0)


def test_split_trees_hold_every_split_cell(spark):
    from meshroad.operators.grid import Grid, split_trees

    grid, rnd = Grid.of_size(0.5, 0.5), random.Random(3)
    splits = {(level, rnd.randrange(3 * 4**level), rnd.randrange(3 * 4**level)) for level in range(4) for _ in range(40)}
    cells = spark.createDataFrame([(int(eval_cell(grid, *x)),) for x in splits], "cell long")  # noqa: S307
    trees = {r.cell: r.tree for r in split_trees(grid, cells, (), 0, 4).collect()}
    assert all(len(t) == 69 for t in trees.values())
    found = set()
    for level in range(4):
        side = 4**level
        for row in range(3 * side):
            for col in range(3 * side):
                place = (side * side - 1) // 15 + row % side * side + col % side
                tree = trees.get(int(eval_cell(grid, 0, row // side, col // side)))
                if tree and tree[place // 64] >> (place % 64) & 1:
                    found.add((level, row, col))
    assert found == splits


def eval_cell(grid, level, row, col):
    return (row * grid.columns * 4**level + col) * 16 + level


@pytest.mark.parametrize("how", [dict(), dict(broadcast_bytes=0)], ids=["plain", "shuffle"])
def test_a_cell_that_cannot_be_split_has_several_rows(spark, how):
    # Stations on a circle: near its centre all of them are nearest somewhere in each small cell.
    n, center = 4_000, (10.0, 20.0)
    s = spark.range(n).selectExpr(
        "concat('s', lpad(id, 6, '0')) station_id", f"{center[0]} + 0.005 * sin(2 * pi() * id / {n}) station_lat",
        f"{center[1]} + 0.005 * cos(2 * pi() * id / {n}) / cos(radians({center[0]})) station_lon", "1D Station_Count", "2000L Station_Year")
    points = [center, (center[0] + 1e-7, center[1]), (center[0], center[1] + 2e-7), center, (10.004, 20.0), (11.0, 20.0)]
    p, _ = frames(spark, points, [(0, 0)])
    index = radius_index(s, max_abs_lat=10, max_candidates=32, **how)
    assert index.wide is not None
    assert index.leaves.selectExpr("max(size(stations)) as n").first().n <= 32
    assert index.wide.selectExpr("max(size(stations)) as n").first().n <= 2 * 1024
    rows = {r.station_id: (r.station_lat, r.station_lon) for r in s.collect()}
    ids = sorted(rows)
    places = np.array([rows[i] for i in ids])
    got = {r.Crash_ID: r for r in nearest_within(p, index).collect()}
    for i, (a, o) in enumerate(points):
        d = miles(a, o, places[:, 0], places[:, 1])
        if d.min() > 1:
            assert got[i].Nearest_Station_LocationId is None
        else:
            assert got[i].Distance_Miles == pytest.approx(d.min(), abs=2e-9)
            assert d[ids.index(got[i].Nearest_Station_LocationId)] == pytest.approx(d.min(), abs=2e-9)


def test_two_trees_pair_few_stations(spark):
    stations = cloud(5000, 30)
    _, s = frames(spark, [(30, -98)], stations)
    index = unbounded_index(s, BBox(29, 31, -99, -97))
    entries = index.leaves.selectExpr("sum(size(stations)) as n", "max(size(stations)) as longest").first()
    assert entries.longest <= nearest.SPLIT_ABOVE and entries.n <= 8 * len(stations)


def test_parts_of_a_cell_are_paired_with_near_stations_only(spark):
    stations = cloud(4000, 31, (30.0, 30.1), (-98.1, -98.0))
    _, s = frames(spark, [(30, -98)], stations)
    grid = radius_index(frames(spark, [(0, 0)], [(0, 0)])[1], max_abs_lat=31).grid
    whole = grid.explode_reach(grid.with_reach(s, "station_lat", "station_lon", 1.0)).selectExpr("*", "0 as _level", f"{grid.cell('_row', '_col')} as cell")
    parts = nearest._spread(whole, grid, (), s.columns, nearest.BROADCAST_BYTES)
    inner = parts.filter("station_lat between 30.04 and 30.06 and station_lon between -98.06 and -98.04")
    rows, n = inner.count(), inner.select("station_id").distinct().count()
    assert n > 100 and rows <= 40 * n  # 16 parts of 9 cells and more, if all were paired
    own = inner.filter(f"_row = {grid.row('station_lat', 1)} and _col = {grid.wrap(grid.col('station_lon', 1), 1)}")
    assert own.count() == n


@pytest.mark.parametrize("by", [(), ("state",)])
def test_pruning_is_compiled(spark, monkeypatch, by):
    """The JVM does not compile methods of more than 8,000 bytes, which then run many times slower."""
    from meshroad.operators import nearest

    sizes, write = {}, nearest.materialize

    def measured(df, name):
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        sizes[name] = max([sizes.get(name, 0), *[stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]])
        return write(df, name)

    monkeypatch.setattr(nearest, "materialize", measured)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # whole stages are known beforehand then
    try:
        stations = frames(spark, [], [(30 + i / 40_000, -98 + (i * 7 % 400) / 40_000) for i in range(400)])[1]
        if by:
            stations = stations.selectExpr("if(station_lat > 30.005, 'a', 'b') as state", "*")
        radius_index(stations, max_candidates=8, by=by)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {"closest", "candidates", "parts"} <= set(sizes) and max(sizes.values()) < 8000, sizes


def test_a_shuffled_index_is_read_by_rows_and_keeps_every_point(spark):
    """Equal points, ties, points without a station or a place; no lambda over the lists, which would be interpreted."""
    stations = cloud(400, 31, (30.0, 30.05), (-98.0, -97.95)) + [(30.5, -98.0)] * 3
    points = cloud(200, 32, (30.0, 30.05), (-98.0, -97.95)) + [(30.5, -98.0), (30.8, -98.5)]
    p, s = frames(spark, points, stations)
    p = p.union(p).union(spark.createDataFrame([(7777, None, None)], p.schema))
    index = radius_index(s, max_abs_lat=31, broadcast_bytes=0)
    found = nearest_within(p, index)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "lambdafunction" not in plan
    rows, want = found.collect(), brute(points, stations)
    assert sorted(r.Crash_ID for r in rows) == sorted([*range(len(points))] * 2 + [7777])
    for r in rows:
        sid, d = want.get(r.Crash_ID, (None, None))
        hit = d is not None and d <= 1.0
        assert r.Nearest_Station_LocationId == (sid if hit else None)
        assert (r.Distance_Miles is None) == (not hit) and (not hit or r.Distance_Miles == pytest.approx(d, abs=1e-7))


def test_a_shuffled_index_is_split_less(spark):
    """Lists that are too long for a broadcast index stay whole in one that is shuffled, and the rows are the same."""
    stations, points = cloud(400, 33, (30.0, 30.1), (-98.1, -98.0)), cloud(100, 34, (30.0, 30.1), (-98.1, -98.0))
    p, s = frames(spark, points, stations)
    box = BBox(29.95, 30.15, -98.15, -97.95)
    sizes = {}
    for kind, how in (("broadcast", {}), ("shuffled", dict(broadcast_bytes=0))):
        index = unbounded_index(s, box, **how)
        sizes[kind] = index.leaves.selectExpr("sum(size(stations))", "max(size(stations))").first()
        check(nearest_unbounded(p, index), points, stations, cap=1.0, keep_distance=True)
    assert sizes["broadcast"][1] <= 32 < sizes["shuffled"][1] <= 128
    assert sizes["shuffled"][0] < sizes["broadcast"][0]


def written(monkeypatch):
    """Names and tables of what the station match writes, as it goes."""
    tables, write = {}, nearest.materialize

    def noted(df, name):
        tables[name] = write(df, name)
        return tables[name]

    monkeypatch.setattr(nearest, "materialize", noted)
    return tables


def test_dense_stations_need_no_pruned_index(spark, monkeypatch):
    """Points with a station at hand are matched from short lists; no cell is pruned or split for them."""
    from meshroad.plans.enrich import match_stations
    from meshroad.sources.testdata import STATE

    side = [(30 + i * 0.001, -98 + j * 0.001) for i in range(40) for j in range(40)]
    points = cloud(200, 20, (30.001, 30.038), (-97.999, -97.962))
    p, s = frames(spark, points, side)
    tables = written(monkeypatch)
    check(match_stations(p, s, STATE), points, side, cap=1.0)
    assert "near-cells" in tables and "candidates" not in tables
    assert tables["near-cells"].selectExpr("max(size(stations)) as n").first().n <= 128


@pytest.mark.parametrize("how", [dict(), dict(broadcast_bytes=0), dict(max_candidates=16, broadcast_bytes=0), dict(near_stations=1)],
                         ids=["plain", "shuffle", "crowded", "narrow"])
def test_dense_stations_and_points_far_from_them(spark, monkeypatch, how):
    stations = cloud(500, 21, (30.0, 30.05), (-98.0, -97.95)) + cloud(200, 22, (30.02, 30.0205), (-97.98, -97.9795)) + cloud(5, 23)
    stations += [stations[3]] * 3 + [(30.1, -97.9), (30.1, -97.898)]
    points = cloud(200, 24, (29.98, 30.07), (-98.02, -97.93)) + cloud(60, 25, (30.019, 30.0215), (-97.981, -97.979)) + cloud(40, 26)
    points += [points[0], (30.1, -97.899), stations[3], (-89.99, 170.0)]
    p, s = frames(spark, points, stations)
    tables = written(monkeypatch)
    check(nearest_in_radius(p, s, max_abs_lat=31, **how), points, stations, cap=1.0)
    # The whole index has only cells in which a point is left.
    assert "near-cells" in tables and tables["open-cells"].count() > 0
    grid = nearest.Grid.for_radius(1.0, 31)
    cells = {r.cell for r in tables["open-cells"].collect()}
    roots = tables["candidates"].selectExpr(f"{grid.cell('_row div shiftleft(1L, 2 * _level)', '_col div shiftleft(1L, 2 * _level)')} as cell").distinct().collect()
    assert {r.cell for r in roots} <= cells


def test_dense_stations_by_state_and_points_off_the_globe(spark):
    stations = cloud(400, 27, (30.0, 30.04), (-98.0, -97.96))
    points = cloud(100, 28, (30.0, 30.04), (-98.0, -97.96))
    p, s = frames(spark, points, stations)
    p = p.selectExpr("if(Crash_ID % 2 = 0, 'a', 'b') as state", "*")
    s = s.selectExpr("if(cast(substr(station_id, 2) as int) % 2 = 0, 'a', 'b') as state", "*")
    odd = spark.createDataFrame([("a", 1000, None, -98.0), ("b", 1001, float("nan"), -98.0), (None, 1002, 30.0, -98.0), ("c", 1003, 30.02, -97.98)],
                                "state string, Crash_ID long, Latitude double, Longitude double")
    got = nearest_in_radius(p.unionByName(odd), s, max_abs_lat=31, by=("state",)).collect()
    assert len(got) == 104 and all(r.Nearest_Station_LocationId is None for r in got if r.Crash_ID >= 1000)
    for k, state in enumerate("ab"):
        mine = stations[k::2]
        want = brute(points, mine)
        for r in got:
            if r.state == state and r.Crash_ID < 1000:
                sid, d = want[r.Crash_ID]
                assert r.Nearest_Station_LocationId == f"s{2 * int(sid[1:]) + k:05d}" and r.Distance_Miles == pytest.approx(d, abs=1e-7)


def test_ranking_in_runs_is_compiled(spark):
    """A leaf's entries are ranked several in a row; the method is short enough for the JVM to compile."""
    stations = cloud(60, 29, (30.0, 30.01), (-98.0, -97.99))
    p, s = frames(spark, cloud(20, 30, (30.0, 30.01), (-98.0, -97.99)), stations)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = nearest_within(p, radius_index(s, broadcast_bytes=0))
        stages = found._jdf.queryExecution().debug().codegenToSeq()
        size = max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
        text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert size < 8000 and "least(" in text
