import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meshroad.operators.asof import closest_in_time
from meshroad.operators.quantiles import exact_quantiles
from meshroad.operators.slices import in_slices


def closest(asked, records):
    """Brute force: smaller gap, no time last, later time, less weight, less name."""
    out = {}
    for k, t in set(asked):
        if k is None or t is None:
            continue
        ranked = sorted((u is None, 0 if u is None else abs(t - u), 0 if u is None else -u, w, n) for j, u, w, n in records if j == k)
        if ranked:
            no_time, gap, later, _, name = ranked[0]
            out[k, t] = (None, None, name) if no_time else (gap, -later, name)
    return out


@pytest.mark.parametrize("slice_rows", [10**6, 40])
def test_closest_in_time_equals_brute_force_with_a_hot_group(spark, slice_rows):
    rnd = random.Random(8)
    group = lambda: "hot" if rnd.random() < 0.4 else rnd.choice([None, "a", "b", "c", "d", "e"])
    records = [(group(), rnd.choice([None, *range(-500, 500, 3)]), rnd.choice([1, 2, 5]), f"r{rnd.randrange(4)}") for _ in range(300)]
    records += [("undated", None, 3, "x"), ("undated", None, 2, "y"), ("idle", 7, 1, "z"), ("ties", 10, 1, "early"), ("ties", 20, 9, "late")]
    asked = [(group(), rnd.randrange(-9000, 9000)) for _ in range(900)] + [("undated", 4), ("nobody", 4), ("a", None), ("ties", 15), ("ties", 10), ("ties", 21)]
    table, size = closest_in_time(
        spark.createDataFrame(asked, "g string, t int"), spark.createDataFrame(records, "g string, u long, w int, n string"),
        by=["g"], asked_time="t", record_time="u", order="w", payload=["n as n"], slice_rows=slice_rows)
    want = closest(asked, records)
    rows = table.collect()
    assert len(rows) == len(want) and size >= len(want) * 100
    assert {(r.g, r.t): (r._best.gap, r._best.time, r._best.n) for r in rows} == want
    assert want["ties", 15][2] == "late" and want["undated", 4] == (None, None, "y")


def test_closest_in_time_of_empty_tables(spark):
    asked, records = spark.createDataFrame([("a", 1)], "g string, t int"), spark.createDataFrame([("a", 1, 1)], "g string, u long, w int")
    how = dict(by=["g"], asked_time="t", record_time="u", order="w", payload=["w as w"])
    for a, r in ((asked.limit(0), records), (asked, records.limit(0)), (asked.limit(0), records.limit(0))):
        table, _ = closest_in_time(a, r, **how)
        assert table.collect() == []


def test_one_group_lies_in_several_slices_of_bounded_size(spark):
    df = spark.range(30_000).selectExpr("cast(id % 100 = 0 as int) as g", "hash(id) as v", "id")
    sliced = in_slices(df, ["g"], ["v", "id"], 30_000, 5_000)
    per = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("g", "v", "id")).alias("lo"), F.max(F.struct("g", "v", "id")).alias("hi"))
    slices = sorted(per.collect(), key=lambda r: r._slice)
    assert len(slices) >= 6 and max(r.n for r in slices) <= 5_000 and sum(r.n for r in slices) == 30_000
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(slices, slices[1:]))


def test_quantiles_of_a_group_in_many_slices_next_to_a_null_group(spark):
    rng = np.random.default_rng(4)
    values = {None: rng.normal(size=2500), 1: np.round(rng.normal(size=4000), 2), 2: np.array([5.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g int, v double")
    probs = {"least": 0.0, "q": 0.3337, "most": 1.0}
    found = exact_quantiles(df, "v", probs, by=["g"], task_values=100)
    got = {r.g: r for r in found.collect()}
    for g, vs in values.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12, abs=1e-15)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
