import random

import numpy as np
import pytest

from meshroad.operators.joins import lookup_join, union_all
from meshroad.operators.quantiles import exact_quantiles

PROBS = {"p5": 0.05, "median": 0.5, "p95": 0.95}


@pytest.mark.parametrize("bound", [10, 1_000_000], ids=["narrowing", "direct"])
def test_quantiles_equal_linear_interpolation(spark, bound):
    rnd = random.Random(3)
    groups = {2016: [rnd.gauss(0, 1) for _ in range(301)], 2017: [7.0] * 200 + [rnd.uniform(0, 9) for _ in range(100)],
              2018: [1e300, -1e300, 0.0, 1.0, 2.0, 3.0] + [rnd.uniform(0, 1) for _ in range(60)], 2019: [4.5]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [(2016, None)]
    got = {r.g: r for r in exact_quantiles(spark.createDataFrame(rows, "g int, v double"), "v", PROBS, by=["g"], task_values=bound).collect()}
    for g, vs in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(float(np.quantile(vs, p)), rel=1e-12), (g, name)


def test_quantiles_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(float(i % 97),) for i in range(1000)], "v double")
    assert exact_quantiles(df, "v", {"m": 0.5}, task_values=5).first().m == np.quantile([i % 97 for i in range(1000)], 0.5)
    assert exact_quantiles(df.filter("v < 0"), "v", {"m": 0.5}, by=[]).first().m is None


@pytest.mark.parametrize("slice_rows", [5, 10**9])
def test_sliced_join_equals_plain_join_with_a_hot_key(spark, slice_rows):
    left = spark.range(600).selectExpr("id", "case when id % 3 = 0 then 1 when id % 7 = 0 then null else id % 50 end as k")
    right = spark.range(0, 60, 2).selectExpr("id as k", "id * 10 as v")
    want = sorted(left.join(right, ["k"], "left").collect(), key=str)
    got = lookup_join(left, right, ["k"], broadcastable=False, slice_rows=slice_rows)
    assert sorted(got.select("k", "id", "v").collect(), key=str) == want
    inner = lookup_join(left, right, ["k"], broadcastable=False, slice_rows=slice_rows, how="inner")
    assert inner.count() == left.join(right, ["k"]).count()


def test_union_widens_and_fills(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3,)], "x long")
    assert sorted(map(tuple, union_all([a, b]).collect())) == [(1, 2), (3, None)]
