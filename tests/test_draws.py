"""Random draws: distribution against closed forms, exact totals, the same on each run and any partitioning."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import draws as D
from tallyframe.operators import filters as Q
from tallyframe.operators import normalise as N


@pytest.mark.parametrize("replace", [False, True])
@pytest.mark.parametrize("total,left,draws", [(2, 1, 1), (10, 3, 7), (10, 9, 9), (1000, 1, 400), (10**6, 400_000, 5), (10**9, 3 * 10**8, 10**6), (50_000, 25_000, 49_999)])
def test_variates(total, left, draws, replace):
    """Mean and variance within four standard errors, and never outside the possible."""
    n = 4000
    rng = np.random.default_rng(total + draws)
    full = lambda v: np.full(n, v)
    x = D.variates(full(total), full(left), full(draws), rng.random(n), replace).astype(float)
    share = left / total
    var = draws * share * (1 - share) * (1 if replace else (total - draws) / (total - 1))
    assert abs(x.mean() - draws * share) <= 4 * math.sqrt(var / n) + 1e-9
    assert abs(x.var() - var) <= 4 * np.std((x - draws * share) ** 2) / math.sqrt(n) + 16 * var / n + 1e-9
    assert x.min() >= (0 if replace else max(0, draws - (total - left))) and x.max() <= (draws if replace else min(draws, left))


def test_variates_are_the_distribution_function():
    """Every value of a small hypergeometric and a small binomial gets its share of the uniform numbers."""
    u = (np.arange(100_000) + 0.5) / 100_000
    full = lambda v: np.full(len(u), v)
    for replace in (False, True):
        x = D.variates(full(12), full(5), full(6), u, replace)
        for k in range(6):
            p = math.comb(6, k) * (5 / 12) ** k * (7 / 12) ** (6 - k) if replace else math.comb(5, k) * math.comb(7, 6 - k) / math.comb(12, 6)
            assert abs((x == k).mean() - p) < 2e-5


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", k, 10.0) for k in range(2500)] + [("b", k, float(k % 7)) for k in range(3)] + [(None, k, 5.0) for k in range(4)]
    return spark.createDataFrame(rows, "sample_id string, feature_id long, value double")


def runs(spark, depths, n):
    return spark.createDataFrame([(s, r, d) for s in ("a", "b", None) for r in range(n) for d in depths], "sample_id string, run int, depth long")


@pytest.mark.parametrize("replace", [False, True])
def test_draws(spark, table, replace):
    """More features than one row of the tree holds: totals are exact, means and variances are those of the closed form."""
    n, depth = 40, 5000
    got = D.draw(table, runs(spark, [depth, 3, 20], n), replace=replace)
    sums = {(r.sample_id, r.depth): (r.t, r.n) for r in got.groupBy("sample_id", "depth").agg(F.sum("drawn").alias("t"), F.countDistinct("run").alias("n")).collect()}
    if not replace:
        assert sums == {("a", 5000): (5000 * n, n), ("a", 20): (20 * n, n), ("a", 3): (3 * n, n), ("b", 3): (3 * n, n), (None, 3): (3 * n, n), (None, 20): (20 * n, n)}
        assert got.where("sample_id = 'a' and drawn > 10").count() == 0
    else:
        assert sums == {(s, d): (d * n, n) for s in ("a", "b", None) for d in (depth, 3, 20)}
    x = np.zeros((n, 2500))
    for r in got.where(f"sample_id = 'a' and depth = {depth}").collect():
        x[r.run, r.feature_id] = r.drawn
    share = 1 / 2500
    var = depth * share * (1 - share) * (1 if replace else (25_000 - depth) / (25_000 - 1))
    assert abs(x.var() / var - 1) < 0.03
    assert abs((x > 0).sum(axis=1).mean() - 2500 * (1 - (1 - share) ** depth if replace else 1 - math.comb(24_990, depth) / math.comb(25_000, depth))) < 4 * 25 / math.sqrt(n)
    half = x[:, ::2].sum(axis=1)
    assert abs(half.mean() - depth / 2) < 4 * math.sqrt(depth / 4 / n) and half.std() > 10


def test_draws_repeat(spark, table):
    key = lambda df: sorted((str(r.sample_id), r.run, r.depth, r.feature_id, r.drawn) for r in df.collect())
    one = key(D.draw(table, runs(spark, [50], 2)))
    assert one == key(D.draw(table.repartition(7), runs(spark, [50], 2).repartition(3)))
    assert one != key(D.draw(table, runs(spark, [50], 2), seed=1))
    assert D.draw(table.limit(0), runs(spark, [5], 2)).count() == 0 and D.draw(table, runs(spark, [5], 2).limit(0)).count() == 0


def test_rarefaction_follows_its_expectation(spark):
    rows = spark.createDataFrame([("s", k, 10.0) for k in range(1000)], "sample_id string, feature_id long, value double")
    depths = [500, 1000, 2000]
    want = {int(r.depth): r.expected for r in N.rarefy_expected(rows, depths).collect()}
    got = N.rarefy(rows, depths, 30).groupBy("depth").agg(F.avg("observed").alias("m"), F.stddev("observed").alias("s")).collect()
    assert len(got) == 3
    for r in got:
        assert r.s > 0 and abs(r.m - want[r.depth]) < 4 * r.s / math.sqrt(30)


def test_downsampling(spark):
    rows = spark.createDataFrame([("a", k, 3.0) for k in range(400)] + [("b", k, 1.0) for k in range(300)] + [("c", 0, 300.0)], "sample_id string, feature_id long, value double")
    got = {}
    for r in Q.downsample_counts(rows).collect():
        got.setdefault(r.sample_id, {})[r.feature_id] = r.value
    assert {s: sum(v.values()) for s, v in got.items()} == {"a": 300.0, "b": 300.0, "c": 300.0}
    assert got["b"] == {k: 1.0 for k in range(300)} and got["c"] == {0: 300.0}
    # 400 equal features, 300 draws with replacement: 400 (1 - (1 - 1/400)^300) = 211 are seen, give or take 7
    assert abs(len(got["a"]) - 211.2) < 28 and max(got["a"].values()) > 1
    less = Q.downsample_counts(rows, replace=False).where("sample_id = 'a'").agg(F.max("value"), F.sum("value")).first()
    assert less[0] <= 3 and less[1] == 300
    assert Q.downsample_counts(rows.limit(0)).count() == 0


def test_sql_draws_from_more_features_than_fifteen_levels_hold(spark):
    n = 40_000
    found = D.draw(spark.range(n).selectExpr("'s' AS sample_id", "id AS feature_id", "1 + id % 3 AS value"), spark.sql("SELECT 's' AS sample_id, 1 AS run, 60L AS depth"))
    sql = D.draw_sql(f"SELECT 's' AS sample_id, i AS feature_id, 1 + i % 3 AS value FROM range({n}) r(i)", "SELECT 's' AS sample_id, 1 AS run, 60 AS depth")
    want = duckdb.connect().sql(f"WITH {sql} SELECT feature_id, drawn FROM drawn").fetchall()
    assert sum(k for _, k in want) == 60 and sorted(want) == sorted((r.feature_id, r.drawn) for r in found.collect())
