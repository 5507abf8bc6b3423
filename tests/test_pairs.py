"""Pair sums by blocks against loops, with more samples and features than a block holds."""

import math

import numpy as np
import pytest

from tallyframe.operators import normalise as N
from tallyframe.operators import pairs as P


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(3)
    x = np.where(rng.random((23, 50)) < 0.5, rng.poisson(4, (23, 50)) + 1.0, 0.0)
    x[5] = 0.0
    x[6, :], x[6, 3] = 0.0, 2.0
    rows = [(f"s{i:02}", int(j), float(x[i, j])) for i in range(23) for j in range(50) if x[i, j]]
    return x, spark.createDataFrame(rows, "sample_id string, feature_id long, value double").repartition(5)


@pytest.mark.parametrize("samples,features", [(4, 8), (256, 1024), (23, 7)])
def test_sums_equal_a_loop(small, monkeypatch, samples, features):
    x, counts = small
    monkeypatch.setattr(P, "SAMPLES", samples)
    monkeypatch.setattr(P, "FEATURES", features)
    u, v = x[:4, :6], x[4:8, :6]
    got = {(r.a, r.b): r for r in counts_sums(counts, samples, features)}
    want = {}
    for i in range(23):
        for j in range(i + 1, 23):
            both = (x[i] > 0) & (x[j] > 0)
            a, b = x[i, both], x[j, both]
            if len(a):
                want[f"s{i:02}", f"s{j:02}"] = (len(a), a.sum(), b.sum(), a @ a, b @ b, a @ b, np.minimum(a, b).sum(), ((a - b) ** 2).sum())
    assert set(got) == set(want) and u.shape == v.shape
    for k, w in want.items():
        assert np.allclose([got[k][s] for s in P.SUMS], w), k


def counts_sums(counts, samples, features):
    return P.pair_sums(counts, list(P.SUMS)).collect()


def test_distances_and_correlations(small):
    x, counts = small
    pearson = {(int(r.a[1:]), int(r.b[1:])): r.r for r in N.correlation(counts).collect()}
    strong = N.correlation(counts, least=0.3).collect()
    assert strong and {(int(r.a[1:]), int(r.b[1:])) for r in strong} == {k for k, r in pearson.items() if r is not None and abs(r) >= 0.3}
    apart = {(int(r.a[1:]), int(r.b[1:])): r.distance for r in N.euclidean(counts).collect()}
    for (i, j), r in pearson.items():
        both = (x[i] > 0) & (x[j] > 0)
        a, b = x[i, both], x[j, both]
        assert math.isclose(apart[i, j], np.linalg.norm(a - b), abs_tol=1e-9)
        if len(a) < 2 or a.std() == 0 or b.std() == 0:
            assert r is None
        else:
            assert math.isclose(r, np.corrcoef(a, b)[0, 1], abs_tol=1e-9)
    for metric in ("bray", "jaccard"):
        for r in N.beta_distance(counts, metric).collect():
            a, b = x[int(r.a[1:])], x[int(r.b[1:])]
            want = 1 - 2 * np.minimum(a, b).sum() / (a.sum() + b.sum()) if metric == "bray" else 1 - ((a > 0) & (b > 0)).sum() / ((a > 0) | (b > 0)).sum()
            assert math.isclose(r.distance, want, abs_tol=1e-9)


def test_pairs_of_nothing(spark):
    none = spark.createDataFrame([], "sample_id string, feature_id long, value double")
    one = spark.createDataFrame([("a", 1, 2.0), (None, 1, 3.0), ("b", None, 1.0)], "sample_id string, feature_id long, value double")
    assert P.pair_sums(none, ["xy"]).count() == 0 and P.pair_sums(one, ["xy"]).count() == 0 and N.correlation(none).count() == 0


@pytest.mark.parametrize("pairs", [0, 4096])
def test_features_are_summed_in_several_places(spark, monkeypatch, pairs):
    """With few samples there is one pair of blocks; its features must still be dealt over tasks."""
    monkeypatch.setattr(P, "FEATURES", 8)
    monkeypatch.setattr(P, "PARTS", 2)
    rng = np.random.default_rng(5)
    x = np.where(rng.random((3, 200)) < 0.7, rng.normal(size=(3, 200)), np.nan)
    rows = [(f"s{i}", j, float(x[i, j])) for i in range(3) for j in range(200) if not np.isnan(x[i, j])]
    found = P.pair_sums(spark.createDataFrame(rows, "sample_id string, feature_id long, value double"), list(P.SUMS))
    got = {(r.a, r.b): r for r in found.collect()}
    for i, j in ((0, 1), (0, 2), (1, 2)):
        a, b = (x[k][~np.isnan(x[i]) & ~np.isnan(x[j])] for k in (i, j))
        want = (len(a), a.sum(), b.sum(), a @ a, b @ b, a @ b, np.minimum(a, b).sum(), ((a - b) ** 2).sum())
        assert np.allclose([got[f"s{i}", f"s{j}"][s] for s in P.SUMS], want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "[i#" in plan and ", run#" in plan.split("RepartitionByExpression")[1].split("\n")[0]
    held = (~np.isnan(x)).astype(float)
    one = np.nan_to_num(x), held
    monkeypatch.setattr(P, "FEW_PAIRS", pairs)
    assert np.allclose(P.block_sums(one, one, ["low", "off"])["off"][0, 1], np.nansum((x[0] - x[1]) ** 2))
    assert np.allclose(P.block_sums(one, one, ["low", "off"])["low"][0, 1], np.nansum(np.minimum(x[0], x[1]) * np.where(np.isnan(x[0] + x[1]), np.nan, 1)))
