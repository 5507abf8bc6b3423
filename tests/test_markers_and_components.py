"""Rank sums of sparse cells and principal components against loops and numpy."""

import math
import random

import numpy as np
import pytest

from tallyframe.operators import decompose as D
from tallyframe.operators import normalise as N


def test_rank_markers_equal_a_loop_with_zeros_filled_in(spark):
    rng = random.Random(5)
    groups = {b: rng.choice("xyz") for b in range(90)} | {90: None}
    cells = {}
    for f in ("a", "b", "c", "never", "all"):
        for b in range(93):
            if f == "all" or (f != "never" and rng.random() < 0.4):
                cells[b, f] = float(rng.choice([1, 1, 2, 3, -1, 5])) if f != "c" else rng.random()
    cells[0, "never"], cells[1, "b"] = 0.0, None
    got = {(r.feature, r.grp): r for r in N.rank_markers(spark.createDataFrame([(b, f, v) for (b, f), v in cells.items()], "barcode long, feature string, value double"), spark.createDataFrame(list(groups.items()), "barcode long, grp string")).collect()}
    some = [b for b in groups if groups[b]]
    assert set(got) == {(f, g) for f in ("a", "b", "c", "never", "all") for g in "xyz"}
    for (f, g), r in got.items():
        x = {b: cells.get((b, f)) or 0.0 for b in some}
        rank = {b: sum(v < x[b] for v in x.values()) + (sum(v == x[b] for v in x.values()) + 1) / 2 for b in some}
        own = [b for b in some if groups[b] == g]
        n, m = len(own), len(some)
        total = sum(rank[b] for b in own)
        u = total - n * (n + 1) / 2
        ties = sum(k**3 - k for k in (sum(v == w for v in x.values()) for w in set(x.values())))
        var = n * (m - n) / 12 * (m + 1 - ties / (m * (m - 1)))
        assert (r.n, r.detected) == (n, sum(x[b] != 0 for b in own)) and math.isclose(r.rank_sum, total) and math.isclose(r.auc, u / n / (m - n))
        if f == "never":
            assert r.z is None and r.p is None
        else:
            z = (u - n * (m - n) / 2) / math.sqrt(var)
            assert math.isclose(r.z, z, abs_tol=1e-9) and math.isclose(r.p, math.erfc(abs(z) / math.sqrt(2)), rel_tol=1e-9)


@pytest.mark.parametrize("n,p,k", [(300, 40, 4), (6, 50, 10), (50, 7, 7), (1, 5, 2)])
def test_components_equal_numpy(spark, n, p, k):
    rng = np.random.default_rng(n)
    x = rng.poisson(3, (n, p)) * (rng.random((n, p)) < 0.5) + 20 * np.outer(rng.standard_normal(n), rng.standard_normal(p)).round(1) * (p > 10)
    rows = [(f"s{i}", j, float(x[i, j])) for i in range(n) for j in range(p) if x[i, j] or i == 0 or j == 0]
    scores, loadings = D.principal_components(spark.createDataFrame(rows, "sample_id string, feature_id long, value double").repartition(5), k)
    c = x - x.mean(axis=0)
    u, s, v = np.linalg.svd(c, full_matrices=False)
    k = min(k, n, p)
    got, load = np.zeros((n, k)), np.zeros((p, k))
    for r in scores.collect():
        got[int(r.sample_id[1:]), r.component - 1] = r.score
        assert math.isclose(r.variance, s[r.component - 1] ** 2, rel_tol=1e-8, abs_tol=1e-6)
    for r in loadings.collect():
        load[r.feature_id, r.component - 1] = r.loading
    real = int((s[:k] > 1e-9).sum())
    assert np.allclose(np.abs(np.diag(load[:, :real].T @ v[:real].T)), 1, atol=1e-6)
    assert np.allclose(c @ load, got, atol=1e-6) and np.allclose(load.T @ load, np.eye(k), atol=1e-9)
    for col in load[:, :real].T:
        assert col[np.abs(col).round(9).argmax()] > 0


def test_the_driver_holds_the_shorter_side(spark, monkeypatch):
    """Few samples of many features: what a pass sends to the driver grows with the samples."""
    sizes, plain = [], D._multiplied
    monkeypatch.setattr(D, "_multiplied", lambda packed, w, *more: sizes.append(w.shape[0]) or plain(packed, w, *more))
    rows = [(f"s{i}", j, float((i + 1) * j % 11)) for i in range(4) for j in range(300)]
    D.principal_components(spark.createDataFrame(rows, "sample_id string, feature_id long, value double"), 2)
    assert set(sizes) == {4}


def test_components_of_nothing(spark):
    none = spark.createDataFrame([], "sample_id string, feature_id long, value double")
    assert [d.count() for d in D.principal_components(none, 3)] == [0, 0]


def test_log_normalise_to_the_median(spark):
    cells = spark.createDataFrame([("a", "f", 1.0), ("a", "g", 3.0), ("b", "f", 10.0), ("c", "f", 2.0), ("d", "f", 0.0)], "barcode string, feature string, value double")
    got = {(r.barcode, r.feature): r.log_value for r in N.log_normalise(cells, None).collect()}
    assert math.isclose(got["a", "g"], math.log1p(3 / 4 * 4)) and math.isclose(got["b", "f"], math.log1p(4))
