"""Neighbour lists and graph against plain versions over all pairs."""

import math

import numpy as np
import pytest

from tallyframe.operators.neighbours import neighbour_graph, neighbour_lists
from tallyframe.plans import QUERIES
from tallyframe.plans.standins import table

SF = "/root/testdata/sf0.001"


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")


def recall(got, ids, x, k):
    """Share of places whose similarity reaches that of the exact list; similarities are checked, too."""
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    at = {int(i): n for n, i in enumerate(ids)}
    np.fill_diagonal(s, -2)
    last = np.sort(s, axis=1)[:, -k]
    assert len({(r.vec_id, r.neighbour) for r in got}) == len(got) == len(ids) * k
    for r in got:
        assert r.vec_id != r.neighbour and abs(s[at[r.vec_id], at[r.neighbour]] - r.similarity) < 1e-9
    return sum(r.similarity >= last[at[r.vec_id]] - 1e-9 for r in got) / len(got)


@pytest.mark.parametrize("common", [0.0, 2.0])
def test_descent_reaches_the_exact_lists(spark, common):
    """Clusters, a third of all vectors equal, with and without a common direction."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 24))[rng.integers(0, 60, 3000)] + 0.5 * rng.normal(size=(3000, 24)) + common
    x[rng.permutation(3000)[:1000]] = x[0]
    ids = rng.permutation(10_000)[:3000]
    got = neighbour_lists(frame(spark, ids, x).repartition(5), 10).collect()
    assert recall(got, ids, x, 10) >= 0.95


def test_vectors_without_direction_have_no_list(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbour_lists(df, 5).collect()
    assert {(r.vec_id, r.neighbour) for r in got} == {(a, b) for a in (1, 2, 7) for b in (1, 2, 7) if a != b}
    assert neighbour_lists(df.where("vec_id = 1"), 5).count() == 0
    assert neighbour_lists(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        neighbour_lists(df.unionByName(frame(spark, [9], [[1.0, 2.0, 3.0]])), 5)


def test_graph_of_all_embeddings(spark):
    """Every row's list against all pairs, and each weight against a loop over the lists."""
    vectors = table(spark, SF, "embeddings")
    rows = vectors.collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float)
    lists = neighbour_lists(vectors, 15)
    got = lists.collect()
    assert recall(got, ids, x, 15) >= 0.95
    held = {}
    for r in got:
        held.setdefault(r.vec_id, []).append((max(1 - r.similarity, 0.0), r.neighbour))
    directed = {}
    for own, near in held.items():
        first = min((d for d, _ in near if d > 0), default=0.0)
        total = lambda w: sum(math.exp(-max(d - first, 0) / w) for d, _ in near)
        low, high = 1e-12, 1e6
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (low, mid) if total(mid) >= math.log2(len(near)) else (mid, high)
        width = max(high, 1e-3 * sum(d for d, _ in near) / len(near))
        directed |= {(own, n): math.exp(-max(d - first, 0) / width) for d, n in near}
    graph = {(r.a, r.b): r.weight for r in neighbour_graph(lists).collect()}
    assert set(graph) == {(min(p), max(p)) for p in directed}
    for (a, b), w in graph.items():
        p, q = directed.get((a, b), 0.0), directed.get((b, a), 0.0)
        assert w == pytest.approx(p + q - p * q, abs=1e-6) and 0 < w <= 1 + 1e-12
    named = {(r.a, r.b): r.weight for r in QUERIES["j17_neighbour_graph"](spark, SF).collect()}
    assert len(named) > 0.95 * len(graph)


def test_surroundings_without_a_new_member_send_no_vectors(spark, monkeypatch):
    from tallyframe.operators import neighbours as G

    units = spark.createDataFrame([(i, [float(i % 4 + 1), 1.0]) for i in range(8)], "vec_id long, unit array<double>")
    lists = spark.createDataFrame([(i, i // 4 * 4 + (i + 1) % 4, 0.5, i == 1) for i in range(8)], "vec_id long, neighbour long, similarity double, fresh boolean")
    monkeypatch.setattr(G, "_compared", lambda rows, k: rows)
    sent = {(r.key, r.member, r.fresh) for r in G._round(lists, units, 3).collect()}
    assert sent == {(1, 0, False), (1, 1, False), (1, 2, True), (2, 1, True), (2, 2, False), (2, 3, False)}
