import numpy as np
import pandas as pd
import pytest

from tallyframe.llm import embedding_dedup
from tallyframe.llm.embedding_dedup import Codes, near_duplicates, plan_tables
from tallyframe.llm.queries import op5_embedding_itq


def brute(x, threshold=0.9):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        new = np.where(linked, label[None, :], label[:, None]).min(axis=1)
        new = np.minimum(new, label)
        if (new == label).all():
            return linked, label
        label = new


def planted(rng, dim, noise):
    """Random vectors, pairs near the threshold, and one large group of near copies."""
    base = rng.normal(size=(600, dim))
    near = base[:150] + noise * rng.normal(size=(150, dim))
    group = rng.normal(size=dim) + 0.05 * rng.normal(size=(400, dim))
    return np.vstack([base, near, group]).astype(np.float32)


@pytest.mark.parametrize("dim,noise", [(64, 0.4), (96, 0.2), (24, 0.4)])
def test_recall_against_brute_force(spark, dim, noise):
    x = planted(np.random.default_rng(dim), dim, noise)
    want, label = brute(x.astype(float))
    rows = near_duplicates(spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(x)], "vec_id long, embedding array<float>, label int")).collect()
    got = {r.vec_id: r for r in rows}
    links = sum(r.n_links for r in rows)
    assert len(rows) == len(x) and links <= want.sum() and links >= 0.9 * want.sum()
    assert all(got[k].n_links <= want[k].sum() for k in range(len(x)))
    assert all(got[k].component_id == 750 for k in range(750, 1150)) and got[800].n_links == 399
    for k, r in got.items():
        assert label[r.component_id] == label[k] and r.kept == (r.component_id == k)


def test_edges(spark):
    e = [1.0] + [0.0] * 7
    rows = [(5, e), (3, [2.0] + [0.0] * 7), (None, e), (4, None), (6, [0.0] * 8), (7, [float("nan")] + e[1:]), (8, [None] + e[1:]), (9, [float("inf")] + e[1:]), (10, [0.0, 1.0] + [0.0] * 6), (5, e), (11, []), (12, [1.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, uid int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(frame).collect()), key=str)
    alone = [(k, 0, k, True) for k in (4, 6, 7, 8, 9, 10, 11, 12)]
    assert got == sorted([(5, 3, 3, False), (5, 3, 3, False), (3, 3, 3, True), (None, 3, 3, None), *alone], key=str)
    assert near_duplicates(frame.limit(0)).count() == 0
    assert near_duplicates(frame.where("vec_id = 4")).first().n_links == 0


def test_tables_follow_the_number_of_rows():
    assert plan_tables(51_282, 0.9, 0.95) == (13, 21)
    assert plan_tables(10**9, 0.9, 0.95)[0] == 27 and plan_tables(2, 0.9, 0.95)[0] == 8


def test_many_equal_vectors_are_one(spark):
    """A third of the table holds one vector and a few hold near copies of it."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(8000, 32))
    same = np.repeat(rng.normal(size=(1, 32)), 4000, axis=0)
    near = same[:5] + 0.02 * rng.normal(size=(5, 32))
    rows = [(k, v.tolist()) for k, v in enumerate(np.vstack([x, same, near]))]
    got = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[k].n_links == 4004 and got[k].component_id == 8000 for k in range(8000, 12005))
    assert len(got) == len(rows) and got[8000].kept and not got[8001].kept


def test_recall_at_fifty_thousand_rows(spark):
    """Recall against brute force for every twentieth vector, at a size with 13-bit chunks; no link is invented."""
    rng = np.random.default_rng(9)
    n, dim = 50_000, 64
    x = rng.normal(size=(n, dim)).astype(np.float32)
    near = rng.permutation(n)[:10_000].reshape(2, -1)
    x[near[1]] = x[near[0]] + 0.4 * rng.normal(size=(5000, dim))
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}), "vec_id long, embedding array<float>")
    got = near_duplicates(frame).select("vec_id", "n_links").toPandas().set_index("vec_id").n_links
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    asked = np.arange(0, n, 20)
    want = (unit[asked] @ unit.T >= 0.9).sum(axis=1) - 1
    found = got.loc[asked].to_numpy()
    assert (found <= want).all() and want.sum() > 300 and found.sum() >= 0.9 * want.sum()


@pytest.mark.parametrize("shared", [0.5, 0.7])
def test_recall_with_a_common_direction(spark, shared):
    """Vectors with a large mean (mean cosine ``shared``) and pairs just above the threshold."""
    rng = np.random.default_rng(5)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    dim = 64
    x = unit(np.sqrt(shared) * unit(rng.normal(size=(1, dim))) + np.sqrt(1 - shared) * unit(rng.normal(size=(3000, dim))))
    step = rng.normal(size=(600, dim))
    step -= np.einsum("ij,ij->i", step, x[:600])[:, None] * x[:600]
    near = 0.905 * x[:600] + np.sqrt(1 - 0.905**2) * unit(step)
    x = np.vstack([x, near])
    want, label = brute(x)
    rows = near_duplicates(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    assert 0.93 * want.sum() <= sum(r.n_links for r in rows) <= want.sum()


def test_query_finds_the_links_and_components(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").toPandas()
    want, label = brute(np.array(table.embedding.tolist(), dtype=float))
    ids = table.vec_id.to_numpy()
    got = {r.vec_id: r for r in op5_embedding_itq(spark, sf).collect()}
    assert all(got[i].n_links <= want[k].sum() for k, i in enumerate(ids))
    assert np.mean([got[i].component_id == ids[label[k]] for k, i in enumerate(ids)]) >= 0.95


def test_each_length_has_its_index(spark):
    """Links within every length, the rare ones too, none between lengths; one vector of a length links with nothing."""
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for dim, n in ((3, 6), (2, 2), (8, 40), (5, 1)):
        x = rng.normal(size=(n, dim))
        x[1:2] = 2 * x[:1]
        links, label = brute(x)
        for k, v in enumerate(x):
            want[len(rows)] = (int(links[k].sum()), len(rows) - k + int(label[k]))
            rows.append((len(rows), v.tolist()))
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == want


def test_a_plan_that_misses_the_recall_compares_all_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 6)) * 0.01 + 1
    monkeypatch.setattr(embedding_dedup, "measured", lambda *a: (0.0, 1))  # a recall that no number of tables reaches
    plan = Codes(x / np.linalg.norm(x, axis=1, keepdims=True), 30, 0.9, 0.95)
    codes = np.frombuffer(b"".join(plan.of(x)), dtype="<u8").reshape(30, -1)
    assert plan.tables == 1 and (plan.chunk(codes, 0) == 0).all() and plan.far >= 64 * codes.shape[1]
