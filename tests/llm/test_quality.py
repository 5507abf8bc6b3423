import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyframe.llm import quality
from tallyframe.llm.quality import CLASSES, DIM, MARKS, classify, features, fit
from tallyframe.llm.queries import op1_quality_pu


def test_features_equal_a_loop():
    texts = [None, "", "Ab c!\nAb c!\n", "x " * 500, "é漢|*"]
    x = features(texts)
    assert x.shape == (5, DIM) and np.isfinite(x).all() and (x[:, -1] == 1).all()
    for row, text in zip(x, texts):
        for k, mark in enumerate(MARKS):
            assert np.isclose(row[k], np.sqrt((text or "").count(mark) / max(len(text or ""), 1)))
    assert np.isclose(x[2, CLASSES + 5], 2 / 4) and np.isclose(x[2, CLASSES + 8], 1 / 2)


def test_prior_and_risk_on_known_mixture(spark):
    rng = np.random.default_rng(3)
    n, prior = 4000, 0.7
    good = rng.random(n) < prior
    x = np.zeros((n, DIM), dtype="<f4")
    x[:, :4] = rng.normal(size=(n, 4)) + np.where(good, 2.5, -2.5)[:, None] / 2
    x[:, -1] = 1
    positive = good & (rng.random(n) < 0.4)
    rows = spark.createDataFrame([(bytes(r.tobytes()), bool(p)) for r, p in zip(x, positive)], "x binary, positive boolean")
    model = fit(rows)
    assert abs(model.prior - prior) < 0.08
    assert ((model.score(x.astype(float)) >= 0.5) == good).mean() > 0.95


def test_negative_risk_is_clamped_and_corrected(spark, monkeypatch):
    """With far too large a prior the negatives' risk falls below zero; steps correct it and the result keeps it above."""
    rng = np.random.default_rng(4)
    n = 2000
    x = np.zeros((n, DIM), dtype="<f4")
    good = np.arange(n) % 2 == 0
    x[:, 0] = np.where(good, 2, -2) + rng.normal(size=n) / 4
    x[:, -1] = 1
    rows = spark.createDataFrame([(bytes(r.tobytes()), bool(p)) for r, p in zip(x, good & (rng.random(n) < 0.5))], "x binary, positive boolean").cache()
    monkeypatch.setattr(quality, "estimate_prior", lambda *_: 0.8)
    seen, real = [], quality.nonnegative_risk

    def watched(r, w, prior, ridge):
        out = real(r, w, prior, ridge)
        seen.append((r["soft_u"] - prior * r["soft_p"], out))
        return out

    monkeypatch.setattr(quality, "nonnegative_risk", watched)
    model = quality.fit(rows)
    clamped = [k for k, (negative, out) in enumerate(seen) if negative < 0]
    assert clamped and all(seen[k][1][3] for k in clamped)
    assert any(seen[k + 1][0] > seen[k][0] for k in clamped[:-1] or clamped if k + 1 < len(seen))
    last = quality._pass(rows, model.w, model.mean, model.scale)
    assert last["soft_u"] - 0.8 * last["soft_p"] >= 0
    assert ((model.score(x.astype(float)) >= 0.5) >= good).all()


def test_edges(spark):
    rows = [(1, "good text here."), (2, None), (3, ""), (None, "no id"), (1, "good text again."), (4, "w " * 20_000)]
    docs = spark.createDataFrame([(*r, 5, 5) for r in rows], "doc_id long, text string, quality int, x int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 1), (9, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for train in (F.lit(True), F.lit(False)):
        for some in (docs, docs.limit(0)):
            for known in (labels, labels.limit(0)):
                out = classify(some, known, train).collect()
                assert len(out) == (len(rows) if some is docs else 0)
                assert all(0 <= r.score <= 1 for r in out)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op1_quality_pu(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert all(r.predicted == (r.score >= 0.5) for r in rows)


def plain_scores(texts, positive, train):
    """The whole fit on arrays in one piece: prior from sorted scores, Newton steps over plain means."""
    x = features(texts).astype("<f4").astype(float)
    rows, p = x[train], positive[train]
    mean, scale = rows.mean(axis=0), np.sqrt(np.maximum((rows**2).mean(axis=0) - rows.mean(axis=0) ** 2, 1e-12))
    scale = np.where(scale < 1e-5, 1.0, scale)
    mean[-1], scale[-1] = 0.0, 1.0
    z = (rows - mean) / scale
    ridge = quality.RIDGE * np.diag([*[1.0] * (DIM - 1), 1e-3])

    def means(w):
        f = z @ w
        s, soft = 1 / (1 + np.exp(-f)), np.log1p(np.exp(f))
        hess = lambda q: (z[q].T * (s * (1 - s))[q]) @ z[q] / q.sum()
        every = np.ones(len(z), dtype=bool)
        return {"soft_u": soft.mean(), "soft_p": soft[p].mean(), "f_p": f[p].mean(), "s_u": (z * s[:, None]).mean(axis=0), "x_p": z[p].mean(axis=0), "s_p": (z * s[:, None])[p].mean(axis=0), "curve_u": hess(every), "curve_p": hess(p)}

    def against(w):
        r = means(w)
        return r["soft_p"] - r["f_p"] + r["soft_u"] + w @ ridge @ w / 2, r["s_p"] - r["x_p"] + r["s_u"] + ridge @ w, r["curve_p"] + r["curve_u"] + ridge, False

    scores = np.minimum((1 / (1 + np.exp(-z @ quality._newton(np.zeros(DIM), against, 6))) * quality.BINS).astype(int), quality.BINS - 1)
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(z)) + 1 / np.sqrt(p.sum()))
    ratios = []
    for low in range(quality.BINS):
        u, q = (scores >= low).mean(), (scores[p] >= low).mean()
        if q > 0:
            ratios.append(((u + margin) / q, -low, u / q))
    prior = float(np.clip(min(ratios)[2], 0.01, 0.99))
    start = np.zeros(DIM)
    start[-1] = np.log(prior / (1 - prior))
    w = quality._newton(start, lambda w: quality.nonnegative_risk(means(w), w, prior, ridge))
    return 1 / (1 + np.exp(-((x - mean) / scale) @ w))


def test_query_equals_a_plain_fit(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1}
    train = np.array([zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in docs])
    want = plain_scores([r.text for r in docs], np.array([r.doc_id in good for r in docs]), train)
    got = {r.doc_id: r for r in op1_quality_pu(spark, sf).collect()}
    assert len(got) == len(docs) and all(got[r.doc_id].held_out == (not t) for r, t in zip(docs, train))
    assert np.allclose([got[r.doc_id].score for r in docs], want, atol=1e-3)
