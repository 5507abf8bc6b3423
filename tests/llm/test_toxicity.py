import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import toxicity as T
from tallyframe.llm.queries import op11_toxicity_knn


def plain_terms(text):
    return re.findall(r"[^\W\d_]+", (text or "").lower())


def plain(docs, labels):
    """Scores of ``docs`` (id to text) by every example's whole vector: no index, no bounds."""
    known = {d: max(v) for d, v in labels.items()}
    ids = [d for d in docs if d in known and zlib.crc32(str(d).encode()) % 5]
    counts = {d: Counter(plain_terms(t)) for d, t in docs.items()}
    n, ones = len(ids), sum(known[d] for d in ids)
    held, held1 = Counter(), Counter()
    for d in ids:
        held.update(counts[d].keys())
        held1.update(counts[d].keys() if known[d] else ())
    tried = [t for t in held if 3 <= held[t] < n]

    def ratio(t):
        a, b = held1[t], held[t] - held1[t]
        table = ((a, held[t], ones), (b, held[t], n - ones), (ones - a, n - held[t], ones), (n - ones - b, n - held[t], n - ones))
        return 2 * sum(x * math.log(x * n / (r * c)) for x, r, c in table if x)

    names = sorted((t for t in tried if ratio(t) >= max(2 * math.log(max(len(tried), 1)), T.GAIN * held[t])), key=lambda t: (-ratio(t), t))[: T.TERMS]
    idf = {t: math.log1p(n / held[t]) for t in names}

    def vector(d):
        v = {t: (1 + math.log(counts[d][t])) * idf[t] for t in names if t in counts[d]}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()}

    vectors = {d: vector(d) for d in docs}
    mean = ones / n if n else 0.0

    def vote(d, skip=None):
        near = [(sum(x * vectors[e].get(t, 0) for t, x in vectors[d].items()), e) for e in ids if e != skip]
        near = sorted((c for c in near if c[0] > 0), key=lambda c: -c[0])
        near = near[: T.NEIGHBOURS]
        w = [c / (1.05 - min(c, 1.0)) for c, _ in near]
        return (sum(x * known[e] for x, (_, e) in zip(w, near)) + 0.5 * mean) / (sum(w) + 0.5), near

    own = np.array([vote(d, d)[0] for d in ids])
    table = T.calibrated(own, np.array([float(known[d]) for d in ids]))
    return {d: (float(table(np.array([vote(d)[0]]))[0]), [c for c, _ in vote(d)[1]]) for d in docs}


def test_query_equals_a_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        labels.setdefault(r.doc_id, []).append(r.toxic)
    want = plain(docs, labels)
    got = {r.doc_id: r for r in op11_toxicity_knn(spark, sf).collect()}
    assert set(got) == set(want)
    for d, r in got.items():
        score, cosines = want[d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert np.allclose([e.cosine for e in r.evidence], cosines, atol=1e-9) and abs(r.score - score) < 1e-9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r.score, toxic[r.doc_id]) for r in op11_toxicity_knn(spark, sf).where("held_out").collect() if r.doc_id in toxic]
    ones, zeros = [s for s, y in rows if y], [s for s, y in rows if not y]
    assert len(ones) > 50
    assert sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros)) > 0.95
    assert sum(s >= 0.5 for s in ones) >= 0.9 * len(ones) and sum(s >= 0.5 for s in zeros) <= 0.01 * len(zeros)


WORDS = [f"w{chr(97 + k)}" for k in range(12)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.dictionaries(st.sampled_from(WORDS), st.integers(1, 9), max_size=6), st.integers(0, 1)), max_size=60), st.lists(st.sampled_from(WORDS), max_size=12), st.integers(1, 9))
def test_nearest_are_exact(examples, query, k):
    """Block bounds lose no neighbour: equal to the cosines with all examples, for blocks of four."""
    old, T.BLOCK = T.BLOCK, 4
    try:
        held = Counter(t for c, _ in examples for t in c)
        index = T.build(list(range(len(examples))), [y for _, y in examples], [c for c, _ in examples], dict(held))
        best, cosine = index.nearest(*index.vector(query), k)
    finally:
        T.BLOCK = old
    idf = {t: math.log1p(len(examples) / n) for t, n in held.items()}

    def vector(counts):
        v = {t: (1 + math.log(c)) * idf[t] for t, c in counts.items() if t in idf}
        size = math.sqrt(sum(x * x for x in v.values())) or 1
        return {t: x / size for t, x in v.items()}

    q = vector(Counter(query))
    want = sorted((c for c in (sum(x * vector(c).get(t, 0) for t, x in q.items()) for c, _ in examples) if c > 0), reverse=True)[:k]
    assert np.allclose(cosine, want, atol=1e-9)
    for e, c in zip(best.tolist(), cosine.tolist()):
        counts, label = examples[index.ids[e]]
        assert index.labels[e] == label and math.isclose(c, sum(x * vector(counts).get(t, 0) for t, x in q.items()), abs_tol=1e-9)


def test_calibration_is_monotone():
    rng = np.random.default_rng(1)
    raw = rng.random(500)
    table = T.calibrated(raw, (rng.random(500) < raw**2).astype(float))
    assert (np.diff(table.share) >= 0).all() and (np.diff(table.raw) > 0).all()
    assert abs(table(np.array([0.9]))[0] - 0.81) < 0.15 and abs(table(np.array([0.3]))[0] - 0.09) < 0.12


def test_edges(spark):
    bad = "You utter villain, a villain indeed number "
    letters = ["q" * (k + 1) for k in range(20)]
    rows = [(k, (bad if k % 4 == 0 else "A calm sentence number ") + letters[k % 20], "x", 1) for k in range(60)]
    rows += [(60, None, "x", 1), (61, "", None, None), (62, "VILLAIN " + "filler " * 100_000, "x", 1), (None, "villain", None, None), (0, "villain", "x", 1), (63, "12 .. 9", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, label int")
    marks = [(k, int(k % 4 == 0), "z") for k in range(60)] + [(0, 0, "z"), (1, None, "z"), (None, 1, "z")]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, text string")
    found = T.classify(docs, labels, ~T.held_out("doc_id")).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert got[62].score > 0.5 and got[None].score > 0.5 and got[60].score == got[61].score == got[63].score < 0.5
    assert got[60].evidence == [] and all(e.label for e in got[None].evidence)
    assert T.classify(docs.limit(0), labels, ~T.held_out("doc_id")).collect() == []
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1")):
        scores = {r.score for r in T.classify(docs, some, ~T.held_out("doc_id")).collect()}
        assert all(0 <= s <= 1 for s in scores)


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")
    a, b = (sorted(r.id for r in T.sample(d, labels, ~T.held_out("doc_id"), "doc_id", "text", "toxic", 50).collect()) for d in (docs, docs.repartition(7)))
    assert a == b and len(a) == 50
    assert all(zlib.crc32(str(d).encode()) % 5 for d in a)
