import math
import zlib

import numpy as np

from tallyframe.llm import language
from tallyframe.llm.language import BUCKETS, EM_ROUNDS, SMOOTHING, gram_counts, grams, held_out, identify, mixtures, train
from tallyframe.llm.queries import op2_language_mixture


def loop_grams(text):
    clean = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    padded = f" {' '.join(clean.split())} " if clean.split() else ""
    return [padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " "]


def test_grams_are_padded_letter_trigrams():
    texts = [None, "", "a", "Ab, cd!", "12 x\n\nyz", "  É é ", "a b"]
    doc, bucket = grams(texts)
    assert np.bincount(doc, minlength=len(texts)).tolist() == [len(loop_grams(t)) for t in texts]
    by_gram = {}
    for d, b in zip(doc, bucket):
        by_gram.setdefault(d, []).append(b)
    for d, buckets in by_gram.items():
        for g, b in zip(loop_grams(texts[d]), buckets):
            alone = grams([g.replace(" ", "")])[1] if g.count(" ") == 2 else None
            assert alone is None or alone[0] == b
    assert bucket.max() < BUCKETS


def test_mixture_proportions_are_recovered():
    rng = np.random.default_rng(1)
    table = np.full((3, BUCKETS), 1e-9)
    words = [[f"{a}{b}{c}" for b in "aeiou" for c in s] for a, s in zip("xyz", ("bcd", "fgh", "jkl"))]
    for k, w in enumerate(words):
        for b in grams([" ".join(w)])[1]:
            table[k, b] += 1
    table /= table.sum(axis=1, keepdims=True)
    text = " ".join([*rng.choice(words[0], 300), *rng.choice(words[2], 100)])
    share = mixtures([text, " ".join(words[1] * 4), "", None, "123"], table)
    assert np.allclose(share[0], [0.75, 0, 0.25], atol=0.05) and np.allclose(share[1], [0, 1, 0])
    assert not share[2:].any()


def test_counts_equal_a_loop_and_edges(spark):
    rows = [(1, "the cat", "en"), (2, "le chat", "fr"), (2, "le chat", "fr"), (3, None, "en"), (4, "xx", None), (None, "the dog", "en"), (5, "42", "fr"), (6, "the " * 30_000, "en")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, bucket int")
    got = {}
    for r in gram_counts(docs).collect():
        got[r.lang] = got.get(r.lang, 0) + r.n
    assert got == {x: sum(len(loop_grams(t)) for _, t, y in rows if y == x) for x in ("en", "fr")}
    out = identify(docs, train(docs)).collect()
    assert len(out) == len(rows)
    assert [(r.lang_pred, r.score) for r in out if r.doc_id in (3, 5)] == [("und", 0.0)] * 2
    assert all(0 <= r.score <= 1 for r in out) and {r.lang_pred for r in out if r.doc_id == 2} == {"fr"}
    assert identify(docs, train(docs.limit(0))).where("lang_pred <> 'und'").count() == 0
    assert identify(docs.limit(0), train(docs)).count() == 0


def test_held_out_and_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_language_mixture(spark, sf).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert spark.createDataFrame([(None,)], "doc_id long").select(held_out("doc_id").alias("h")).first().h


def test_many_labels_give_coarser_models(spark):
    assert [language.buckets_of(n) for n in (0, 1, 512, 513, 1024, 3_000, 1 << 24, 1 << 26)] == [BUCKETS, BUCKETS, BUCKETS, BUCKETS // 2, BUCKETS // 2, 4096, 1, 1]
    rows = [(k, "".join(chr(97 + k // 26**p % 26) for p in range(3)) + "zq", f"l{k:04}") for k in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    langs, table = train(docs)
    assert langs == sorted(r[2] for r in rows) and table.shape == (3_000, 4096)
    for k in (0, 1, 1_234, 2_999):  # the counts of a loop, folded onto the buckets left
        plain = np.full(4096, SMOOTHING)
        for b in grams([rows[k][1]])[1]:
            plain[b % 4096] += 1
        assert np.allclose(table[k], plain / plain.sum())
    # as many texts of one label as it takes to be told from 2,999 others
    out = identify(docs.where("doc_id < 40"), (langs, table)).collect()
    assert len(out) == 40 and all(0 <= r.score <= 1 for r in out)
    assert sum(r.lang_pred == f"l{r.doc_id:04}" for r in out) >= 36


def test_counts_of_more_labels_than_a_task_holds(spark, monkeypatch):
    monkeypatch.setattr(language, "HELD_LANGUAGES", 2)
    rows = [(k, "the cat " * (k + 1), f"l{k % 5}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    got = {}
    for r in gram_counts(docs).collect():
        got[r.lang] = got.get(r.lang, 0) + r.n
    assert got == {f"l{j}": sum(6 * (k + 1) for k in range(40) if k % 5 == j) for j in range(5)}


def plain_mixture(counts, table):
    """Proportions of one document by loops: EM over a growing set of languages as long as BIC rises."""
    langs = range(len(table))

    def em(theta):
        for _ in range(EM_ROUNDS):
            new = dict.fromkeys(theta, 0.0)
            for g, n in counts.items():
                whole = sum(theta[k] * table[k][g] for k in theta)
                for k in theta:
                    new[k] += n * theta[k] * table[k][g] / whole
            theta = {k: v / total for k, v in new.items()}
        return theta, sum(n * math.log(sum(theta[k] * table[k][g] for k in theta)) for g, n in counts.items())

    total = sum(counts.values())
    soft, _ = em({k: 1 / len(table) for k in langs})
    single = [sum(n * math.log(table[k][g]) for g, n in counts.items()) for k in langs]
    best, score = {single.index(max(single)): 1.0}, max(single)
    members = set(best)
    for size in range(2, len(table) + 1):
        tried = sorted(langs, key=lambda k: (k not in members, -soft[k]))[:size]
        theta, fit = em({k: 1 / size for k in tried})
        if (fit - score) / 3 <= math.log(max(total / 3, 2)) / 2:
            break
        best, score, members = theta, fit, set(tried)
    return best


def test_query_equals_loops(spark):
    """Counts, EM, language sets and predictions of every document against plain loops."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    found = {r.doc_id: {} for r in docs}
    for r in docs:
        for g in grams([r.text])[1].tolist():
            found[r.doc_id][g] = found[r.doc_id].get(g, 0) + 1
    sums = {}
    for r in docs:
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang is not None:
            for g, n in found[r.doc_id].items():
                sums.setdefault(r.lang, {}).setdefault(g, 0)
                sums[r.lang][g] += n
    names = sorted(sums)
    table = []
    for k in names:
        whole = sum(sums[k].values()) + SMOOTHING * BUCKETS
        table.append([(sums[k].get(g, 0) + SMOOTHING) / whole for g in range(BUCKETS)])
    for r in op2_language_mixture(spark, sf).collect():
        if not found[r.doc_id]:
            assert r.lang_pred == "und" and r.score == 0
            continue
        best = plain_mixture(found[r.doc_id], table)
        top = max(best, key=best.get)
        assert abs(r.score - best[top]) < 1e-6 and (r.lang_pred == names[top] or abs(best[names.index(r.lang_pred)] - best[top]) < 1e-6)
