import re
import zlib
from hashlib import sha256

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st

from tallyframe.llm.periodic_runs import find_runs, runs_of, word_numbers
from tallyframe.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words):
    """All runs (start, length, period): every lag's whole diagonal, each stretch with its smallest period only."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted((a, n, q) for (a, n), q in found.items())


def smallest(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def check(texts):
    numbers, starts = word_numbers([[w.encode() for w in t] for t in texts])
    got = [tuple(r) for r in runs_of(numbers).tolist()]
    want = [(a + s, n, q) for t, s in zip(texts, starts.tolist()) for a, n, q in brute(t)]
    assert got == sorted(want, key=lambda r: (r[0], r[2]))
    for t in texts:
        assert all(smallest(t[a : a + n]) == q for a, n, q in brute(t))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=90) | st.lists(st.sampled_from("abcd"), max_size=90), max_size=4))
@example([["a"] * 90, ["a"] * 90, ["a", "b"] * 40])
def test_runs_of_few_words(texts):
    check(texts)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_planted_runs(data):
    """A root of any length, repeated two to six times and a part, between other words and with one word changed or not."""
    root = data.draw(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=70))
    times = data.draw(st.integers(2 * len(root), 6 * len(root) + 12))
    text = [*data.draw(st.lists(st.sampled_from("abxyz"), max_size=20)), *(root * (times // len(root) + 1))[:times], *data.draw(st.lists(st.sampled_from("abxyz"), max_size=20))]
    if data.draw(st.booleans()):
        text[data.draw(st.integers(0, len(text) - 1))] = "!"
    check([text, text[::-1]])


def test_longest_cases():
    """Fibonacci words have the most runs; one word over and over has the most pairs."""
    a, b = ["a"], ["a", "b"]
    while len(b) < 900:
        a, b = b, b + a
    check([b])
    numbers = np.zeros(300_000, dtype=np.int64)
    assert runs_of(numbers).tolist() == [[0, 300_000, 1]]


def digests(words, found):
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = {k for a, n, q in found for k in range(a + q, a + n)}
    hexed = lambda t: sha256(t.encode()).hexdigest()
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (len(found), *four, hexed("".join(f"{a},{n},{q}\n" for a, n, q in found)), hexed(" ".join(w for k, w in enumerate(words) if k not in drop)))


def planted(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op13_periodic_runs(spark, SF).collect()}
    words = {r.doc_id: planted(r.doc_id, r.text) for r in docs}
    some = {d: w for d, w in words.items() if len(w) < 2500}
    assert len(some) > 150 and set(got) == set(words)
    for d, w in some.items():
        found = sorted(brute(w), key=lambda r: (r[0], r[2]))
        assert got[d] == digests(w, found), d


def test_edges(spark, tmp_path):
    long = "x " * 60_000 + " ".join(f"w{k % 1009}" for k in range(60_000))
    texts = [None, "", " \t\n", "one", "a\x0bb " * 6, "a\xa0b " * 12, "é à " * 7, long, "a " * 11, "a " * 12]
    rows = [(k, t, "r", 1) for k, t in enumerate(texts)] + [(None, "b c d " * 5, None, None), (4, "a\x0bb " * 6, "r", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, id int")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(docs).collect()]
    by = {d: (n, r, c) for d, n, r, c in got}
    assert by[0] == by[1] == by[2] == (0, [], "") and by[3] == (1, [], "one")
    assert by[4] == (12, [(0, 12, 2)], "a b") and by[5] == (12, [(0, 12, 1)], "a\xa0b") and by[6] == (14, [(0, 14, 2)], "é à")
    assert by[7][0] == 120_000 and by[7][1] == [(0, 60_000, 1), (60_000, 60_000, 1009)] and len(by[7][2].split()) == 1010
    assert by[8] == (11, [], " ".join("a" * 11)) and by[9] == (12, [(0, 12, 1)], "a")
    assert by[None] == (15, [(0, 15, 3)], "b c d") and sum(d == 4 for d, *_ in got) == 2
    assert find_runs(docs.limit(0)).collect() == []
    docs.drop("runs", "id").write.parquet(f"{tmp_path}/documents.parquet")
    for r in op13_periodic_runs(spark, str(tmp_path)).collect():
        if r.doc_id != 7:
            w = planted(r.doc_id, texts[r.doc_id] if r.doc_id is not None else "b c d " * 5)
            assert tuple(r[c] for c in COLUMNS) == digests(w, sorted(brute(w), key=lambda x: (x[0], x[2])))
