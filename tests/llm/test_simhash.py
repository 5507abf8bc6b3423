import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.components import components
from tallyframe.llm.queries import op9_simhash
from tallyframe.llm.simhash import ball_links, fingerprint, near_duplicates


def plain(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints):
    """Smallest id reachable over fingerprints at two bits or fewer."""
    parent = {f: f for f in set(prints.values())}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct = sorted(parent)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, f in prints.items():
        r = find(f)
        least[r] = min(least.get(r, d), d)
    return {d: least[find(f)] for d, f in prints.items()}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBcÉ \t\n\x0b\x85\xa0", max_size=80))
def test_fingerprint(text):
    assert fingerprint(text.encode()) == plain(text)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7)] + [(200, 200 + k) for k in range(1, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, **{200 + k: 200 for k in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_ball_links(spark, radius):
    base = [0, 1, 3, 7, -1, -2, 1 << 40, (1 << 40) + 3, 5, -(1 << 63), (1 << 62)]
    found = components(ball_links(spark.createDataFrame([(b,) for b in base], "fp long"), radius))
    got = {r.node: r.component for r in found.collect()}
    near = {a: {b for b in base if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius} for a in base}
    for a in base:
        seen, todo = {a}, [a]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        assert got.get(a, a) == min(seen)


def test_edges(spark):
    long = " ".join(f"w{i % 997}" for i in range(20_000))
    texts = [None, "", "  ", "one", "One", "one two three four", "one two three four", long, long + " tail", "é é é"]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, "one", 1, "x"), (3, "one", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string")
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in near_duplicates(docs).collect()]
    prints = {i: plain(t) for i, t in enumerate(texts)}
    least = brute(prints)
    want = [(i, prints[i], least[i]) for i in prints] + [(None, prints[3], least[3]), (3, prints[3], least[3])]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    prints = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    least = brute(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op9_simhash(spark, sf).collect()}
    assert got == {d: (f"{f:016x}", least[d]) for d, f in prints.items()}
