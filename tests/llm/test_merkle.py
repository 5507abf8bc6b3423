import zlib
from hashlib import sha256

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import merkle
from tallyframe.llm.merkle import expanded, folded, leaf_digest, levels, manifest, missing
from tallyframe.llm.queries import ORACLE_SQL, op12_merkle_manifest

SF = "/root/testdata/sf0.001"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def paths(leaves):
    """Root of a list and the path of each place, by plain recursion over levels."""
    found, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, k in enumerate(at):
            found[i].append((k % 2, nodes[k ^ 1] if k ^ 1 < len(nodes) else None))
            at[i] = k // 2
        nodes = [h(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)]
    return nodes[0], found


def brute(rows, tampered=lambda r: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((h(*map(field, r)), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {g: paths([x[0] for x in groups[g]]) for g in names}
    root, over = paths([trees[g][0] for g in names])
    out = []
    for g, last in zip(names, over):
        subroot, own = trees[g]
        for (leaf, r), path in zip(groups[g], own):
            path = path + last
            at = h(*map(field, (*r[:3], r[3] if r[3] is None else r[3] + 1, r[4]))) if tampered(r) else leaf
            for side, other in path:
                at = h(at) if other is None else h(other, at) if side else h(at, other)
            out.append((r[0], leaf, subroot, root, h(*[o for _, o in path if o]), at, at == root))
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_query_equals_brute_force_and_sql(spark):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(tuple(r[c] for c in COLUMNS) for r in op12_merkle_manifest(spark, SF).collect())
    assert got == sorted(brute(rows)) and any(not r[6] for r in got)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLE_SQL['op12_merkle_manifest']})").fetchall()) == got


def digests(n):
    return [h(str(k)).encode() for k in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70).flatmap(lambda n: st.tuples(st.just(n), st.sets(st.integers(0, n - 1), min_size=1))))
def test_octopus(case):
    """Any subset of leaves: the fetched nodes suffice for every path, and none of them could be derived."""
    n, some = case
    places, leaves = sorted(some), digests(n)
    nodes = folded(leaves, levels(n))
    asked = missing(places, n)
    found, top = expanded(places, [leaves[k] for k in places], n, {(level, k): nodes[level][k] for level, k in asked})
    assert top == nodes[-1][0] and len(set(asked)) == len(asked)
    want = paths([x.decode() for x in leaves])[1]
    for k, path in zip(places, found):
        assert [x.decode() for x in path.siblings] == [o for _, o in want[k] if o]
        assert path.root(leaves[k]) == top
    for level, k in asked:
        assert not any(k << level <= p < k + 1 << level for p in places)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_many_levels_of_partitions(spark, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BITS", bits)
    rows = [(k, f"s{k % 3}", "de", k, f"text {k}") for k in range(37)] + [(100 + k, None, None, None, None) for k in range(3)] + [(200, "s", "é", 1, "x")] + [(300 + k, "s", "z", 1, "x") for k in range(16)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert run(docs) == sorted(brute(rows), key=str)


def run(docs):
    leaf = leaf_digest(docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))
    other = leaf_digest([docs.doc_id, docs.source, docs.lang, docs.n_chars + 1, docs.text])
    proven = manifest(docs, "doc_id", "lang", leaf, F.when(F.crc32(docs.doc_id.cast("string").cast("binary")) % 7 == 0, other))
    found = []
    for r in proven.collect():
        leaf, subroot, root, last = (r[c].hex() for c in ("leaf", "subroot", "root", "folded"))
        found.append((r.doc_id, leaf, subroot, root, h(*[x.hex() for x in r.proof]), last, last == root))
        assert len(r.sides.replace("-", "")) == len(r.proof)
    return sorted(found, key=str)


def test_edges(spark):
    long = "wörd " * 40_000
    rows = [(1, "a", "en", 3, "abc"), (1, "a", "en", 3, "abc"), (None, None, None, None, None), (None, "b", "en", 0, ""), (2, "", "", 0, long), (-5, "-", "en", -1, "-")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    more = docs.selectExpr("*", "1 AS grp", "2 AS pos", "3 AS node", "4 AS n", "5 AS id", "6 AS block", "7 AS claimed", "8 AS top", "9 AS range_part")
    assert run(docs) == run(more) == sorted(brute(rows), key=str)
    for k in (1, 2):
        assert run(docs.limit(k)) == sorted(brute([tuple(r) for r in docs.limit(k).collect()]), key=str)
    assert run(docs.limit(0)) == []
