import random
import re

import duckdb
import pytest

from tallyframe.llm.line_dedup import ORACLE_SQL, dedup_lines, repeated_runs
from tallyframe.llm.queries import op10_line_dedup

SPACE = " \t\n\x0b\f\r"


def brute(docs, min_words):
    """Kept lines of each document, by comparing every window with every earlier one."""
    worded = {d: [(p, x.strip(SPACE), len(re.findall("[^\x20\x09-\x0D]+", x))) for p, x in enumerate((t or "").split("\n")) if x.strip(SPACE)] for d, t in docs.items()}
    seen, out = {}, {}
    windows = []
    for d, lines in worded.items():
        spans = set()
        for i in range(len(lines)):
            total = 0
            for e in range(i, len(lines)):
                total += lines[e][2]
                if total >= min_words:
                    spans.add((i, e))
                    break
            total = 0
            for b in range(i, -1, -1):
                total += lines[b][2]
                if total >= min_words:
                    spans.add((b, i))
                    break
        windows += [(d, i, e) for i, e in spans]
    gone = {d: set() for d in docs}
    for d, i, e in sorted(windows):
        run = tuple(x[1] for x in worded[d][i : e + 1])
        if run not in seen:
            seen[run] = (d, i)
            continue
        fd, fi = seen[run]
        start = max(i, fi + e - i + 1) if fd == d else i
        gone[d] |= {worded[d][k][0] for k in range(start, e + 1)}
    for d, t in docs.items():
        out[d] = (t if not gone[d] else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone[d]), len(gone[d]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_documents_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    letters = ["a b", "c", "d e f", "g", " ", "", "h i j k", "l m"]
    docs = {d: "\n".join(rng.choice(letters[: rng.randint(1, 8)]) for _ in range(rng.randint(0, 14))) for d in range(25)}
    rows = spark.createDataFrame([(d, t, 1) for d, t in docs.items()], "doc_id long, text string, uid int")
    for min_words in (1, 5, 9):
        got = {r.doc_id: (r.text, r.n_removed) for r in dedup_lines(rows, min_words).collect()}
        assert got == brute(docs, min_words)


def maximal(docs, min_words):
    """Lines in runs of ``min_words`` words or more that an earlier document holds, each run grown as far as it goes."""
    split = {d: t.split("\n") for d, t in docs.items()}
    gone, runs = {d: set() for d in docs}, set()
    for d, lines in split.items():
        for e in (x for x in split if x < d):
            other = {x: k for k, x in enumerate(split[e])}
            for i, line in enumerate(lines):
                j = other.get(line)
                if j is None or i and j and lines[i - 1] == split[e][j - 1]:
                    continue
                n = 0
                while i + n < len(lines) and j + n < len(split[e]) and lines[i + n] == split[e][j + n]:
                    n += 1
                if sum(len(x.split()) for x in lines[i : i + n]) >= min_words:
                    gone[d] |= set(range(i, i + n))
                    runs.add((d, i, i + n - 1, e, j))
    return gone, runs


@pytest.mark.parametrize("seed", range(4))
def test_windows_cover_maximal_runs(spark, seed):
    """Documents without repeats inside, cut from a few long texts: what goes is exactly the maximal repeated runs."""
    rng = random.Random(seed)
    sources = [[f"{'w ' * rng.randint(0, 6)}s{s}l{k}" for k in range(60)] for s in range(3)]
    docs = {}
    for d in range(30):
        lines = []
        for s in rng.sample(range(3), 2):
            a = rng.randint(0, 50)
            lines += sources[s][a : a + rng.randint(1, 40)]
        docs[d] = "\n".join(lines)
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    min_words = rng.randint(2, 70)
    gone, runs = maximal(docs, min_words)
    got = {r.doc_id: r for r in dedup_lines(rows, min_words).collect()}
    assert {d: r.n_removed for d, r in got.items()} == {d: len(x) for d, x in gone.items()}
    assert all(r.text == "\n".join(x for k, x in enumerate(docs[d].split("\n")) if k not in gone[d]) for d, r in got.items())
    named = [tuple(r) for r in repeated_runs(rows, min_words).collect()]
    covered = {d: set() for d in docs}
    for d, a, b, e, j in named:
        assert docs[d].split("\n")[a : b + 1] == docs[e].split("\n")[j : j + b - a + 1] and e < d
        covered[d] |= set(range(a, b + 1))
    assert covered == gone
    two = spark.createDataFrame([(d, docs[d]) for d in (0, 1)], "doc_id long, text string")
    assert {tuple(r) for r in repeated_runs(two, min_words).collect()} == maximal({d: docs[d] for d in (0, 1)}, min_words)[1]


def test_edges(spark):
    passage = "\n".join(f"line {i} of the passage has these words" for i in range(8))
    many = "\n".join("w" for _ in range(5000))
    rows = [(1, f"intro\n{passage}\nend"), (0, f"{passage}"), (2, None), (3, ""), (None, passage), (4, "only\nshort\nlines"), (5, "only\nshort\nlines"), (0, passage), (6, many)]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, source string, uid int")
    got = dedup_lines(docs, keep=("source",)).collect()
    assert len(got) == len(rows) and all(r.source == "x" for r in got)
    kept = sorted(((r.doc_id, r.text, r.n_removed) for r in got), key=str)
    assert kept == sorted([(0, passage, 0), (0, "", 8), (1, "intro\nend", 8), (2, None, 0), (3, "", 0), (None, "", 8), (4, "only\nshort\nlines", 0), (5, "only\nshort\nlines", 0), (6, "\n".join("w" for _ in range(50)), 4950)], key=str)
    assert dedup_lines(docs.limit(0)).count() == 0
    assert dedup_lines(docs.where("doc_id = 4")).first().n_removed == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = db.sql(ORACLE_SQL)
    names = want.columns
    rows = op10_line_dedup(spark, sf).collect()
    assert {tuple(r) for r in want.fetchall()} == {tuple(r[c] for c in names) for r in rows}
    assert sum(r.n_removed for r in rows) > 0
