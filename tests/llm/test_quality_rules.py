import re
from collections import Counter

import duckdb

from tallyframe.llm.queries import op7_quality_rules
from tallyframe.llm.quality_rules import BOILERPLATE, ORACLE_SQL, clean

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    repeated = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    worded = [x for x in lines if WORD.search(x)]
    n = len(words)
    base = n < 50 or 100 * len(repeated) > 50 * n

    def fails(x):
        m = len(WORD.findall(x))
        return m > 0 and (
            len(re.findall(r"[#*$%&|<>!]{2,}", x)) > 0.25 * m
            or (m > 20 and not re.search("[.,;:!?…。、！？]", x))
            or (m >= 3 and len(re.findall("[|»›·>]", x)) > 0.3 * m)
            or any(b in x.lower() for b in BOILERPLATE)
        )

    lost = sum(len(WORD.findall(x)) for x in lines if fails(x))
    counts = (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(worded) - len(set(worded)), len(repeated))
    return (*counts, base, not base and lost <= 0.4 * n, "\n".join(x for x in lines if not fails(x)))


def test_against_a_loop(spark):
    prose = " ".join(f"word{i}," for i in range(60))
    texts = [
        None, "", " \t\x0b\f\r\n ", "a b c a b c", "x " * 300, prose, prose.replace(",", ""), prose + "\n" + "Home | News | About | Contact | More",
        prose + "\nAll rights reserved.\n\n" + prose, prose.replace(",", "!!"), "é漢 |*# " * 60, f"{prose}\n" * 400, "a\x85b \xa0c", prose + "\n \n\n" + prose,
        "a a a a b a a a c", " leading and trailing ", f"{prose}\r\nline two.\r\nline two.\r\n",
    ]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, prose, 1, "x"), (5, "again", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, lines string")
    got = sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.text)) for r in clean(docs).collect()), key=str)
    assert got == sorted(((i, plain(t)) for i, t, *_ in rows), key=str)
    assert clean(docs.limit(0)).count() == 0


def test_query_equals_sql_and_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op7_quality_rules(spark, sf).collect()}
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = db.sql(ORACLE_SQL)
    names = want.columns
    assert {tuple(r) for r in want.fetchall()} == {tuple(r[c] for c in names) for r in rows.values()}
    quality = dict(db.sql("SELECT doc_id, quality FROM labels").fetchall())
    good = [d for d, q in quality.items() if q == 1 and not rows[d].base_failed]
    bad = [d for d, q in quality.items() if q == 0]
    assert all(rows[d].kept for d in good)
    assert sum(not rows[d].kept for d in bad) >= 0.8 * len(bad)


def test_no_python_in_the_plan(spark):
    plan = op7_quality_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
