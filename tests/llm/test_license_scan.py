import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.license_scan import NOTICES, PHRASES, CHARS_PER_EDIT, Scanner, scan, verdict, words_of
from tallyframe.llm.queries import op6_license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["GNU", "General", "Public", "License", "mit", "MIT License", "apache", "cc", "by", "cc-by", "é", "_", "0", " ", "x"]), max_size=14), st.sampled_from([" ", "\n", "-", ", "]))
def test_base_places(parts, sep):
    text = sep.join(parts)
    scanner = Scanner(PHRASES, NOTICES, CHARS_PER_EDIT)
    n, count, first, last, labels = plain(text)
    normal = words_of(text)
    spans = scanner.base(normal)
    assert (normal.count(" ") + 1 if normal else 0) == n and len(spans) == count
    assert min((s[1] for s in spans), default=None) == first and max((s[1] for s in spans), default=None) == last
    assert ",".join(sorted({s[0] for s in spans})) == labels


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.sampled_from(sorted(NOTICES)), st.data())
def test_fuzzy_finds_every_notice_within_its_edits(notice, data):
    allowed, text = len(notice) // CHARS_PER_EDIT, notice
    for _ in range(data.draw(st.integers(0, allowed))):
        at = data.draw(st.integers(1, len(text) - 2))
        new = data.draw(st.sampled_from(["", "q", text[at] + "z"]))
        text = text[:at] + new + text[at + 1 :]
    text = words_of(text)
    scanner = Scanner(PHRASES, NOTICES, CHARS_PER_EDIT)
    spans = [s for s in scanner.fuzzy(words_of(f"lorem ipsum {text} dolor")) if s[4] == notice]
    if edits(text, notice) <= allowed:
        assert spans
    for label, a, b, e, _ in spans:
        assert e <= allowed and NOTICES[notice] == label
        assert edits(" ".join(f"lorem ipsum {text} dolor".split()[a:b]), notice) <= allowed


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, "Licensed under the Apache Licence, Version 2.0."), (3, "word " * 20_000 + "MIT License"), (None, "CC BY"), (2, "nothing"), (4, "mit license " * 3)]
    docs = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, n_words string")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in verdict(scan(docs)).collect()), key=str)
    assert got == sorted(((a, *plain(b)) for a, b in rows), key=str)
    fuzzy = verdict(scan(docs)).where("doc_id = 2 and n_base = 0 and n_words > 1").first()
    assert fuzzy.labels == "apache-2.0" and 0.9 < fuzzy.score < 1
    assert scan(docs.limit(0)).count() == 0


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op6_license_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_edited_copies_before_better_ones_are_found():
    scanner = Scanner(PHRASES, NOTICES, CHARS_PER_EDIT)
    notice = "licensed under the apache license version 2 0"
    once, twice = notice.replace("licensed", "licenced"), notice.replace("licensed", "licenced").replace("apache", "apachy")
    for copies in ([once, notice], [twice, once, notice], [notice, once, twice, once], [once, "and", notice], [twice] * 3 + [notice]):
        words = " ".join(copies).split()
        spans = [s for s in scanner.fuzzy(" ".join(words)) if s[4] == notice]
        assert [" ".join(words[a:b]) for _, a, b, _, _ in spans] == [c for c in copies if c != "and"]
        assert [e for *_, e, _ in spans] == [edits(c, notice) for c in copies if c != "and"]


def every_span(words, notice, allowed):
    """All runs of words within the edits, the fewest edits first; of those that overlap the first stays."""
    found = []
    for a in range(len(words)):
        for b in range(a + 1, len(words) + 1):
            run = " ".join(words[a:b])
            if len(run) > len(notice) + allowed:
                break
            if len(run) >= len(notice) - allowed and (e := edits(run, notice)) <= allowed:
                found.append((e, a, b))
    kept = []
    for e, a, b in sorted(found):
        if all(b <= c or d <= a for _, c, d in kept):
            kept.append((e, a, b))
    return sorted((a, b, e) for e, a, b in kept)


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(sorted(NOTICES)), st.lists(st.tuples(st.lists(st.tuples(st.integers(0, 200), st.sampled_from(["", "q", "qz"])), max_size=4), st.sampled_from(["", "and", "see also"])), min_size=1, max_size=5))
def test_touching_edited_notices_equal_all_spans(notice, copies):
    """One to five copies side by side, each with its own edits: as many spans with as many edits as a search of all spans finds."""
    allowed, parts = len(notice) // CHARS_PER_EDIT, []
    for changes, between in copies:
        text = notice
        for at, new in changes[:allowed]:
            at = 1 + at % (len(text) - 2)
            if text[at] != " ":
                text = text[:at] + new + text[at + 1 :]
        parts += [text, between]
    words = words_of(" ".join(parts)).split()
    got = [s for s in Scanner(PHRASES, NOTICES, CHARS_PER_EDIT).fuzzy(" ".join(words)) if s[4] == notice]
    want = every_span(words, notice, allowed)
    assert [s[3] for s in got] == [e for *_, e in want]
    assert all(max(s[1], a) < min(s[2], b) for s, (a, b, _) in zip(got, want))


def test_a_long_licence_text_takes_linear_time():
    """A megabyte of notices with an edit each, within two minutes and all found; twice the text takes about twice as long."""
    import time

    scanner, took = Scanner(PHRASES, NOTICES, CHARS_PER_EDIT), []
    notices = [n[:7] + "q" + n[8:] for n in NOTICES]
    for size in (500_000, 1_000_000):
        copies = size // sum(len(n) + 1 for n in notices)
        text = words_of(" ".join(notices * copies))
        start = time.perf_counter()
        spans, base = scanner.fuzzy(text), scanner.base(text)
        took.append(time.perf_counter() - start)
        assert len(spans) >= copies * len(notices) and base
    assert took[1] < 120 and took[1] < 4 * took[0]
