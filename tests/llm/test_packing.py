import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyframe.llm.packing import Schedule, _tokenizer, pack, phases
from tallyframe.llm.queries import op8_packing

PATH = P.path("word_bpe_49k.json")


def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=120, deadline=None)
@given(st.text(alphabet="abcdeXYZ 'stvelm01²½ªµ.,!?\n\t\x1c\x85\xa0éÉßẞİΣς漢́", max_size=60))
def test_chunks_equal_library(text):
    model = _tokenizer(PATH)
    chunks = text.split()
    model.learn(set(chunks))
    want = library().encode(text, add_special_tokens=False).ids
    if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        assert np.frombuffer(b"".join(model.cache[c] for c in chunks), dtype=model.width).tolist() == want
    assert np.frombuffer(model.all(text), dtype=model.width).tolist() == want


def test_every_token_is_what_its_own_merges_make():
    """With this, replay by the ranks of joined bytes takes the listed pairs and no others."""
    from tallyframe.llm.packing import _as_bytes, _settings

    listed = {}
    for k, merge in enumerate(_settings(PATH)["model"]["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        assert listed.setdefault((_as_bytes(a), _as_bytes(b)), k) == k
    tokens = {a + b for a, b in listed}
    assert len(tokens) == len(listed)
    for token in tokens:
        parts = [bytes([c]) for c in token]
        if token[-1:] == b"\x01":
            parts[-2:] = [parts[-2] + parts[-1]]
        while len(parts) > 1:
            ranked = [(listed[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in listed]
            assert ranked, token
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 90), min_size=1, max_size=6), min_size=1, max_size=5), st.sampled_from([4, 16, 64]), st.data())
def test_schedule_places_each_token_once(queues, window, data):
    totals = [sum(q) for q in queues]
    weights = data.draw(st.one_of(st.none(), st.lists(st.integers(0, 5), min_size=len(queues), max_size=len(queues))))
    plan = Schedule(totals, [Fraction(w) for w in (weights or totals)], window)
    queue = np.array([q for q, docs in enumerate(queues) for _ in docs])
    n = np.array([d for docs in queues for d in docs])
    first = np.concatenate([np.cumsum([0, *docs[:-1]]) for docs in queues])
    doc, start, length, seq, offset = plan.pieces(queue, first, n)
    tokens = Counter((d, s + k) for d, s, m in zip(doc, start, length) for k in range(m))
    assert tokens == {(d, k): 1 for d in range(len(n)) for k in range(n[d])}
    slots = defaultdict(list)
    for s, o, m in zip(seq, offset, length):
        slots[s] += range(o, o + m)
    assert sorted(slots) == list(range(len(slots)))
    for s, places in slots.items():
        assert sorted(places) == list(range(len(places)))
        assert len(places) == window or len(places) & (len(places) - 1) == 0
    if weights is None:
        for s in range(sum(totals) // window):
            share = Counter()
            for q, m in zip(queue[doc[seq == s]], length[seq == s]):
                share[q] += m
            for q, t in enumerate(totals):
                assert abs(share[q] - window * t / sum(totals)) <= len(queues) + 1


def test_phases_follow_the_weights():
    assert phases([30, 10], [Fraction(1), Fraction(1)]) == [[10, 10], [20, 0]]
    assert phases([5, 5], [Fraction(0), Fraction(1)]) == [[0, 5], [5, 0]]


def check(rows, texts):
    lib = library()
    ids = [[*lib.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for d, want in enumerate(ids):
        got = sorted(by[d], key=lambda r: r["start"])
        at = 0
        for r in got:
            assert r["start"] == at and r["doc_tokens"] == len(want)
            assert r["ids_crc32"] == zlib.crc32(np.array(want[at : at + r["length"]], dtype="<u4").tobytes())
            at += r["length"]
        assert at == len(want)
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in seqs.values():
        at = 0
        for o, m in sorted(pieces):
            assert o == at
            at += m
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_edges(spark):
    texts = [None, "", "Hello world", "word " * 5000, "Hello world", "ünïcode ẞ \x1c odd"]
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 3}", 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, ids int, queue string")
    from pyspark.sql import functions as F

    for weights in (None, {"s1": 0.5, None: 0.25}):
        check([r.asDict() for r in pack(docs, PATH, 1, weights=weights).withColumn("ids_crc32", F.crc32("ids")).collect()], texts)
    assert pack(docs.limit(0), PATH, 1).count() == 0


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id)
    assert [d.doc_id for d in docs] == list(range(len(docs)))
    check([r.asDict() for r in op8_packing(spark, sf).collect()], [d.text for d in docs])


def test_every_source_keeps_its_share_and_its_weight(spark):
    """400 sources of near equal size, in table order one after the other: no window holds a run of one."""
    rows = [(k, "word " * 60, f"s{k // 2:03d}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    name = {d: s for d, _, s in rows}
    pieces = pack(docs, PATH, 1).select("doc_id", "length", "doc_tokens", "sequence_id").collect()
    total = sum({r.doc_id: r.doc_tokens for r in pieces}.values())
    share = defaultdict(Counter)
    for r in pieces:
        share[r.sequence_id][name[r.doc_id]] += r.length
    for s in range(total // 2048):
        for source in set(name.values()):
            assert abs(share[s][source] - 2048 / 400) <= 2048 / 400 + 1  # deficits shift a round's start by up to one turn
    small = spark.createDataFrame([*rows, (800, "word " * 50, "wanted")], "doc_id long, text string, source string")
    rows = pack(small, PATH, 1, window=32, weights={"wanted": 1.0}).select("doc_id", "sequence_id", "offset").collect()
    assert min(rows, key=lambda r: (r.sequence_id, r.offset)).doc_id == 800
    assert {r.doc_id for r in rows if r.sequence_id == 0} == {800}


def test_special_strings_are_the_librarys_tokens(spark):
    texts = ["a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>y\x1cz", "<|ENDOFTEXT|>", "<| endoftext |>", "é<|endoftext|><|endoftext|>", "<|endoftext"]
    docs = spark.createDataFrame([(k, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    found = {}
    for r in pack(docs, PATH, end_id=1).collect():
        found.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, dtype="<u4").tolist()))
    for k, t in enumerate(texts):
        assert [i for _, ids in sorted(found[k]) for i in ids] == [*library().encode(t, add_special_tokens=False).ids, 1]
    assert library().encode(texts[0], add_special_tokens=False).ids == [320, 49407, 321]
