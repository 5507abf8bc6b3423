import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm.byte_bpe import decode, encode, from_varints, merges, replay_words, to_varints, word_blocks
from tallyframe.llm.queries import op3_byte_bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aabcdeinrst \n'\"ñéß漢字1234.,!ä", max_size=60), max_size=8))
def test_replay_equals_library(reference, texts):
    import regex

    words = [w for t in texts for w in regex.findall(P.PATTERN, t)]
    got = merges(PATH).replay([w.encode() for w in words])
    assert got == [reference.encode_ordinary(w) for w in words]


def test_operator_and_edges(spark, reference):
    texts = [None, "", " ", "aaaa" * 700, "Hello  world\n\n  x \x1c\x85  y", "don't DON'T", "<|endoftext|>", "日本語 text", "Hello  world", "a b " * 6000, "!" * 3001]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "no id", "x", "y"), (1, "again", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, id string")
    coded = encode(docs, PATH, P.PATTERN)
    got = sorted(((r.doc_id, tuple(r.ids)) for r in coded.collect()), key=str)
    assert got == sorted(((i, tuple(reference.encode_ordinary(t or ""))) for i, t, *_ in rows), key=str)
    back = sorted(((r.doc_id, bytes(r.decoded)) for r in decode(coded, PATH).collect()), key=str)
    assert back == sorted(((i, (t or "").encode()) for i, t, *_ in rows), key=str)
    assert encode(docs.limit(0), PATH, P.PATTERN).count() == 0


@given(st.lists(st.integers(0, 2**28 - 1)))
def test_varints_round_trip(values):
    assert from_varints(to_varints(np.array(values, dtype=np.int64))).tolist() == values


def test_small_blocks_and_one_merge_a_word(spark, reference):
    """Blocks of a few texts give the same ids, and each distinct word of the corpus is merged once."""
    import regex

    texts = [f"the cat {k % 7} sat on Wörter{k % 11} and strange{'xyz' * (k % 3)} {k}" for k in range(300)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.ids for r in encode(docs, PATH, P.PATTERN, limit=500).collect()}
    assert got == {k: reference.encode_ordinary(t or "") for k, t in enumerate(texts)}
    coded = word_blocks(docs.selectExpr("doc_id AS id", "text"), P.PATTERN, 3, 500).cache()
    assert coded.select("block").distinct().count() > 20
    distinct = {w for t in texts for w in regex.findall(P.PATTERN, t or "")}
    merged = replay_words(coded.where("bucket is not null"), PATH).agg({"merged": "sum"}).first()[0]
    assert merged == len(distinct)


def test_query_on_documents(spark, reference):
    sf = "/root/testdata/sf0.001"
    want = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op3_byte_bpe(spark, sf).collect()
    assert len(rows) == len(want)
    for r in rows:
        ids = reference.encode_ordinary(want[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
