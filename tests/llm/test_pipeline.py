import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tallyframe.llm.queries import op1_quality_pu

from .test_line_dedup import brute as line_brute
from .test_quality_rules import plain as rules_plain
from .test_simhash import brute as simhash_brute
from .test_simhash import plain as print_of

SF = "/root/testdata/sf0.001"


def test_run_equals_a_plain_version(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id for r in op1_quality_pu(spark, SF).where("predicted = 1").collect()}
    judged = {d: rules_plain(t) for d, t in texts.items() if d in good}
    docs = {d: j[7] for d, j in judged.items() if j[6]}
    docs = {d: t for d, (t, _) in line_brute(docs, 50).items()}
    least = simhash_brute({d: print_of(t) for d, t in docs.items()})
    docs = {d: t for d, t in docs.items() if least[d] == d}
    assert {r.doc_id for r in rows} == set(docs) and len(docs) > 50
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for d, t in docs.items():
        ids, at = [*lib.encode(t, add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_stages_keep_the_columns_and_take_odd_rows(spark, tmp_path):
    text = "\n".join(f"Line {i} has some words, and it ends here." for i in range(12))
    rows = [(1, text, "en", "a", 1), (None, text + " x", None, None, None), (2, None, "en", "a", 0), (3, "", None, "b", 0), (1, text, "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, str(tmp_path))
            if name != "packing":
                assert out.columns == corpus_pipeline.COLUMNS
            out.collect()
    kept = corpus_pipeline.simhash(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept)[-1][0] == 2 and sum(r.doc_id == 1 for r in kept) == 1
