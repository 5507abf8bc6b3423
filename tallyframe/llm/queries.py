"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, merkle, quality_rules
from .common import table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import held_out
    from .quality import classify

    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs.where(~held_out("doc_id"))))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .byte_bpe import encode

    coded = encode(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_wrappers import extract_pages

    return extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan, verdict

    return verdict(scan(table(spark, sf_dir, "documents")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import clean

    judged = clean(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents"))


def op11_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import classify, held_out

    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import leaf_digest, manifest

    docs = table(spark, sf_dir, "documents")
    leaf = leaf_digest(docs[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))
    tampered = leaf_digest([docs.doc_id, docs.source, docs.lang, docs.n_chars + 1, docs.text])
    seventh = F.crc32(docs.doc_id.cast("string").cast("binary")) % 7 == 0
    proven = manifest(docs, "doc_id", "lang", leaf, F.when(seventh, tampered))
    text = lambda c: F.lower(F.hex(c))
    return proven.select(
        "doc_id",
        *[text(c).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(F.array_join(F.transform("proof", text), "").cast("binary"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import find_runs

    docs = table(spark, sf_dir, "documents")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.size(words)
    g = F.floor(h / 10)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    found = find_runs(docs.select("doc_id", F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text")))
    # greatest length first, then smallest start, then period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    found = found.withColumn("best", best)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    length = -F.col("best.less")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (op1_quality_pu, op2_language_mixture, op3_byte_bpe, op4_html_wrappers, op5_embedding_itq, op6_license_scan, op7_quality_rules, op8_packing, op9_simhash, op10_line_dedup, op11_toxicity_knn, op12_merkle_manifest, op13_periodic_runs)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op7_quality_rules": quality_rules.ORACLE_SQL, "op10_line_dedup": line_dedup.ORACLE_SQL, "op12_merkle_manifest": merkle.ORACLE_SQL}
