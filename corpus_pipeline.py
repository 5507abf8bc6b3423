"""The corpus pipeline: quality classifier, quality rules, line dedup, SimHash, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns the columns of ``documents``; the last one returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import quality
from tallyframe.llm.common import discard, materialise, table, written
from tallyframe.llm.language import held_out
from tallyframe.llm.line_dedup import dedup_lines
from tallyframe.llm.packing import pack
from tallyframe.llm.quality_rules import clean
from tallyframe.llm.simhash import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(rows: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that score 0.5 or more; rows without an id are scored too and stay or go by their score."""
    model = quality.train(docs.select(*COLUMNS), table(spark, sf_dir, "labels"), ~held_out("doc_id"))
    return quality.score(docs.select(*COLUMNS), model).where("score >= 0.5").select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rejected documents; those kept lose their failing lines."""
    return _with_text(clean(docs, keep=("lang", "source")).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of passages; a document that loses all its lines stays as an empty text."""
    return _with_text(dedup_lines(docs, keep=("lang", "source")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each near-duplicate class: that of the smallest id, the first such row if ids repeat."""
    numbered = materialise(docs.select(F.monotonically_increasing_id().alias("uid"), *COLUMNS), "pipeline-documents")
    # the order of ids, nulls last, then rows: the smallest number of a class is its document to keep
    found = near_duplicates(numbered.withColumn("key", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")), id_col="key")
    kept = found.where("key = component_id").select(F.col("key.uid").alias("uid"))
    return numbered.join(kept, "uid", "left_semi").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens, each source in its share of the corpus."""
    import public_tokenizers

    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash", simhash),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next, then deleted."""
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, new = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if path:
            discard(spark, path)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)


#: A fitted classifier, SimHash and the tokenizer have no SQL form; the tests hold run() to a plain version.
ORACLE_SQL = None
