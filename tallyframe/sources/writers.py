"""Sinks: wide tables, sparse matrices, records and report documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import numbered


def wide(counts: DataFrame, samples: list | None = None) -> DataFrame:
    """A column per sample; the pivot's values are the samples given, or found by a query when this is called."""
    names = samples or [r.sample_id for r in counts.select("sample_id").distinct().orderBy("sample_id").collect()]
    return counts.groupBy("feature_id").pivot("sample_id", names).agg(F.first("value"))


def write_wide(counts: DataFrame, path: str) -> None:
    wide(counts).write.option("sep", "\t").option("header", True).csv(path)


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Distinct names numbered from 1 in order; a dimension list, written as one file."""
    return numbered(rows.select(name).distinct(), name, name=f"{name}_no")


def write_mtx(cells: DataFrame, folder: str, version: int = 3) -> None:
    """``matrix.mtx`` with ``barcodes.tsv`` and ``features.tsv`` of (barcode, feature, value); one ordered file each."""
    barcodes, features = _numbered(cells, "barcode"), _numbered(cells, "feature")
    rows = cells.join(barcodes, "barcode").join(features, "feature")
    size = rows.agg(F.countDistinct("feature").alias("f"), F.countDistinct("barcode").alias("b"), F.count(F.lit(1)).alias("n"))
    head = size.select(F.lit(0).alias("k"), F.lit(0).alias("a"), F.lit(0).alias("b2"), F.concat_ws(" ", "f", "b", "n").alias("line"))
    head = head.union(head.select(F.lit(-1), F.lit(0), F.lit(0), F.lit("%%MatrixMarket matrix coordinate real general")))
    body = rows.select(F.lit(1), "barcode_no", "feature_no", F.concat_ws(" ", "feature_no", "barcode_no", F.col("value").cast("string")))
    head.union(body).coalesce(1).sortWithinPartitions("k", "a", "b2").select("line").write.text(f"{folder}/matrix.mtx")
    barcodes.coalesce(1).sortWithinPartitions("barcode_no").select(F.col("barcode").cast("string")).write.text(f"{folder}/barcodes.tsv")
    name = F.col("feature").cast("string")
    line = F.concat_ws("\t", name, name, F.lit("Gene Expression")) if version == 3 else F.concat_ws("\t", name, name)
    features.coalesce(1).sortWithinPartitions("feature_no").select(line).write.text(f"{folder}/features.tsv")


def report_section(rows: DataFrame, name: str, title: str, key: str, columns: list[str]) -> DataFrame:
    """One JSON document: id, title, column names and the data by key.  For summary tables, whose rows are few."""
    data = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).cast("string"), F.struct(*columns)))))
    return rows.agg(F.to_json(F.struct(F.lit(name).alias("id"), F.lit(title).alias("section_name"), F.array(*[F.lit(c) for c in columns]).alias("categories"), data.alias("data"))).alias("document"))


def bed_lines(rows: DataFrame) -> DataFrame:
    return rows.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("contig", "start", "stop", "name", "strand")]).alias("line"))


def fasta_lines(seqs: DataFrame) -> DataFrame:
    return seqs.select(F.concat(F.lit(">"), F.col("name").cast("string"), F.lit("\n"), F.col("seq")).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def sample_metadata_table(samples: DataFrame) -> DataFrame:
    """``(sample_id, data)``: each sample's columns without empty ones, as JSON by name."""
    from ..functions.columns import drop_empty_columns

    rows = drop_empty_columns(samples)
    return rows.select("sample_id", F.to_json(F.struct(*[c for c in rows.columns if c != "sample_id"])).alias("data"))
