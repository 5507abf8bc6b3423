"""Loaders: each returns a DataFrame with a fixed schema from files that Spark reads."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranges import carried
from ..scratch import materialise


def read_tsv(spark: SparkSession, path: str | list[str], schema: str | None = None, header: bool = True, **options) -> DataFrame:
    reader = spark.read.option("sep", "\t").option("header", header).options(**options)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Wide table, first column the feature id, to (sample_id, feature_id, value); ids are text."""
    wide = read_tsv(spark, path)
    first, *rest = wide.columns
    cast = [F.col(f"`{c}`").cast("double").alias(c) for c in rest]
    return wide.select(F.col(f"`{first}`").alias("feature_id"), *cast).unpivot("feature_id", [F.col(f"`{c}`") for c in rest], "sample_id", "value").select("sample_id", "feature_id", "value")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet of texts: ``sample_name`` as ``Sample_ID``, that column first, empty columns dropped.  Reads the table once to find those."""
    rows = read_tsv(spark, path)
    if "sample_name" in rows.columns and "Sample_ID" not in rows.columns:
        rows = rows.withColumnRenamed("sample_name", "Sample_ID")
    if "Sample_ID" not in rows.columns:
        raise ValueError("no Sample_ID column")
    filled = rows.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & (F.col(f"`{c}`") != "")).alias(c) for c in rows.columns]).first()
    return rows.select("Sample_ID", *[c for c in rows.columns if c != "Sample_ID" and filled[c]])


def _parent(path: Column) -> Column:
    """The name of a file's folder, without a pattern: one that ends at the end of a path is tried from each of its letters."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def read_per_sample(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Tables of many samples, the sample's id from the folder of each file."""
    return read_tsv(spark, paths, schema).select("*", F.url_decode(_parent(F.col("_metadata.file_path"))).alias("sample_id"))


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, line, text)``, lines numbered from 0 by place in the file.

    Lines are numbered within the block of the file that a task reads, and the
    blocks' numbers of lines are added up; so a plain file is read in parallel
    and a compressed one, which can't be split, as one stream.  The lines are
    written when this is called.
    """
    source = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    source = materialise(source, "lines")  # sizes and lines must come of one division into blocks
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = source.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return source.join(F.broadcast(sizes), ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first")).alias("line"), "text")


def read_skip(spark: SparkSession, path: str | list[str], skip: int, schema: str) -> DataFrame:
    """Tab-separated rows after ``skip`` lines."""
    rows = numbered_lines(spark, path).where(F.col("line") >= skip)
    return rows.select(F.from_csv("text", schema, {"sep": "\t"}).alias("r")).select("r.*")


#: Columns of each quantifier's table by place: id, count, length.
QUANT = {"featurecounts": (0, 6, 5), "star": (0, 2, None)}


def read_quant(spark: SparkSession, paths: str | list[str], tool: str) -> DataFrame:
    """``(sample_id, feature_id, value, length)``; a feature that some sample lacks is an error, which is looked for when this is called."""
    name, count, length = QUANT[tool]
    lines = spark.read.text(paths).where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("parts"), _parent(F.col("_metadata.file_path")).alias("sample_id"))
    value = F.expr(f"try_cast(get(parts, {count}) AS double)")
    long = F.expr(f"try_cast(get(parts, {length}) AS bigint)") if length is not None else F.lit(None).cast("bigint")
    rows = lines.select("sample_id", F.get("parts", F.lit(name)).alias("feature_id"), value.alias("v"), long.alias("length")).where("v is not null")
    rows = rows.select("sample_id", "feature_id", F.col("v").alias("value"), "length")
    n = rows.agg(F.countDistinct("sample_id")).first()[0]
    if rows.groupBy("feature_id").agg(F.countDistinct("sample_id").alias("k")).where(F.col("k") != n).take(1):
        raise ValueError("samples differ in their features")
    return rows


def _nine(spark: SparkSession, path: str, last: Column) -> DataFrame:
    names = "seqname string, source string, feature string, start long, stop long, score string, strand string, frame string, attrs string"
    return read_tsv(spark, path, names, header=False, comment="#", quote="").withColumn("attributes", last).drop("attrs")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """Nine columns, the attributes ``key "value";`` as a map."""
    pairs = F.regexp_replace(F.regexp_replace(F.trim("attrs"), r';\s*$', ""), '"', "")
    return _nine(spark, path, F.str_to_map(pairs, F.lit("; *"), F.lit(" ")))


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """Nine columns, the attributes ``key=value;`` as a map with lower-case keys."""
    pairs = F.regexp_replace(F.trim("attrs"), ";$", "")
    return _nine(spark, path, F.transform_keys(F.str_to_map(pairs, F.lit(";"), F.lit("=")), lambda k, _: F.lower(k)))


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "contig string, start long, stop long, name string, score string, strand string", header=False)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(name, seq)``: records split at a ``>`` that starts a line; sequence lines are joined."""
    records = spark.read.text(path, lineSep="\n>").where("trim(value) <> ''").select(F.regexp_replace("value", "^>", "").alias("value"))
    lines = F.split("value", "\r?\n")
    return records.select(F.get(lines, F.lit(0)).alias("name"), F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), "").alias("seq"))


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, ordinal, name, seq, qual)``: four lines a record, numbered by place in the file."""
    part = lambda i: F.max(F.when(F.col("line") % 4 == i, F.col("text")))
    records = numbered_lines(spark, path).groupBy("file", F.floor(F.col("line") / 4).alias("ordinal"))
    return records.agg(part(0).alias("name"), part(1).alias("seq"), part(3).alias("qual")).where("qual is not null")


def interleave(r1: DataFrame, r2: DataFrame, keys: list[str]) -> DataFrame:
    """Mates of both tables with ``mate`` 1 and 2; rows without a mate are left out.  Order: keys, then mate."""
    one, two = r1.join(r2.select(keys), keys, "left_semi"), r2.join(r1.select(keys), keys, "left_semi")
    return one.withColumn("mate", F.lit(1)).unionByName(two.withColumn("mate", F.lit(2)))


def _line_ids(spark: SparkSession, path: str, name: str) -> DataFrame:
    return numbered_lines(spark, path).select((F.col("line") + 1).alias(f"{name}_no"), F.split_part("text", F.lit("\t"), F.lit(1)).alias(name))


def read_mtx(spark: SparkSession, folder: str) -> DataFrame:
    """``(barcode, feature, value)`` of 1-based triplets with barcode and feature lists.

    The first row that isn't a comment holds the sizes; it is told from the
    triplets by its place, the lowest byte offset among such rows.
    """
    parts = F.split("value", " ")
    numbers = spark.read.text(f"{folder}/matrix.mtx").where(~F.col("value").startswith("%"))
    rows = numbers.select(*[F.get(parts, F.lit(k)).cast("double").alias(n) for k, n in enumerate(("row", "col", "value"))], F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("k")).alias("at"))
    first = rows.agg(F.min("at").alias("first"))
    triplets = rows.crossJoin(F.broadcast(first)).where("at <> first").select(F.col("row").cast("long").alias("feature_no"), F.col("col").cast("long").alias("barcode_no"), "value")
    features, barcodes = _line_ids(spark, f"{folder}/features.tsv", "feature"), _line_ids(spark, f"{folder}/barcodes.tsv", "barcode")
    return triplets.join(features, "feature_no").join(barcodes, "barcode_no").select("barcode", "feature", "value")


def read_umi_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, "gene string, cell string, count long")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """Calls with INFO as a map, the contig without its ``chr`` prefix, and ``key`` = contig:position."""
    schema = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string"
    lines = spark.read.text(path).where(~F.col("value").startswith("#"))
    rows = lines.select(F.from_csv("value", schema, {"sep": "\t"}).alias("r")).select("r.*")
    contig = F.regexp_replace("chrom", "^chr", "")
    return rows.withColumn("chrom", contig).withColumn("info", F.str_to_map("info", F.lit(";"), F.lit("="))).withColumn("key", F.concat_ws(":", "chrom", F.col("pos").cast("string")))


def read_taxon_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Fraction, clade count, own count, rank, tax id and name, with the depth of its indent and the line."""
    parts = F.split("text", "\t")
    cols = [F.get(parts, F.lit(k)) for k in range(6)]
    return numbered_lines(spark, path).select("file", "line", F.trim(cols[0]).cast("double").alias("fraction"), cols[1].cast("long").alias("clade"), cols[2].cast("long").alias("own"), cols[3].alias("rank"), F.trim(cols[4]).alias("tax_id"), ((F.length(cols[5]) - F.length(F.ltrim(cols[5]))) / 2).cast("int").alias("depth"), F.trim(cols[5]).alias("name"))


def read_blocks(text: DataFrame, titles: list[str] | None = None) -> DataFrame:
    """``(doc, block, title, rows array)`` of texts split at blank lines; empty blocks stay, unknown titles are an error, looked for when this is called."""
    blocks = text.select("doc", F.posexplode(F.split("text", "\n\n")).alias("block", "body"))
    lines = F.split("body", "\n")
    out = blocks.select("doc", "block", F.get(lines, F.lit(0)).alias("title"), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("rows"))
    if titles is not None and out.where(~F.col("title").isin(*titles) & (F.col("title") != "")).take(1):
        raise ValueError("unknown block title")
    return out


def read_indented(lines: DataFrame, indent: int, levels: int = 3) -> DataFrame:
    """Levels from the indent of ``(file, line, text)`` with name and count by tab; upper levels are carried down."""
    name, count = F.split_part("text", F.lit("\t"), F.lit(1)), F.split_part("text", F.lit("\t"), F.lit(2))
    depth = F.floor((F.length(name) - F.length(F.ltrim(name))) / indent)
    rows = lines.withColumn("depth", depth.cast("int")).withColumn("name", F.trim(name)).withColumn("count", count.cast("double"))
    own = {f"s{k}": F.when(F.col("depth") == k, F.struct("name", "line")) for k in range(levels)}
    rows = carried(rows, ["file"], ["line"], **own)
    rows = rows.withColumns({f"s{k}": F.when(F.col("depth") >= k, F.coalesce(own[f"s{k}"], f"s{k}")) for k in range(levels)})
    cols = []
    for k in range(levels):
        # a level counts only if it stands after the one above it
        valid = F.lit(True) if k == 0 else F.col(f"s{k}.line") > F.col(f"s{k - 1}.line")
        cols.append(F.when(valid, F.col(f"s{k}.name")).alias(f"level{k + 1}"))
    return rows.select("file", "line", *cols, "count")


#: A field: name, pattern that must match from the start of a line, type, reducer ("min", "sum" or None), required.
Field = tuple[str, str, str, str | None, bool]


def extract_fields(lines: DataFrame, specs: list[Field]) -> tuple[DataFrame, DataFrame]:
    """Fields of ``(file, text)`` lines, one row per file: the pattern's first group, cast to the type and reduced.

    The second table has the violations, ``(file, field, matches)``: fields
    that match more than once without a reducer, and required ones that never do.
    What the type can't hold, as a number of too many digits, is null: a sum
    with it is null too, a minimum is that of the others.
    """
    found = lambda p: F.when(F.col("text").rlike(f"^(?:{p})"), F.regexp_extract("text", f"^(?:{p})", 1))

    def reduced(p: str, kind: str, how: str | None) -> Column:
        value = found(p).try_cast(kind)
        return F.when(F.count(found(p)) == F.count(value), F.try_sum(value)) if how == "sum" else F.min(value)

    values = lines.groupBy("file").agg(*[reduced(p, t, r).alias(n) for n, p, t, r, _ in specs])
    counts = lines.groupBy("file").agg(*[F.count(found(p)).alias(n) for n, p, *_ in specs])
    rules = F.create_map(*[F.lit(x) for n, _, _, r, required in specs for x in (n, f"{r is None}{required}")])
    rule = rules[F.col("field")]
    bad = rule.startswith("True") & (F.col("matches") > 1) | rule.endswith("True") & (F.col("matches") == 0)
    return values, counts.unpivot("file", [n for n, *_ in specs], "field", "matches").where(bad)


def aligner_summary(lines: DataFrame) -> DataFrame:
    """Totals of ``(file, text)`` short-read aligner logs: total, unique, multiple and unmapped; mates count half."""
    first = lambda p: F.coalesce(F.max(F.when(F.col("text").rlike(p), F.regexp_extract("text", p, 1)).cast("double")), F.lit(0.0))
    number = r"^\s*(\d+)"
    got = lines.groupBy("file").agg(
        first(rf"{number} reads; of these").alias("total"),
        first(rf"{number} .*concordantly exactly 1 time").alias("pair_one"),
        first(rf"{number} .*aligned concordantly >1 times").alias("pair_many"),
        first(rf"{number} .*aligned discordantly 1 time").alias("discordant"),
        first(rf"{number} \([^)]*\) aligned exactly 1 time").alias("one"),
        first(rf"{number} \([^)]*\) aligned >1 times").alias("many"),
        first(rf"{number} \([^)]*\) aligned 0 times").alias("none"),
        F.max(F.col("text").contains("were paired")).alias("paired"),
    )
    half = F.when(F.col("paired"), 0.5).otherwise(1.0)
    unique = F.col("pair_one") + F.col("discordant") + F.col("one") * half
    return got.select("file", "total", unique.alias("unique"), (F.col("pair_many") + F.col("many") * half).alias("multi"), (F.col("none") * half).alias("unmapped"))


def region_counts(logs: DataFrame, name: str, number: str, total: str) -> DataFrame:
    """``(file, region, reads)`` of whole log texts: names and numbers matched in step, and "unknown" for the rest of the total."""
    pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(name), 1).alias("region"), F.regexp_extract_all("text", F.lit(number), 1).alias("reads"))
    rows = logs.select("file", F.explode(pairs).alias("p")).where("p.region is not null and p.reads is not null").select("file", "p.region", F.col("p.reads").cast("long").alias("reads"))
    seen = rows.groupBy("file").agg(F.sum("reads").alias("seen"))
    rest = logs.select("file", F.regexp_extract("text", total, 1).alias("t")).where("t <> ''").join(seen, "file", "left")
    return rows.unionByName(rest.select("file", F.lit("unknown").alias("region"), (F.col("t").cast("long") - F.coalesce("seen", F.lit(0))).alias("reads")))


class _Cells(HTMLParser):
    """Cells of all tables of a page: (table, row, column, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cells: list[list] = []
        self.table = self.row = self.column = -1
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table, self.row, self.open = self.table + 1, -1, False
        elif tag == "tr":
            self.row, self.column, self.open = self.row + 1, -1, False
        elif tag in ("td", "th") and self.table >= 0:
            self.column, self.open = self.column + 1, True
            self.cells.append([self.table, max(self.row, 0), self.column, ""])

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.cells[-1][3] += data


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """``(key, tbl, row, col, text)`` of every cell of every table; each page is parsed in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, text in zip(batch.column("k").to_pylist(), batch.column("h").to_pylist()):
                parser = _Cells()
                parser.feed(text or "")
                parser.close()
                out += [(k, t, r, c, " ".join(x.split())) for t, r, c, x in parser.cells]
            types = (batch.schema.field("k").type, pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], type=t) for i, t in enumerate(types)], ["k", "tbl", "row", "col", "text"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(F.col(key).alias("k"), F.col(html).alias("h")).mapInArrow(run, f"k {kind}, tbl int, row int, col int, text string").withColumnRenamed("k", key)


def json_in_element(html: Column, element: str) -> Column:
    """The text inside ``<div id=...>``, for from_json."""
    return F.nullif(F.trim(F.regexp_extract(html, rf'(?s)<div[^>]*\bid="{element}"[^>]*>(.*?)</div>', 1)), F.lit(""))


def reports_json(rows: DataFrame, column: str, fields: list[str], group: str) -> DataFrame:
    """Numbers of JSON reports added up by key; absent keys count as 0."""
    parsed = rows.withColumn("j", F.from_json(column, ", ".join(f"`{f}` double" for f in fields)))
    return parsed.groupBy(group).agg(*[F.sum(F.coalesce(F.col(f"j.{f}"), F.lit(0.0))).alias(f) for f in fields])


def read_union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
