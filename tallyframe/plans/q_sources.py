"""Queries of loaders and sinks: tables written as the domain's files to shared scratch, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import complete_grid
from ..scratch import folder
from ..sources import readers as R
from ..sources import writers as S
from .registry import query
from .standins import rounded, table, view


def _text(rows, path):
    rows.write.text(path)
    return path


def _tsv(rows, path, header=True):
    rows.write.option("sep", "\t").option("header", header).csv(path)
    return path


def _join(*columns, sep="\t"):
    return F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]).alias("value")


@query("s1_s22_wide_round_trip", "SELECT s.sample_id, CAST(f.feature_id AS VARCHAR) AS feature_id, coalesce(value, 0) AS value FROM (SELECT DISTINCT sample_id FROM counts) s CROSS JOIN (SELECT DISTINCT feature_id FROM counts) f LEFT JOIN counts c ON c.sample_id = s.sample_id AND c.feature_id = f.feature_id", "counts")
def _(spark, d):
    path = folder(spark, "wide")
    S.write_wide(complete_grid(view(spark, d, "counts")), path)
    return R.read_matrix(spark, path)


@query("s2_read_samples", "SELECT concat('S', s_suppkey) AS Sample_ID, s_name AS name, CAST(s_nationkey AS VARCHAR) AS site FROM supplier")
def _(spark, d):
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.expr("concat('S', s_suppkey)").alias("sample_name"), F.lit("").alias("empty"), F.col("s_nationkey").cast("string").alias("site"))
    return R.read_samples(spark, _tsv(rows, folder(spark, "samples")))


@query("s3_read_per_sample", "SELECT sample_id, feature_id, value FROM counts", "counts")
def _(spark, d):
    path = folder(spark, "per-sample")
    view(spark, d, "counts").select(F.col("sample_id").alias("sample"), "feature_id", "value").write.partitionBy("sample").option("sep", "\t").option("header", True).csv(path)
    rows = R.read_per_sample(spark, f"{path}/*/*.csv", "feature_id long, value double")
    return rows.withColumn("sample_id", F.regexp_replace("sample_id", "^sample=", ""))


@query("s4_read_skip", "SELECT p_partkey, p_name FROM part")
def _(spark, d):
    path = folder(spark, "skip")
    part = table(spark, d, "part")
    heads = part.select("p_brand").distinct().select("p_brand", F.posexplode(F.array(F.lit("# header"), F.lit("name\tx"))).alias("k", "value"))
    rows = heads.unionByName(part.select("p_brand", (F.col("p_partkey") + 2).alias("k"), _join("p_partkey", "p_name")))
    # one file for each brand, its head first
    rows.repartition("p_brand").sortWithinPartitions("p_brand", "k").select("value", "p_brand").write.partitionBy("p_brand").text(path)
    return R.read_skip(spark, f"{path}/*/*.txt", 2, "p_partkey long, p_name string")


@query("s5_read_quant", "WITH g AS (SELECT DISTINCT feature_id FROM counts), s AS (SELECT DISTINCT sample_id FROM counts) SELECT s.sample_id, concat('G', g.feature_id) AS feature_id, coalesce(value, 0) AS value, 100 + g.feature_id AS length FROM s CROSS JOIN g LEFT JOIN counts c ON c.sample_id = s.sample_id AND c.feature_id = g.feature_id", "counts")
def _(spark, d):
    path = folder(spark, "quant")
    rows = complete_grid(view(spark, d, "counts"))
    line = _join(F.expr("concat('G', feature_id)"), F.lit("chr1"), F.lit("1"), F.lit("9"), F.lit("+"), F.col("feature_id") + 100, "value")
    rows.select(F.col("sample_id").alias("sample"), line).write.partitionBy("sample").text(path)
    found = R.read_quant(spark, f"{path}/*/*.txt", "featurecounts")
    return found.withColumn("sample_id", F.regexp_replace("sample_id", "^sample=", ""))


NINE = ("seqname", "source", "feature", "start", "stop", "score", "strand", "frame")


@query("s6_read_gtf", "SELECT concat('chr', p_size) AS seqname, p_partkey AS start, p_partkey + 10 AS stop, concat('G', p_partkey) AS gene_id, p_name AS gene_name FROM part")
def _(spark, d):
    line = F.expr("concat_ws('\t', concat('chr', p_size), 'x', 'gene', p_partkey, p_partkey + 10, '.', '+', '.', concat('gene_id \"G', p_partkey, '\"; gene_name \"', p_name, '\";'))")
    rows = R.read_gtf(spark, _text(table(spark, d, "part").select(line), folder(spark, "gtf")))
    return rows.select("seqname", "start", "stop", F.col("attributes")["gene_id"].alias("gene_id"), F.col("attributes")["gene_name"].alias("gene_name"))


@query("s7_read_gff3", "SELECT p_partkey AS start, concat('MI', p_partkey) AS id, p_name AS name FROM part")
def _(spark, d):
    line = F.expr("concat_ws('\t', 'chr1', '.', 'miRNA', p_partkey, p_partkey + 20, '.', '+', '.', concat('ID=MI', p_partkey, ';Name=', p_name))")
    rows = R.read_gff3(spark, _text(table(spark, d, "part").select(line), folder(spark, "gff")))
    return rows.select("start", F.col("attributes")["id"].alias("id"), F.col("attributes")["name"].alias("name"))


@query("s8_s25_bed_round_trip", "SELECT contig, start, stop, CAST(name AS VARCHAR) AS name FROM intervals", "intervals")
def _(spark, d):
    path = folder(spark, "bed")
    S.write_lines(S.bed_lines(view(spark, d, "intervals")), path)
    return R.read_bed(spark, path).select("contig", "start", "stop", "name")


@query("s9_s25_fasta_round_trip", "SELECT concat('d', doc_id, ' x>y') AS name, replace(replace(text, chr(10), ''), '>', ')') AS seq FROM documents WHERE text <> ''")
def _(spark, d):
    path = folder(spark, "fasta")
    seqs = table(spark, d, "documents").where("text <> ''").select(F.expr("concat('d', doc_id, ' x>y')").alias("name"), F.replace("text", F.lit(">"), F.lit(")")).alias("seq"))
    S.write_lines(S.fasta_lines(seqs), path)
    return R.read_fasta(spark, path)


LANES = "SELECT doc_id // 1000 AS lane, row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) - 1 AS ordinal, doc_id, regexp_replace(text, '\\s', '.', 'g') AS s FROM documents"


@query("s10_read_fastq_interleave", f"WITH l AS ({LANES}) SELECT lane, ordinal, 1 AS mate, concat('@r', doc_id) AS name, s AS seq FROM l UNION ALL SELECT lane, ordinal, 2, concat('@r', doc_id), concat('N', s) FROM l")
def _(spark, d):
    found = []
    for mate, start in ((1, ""), (2, "N")):
        seq = F.concat(F.lit(start), F.regexp_replace(F.coalesce("text", F.lit("")), r"\s", "."))
        docs = table(spark, d, "documents").select("doc_id", F.floor(F.col("doc_id") / 1000).alias("lane"), seq.alias("s"))
        record = F.concat_ws("\n", F.concat(F.lit("@r"), F.col("doc_id").cast("string")), "s", F.lit("+"), F.repeat(F.lit("I"), F.length("s"))).alias("value")
        # a compressed file for each lane, as sequencers write them, in order of the ids; the reader numbers its records
        path = folder(spark, "fastq")
        docs.repartition("lane").sortWithinPartitions("lane", "doc_id").select("lane", record).write.partitionBy("lane").option("compression", "gzip").text(path)
        rows = R.read_fastq(spark, f"{path}/*/*.txt.gz")
        found.append(rows.select(F.regexp_extract("file", r"lane=(\d+)", 1).cast("long").alias("lane"), "ordinal", "name", "seq"))
    return R.interleave(*found, ["lane", "ordinal"]).select("lane", "ordinal", "mate", "name", "seq")


@query("s10_interleave_turns", "SELECT conv_id, turn, 1 AS mate FROM conversations WHERE turn % 2 = 0 AND (conv_id, turn + 1) IN (SELECT (conv_id, turn) FROM conversations) UNION ALL SELECT conv_id, turn - 1, 2 FROM conversations WHERE turn % 2 = 1 AND (conv_id, turn - 1) IN (SELECT (conv_id, turn) FROM conversations)")
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn")
    return R.interleave(rows.where("turn % 2 = 0"), rows.where("turn % 2 = 1").withColumn("turn", F.col("turn") - 1), ["conv_id", "turn"])


@query("s11_s23_mtx_round_trip", "SELECT CAST(barcode AS VARCHAR) AS barcode, feature, value FROM cellcounts", "cellcounts")
def _(spark, d):
    path = folder(spark, "mtx")
    S.write_mtx(view(spark, d, "cellcounts"), path)
    return R.read_mtx(spark, path)


@query("s12_read_umi_counts", "SELECT event_type AS gene, CAST(user_id AS VARCHAR) AS cell, count(*) AS count FROM events GROUP BY 1, 2")
def _(spark, d):
    rows = table(spark, d, "events").groupBy(F.col("event_type").alias("gene"), F.col("user_id").alias("cell")).agg(F.count(F.lit(1)).alias("count"))
    return R.read_umi_counts(spark, _tsv(rows, folder(spark, "umi")))


@query("s13_read_vcf", "SELECT CAST(l_suppkey % 10 AS VARCHAR) AS chrom, l_partkey AS pos, concat(l_suppkey % 10, ':', l_partkey) AS key, CAST(l_linenumber AS VARCHAR) AS dp FROM lineitem")
def _(spark, d):
    line = F.expr("concat_ws('\t', concat('chr', l_suppkey % 10), l_partkey, '.', 'A', 'C', '50', 'PASS', concat('DP=', l_linenumber, ';AF=0.5;DB'))")
    path = _text(table(spark, d, "lineitem").select(line), folder(spark, "vcf"))
    _text(spark.range(1).select(F.lit("##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")), f"{path}/head")
    return R.read_vcf(spark, [path, f"{path}/head"]).select("chrom", "pos", "key", F.col("info")["DP"].alias("dp"))


@query("s14_read_taxon_report", "SELECT c_name AS name, c_custkey % 4 AS depth, c_custkey AS clade, 'S' AS rank, round(c_custkey / 100.0, 6) AS fraction FROM customer")
def _(spark, d):
    line = F.expr("concat_ws('\t', lpad(cast(c_custkey / 100.0 as string), 12, ' '), c_custkey, 1, 'S', concat(' ', c_custkey), concat(repeat('  ', cast(c_custkey % 4 as int)), c_name))")
    rows = R.read_taxon_report(spark, _text(table(spark, d, "customer").select(line), folder(spark, "report")))
    return rounded(rows.select("name", "depth", "clade", "rank", "fraction"), "fraction")


@query("s15_read_blocks", "WITH b AS (SELECT doc_id AS doc, unnest(string_split(replace(text, '.' || chr(10), chr(10) || chr(10)), chr(10) || chr(10))) AS body, unnest(range(len(string_split(replace(text, '.' || chr(10), chr(10) || chr(10)), chr(10) || chr(10))))) AS block FROM documents) SELECT doc, block, string_split(body, chr(10))[1] AS title, len(string_split(body, chr(10))) - 1 AS n FROM b")
def _(spark, d):
    text = table(spark, d, "documents").select(F.col("doc_id").alias("doc"), F.replace("text", F.lit(".\n"), F.lit("\n\n")).alias("text"))
    return R.read_blocks(text).select("doc", "block", "title", F.size("rows").alias("n"))


IND = "SELECT c_nationkey AS file, c_custkey AS line, c_custkey % 3 AS depth, c_name AS name, c_acctbal AS count FROM customer"


@query("s16_read_indented", f"""WITH r AS ({IND}), s AS (SELECT *, last_value(CASE WHEN depth = 0 THEN line END IGNORE NULLS) OVER w AS p0, last_value(CASE WHEN depth = 0 THEN name END IGNORE NULLS) OVER w AS n0, last_value(CASE WHEN depth = 1 THEN line END IGNORE NULLS) OVER w AS p1, last_value(CASE WHEN depth = 1 THEN name END IGNORE NULLS) OVER w AS n1 FROM r WINDOW w AS (PARTITION BY file ORDER BY line ROWS UNBOUNDED PRECEDING))
SELECT file, line, n0 AS level1, CASE WHEN depth >= 1 AND p1 > p0 THEN n1 END AS level2, CASE WHEN depth = 2 AND p1 < line AND p1 > p0 THEN name WHEN depth = 2 AND line > p1 THEN name END AS level3, count FROM s""")
def _(spark, d):
    rows = spark.sql(IND.replace("FROM customer", "FROM {customer}"), customer=table(spark, d, "customer"))
    text = rows.select("file", "line", F.expr("concat(repeat('   ', cast(depth as int)), name, '\t', count)").alias("text"))
    return R.read_indented(text, 3)


LINES = "SELECT doc_id AS file, unnest(string_split(text, chr(10))) AS l FROM documents"


def _lines(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("file"), F.explode(F.split("text", "\n")).alias("text"))


@query("s17_extract_fields", f"SELECT file, min(CAST(nullif(regexp_extract(l, '(\\d+)', 1), '') AS BIGINT)) AS low, sum(CAST(nullif(regexp_extract(l, 'License, Version (\\d)', 1), '') AS BIGINT))::BIGINT AS versions FROM ({LINES}) GROUP BY 1")
def _(spark, d):
    return R.extract_fields(_lines(spark, d), [("low", r".*?(\d+)", "bigint", "min", False), ("versions", r".*?License, Version (\d)", "bigint", "sum", False)])[0]


@query("s17_field_violations", f"""WITH c AS (SELECT file, count(*) FILTER (starts_with(l, 'The ')) AS a, count(*) FILTER (regexp_matches(l, '[0-9A-Za-z_]\\.\\z')) AS w, count(*) FILTER (regexp_matches(l, 'License, Version \\d')) AS v FROM ({LINES}) GROUP BY 1)
SELECT file, 'first' AS field, a AS matches FROM c WHERE a > 1 UNION ALL SELECT file, 'words', w FROM c WHERE w <> 1 UNION ALL SELECT file, 'versions', v FROM c WHERE v = 0""")
def _(spark, d):
    specs = [("first", "(The) ", "string", None, False), ("words", r".*?(\w+)\.\z", "string", None, True), ("versions", r".*?License, Version (\d)", "bigint", "sum", True)]
    return R.extract_fields(_lines(spark, d), specs)[1]


@query("s18_aligner_summary", "SELECT o_orderkey AS file, CAST(o_custkey * 10 AS DOUBLE) AS total, o_custkey + o_orderkey % 7 + (o_orderkey % 9) / 2 AS \"unique\", o_custkey % 5 + (o_orderkey % 3) / 2 AS multi, (o_orderkey % 11) / 2 AS unmapped FROM orders")
def _(spark, d):
    rows = table(spark, d, "orders")
    log = F.expr("array(concat(o_custkey * 10, ' reads; of these:'), concat('  ', o_custkey * 10, ' (100.00%) were paired; of these:'), concat('    ', o_custkey, ' (1%) aligned concordantly exactly 1 time'), concat('    ', o_custkey % 5, ' (1%) aligned concordantly >1 times'), concat('      ', o_orderkey % 7, ' (1%) aligned discordantly 1 time'), concat('        ', o_orderkey % 11, ' (1%) aligned 0 times'), concat('        ', o_orderkey % 9, ' (1%) aligned exactly 1 time'), concat('        ', o_orderkey % 3, ' (1%) aligned >1 times'))")
    return R.aligner_summary(rows.select(F.col("o_orderkey").alias("file"), F.explode(log).alias("text")))


LOG = "SELECT page_id AS file, concat('Total read pairs processed: ', 100 + page_id, chr(10), '=== First read: Adapter v1v2 ===', chr(10), 'Trimmed: ', page_id % 30, ' times', chr(10), '=== First read: Adapter its1 ===', chr(10), 'Trimmed: ', page_id % 50, ' times') AS text FROM pages"


@query("s19_region_counts", f"WITH l AS ({LOG}), e AS (SELECT file, unnest(regexp_extract_all(text, 'Adapter (\\w+) ===', 1)) AS region, unnest(regexp_extract_all(text, 'Trimmed: (\\d+) times', 1))::BIGINT AS reads, text FROM l) SELECT file, region, reads FROM e UNION ALL SELECT file, 'unknown', CAST(regexp_extract(any_value(text), 'processed: (\\d+)', 1) AS BIGINT) - sum(reads)::BIGINT FROM e GROUP BY 1")
def _(spark, d):
    logs = spark.sql(LOG.replace("FROM pages", "FROM {pages}"), pages=table(spark, d, "pages"))
    return R.region_counts(logs, r"Adapter (\w+) ===", r"Trimmed: (\d+) times", r"processed: (\d+)")


@query("s20_html_tables", "SELECT page_id, 0 AS tbl, r AS \"row\", c AS col, CASE WHEN r = 0 THEN ['id', 'url'][c + 1] WHEN c = 0 THEN CAST(page_id AS VARCHAR) ELSE url END AS text FROM pages, range(2) AS a(r), range(2) AS b(c)")
def _(spark, d):
    table_html = F.concat(F.lit("<table><tr><th>id</th><th> url </th></tr><tr><td><b>"), F.col("page_id").cast("string"), F.lit("</b></td><td>\n"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</td></tr></table>"))
    pages = table(spark, d, "pages").select("page_id", F.concat("html", table_html).alias("html"))
    return R.html_tables(pages, "page_id", "html")


@query("s20_json_in_element", "SELECT page_id, page_id * 2 AS n FROM pages")
def _(spark, d):
    html = F.concat("html", F.lit('<div class="x" id="data"> {"n": '), (F.col("page_id") * 2).cast("string"), F.lit("} </div>"))
    return table(spark, d, "pages").select("page_id", F.from_json(R.json_in_element(html, "data"), "n bigint")["n"].alias("n"))


@query("s21_reports_json", "SELECT user_id, sum(coalesce(CAST(props->>'k' AS DOUBLE), 0)) AS k, sum(coalesce(CAST(props->>'absent' AS DOUBLE), 0)) AS absent FROM events GROUP BY 1")
def _(spark, d):
    return R.reports_json(table(spark, d, "events"), "props", ["k", "absent"], "user_id")


@query("s24_report_section", """WITH t AS (SELECT sample_id, CAST(sum(value) AS BIGINT) AS total, count(*) AS features FROM counts GROUP BY 1)
SELECT concat('{"id":"counts","section_name":"Counts by sample","categories":["total","features"],"data":{', string_agg(concat('"', sample_id, '":{"total":', total, ',"features":', features, '}'), ',' ORDER BY sample_id), '}}') AS document FROM t""", "counts")
def _(spark, d):
    totals = view(spark, d, "counts").groupBy("sample_id").agg(F.sum("value").cast("long").alias("total"), F.count(F.lit(1)).alias("features"))
    return S.report_section(totals, "counts", "Counts by sample", "sample_id", ["total", "features"])


@query("s26_sample_metadata", "SELECT sample_id, concat('{\"sample_group\":\"', sample_group, '\",\"batch\":\"', batch, '\"}') AS data FROM samples", "samples")
def _(spark, d):
    return S.sample_metadata_table(view(spark, d, "samples"))
