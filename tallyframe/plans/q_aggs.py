"""Queries of the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.joins import join_annotation
from ..operators.normalise import share_of_sample
from .registry import query
from .standins import rounded, table, view

JUNC = "SELECT concat('chr', l_suppkey % 10) AS contig, l_partkey % 50 AS start, l_partkey % 50 + 10 AS stop, l_orderkey % 2 AS strand, l_linenumber AS motif, l_partkey % 2 AS known, l_quantity AS unique_mappers, l_tax AS multi_mappers, l_orderkey % 60 AS overhang FROM lineitem"


def lines(spark, d, sql, name):
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: table(spark, d, name)})


@query("a1_collapse_junctions", f"WITH j AS ({JUNC}) SELECT contig, start, stop, strand, motif, known, sum(unique_mappers) AS unique_mappers, round(sum(multi_mappers), 6) AS multi_mappers, max(overhang) AS max_overhang, count(*) AS samples_detected FROM j GROUP BY ALL")
def _(spark, d):
    return rounded(A.collapse_junctions(lines(spark, d, JUNC, "lineitem")), "multi_mappers")


TX = "SELECT concat('S', l_suppkey % 8) AS sample_id, l_partkey AS transcript_id, sum(l_quantity) AS count, CASE WHEN l_partkey % 11 = 0 THEN 0.0 ELSE sum(l_discount) END AS abundance, CAST(100 + l_partkey % 900 AS DOUBLE) AS length FROM lineitem GROUP BY concat('S', l_suppkey % 8), l_partkey"


@query("a2_summarize_to_gene", f"WITH t AS ({TX}) SELECT sample_id, gene AS gene_id, sum(count) AS count, round(sum(abundance), 6) AS abundance, round(CASE WHEN sum(abundance) > 0 THEN sum(t.length * abundance) / sum(abundance) ELSE avg(t.length) END, 4) AS length FROM t JOIN features ON transcript_id = feature_id GROUP BY 1, 2", "features")
def _(spark, d):
    genes = view(spark, d, "features").select(F.col("feature_id").alias("transcript_id"), F.col("gene").alias("gene_id"))
    return rounded(rounded(A.summarize_to_gene(lines(spark, d, TX, "lineitem"), genes), "abundance"), "length", digits=4)


@query("a3_counts_from_abundance", f"""WITH t AS ({TX}), m AS (SELECT *, avg(length) OVER (PARTITION BY transcript_id) AS ml FROM t)
SELECT sample_id, transcript_id AS feature_id, round(abundance * sum(count) OVER (PARTITION BY sample_id) / sum(abundance) OVER (PARTITION BY sample_id), 5) AS scaled, round(abundance * ml * sum(count) OVER (PARTITION BY sample_id) / sum(abundance * ml) OVER (PARTITION BY sample_id), 5) AS length_scaled FROM m""")
def _(spark, d):
    tx = lines(spark, d, TX, "lineitem").withColumnRenamed("transcript_id", "feature_id")
    both = A.counts_from_abundance(A.counts_from_abundance(tx, "lengthScaledTPM").withColumnRenamed("scaled", "length_scaled"))
    return rounded(both, "scaled", "length_scaled", digits=5).select("sample_id", "feature_id", "scaled", "length_scaled")


A4 = """WITH s AS (SELECT sample_id, biotype, sum(value) AS value FROM counts JOIN features USING (feature_id) GROUP BY 1, 2), p AS (SELECT *, value / sum(value) OVER (PARTITION BY sample_id) AS share FROM s),
k AS (SELECT biotype FROM p GROUP BY 1 HAVING count(*) FILTER (share >= 0.165) > floor((SELECT count(DISTINCT sample_id) FROM counts) * 0.5))
SELECT sample_id, CASE WHEN biotype IN (SELECT biotype FROM k) THEN biotype ELSE 'other' END AS biotype, sum(value) AS value FROM p GROUP BY 1, 2"""


@query("a4_biotype_totals", A4, "counts features")
def biotype_totals(spark, d):
    return A.biotype_totals(view(spark, d, "counts"), view(spark, d, "features"), 0.165)


@query("entry_biotype_shares", f"WITH t AS ({A4}) SELECT sample_id, biotype, value, round(value / sum(value) OVER (PARTITION BY sample_id), 6) AS share FROM t", "counts features")
def biotype_shares(spark, d):
    """The flagship: annotation join, totals by biotype with a remainder, shares of each sample."""
    annotated = join_annotation(view(spark, d, "counts"), view(spark, d, "features").select("feature_id", "biotype"), "feature_id")
    return rounded(share_of_sample(A.biotype_totals(annotated.drop("biotype"), view(spark, d, "features"), 0.165)), "share")


@query("a5_top_features", "WITH t AS (SELECT feature_id FROM counts GROUP BY 1 ORDER BY sum(value) DESC, feature_id LIMIT 10) SELECT sample_id, CASE WHEN feature_id IN (SELECT feature_id FROM t) THEN CAST(feature_id AS VARCHAR) ELSE 'other' END AS feature, sum(value) AS value FROM counts GROUP BY 1, 2", "counts")
def _(spark, d):
    return A.top_features(view(spark, d, "counts"))


@query("a6_top_mean_percent", "WITH p AS (SELECT feature_id, 100 * value / sum(value) OVER (PARTITION BY sample_id) AS p FROM counts) SELECT feature_id, round(avg(p), 6) AS mean_percent FROM p GROUP BY 1 ORDER BY round(avg(p), 9) DESC, feature_id LIMIT 10", "counts")
def _(spark, d):
    return rounded(A.top_mean_percent(view(spark, d, "counts")), "mean_percent")


@query("a7_pivot_counts", "SELECT p_brand, " + ", ".join(f"coalesce(round(avg(p_retailprice) FILTER (p_type = '{t}'), 6), 0) AS {t}" for t in ("PROMO", "SMALL", "LARGE")) + " FROM part GROUP BY 1")
def _(spark, d):
    rows = table(spark, d, "part").withColumnRenamed("p_retailprice", "value")
    return rounded(A.pivot_counts(rows, "p_brand", "p_type", ["PROMO", "SMALL", "LARGE"]), "PROMO", "SMALL", "LARGE")


@query("a8_fractional_counts", "WITH s AS (SELECT n_chars, CASE WHEN doc_id % 7 = 0 THEN ['no-annotation'] ELSE list_distinct([source, lang, CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'x' END]) END AS a FROM documents), e AS (SELECT n_chars / len(a) AS share, n_chars AS whole, unnest(a) AS feature FROM s) SELECT feature, round(sum(share), 4) AS value, CAST(sum(whole) AS DOUBLE) AS whole FROM e GROUP BY 1")
def _(spark, d):
    found = F.array("source", "lang", F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("x"))
    seqs = table(spark, d, "documents").select(F.col("n_chars").alias("count"), F.when(F.col("doc_id") % 7 == 0, F.array(F.lit(""))).otherwise(found).alias("annotations"))
    return rounded(A.fractional_counts(seqs), "value", digits=4).join(A.fractional_counts(seqs, split=False).withColumnRenamed("value", "whole"), "feature")


READS = "SELECT l_orderkey * 10 + l_linenumber AS name, concat('chr', l_suppkey % 10) AS contig, datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS start, datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 2 AS stop, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand, l_quantity AS quality FROM lineitem"


def reads(spark, d):
    return lines(spark, d, READS.replace("datediff('day',", "datediff(DAY,"), "lineitem")


EXONS = "SELECT concat('g', name % 400) AS gene, contig, start, stop, strand, class FROM intervals"


def exons(spark, d):
    return view(spark, d, "intervals").withColumn("gene", F.concat(F.lit("g"), (F.col("name") % 400).cast("string")))


@query("a9_assign_reads", f"WITH r AS ({READS}), e AS ({EXONS}), h AS (SELECT r.name, count(DISTINCT gene) AS n, min(gene) AS gene FROM r JOIN e ON r.contig = e.contig AND r.start < e.stop AND e.start < r.stop AND r.strand = e.strand GROUP BY 1) SELECT gene, count(*) AS reads FROM h WHERE n = 1 GROUP BY 1", "intervals")
def _(spark, d):
    return A.assign_reads(reads(spark, d), exons(spark, d), stranded=1)


@query("a10_umi_count", "SELECT barcode, feature, count(DISTINCT umi) AS n FROM cells GROUP BY 1, 2", "cells")
def _(spark, d):
    return A.umi_count(view(spark, d, "cells"))


@query("a11_collapse_reads", "SELECT text AS seq, count(*) AS n FROM documents GROUP BY 1")
def _(spark, d):
    return A.collapse_reads(table(spark, d, "documents").select(F.col("text").alias("seq")))


@query("a12_mark_duplicates", f"WITH r AS ({READS}) SELECT name, row_number() OVER (PARTITION BY contig, start, strand ORDER BY quality DESC, name) > 1 AS duplicate FROM r")
def _(spark, d):
    return A.mark_duplicates(reads(spark, d)).select("name", "duplicate")


@query("a13_spike_counts", "SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def _(spark, d):
    return A.count_by(table(spark, d, "documents"), "source", "lang")


DEPTH = "SELECT concat('chr', l_suppkey % 10) AS contig, l_partkey AS pos, CAST(l_partkey % 7 * l_partkey * count(*) AS BIGINT) AS depth FROM lineitem GROUP BY concat('chr', l_suppkey % 10), l_partkey"


@query("a14_depth_stats", f"WITH d AS ({DEPTH}) SELECT contig, round(avg(depth), 6) AS mean, quantile_cont(depth, 0.5) AS median, min(depth) AS min, max(depth) AS max, round(avg(CASE WHEN depth >= 100 THEN 1.0 ELSE 0 END), 6) AS share_100, count(*) FILTER (depth = 0) AS depth_0, " + ", ".join(f"count(*) FILTER (depth > {a} AND depth <= {b}) AS depth_{b}" for a, b in ((0, 10), (10, 100), (100, 1000), (1000, 2000), (2000, 10000))) + ", count(*) FILTER (depth > 10000) AS depth_more FROM d GROUP BY 1")
def _(spark, d):
    return rounded(A.depth_stats(lines(spark, d, DEPTH, "lineitem")), "mean", "share_100")


@query("a15_qc_per_cell", "SELECT barcode, sum(value) AS total, count(DISTINCT feature) AS n_features, round(100 * sum(CASE WHEN feature = 'error' THEN value ELSE 0 END) / sum(value), 6) AS pct_mt FROM cellcounts GROUP BY 1", "cellcounts")
def _(spark, d):
    return rounded(A.qc_per_cell(view(spark, d, "cellcounts"), F.col("feature") == "error"), "pct_mt")


@query("a16_tax_glom", "SELECT sample_id, genus, sum(value) AS value, string_agg(DISTINCT CAST(feature_id AS VARCHAR), '_' ORDER BY CAST(feature_id AS VARCHAR)) AS origin FROM otus GROUP BY 1, 2", "otus")
def _(spark, d):
    return A.tax_glom(view(spark, d, "otus"), "genus")


@query("a17_merge_reports", "SELECT p_brand AS tax_id, sum(value) AS value FROM counts JOIN part ON feature_id = p_partkey GROUP BY 1", "counts")
def _(spark, d):
    reports = view(spark, d, "counts").join(table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), F.col("p_brand").alias("tax_id")), "feature_id")
    return A.merge_reports(reports)


@query("a18_clade_rollup", "SELECT level1, level2, level3, round(sum(value), 2) AS value FROM taxa GROUP BY ROLLUP (level1, level2, level3)", "taxa")
def _(spark, d):
    return rounded(A.clade_rollup(view(spark, d, "taxa"), ["level1", "level2", "level3"]), "value", digits=2)


@query("a19_nearest_level", "SELECT arg_min(length, (abs(length - 777), length)) AS nearest FROM features", "features")
def _(spark, d):
    return A.nearest_level(view(spark, d, "features"), "length", 777)


RANKS = "SELECT c_name AS sample_id, substr('SGFOCPKUXY', CAST(o_orderkey % 10 + 1 AS INTEGER), 1) AS rank FROM orders JOIN customer ON o_custkey = c_custkey"


@query("a19_first_level", f"WITH r AS ({RANKS}) SELECT sample_id, arg_min(rank, strpos('SGFOCPKU', rank)) AS level FROM r WHERE strpos('SGFOCPKU', rank) > 0 GROUP BY 1")
def _(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return A.first_level(rows.select(F.col("c_name").alias("sample_id"), F.expr("substr('SGFOCPKUXY', CAST(o_orderkey % 10 + 1 AS INT), 1)").alias("rank")))


NEW = "SELECT CASE WHEN p_size < 30 THEN concat('New', p_brand) ELSE concat('G', p_partkey) END AS key, p_partkey AS line, 100 + p_size AS length, p_retailprice AS gc, p_name AS name, CASE WHEN p_partkey % 100 < 45 + p_size THEN 'protein_coding' WHEN p_partkey % 2 = 0 THEN 'lncRNA' ELSE 'miRNA' END AS biotype FROM part"


@query("a20_collapse_groups", f"""WITH g AS ({NEW}), n AS (SELECT * FROM g WHERE starts_with(key, 'New')), v AS (SELECT key, biotype, count(*) AS v FROM n GROUP BY 1, 2), s AS (SELECT *, v / sum(v) OVER (PARTITION BY key) AS share FROM v),
w AS (SELECT key, max(biotype) FILTER (share > 0.7 OR (biotype = 'protein_coding' AND share >= 0.5)) AS winner FROM s GROUP BY 1)
SELECT key, max(length) AS length, round(avg(gc), 6) AS gc, CASE WHEN count(DISTINCT name) = 1 THEN min(name) ELSE string_agg(name, ';' ORDER BY line) END AS name, coalesce(any_value(w.winner), string_agg(biotype, ';' ORDER BY line)) AS biotype FROM n JOIN w USING (key) GROUP BY key
UNION ALL SELECT key, length, round(gc, 6), name, biotype FROM g WHERE NOT starts_with(key, 'New')""")
def _(spark, d):
    return rounded(A.collapse_groups(lines(spark, d, NEW, "part"), "key", "New"), "gc")


QC = "SELECT o_custkey AS sample, o_orderpriority AS check, CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'P' THEN 'WARN' ELSE 'PASS' END AS status, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 5 END AS reads FROM orders"


@query("a22_combine_qc", f"WITH q AS ({QC}) SELECT sample, check, CASE max(CASE status WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS status, CAST(sum(reads) AS BIGINT) AS reads, min(reads) <> max(reads) AS mismatch FROM q GROUP BY 1, 2".replace("check,", '"check",').replace("AS check", 'AS "check"'))
def _(spark, d):
    return A.combine_qc(lines(spark, d, QC.replace("AS check", "AS `check`"), "orders"), "sample")


SHARES = "b AS (SELECT contig, pos, base, count(*) AS n, any_value(ref) AS ref FROM pileup {w} GROUP BY 1, 2, 3), s AS (SELECT *, sum(n) OVER (PARTITION BY contig, pos) AS depth FROM b)"


@query("a23_allele_counts", """WITH s AS (SELECT contig, pos, base, count(*) AS n, any_value(ref) AS ref FROM pileup GROUP BY 1, 2, 3), a AS (SELECT contig, pos, arg_max(base, (n, base)) AS alt, max(n) AS an FROM s WHERE base <> ref GROUP BY 1, 2), t AS (SELECT contig, pos, sum(n) AS depth FROM s GROUP BY 1, 2),
c AS (SELECT contig, pos, alt FROM t JOIN a USING (contig, pos) WHERE depth >= 20 AND least(an / depth, 1 - an / depth) >= 0.1)
SELECT barcode, p.contig, p.pos, alt, count(*) FILTER (base = ref) AS ref_n, count(*) FILTER (base = alt) AS alt_n, count(*) FILTER (base <> ref AND base <> alt) AS other_n FROM pileup p JOIN c ON c.contig = p.contig AND c.pos = p.pos GROUP BY 1, 2, 3, 4""", "pileup")
def _(spark, d):
    return A.allele_counts(view(spark, d, "pileup"))


@query("a24_consensus", "WITH " + SHARES.format(w="") + " SELECT contig, pos, CASE WHEN max(depth) >= 10 AND max(n) >= 0.6 * max(depth) THEN arg_max(base, (n, base)) ELSE 'N' END AS base FROM s GROUP BY 1, 2", "pileup")
def _(spark, d):
    return A.consensus(view(spark, d, "pileup"), 0.6)


@query("a25_call_variants", "WITH " + SHARES.format(w="WHERE qual >= 20") + " SELECT contig, concat(ref, pos, base) AS variant, round(n / depth, 6) AS frequency FROM s WHERE base <> ref AND base <> '' AND depth >= 10 AND n / depth >= 0.25", "pileup")
def _(spark, d):
    return rounded(A.call_variants(view(spark, d, "pileup")), "frequency")


@query("a26_nuclear_fraction", "SELECT user_id AS barcode, round(sum(CASE WHEN event_type IN ('view', 'click') THEN value ELSE 0 END) / nullif(sum(CASE WHEN event_type IN ('view', 'click', 'error') THEN value ELSE 0 END), 0), 6) AS nuclear_fraction FROM events GROUP BY 1")
def _(spark, d):
    layer = F.when(F.col("event_type").isin("view", "click"), "unspliced").when(F.col("event_type") == "error", "spliced")
    return rounded(A.nuclear_fraction(table(spark, d, "events").select(F.col("user_id").alias("barcode"), layer.alias("layer"), "value")), "nuclear_fraction")


@query("a27_histogram", "SELECT CASE WHEN l_extendedprice < 10000 THEN 0 WHEN l_extendedprice >= 90000 THEN 21 ELSE CAST(floor((l_extendedprice - 10000) / 4000.0) AS BIGINT) + 1 END AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, d):
    return A.histogram(table(spark, d, "lineitem"), "l_extendedprice", 10000.0, 90000.0, 20)


@query("a28_read_distribution", f"WITH r AS ({READS}), e AS ({EXONS}), h AS (SELECT r.name, min(list_position(['P', 'O', 'F'], e.class)) AS k FROM r JOIN e ON r.contig = e.contig AND r.start < e.stop AND e.start < r.stop GROUP BY 1) SELECT coalesce(['P', 'O', 'F'][k], 'intergenic') AS class, count(*) AS reads FROM r LEFT JOIN h USING (name) GROUP BY 1", "intervals")
def _(spark, d):
    return A.read_distribution(reads(spark, d), exons(spark, d), ["P", "O", "F"])


@query("a29_saturation", "WITH f AS (SELECT l_partkey, min(l_orderkey % 10) AS first FROM lineitem GROUP BY 1), e AS (SELECT unnest(range(first + 1, 11)) AS step FROM f) SELECT step, count(*) AS n FROM e GROUP BY 1")
def _(spark, d):
    return A.saturation(table(spark, d, "lineitem"), "l_orderkey", "l_partkey")


TAXREADS = "SELECT user_id AS file, CASE WHEN event_id % 17 = 0 THEN 'Phage x' WHEN event_id % 13 = 0 THEN 'plasmid' ELSE event_type END AS taxon FROM events"


@query("a30_taxon_summary", f"""WITH t AS ({TAXREADS}), p AS (SELECT file, taxon, count(*) AS n FROM t GROUP BY 1, 2), r AS (SELECT *, sum(n) OVER (PARTITION BY file) AS total, coalesce(sum(n) OVER (PARTITION BY file ORDER BY n DESC, taxon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, row_number() OVER (PARTITION BY file ORDER BY n DESC, taxon) AS k FROM p)
SELECT file, max(taxon) FILTER (k = 1) AS best, CAST(floor(max(n * 1000 / total) FILTER (k = 1) + 0.5) AS BIGINT) AS per_mille, count(*) FILTER (before < 0.9 * total) AS covering, count(*) FILTER (regexp_matches(taxon, '(?i)plasmid|phage')) AS special FROM r GROUP BY 1""")
def _(spark, d):
    return A.taxon_summary(lines(spark, d, TAXREADS, "events"))


@query("a31_sample_groups", "WITH s AS (SELECT s_name AS sample_id, concat('n', s_nationkey % 5, ', m', s_suppkey % 3) AS g FROM supplier), e AS (SELECT unnest(regexp_split_to_array(g, '\\s*,\\s*')) AS grp, sample_id FROM s UNION ALL SELECT 'all_samples', sample_id FROM s) SELECT grp, array_to_string(list_sort(list_distinct(list(sample_id))), '|') AS samples FROM e GROUP BY 1")
def _(spark, d):
    rows = table(spark, d, "supplier").select(F.col("s_name").alias("sample_id"), F.expr("concat('n', s_nationkey % 5, ', m', s_suppkey % 3)").alias("g"))
    return A.sample_groups(rows, "g").withColumn("samples", F.array_join("samples", "|"))


@query("a32_psi", "WITH i AS (SELECT concat('S', l_suppkey % 8) AS sample_id, concat('mir', l_partkey % 40, ';v', l_linenumber) AS name, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2) SELECT sample_id, name, round(value / sum(value) OVER (PARTITION BY sample_id, split_part(name, ';', 1)), 6) AS psi FROM i")
def _(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.expr("concat('S', l_suppkey % 8)").alias("sample_id"), F.expr("concat('mir', l_partkey % 40, ';v', l_linenumber)").alias("name")).agg(F.sum("l_quantity").alias("value"))
    return rounded(A.psi(rows), "psi").select("sample_id", "name", "psi")
