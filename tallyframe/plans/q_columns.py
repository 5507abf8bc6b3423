"""Queries of the projections, column rules and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import filters as Q
from ..operators.draws import draw_sql
from .registry import query
from .standins import rounded, table, view

GTF = "SELECT CASE WHEN p_partkey % 10 = 0 THEN 'MT' ELSE concat('chr', p_partkey % 10) END AS seqname, CASE WHEN p_partkey % 2 = 0 THEN 'gene' ELSE 'transcript' END AS feature, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'protein_coding' ELSE lower(p_type) END AS gene_biotype, concat('G', p_partkey) AS gene_id, concat('T', p_partkey) AS transcript_id, p_size AS version, p_partkey AS start, p_partkey + 50 * p_size AS stop, p_name AS gene_name FROM part"


def _gtf(spark, d):
    return spark.sql(GTF.replace("FROM part", "FROM {part}"), part=table(spark, d, "part"))


@query("p1_feature_table", f"WITH g AS ({GTF}) SELECT gene_id, seqname AS chrom, gene_biotype, version, start, stop, gene_name FROM g WHERE feature = 'gene'")
def _(spark, d):
    return C.feature_table(_gtf(spark, d), "gene", ["transcript_id"])


@query("p2_p3_p4_feature_rules", f"""WITH g AS ({GTF}) SELECT gene_id, CASE WHEN seqname = 'MT' AND gene_biotype = 'protein_coding' THEN 'Mt_protein_coding' ELSE gene_biotype END AS biotype,
concat(gene_id, '.', version) AS versioned, stop - start AS length FROM g""")
def _(spark, d):
    c = F.col
    return _gtf(spark, d).select("gene_id", C.relabel_mito(c("seqname"), c("gene_biotype")).alias("biotype"), C.versioned_id(c("gene_id"), c("version")).alias("versioned"), C.feature_length(c("start"), c("stop")).alias("length"))


@query("p5_drop_blacklisted", "SELECT p_partkey, p_name, p_type FROM part")
def _(spark, d):
    return C.drop_blacklisted(table(spark, d, "part"), ["P_BRAND", "p_Size", "p_retailprice", "absent"])


@query("p6_drop_empty_columns", "SELECT c_custkey, c_name, round(c_acctbal / 3, 2) AS third, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS segment FROM customer")
def _(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", (F.col("c_acctbal") / 3).alias("third"), F.when(F.col("c_custkey") % 3 == 0, "NA").otherwise(F.col("c_mktsegment")).alias("segment"), F.lit("nan").alias("gone"), F.lit("").alias("blank"))
    return C.drop_empty_columns(rows)


@query("p7_drop_duplicate_columns", "SELECT l_orderkey * 10 + l_linenumber AS k, l_quantity AS a, l_returnflag AS b, l_tax AS e FROM lineitem")
def _(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.col("l_quantity").alias("a"), F.col("l_returnflag").alias("b"), F.col("l_quantity").alias("c"), F.concat("l_returnflag", F.lit("")).alias("d"), F.col("l_tax").alias("e"))
    return C.drop_duplicate_columns(rows, "k")


@query("p8_gene_flags", "SELECT p_partkey, starts_with(n, 'mt-') AS mt, starts_with(n, 'rps') OR starts_with(n, 'rpl') AS ribo, regexp_matches(n, '^hb[^(p)]') AS hb FROM (SELECT p_partkey, lower(concat(CASE p_partkey % 5 WHEN 0 THEN 'MT-' WHEN 1 THEN 'Rps' WHEN 2 THEN 'HBa' WHEN 3 THEN 'hbp' ELSE '' END, p_name)) AS n FROM part)")
def _(spark, d):
    prefix = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'MT-' WHEN 1 THEN 'Rps' WHEN 2 THEN 'HBa' WHEN 3 THEN 'hbp' ELSE '' END")
    return table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in C.gene_flags(F.concat(prefix, "p_name")).items()])


ANNOT = """SELECT doc_id, concat(CASE doc_id % 11 WHEN 0 THEN 'hsa-miR-' WHEN 1 THEN 'piR-' WHEN 2 THEN 'tRNA-Ala-AGC-' WHEN 3 THEN 'rRNA|' WHEN 4 THEN 'let-7 ' WHEN 5 THEN 'outlet ' WHEN 6 THEN 'tRNA-Leu-TAAx' WHEN 7 THEN 'tRNA-Lys-TT1'
WHEN 8 THEN 'a-(2)b ' WHEN 9 THEN 'a(b)c ' ELSE 'x ' END, source, CASE doc_id % 7 WHEN 0 THEN ' (1-22)' WHEN 1 THEN '-(3)' WHEN 2 THEN '(A->G)' WHEN 3 THEN ' (u) (v' WHEN 4 THEN ' (1-2)-(3)' WHEN 5 THEN ' (p) (A->G)' ELSE '' END) AS name FROM documents"""


def _annot(spark, d):
    return spark.sql(ANNOT.replace("FROM documents", "FROM {documents}"), documents=table(spark, d, "documents"))


@query("p9_p10_p12_annotation_names", rf"""WITH a AS ({ANNOT}), p AS (SELECT *, regexp_replace(regexp_replace(name, '\s\(\d+-\d+\)$', ''), '-\(\d+\)$', '') AS plain FROM a),
c AS (SELECT *, CASE WHEN contains(plain, 'miR') THEN plain ELSE regexp_replace(plain, '\(.*->.*\)$', '') END AS short, regexp_replace(plain, '\(.*->.*\)$', '') AS shorter FROM p)
SELECT doc_id, CASE WHEN contains(name, 'miR') OR starts_with(name, 'let') THEN 'miRNA' WHEN contains(name, 'piR') THEN 'piRNA' WHEN contains(name, 'tRNA') OR contains(name, 'tRF') OR contains(name, '-tR') THEN 'tRNA' WHEN contains(name, '|') THEN split_part(name, '|', 1) ELSE 'unknown' END AS class,
CASE WHEN contains(name, '|') AND NOT (contains(name, 'miR') OR starts_with(name, 'let') OR contains(name, 'piR') OR contains(name, 'tRNA') OR contains(name, 'tRF') OR contains(name, '-tR')) THEN split_part(name, '|', 2) ELSE name END AS feature,
CASE WHEN contains(name, 'tRNA') AND regexp_matches(short, 'tRNA-\w{{3}}-\w{{3}}') THEN regexp_extract(short, '^.*(tRNA-\w{{3}}-\w{{3}})', 1) ELSE short END AS cleaned, shorter AS simplified,
trim(CASE WHEN regexp_matches(name, '\(.*\)') THEN regexp_extract(name, '^(.*)\(.*\)', 1) ELSE name END) AS base FROM c""")
def _(spark, d):
    n = F.col("name")
    return _annot(spark, d).select("doc_id", C.feature_class(n).alias("class"), C.feature_name(n).alias("feature"), C.clean_annotation(n).alias("cleaned"), C.clean_annotation(n, False, True).alias("simplified"), C.base_name(n).alias("base"))


@query("p11_rewrite_header", f"WITH a AS ({ANNOT}) SELECT doc_id, concat('Spike|', replace(replace(concat(name, '_', doc_id), '|', '::'), '_', '')) AS header FROM a")
def _(spark, d):
    return _annot(spark, d).select("doc_id", C.rewrite_header(F.concat("name", F.lit("_"), F.col("doc_id").cast("string")), "Spike").alias("header"))


@query("p13_barcode_postfix", "SELECT event_id, concat('B', user_id, '-', coalesce(s_name, CAST(event_id % 8 + 1 AS VARCHAR))) AS sample, concat('B', user_id) AS trimmed FROM events LEFT JOIN supplier ON s_suppkey = event_id % 8 AND s_suppkey < 6")
def _(spark, d):
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("B"), F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 8 + 1).cast("string")).alias("barcode"))
    numbers = table(spark, d, "supplier").where("s_suppkey < 6").select((F.col("s_suppkey") + 1).alias("number"), F.col("s_name").alias("sample_id"))
    named = C.barcode_postfix(rows, "sample", numbers).withColumnRenamed("barcode", "sample")
    return named.join(C.barcode_postfix(rows, "trimmed").withColumnRenamed("barcode", "trimmed"), "event_id")


@query("p14_strand_from_coords", "SELECT o_orderkey, CASE WHEN o_custkey < o_orderkey THEN '+' WHEN o_custkey > o_orderkey THEN '-' END AS strand, least(o_custkey, o_orderkey) AS start, greatest(o_custkey, o_orderkey) AS stop FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in C.strand_from_coords(F.col("o_custkey"), F.col("o_orderkey")).items()])


@query("p15_read_strand", """WITH f AS (SELECT event_id, event_id % 256 AS f FROM events), m AS (SELECT *, CASE WHEN f & 1 = 0 THEN 1 ELSE (f & 64) // 64 + 2 * ((f & 128) // 128) END AS mate, (f & 16) // 16 AS rev FROM f)
SELECT event_id, CASE WHEN mate IN (1, 2) THEN CASE WHEN (CASE WHEN mate <> 1 THEN 1 - rev ELSE rev END) = 1 THEN '-' ELSE '+' END END AS first, CASE WHEN mate IN (1, 2) THEN CASE WHEN (CASE WHEN mate <> 2 THEN 1 - rev ELSE rev END) = 1 THEN '-' ELSE '+' END END AS second FROM m""")
def _(spark, d):
    flag = F.col("event_id") % 256
    return table(spark, d, "events").select("event_id", C.read_strand(flag).alias("first"), C.read_strand(flag, 2).alias("second"))


SEQ = "SELECT doc_id AS name, upper(regexp_replace(lower(text), '[^acgtn]', '', 'g')) AS seq FROM documents"


def seqs(spark, d):
    """Documents as sequences of the letters that nucleotides use."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("name"), F.upper(F.regexp_replace(F.lower("text"), "[^acgtn]", "")).alias("seq"))


@query("p16_p17_sequence_columns", f"""WITH s AS ({SEQ}) SELECT name, length(seq) - length(ltrim(seq, 'N')) AS leading, length(seq) - length(rtrim(seq, 'N')) AS trailing, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS rc, translate(replace(seq, 'T', 'U'), 'Uu', 'Tt') AS dna,
round(100.0 * length(regexp_replace(seq, '[^GCgc]', '', 'g')) / nullif(length(seq), 0), 6) AS gc FROM s""")
def _(spark, d):
    s = F.col("seq")
    edge = C.edge_run(s)
    return rounded(seqs(spark, d).select("name", edge["leading"].alias("leading"), edge["trailing"].alias("trailing"), C.reverse_complement(s).alias("rc"), C.to_dna(F.replace(s, F.lit("T"), F.lit("U"))).alias("dna"), C.gc_percent(s).alias("gc")), "gc")


LINEAGE = "SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 'Unassigned' ELSE concat('D_0__', lang, ';D_1__', source, '; g__', CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'g' END) END AS lineage FROM documents"


@query("p18_split_lineage", f"WITH l AS ({LINEAGE}), p AS (SELECT doc_id, lineage, regexp_split_to_array(lineage, '\\s*;\\s*') AS parts FROM l) SELECT doc_id, " + ", ".join(f"CASE WHEN lineage <> 'Unassigned' THEN nullif(regexp_replace(parts[{k}], '^(D_[0-9]+__|[a-z]__)', ''), '') END AS {r}" for k, r in enumerate(("kingdom", "phylum", "genus"), 1)) + " FROM p")
def _(spark, d):
    rows = spark.sql(LINEAGE.replace("FROM documents", "FROM {documents}"), documents=table(spark, d, "documents"))
    return rows.select("doc_id", *[c.alias(n) for n, c in C.split_lineage(F.col("lineage"), ["kingdom", "phylum", "genus"]).items()])


@query("p19_assembly_paths", "SELECT page_id, regexp_extract(u, '([^/]+)/?$', 1) AS base, concat(regexp_replace(u, '/$', ''), '/', regexp_extract(u, '([^/]+)/?$', 1), '_genomic.fna.gz') AS genome, concat(regexp_replace(u, '/$', ''), '/', regexp_extract(u, '([^/]+)/?$', 1), '_genomic.gff.gz') AS annotation, replace(lower(concat('Genus Sp', page_id)), ' ', '_') AS species FROM (SELECT page_id, url AS u FROM pages)")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", *[c.alias(n) for n, c in C.assembly_paths(F.col("url"), F.concat(F.lit("Genus Sp"), F.col("page_id").cast("string"))).items()])


@query("p20_flag_qc", "SELECT o_orderkey, CASE WHEN v IS NULL THEN 'MISSING' WHEN v >= 400000 THEN 'PASS' WHEN v >= 200000 THEN 'WARN' ELSE 'FAIL' END AS qc FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v FROM orders)")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.flag_qc(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")), 400000, 200000).alias("qc"))


@query("p21_fill_forward", "SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events")
def _(spark, d):
    rows = table(spark, d, "events").withColumn("x", F.when(F.col("event_id") % 3 == 0, F.col("event_type")))
    return C.fill_forward(rows, "x", "user_id", "event_id", "filled").select("event_id", "filled")


@query("p22_clean_names", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda w: concat(upper(w[1]), lower(w[2:]))), ' ') END AS clean FROM part")
def _(spark, d):
    name = F.concat(F.lit(" "), F.replace(F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name")), F.lit(" "), F.lit("_")), F.lit(" "))
    return table(spark, d, "part").select("p_partkey", C.clean_names(name).alias("clean"))


@query("p23_tile", "SELECT doc_id AS name, k + 1 AS tile, substr(text, k * 500 + 1, 500) AS seq FROM (SELECT doc_id, text, unnest(range((length(text) + 499) // 500)) AS k FROM documents)")
def _(spark, d):
    return C.tile(table(spark, d, "documents").select(F.col("doc_id").alias("name"), F.col("text").alias("seq")), 500)


@query("p24_side_from_suffix", "SELECT n, CASE WHEN n LIKE '%R' THEN '-' ELSE '+' END AS strand, CASE WHEN lower(n) LIKE '%\\_left%' ESCAPE '\\' THEN 'forward' WHEN lower(n) LIKE '%\\_right%' ESCAPE '\\' THEN 'reverse' END AS side FROM (SELECT concat(l_orderkey, '_', l_linenumber, CASE l_orderkey % 4 WHEN 0 THEN '_LEFT' WHEN 1 THEN '_right' WHEN 2 THEN '_R' ELSE '_F' END) AS n FROM lineitem)")
def _(spark, d):
    n = F.concat_ws("_", F.col("l_orderkey").cast("string"), F.concat(F.col("l_linenumber").cast("string"), F.expr("CASE l_orderkey % 4 WHEN 0 THEN '_LEFT' WHEN 1 THEN '_right' WHEN 2 THEN '_R' ELSE '_F' END")))
    rows = table(spark, d, "lineitem").select(n.alias("n"))
    return rows.select("n", *[c.alias(k) for k, c in C.side_from_suffix(F.col("n")).items()])


@query("p25_mask_intervals", """WITH s AS (SELECT doc_id AS name, text AS seq FROM documents), v AS (SELECT s.name, start, stop FROM (SELECT o_orderkey % 1000 AS name, o_custkey % 50 AS start, o_custkey % 50 + 1 + o_orderkey % 9 AS stop FROM orders) v JOIN s USING (name)),
p AS (SELECT name, seq, unnest(range(length(seq))) AS i FROM s), m AS (SELECT DISTINCT name, unnest(range(start, stop)) AS i FROM v)
SELECT p.name, string_agg(CASE WHEN m.i IS NULL THEN substr(seq, p.i + 1, 1) ELSE 'N' END, '' ORDER BY p.i) AS seq FROM p LEFT JOIN m ON m.name = p.name AND m.i = p.i GROUP BY 1""")
def _(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("name"), F.col("text").alias("seq"))
    spans = table(spark, d, "orders").select((F.col("o_orderkey") % 1000).alias("name"), (F.col("o_custkey") % 50).alias("start"), (F.col("o_custkey") % 50 + 1 + F.col("o_orderkey") % 9).alias("stop"))
    return C.mask_intervals(rows, spans)


@query("p26_append_attributes", f"WITH g AS ({GTF}) SELECT gene_id, CASE WHEN feature = 'transcript' THEN 'gene' ELSE 'keep' END AS feature, 'ERCC' AS gene_biotype, 'ERCC' AS transcript_biotype, gene_name FROM g")
def _(spark, d):
    rows = _gtf(spark, d).select("gene_id", F.when(F.col("feature") == "transcript", "exon").otherwise("keep").alias("feature"), F.create_map(F.lit("gene_name"), "gene_name", F.lit("gene_biotype"), "gene_biotype").alias("attributes"))
    return C.append_attributes(rows, "ERCC", True).select("gene_id", "feature", *[F.col("attributes")[k].alias(k) for k in ("gene_biotype", "transcript_biotype", "gene_name")])


@query("p27_lookup_rows", "SELECT n_name AS species, r_name AS assembly, 'plants' AS division FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, d):
    rows = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("species"), F.col("r_name").alias("assembly"))
    return C.lookup_rows(rows, "plants")


@query("m23_dereplicate", "SELECT DISTINCT lang AS domain, text AS seq FROM documents WHERE length(text) >= CASE lang WHEN 'en' THEN 900 WHEN 'fr' THEN 1200 ELSE 1400 END")
def _(spark, d):
    docs = table(spark, d, "documents").select(F.col("lang").alias("domain"), F.col("text").alias("seq"))
    floors = docs.select("domain").distinct().withColumn("floor", F.expr("CASE domain WHEN 'en' THEN 900 WHEN 'fr' THEN 1200 ELSE 1400 END"))
    return C.dereplicate(docs, floors)


@query("m24_extract_region", f"WITH s AS ({SEQ}) SELECT name, nullif(regexp_extract(seq, 'A[AG]T(.*?)[ACGT]G[CT]', 1), '') AS region FROM s")
def _(spark, d):
    return seqs(spark, d).select("name", C.extract_region(F.col("seq"), C.iupac_regex("ART"), C.iupac_regex("NGY")).alias("region"))


@query("m25_demultiplex", f"""WITH s AS ({SEQ}), p AS (SELECT name, seq AS r1, reverse(seq) AS r2 FROM s)
SELECT name, CASE WHEN regexp_matches(r1, '^(?:[AG]T)') AND regexp_matches(r2, '^(?:[ACGT])') THEN 'v1' WHEN regexp_matches(r1, '^(?:A)') AND regexp_matches(r2, '^(?:[CT])') THEN 'v2' ELSE 'unknown' END AS region,
CASE WHEN regexp_matches(r1, '^(?:[AG]T)') AND regexp_matches(r2, '^(?:[ACGT])') THEN regexp_replace(r1, '^(?:[AG]T)', '') WHEN regexp_matches(r1, '^(?:A)') AND regexp_matches(r2, '^(?:[CT])') THEN regexp_replace(r1, '^(?:A)', '') ELSE r1 END AS trimmed_1 FROM p""")
def _(spark, d):
    pairs = seqs(spark, d).select("name", F.col("seq").alias("r1")).withColumn("r2", F.reverse("r1"))
    primers = [("v1", C.iupac_regex("RT"), C.iupac_regex("N")), ("v2", "A", C.iupac_regex("Y"))]
    return C.demultiplex(pairs, primers).select("name", "region", "trimmed_1")


PROBS = "SELECT user_id AS barcode, CASE WHEN event_type IN ('click', 'error') THEN concat(event_type, '+x') ELSE event_type END AS donor, sum(value) / sum(sum(value)) OVER (PARTITION BY user_id) * 3 AS p FROM events GROUP BY user_id, event_type"


@query("m26_posterior_call", f"""WITH p AS ({PROBS}), b AS (SELECT barcode, max(p) AS p, arg_min(donor, (-p, donor)) AS donor, arg_min(donor, (-p, donor)) FILTER (donor NOT LIKE '%+%') AS best_singlet FROM p GROUP BY 1)
SELECT barcode, CASE WHEN p <= 0.9 THEN 'unassigned' WHEN donor LIKE '%+%' THEN 'doublet' ELSE donor END AS call, best_singlet FROM b""")
def _(spark, d):
    return C.posterior_call(spark.sql(PROBS.replace("FROM events", "FROM {events}"), events=table(spark, d, "events")))


@query("m27_normalise_calls", "SELECT event_id, CASE event_type WHEN 'click' THEN 'singlet' WHEN 'view' THEN 'singlet' WHEN 'error' THEN 'doublet' ELSE 'unassigned' END AS call FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_id", C.normalise_call(F.col("event_type"), {"click": "singlet", "view": "singlet", "error": "doublet"}).alias("call"))


# filters


JUNCTIONS = "SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_quantity AS BIGINT) AS unique_mappers, l_partkey % 60 AS max_overhang, l_suppkey % 12 AS samples_detected FROM lineitem"


def _junctions(spark, d):
    return spark.sql(JUNCTIONS.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, d, "lineitem"))


@query("f1_filter_junctions", f"WITH j AS ({JUNCTIONS}) SELECT * FROM j WHERE unique_mappers > 3 AND max_overhang > 10 AND samples_detected > floor((SELECT max(samples_detected) FROM j) * 0.2)")
def _(spark, d):
    return Q.filter_junctions(_junctions(spark, d), 3, 10, 0.2)


@query("f1_junction_criteria", f"WITH j AS ({JUNCTIONS}) SELECT count(*) AS total, count(*) FILTER (unique_mappers > 3) AS unique_ok, count(*) FILTER (max_overhang > 10) AS overhang_ok, count(*) FILTER (samples_detected > 2) AS samples_ok FROM j")
def _(spark, d):
    return Q.junction_criteria(_junctions(spark, d), 3, 10, 2)


@query("f2_filter_low_features", "SELECT * FROM counts WHERE feature_id IN (SELECT feature_id FROM counts GROUP BY 1 HAVING count(*) FILTER (value >= 120) >= 3)", "counts")
def _(spark, d):
    return Q.filter_low_features(view(spark, d, "counts"), 120, 3)


@query("f3_filter_total", "SELECT * FROM counts WHERE feature_id IN (SELECT feature_id FROM counts GROUP BY 1 HAVING sum(value) > 800)", "counts")
def _(spark, d):
    return Q.filter_total(view(spark, d, "counts"), 800)


@query("f4_filter_cpm", "WITH c AS (SELECT *, value / sum(value) OVER (PARTITION BY sample_id) * 1e6 AS cpm FROM counts) SELECT * FROM counts WHERE feature_id IN (SELECT feature_id FROM c GROUP BY 1 HAVING count(*) FILTER (cpm > 500) >= 5)", "counts")
def _(spark, d):
    return Q.filter_cpm(view(spark, d, "counts"), 500, 5)


@query("f5_filter_cells", """WITH a AS (SELECT * FROM cellcounts WHERE barcode IN (SELECT barcode FROM cellcounts WHERE value > 0 GROUP BY 1 HAVING count(DISTINCT feature) >= 4)),
b AS (SELECT * FROM a WHERE feature IN (SELECT feature FROM a WHERE value > 0 GROUP BY 1 HAVING count(DISTINCT barcode) >= 5))
SELECT * FROM b WHERE barcode IN (SELECT barcode FROM b GROUP BY 1 HAVING 100 * sum(CASE WHEN feature = 'error' THEN value ELSE 0 END) / sum(value) < 22 AND sum(value) > 55 AND sum(value) < 80)""", "cellcounts")
def _(spark, d):
    cells = view(spark, d, "cellcounts")
    return Q.filter_cells(cells, cells.select("feature").distinct().withColumn("mt", F.col("feature") == "error"), 4, 5, 22, 55, 80)


@query("f6_drop_zero", "WITH a AS (SELECT * FROM cellcounts WHERE barcode IN (SELECT barcode FROM cellcounts GROUP BY 1 HAVING sum(value) > 60)) SELECT * FROM a WHERE feature IN (SELECT feature FROM a GROUP BY 1 HAVING sum(value) > 60)", "cellcounts")
def _(spark, d):
    return Q.drop_zero(view(spark, d, "cellcounts"), 60)


@query("f7_filter_taxonomy", "SELECT doc_id, taxon, confidence FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'D_0__Bacteria' WHEN 1 THEN concat('k__B;p__', source) WHEN 2 THEN 'k__B;p__x;CHLOROPLAST' ELSE concat('k__B;p__', lang) END AS taxon, (doc_id % 100) / 100.0 AS confidence FROM documents) WHERE confidence >= 0.7 AND NOT regexp_matches(taxon, '(?i)chloroplast|mitochondria') AND taxon LIKE '%;%'")
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.expr("CASE doc_id % 5 WHEN 0 THEN 'D_0__Bacteria' WHEN 1 THEN concat('k__B;p__', source) WHEN 2 THEN 'k__B;p__x;CHLOROPLAST' ELSE concat('k__B;p__', lang) END").alias("taxon"), ((F.col("doc_id") % 100) / 100.0).alias("confidence"))
    return Q.filter_taxonomy(rows, 0.7)


@query("f8_filter_table", """WITH a AS (SELECT * FROM counts WHERE sample_id IN (SELECT sample_id FROM counts WHERE value > 0 GROUP BY 1 HAVING sum(value) >= 1000 AND count(*) >= 10)),
b AS (SELECT * FROM a WHERE feature_id IN (SELECT feature_id FROM a WHERE value > 0 GROUP BY 1 HAVING sum(value) >= 500 AND count(*) >= 6))
SELECT * FROM b WHERE feature_id IN (SELECT feature_id FROM features WHERE biotype <> 'PROMO') AND feature_id NOT IN (SELECT feature_id FROM features WHERE gene = 'Brand#1')""", "counts features")
def _(spark, d):
    f = view(spark, d, "features")
    return Q.filter_table(view(spark, d, "counts"), 1000, 10, 500, 6, f.where("biotype <> 'PROMO'").select("feature_id"), f.where("gene = 'Brand#1'").select("feature_id"))


@query("f9_filter_abundance", """WITH k AS (SELECT * FROM otus WHERE feature_id IN (SELECT feature_id FROM otus GROUP BY 1 HAVING count(*) FILTER (value > 5) > 0.25 * (SELECT count(DISTINCT sample_id) FROM otus)))
SELECT * FROM k WHERE phylum IN (SELECT phylum FROM k GROUP BY 1 ORDER BY sum(value) DESC, phylum LIMIT 3)""", "otus")
def _(spark, d):
    return Q.filter_abundance(view(spark, d, "otus"), 5, 0.25, 3)


@query("f10_require_taxa", "SELECT * FROM taxa WHERE level1 = 'ASIA' AND level3 <> 'MACHINERY' AND value > 0", "taxa")
def _(spark, d):
    return Q.require_taxa(view(spark, d, "taxa"), {"level1": "ASIA"}, {"level3": "MACHINERY"})


@query("f11_min_group_total", "SELECT * FROM taxa WHERE level2 IN (SELECT level2 FROM taxa GROUP BY 1 HAVING sum(value) > 150000000)", "taxa")
def _(spark, d):
    return Q.min_group_total(view(spark, d, "taxa"), "level2", 150000000)


@query("f12_var_filter", """WITH s AS (SELECT feature_id, sum(value) AS total, var_samp(value) AS variance FROM counts GROUP BY 1), k AS (SELECT * FROM s WHERE total > (SELECT quantile_cont(total, 0.1) FROM s) AND variance IS NOT NULL)
SELECT feature_id, total, round(variance, 6) AS variance FROM k ORDER BY round(k.variance, 9) DESC, feature_id LIMIT (SELECT greatest(3, CAST(floor(count(*) * 0.5) AS BIGINT)) FROM k)""", "counts")
def _(spark, d):
    return rounded(Q.var_filter(view(spark, d, "counts")), "variance")


@query("f13_filter_low_var", """WITH m AS (SELECT feature_id, avg(value) AS m, quantile_cont(value, 0.5) AS median FROM counts GROUP BY 1 HAVING avg(value) > 5),
k AS (SELECT feature_id, quantile_cont(abs(value - median), 0.5) AS mad FROM counts JOIN m USING (feature_id) GROUP BY 1) SELECT feature_id, round(mad, 6) AS mad FROM k WHERE mad >= (SELECT quantile_cont(mad, 0.75) FROM k)""", "counts")
def _(spark, d):
    return rounded(Q.filter_low_var(view(spark, d, "counts"), 0.25), "mad")


@query("f14_length_cutoff", """WITH l AS (SELECT sample_id, feature_id, length + feature_id % 3 AS length FROM counts JOIN features USING (feature_id))
SELECT * FROM l WHERE feature_id NOT IN (SELECT feature_id FROM l GROUP BY 1 HAVING count(*) FILTER (length <= 800) > (SELECT count(DISTINCT sample_id) FROM l) / 2)""", "counts features")
def _(spark, d):
    rows = view(spark, d, "counts").join(view(spark, d, "features"), "feature_id").select("sample_id", "feature_id", (F.col("length") + F.col("feature_id") % 3).alias("length"))
    return Q.length_cutoff(rows, 800)


ALN = "SELECT event_id, event_type AS contig, (event_id * 37) % 4096 AS flag, event_id % 60 AS mapq FROM events"


def _aln(spark, d):
    return spark.sql(ALN.replace("FROM events", "FROM {events}"), events=table(spark, d, "events"))


@query("f15_filter_host_reads", f"WITH a AS ({ALN}) SELECT *, CASE WHEN flag & 4 <> 0 THEN 'unmapped' ELSE 'target' END AS class FROM a WHERE flag & 2304 = 0 AND (flag & 4 <> 0 OR contig = 'view')")
def _(spark, d):
    return Q.filter_host_reads(_aln(spark, d), "view")


@query("f15_host_summary", f"WITH a AS ({ALN}), c AS (SELECT CASE WHEN flag & 4 <> 0 THEN 'unmapped' WHEN contig = 'view' THEN 'target' ELSE 'host' END AS class, count(*) AS n FROM a WHERE flag & 2304 = 0 GROUP BY 1) SELECT class, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM c")
def _(spark, d):
    return rounded(Q.host_summary(_aln(spark, d), "view"), "percent")


@query("f16_filter_flags", f"WITH a AS ({ALN}) SELECT * FROM a WHERE mapq >= 10 AND flag & 3844 = 0")
def _(spark, d):
    return Q.filter_flags(_aln(spark, d))


@query("f17_filter_residual", """WITH p AS (SELECT doc_id, substr(text, 1, length(text) // 2) AS r1, substr(text, length(text) // 2 + 1) AS r2 FROM documents), a AS (SELECT text AS adapter FROM benchmark UNION SELECT unnest(regexp_extract_all(text, '[a-z]{12,}')) FROM benchmark)
SELECT doc_id FROM p WHERE NOT EXISTS (SELECT 1 FROM a WHERE contains(r1, adapter) OR (length(r1) >= 10 AND contains(adapter, right(r1, 10))) OR contains(r2, adapter) OR (length(r2) >= 10 AND contains(adapter, right(r2, 10))))""")
def _(spark, d):
    bench, half = table(spark, d, "benchmark"), F.floor(F.length("text") / 2).cast("int")
    words = F.explode(F.regexp_extract_all("text", F.lit("[a-z]{12,}"), F.lit(0)))
    adapters = bench.select(F.col("text").alias("adapter")).union(bench.select(words)).distinct()
    pairs = table(spark, d, "documents").select("doc_id", F.substr("text", F.lit(1), half).alias("r1"), F.substr("text", half + 1, F.length("text")).alias("r2"))
    return Q.filter_residual(pairs, adapters, "doc_id").select("doc_id")


@query("f18_grep_headers", "SELECT p_partkey, p_name AS name FROM part WHERE NOT regexp_matches(p_name, '(?i)(?:RED)|(?:sm.ll)')")
def _(spark, d):
    return Q.grep_headers(table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name")), ["RED", "sm.ll"], invert=True)


VCF = "SELECT concat(l_suppkey, ':', l_linenumber) AS key, l_discount * 10 AS af, l_orderkey AS id FROM lineitem"


@query("f19_filter_vcf_af", f"WITH v AS ({VCF}) SELECT key, id, round(af, 6) AS af FROM v WHERE key IN (SELECT key FROM v WHERE af > 0.95)")
def _(spark, d):
    return rounded(Q.filter_vcf_af(spark.sql(VCF.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, d, "lineitem")), 0.95), "af")


@query("f20_keep_common_contigs", "SELECT name, pos, CAST(regexp_extract(contig, '\\d+') AS VARCHAR) AS contig FROM positions WHERE contig IN ('chr1', 'chr2', 'chr3')", "positions")
def _(spark, d):
    nations = table(spark, d, "nation").where("n_nationkey between 1 and 3").select(F.col("n_nationkey").cast("string").alias("contig"))
    return Q.keep_common_contigs(view(spark, d, "positions").select("name", "pos", "contig"), nations)


@query("f21_subset", "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' OR o_orderpriority = '5-LOW') AND NOT o_orderpriority = '1-URGENT'")
def _(spark, d):
    return Q.subset(table(spark, d, "orders"), ["o_orderstatus::F", "o_orderpriority::5-LOW", "o_orderpriority::!1-URGENT"]).select("o_orderkey")


@query("f22_subsample_every", "SELECT conv_id, turn FROM conversations WHERE conv_id % 4 = 0")
def _(spark, d):
    return Q.subsample_every(table(spark, d, "conversations"), "conv_id", 4).select("conv_id", "turn")


DRAW = "md5(concat('{s}:', {k}))"


@query("f22_subsample_reads", f"SELECT conv_id, turn FROM conversations WHERE substr({DRAW.format(s=0, k='conv_id')}, 1, 8) < '66666666'")
def _(spark, d):
    return Q.subsample_reads(table(spark, d, "conversations"), "conv_id", 0.4).select("conv_id", "turn")


@query("f22_subsample_number", f"SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT conv_id FROM (SELECT DISTINCT conv_id, {DRAW.format(s=7, k='conv_id')} AS m FROM conversations) ORDER BY m LIMIT 25)")
def _(spark, d):
    return Q.subsample_reads(table(spark, d, "conversations"), "conv_id", n=25, seed=7).select("conv_id", "turn")


@query("f22_subsample_then_head", f"SELECT conv_id, turn FROM conversations WHERE conv_id IN (SELECT DISTINCT conv_id FROM conversations WHERE substr({DRAW.format(s=0, k='conv_id')}, 1, 8) < '66666666' ORDER BY conv_id LIMIT 20)")
def _(spark, d):
    return Q.subsample_reads(table(spark, d, "conversations"), "conv_id", 0.4, 20).select("conv_id", "turn")


LEAST = "(SELECT min({total: t, name: sample_id}) FROM (SELECT sample_id, sum(value) AS t FROM otus GROUP BY 1))"


@query("f23_downsample_counts", f"""WITH {draw_sql("SELECT sample_id, feature_id, value FROM otus", f"SELECT DISTINCT sample_id, 0 AS run, {LEAST}.total AS depth FROM otus WHERE sample_id <> {LEAST}.name", replace=True)}
SELECT sample_id, feature_id, CAST(drawn AS DOUBLE) AS value FROM drawn UNION ALL SELECT sample_id, feature_id, value FROM otus WHERE sample_id = {LEAST}.name""", "otus")
def _(spark, d):
    return Q.downsample_counts(view(spark, d, "otus").select("sample_id", "feature_id", "value"))


@query("f24_trim_reads", f"""WITH s AS ({SEQ}), t AS (SELECT name, name % 40 AS qual, substr(seq, 6) AS seq FROM s), c AS (SELECT *, CASE WHEN length(seq) > 1 THEN len(list_filter(range(1, length(seq)), lambda i: seq[i] <> seq[i + 1])) / (length(seq) - 1) ELSE 0 END AS complexity FROM t WHERE length(seq) >= 30 AND qual >= 10)
SELECT name, qual, seq, round(complexity, 6) AS complexity FROM c WHERE complexity >= 0.6""")
def _(spark, d):
    return rounded(Q.trim_reads(seqs(spark, d).withColumn("qual", F.col("name") % 40), 5, 30, 10, 0.6), "complexity").select("name", "qual", "seq", "complexity")


ASM = "SELECT p_brand AS species, concat('GCF_', p_partkey) AS accession, CASE WHEN p_brand < 'Brand#15' AND p_size = 7 THEN 'reference genome' WHEN p_brand < 'Brand#20' AND p_size = 8 THEN 'representative genome' ELSE 'na' END AS category FROM part WHERE p_size < 12"


@query("f25_select_assembly", f"""WITH a AS ({ASM}), r AS (SELECT *, CASE category WHEN 'reference genome' THEN 1 WHEN 'representative genome' THEN 2 ELSE 3 END AS k FROM a), b AS (SELECT *, min(k) OVER (PARTITION BY species) AS best FROM r)
SELECT species, CASE WHEN min(k) = 3 THEN string_agg(DISTINCT accession, ',' ORDER BY accession) ELSE min(accession) END AS accession FROM b WHERE k = best GROUP BY 1""")
def _(spark, d):
    return Q.select_assembly(spark.sql(ASM.replace("FROM part", "FROM {part}"), part=table(spark, d, "part")))


@query("f27_marker_list", "SELECT DISTINCT feature_id FROM features WHERE regexp_matches(name, '(?i)^RED') OR regexp_matches(biotype, '(?i)promo')", "features")
def _(spark, d):
    return Q.marker_list(view(spark, d, "features"), "RED", "promo")


@query("f28_significant", "SELECT feature_id, padj, lfc, name FROM (SELECT p_partkey AS feature_id, CASE WHEN p_partkey % 7 > 0 THEN p_size / 50.0 END AS padj, p_retailprice / 1000 - 1 AS lfc, CASE WHEN p_partkey % 5 = 0 THEN concat('MT-', p_name) ELSE p_name END AS name FROM part) WHERE padj < 0.5 AND abs(lfc) > 0.05 AND NOT starts_with(name, 'MT-')")
def _(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("feature_id"), F.when(F.col("p_partkey") % 7 > 0, F.col("p_size") / 50.0).alias("padj"), (F.col("p_retailprice") / 1000 - 1).alias("lfc"), F.when(F.col("p_partkey") % 5 == 0, F.concat(F.lit("MT-"), "p_name")).otherwise(F.col("p_name")).alias("name"))
    return Q.significant(rows, 0.5, 0.05)


@query("f29_filter_detected", "SELECT * FROM otus WHERE feature_id IN (SELECT feature_id FROM otus GROUP BY 1 HAVING count(*) FILTER (value > 6) > (SELECT greatest(1, CAST(round_even(count(DISTINCT sample_id) * 0.3, 0) AS BIGINT)) FROM otus))", "otus")
def _(spark, d):
    return Q.filter_detected(view(spark, d, "otus"), 6, 0.3)
