"""Queries of the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from .registry import query
from .standins import rounded, table, view


@query("j1_join_annotation", "SELECT sample_id, feature_id, value, name, biotype, gene, length FROM counts LEFT JOIN features USING (feature_id)", "counts features")
def _(spark, d):
    return J.join_annotation(view(spark, d, "counts"), view(spark, d, "features"), "feature_id")


@query("j2_remap_ids", "SELECT p_partkey, p_name, coalesce(c, p_name) AS mapped FROM part LEFT JOIN (SELECT p_name AS member, concat('New', min(p_brand)) AS c FROM part WHERE p_size < 10 GROUP BY p_name) ON p_name = member")
def _(spark, d):
    part = table(spark, d, "part")
    clusters = part.where("p_size < 10").groupBy("p_name").agg(F.concat(F.lit("New"), F.min("p_brand")).alias("cluster")).groupBy("cluster").agg(F.collect_list("p_name").alias("members"))
    return J.remap_ids(part.select("p_partkey", "p_name"), clusters, "p_name")


@query("j3_align_samples", "SELECT sample_id, feature_id, value, sample_group, batch FROM counts JOIN samples USING (sample_id)", "counts samples")
def _(spark, d):
    return J.align_samples(view(spark, d, "counts"), view(spark, d, "samples"))


@query("j4_align_features", "SELECT sample_id, c.feature_id, value, name, f.feature_id IS NULL AS missing FROM counts c LEFT JOIN (SELECT * FROM features WHERE biotype <> 'PROMO') f ON c.feature_id = f.feature_id", "counts features")
def _(spark, d):
    return J.align_features(view(spark, d, "counts"), view(spark, d, "features").where("biotype <> 'PROMO'").select("feature_id", "name"))


@query("j5_complete_grid", "SELECT s.sample_id, f.feature_id, coalesce(value, 0) AS value FROM (SELECT DISTINCT sample_id FROM counts) s CROSS JOIN (SELECT DISTINCT feature_id FROM counts) f LEFT JOIN counts c ON c.sample_id = s.sample_id AND c.feature_id = f.feature_id", "counts")
def _(spark, d):
    return J.complete_grid(view(spark, d, "counts")).select("sample_id", "feature_id", "value")


@query("j6_merge_calls", "SELECT barcode, " + ", ".join(f"coalesce(max(call) FILTER (caller = {k}), 'unassigned') AS caller_{k}" for k in range(3)) + " FROM calls GROUP BY 1", "calls")
def _(spark, d):
    return J.merge_calls(view(spark, d, "calls"), [0, 1, 2])


@query("j7_attach_one_to_one", "SELECT o_orderkey, o_custkey, c_name AS c_name_info, c_mktsegment AS c_mktsegment_info FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(spark, d):
    info = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.attach_one_to_one(table(spark, d, "orders").select("o_orderkey", "o_custkey"), info, "o_custkey", "_info")


@query("j8_semi_join_list", "SELECT o_orderkey, o_custkey, 'in' AS side FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000) UNION ALL SELECT o_orderkey, o_custkey, 'out' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    keys = table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    kept = J.semi_join_list(rows, keys, "o_custkey").withColumn("side", F.lit("in"))
    return kept.unionByName(J.semi_join_list(rows, keys, "o_custkey", invert=True).withColumn("side", F.lit("out"))).select("o_orderkey", "o_custkey", "side")


@query("f26_keep_listed", "SELECT p_partkey, p_name FROM part WHERE p_brand IN (SELECT concat('Brand#', n_nationkey) FROM nation WHERE n_regionkey = 1)")
def _(spark, d):
    keys = table(spark, d, "nation").where("n_regionkey = 1").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("p_brand"))
    return J.semi_join_list(table(spark, d, "part").select("p_partkey", "p_name", "p_brand"), keys, "p_brand").select("p_partkey", "p_name")


@query("j9_overlap_join", "SELECT a.name AS a_name, b.name AS b_name, least(a.stop, b.stop) - greatest(a.start, b.start) AS overlap FROM intervals a JOIN intervals b ON a.contig = b.contig AND a.start < b.stop AND b.start < a.stop AND least(a.stop, b.stop) - greatest(a.start, b.start) >= 2 WHERE a.strand = '+' AND b.strand = '-'", "intervals")
def _(spark, d):
    rows = view(spark, d, "intervals").drop("class")
    return J.overlap_join(rows.where("strand = '+'").drop("strand"), rows.where("strand = '-'").drop("strand"), 16, 2).select("a_name", "b_name", "overlap")


@query("j10_point_in_interval", "SELECT p.name, i.name AS i_name FROM positions p JOIN intervals i ON p.contig = i.contig AND p.pos >= start AND p.pos < stop WHERE i.class = 'P'", "positions intervals")
def _(spark, d):
    rows = view(spark, d, "intervals").where("class = 'P'").drop("class", "strand")
    return J.point_in_interval(view(spark, d, "positions").drop("qual"), rows, 16).select("name", "i_name")


@query("j10_cluster_sizes", "SELECT name, count(*) OVER (PARTITION BY contig ORDER BY pos RANGE BETWEEN 35 PRECEDING AND 35 FOLLOWING) AS near FROM positions", "positions")
def _(spark, d):
    return J.cluster_sizes(view(spark, d, "positions"), 35).select("name", "near")


@query("j11_contains_join", "SELECT doc_id AS read_id, probe FROM documents JOIN (SELECT DISTINCT text AS probe FROM benchmark UNION SELECT unnest(regexp_extract_all(text, '[a-z]{12,}')) FROM benchmark) ON contains(documents.text, probe)")
def _(spark, d):
    reads, bench = table(spark, d, "documents").select(F.col("doc_id").alias("read_id"), "text"), table(spark, d, "benchmark")
    panel = bench.select(F.col("text").alias("probe")).union(bench.select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{12,}"), F.lit(0)))))
    return J.contains_join(reads, panel)


@query("j12_ngram_screen", """WITH m AS (SELECT DISTINCT doc_id, substr(text, i, 40) AS k FROM (SELECT doc_id, text, unnest(range(1, length(text) - 38)) AS i FROM documents WHERE length(text) >= 40)),
t AS (SELECT DISTINCT item_id, substr(text, i, 40) AS k FROM (SELECT item_id, text, unnest(range(1, length(text) - 38)) AS i FROM benchmark WHERE length(text) >= 40))
SELECT item_id AS panel_id, count(DISTINCT doc_id) AS hits, round(count(DISTINCT doc_id) / (SELECT count(*) FROM documents), 6) AS share FROM m JOIN t USING (k) GROUP BY 1""")
def _(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("read_id"), "text")
    return rounded(J.ngram_screen(docs, table(spark, d, "benchmark").select(F.col("item_id").alias("panel_id"), "text"), 40), "share")


@query("j13_pairwise_self", "SELECT x.sample_id AS a, y.sample_id AS b, x.feature_id, x.value AS x, y.value AS y FROM counts x JOIN counts y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id", "counts")
def _(spark, d):
    return J.pairwise_self(view(spark, d, "counts"))


@query("j14_cross_expand", "SELECT p_partkey, concat(p_name, t) AS name FROM part, (SELECT unnest(['AA', 'AC', 'AG', 'AT']) AS t)")
def _(spark, d):
    rows = J.cross_expand(table(spark, d, "part").select("p_partkey", "p_name"), ["AA", "AC", "AG", "AT"])
    return rows.select("p_partkey", F.concat("p_name", "tag").alias("name"))


@query("j15_positional_align", "SELECT coalesce(a.feature_id, b.feature_id) AS feature_id, a.value AS s0, b.value AS s1 FROM (SELECT * FROM counts WHERE sample_id = 'S0') a FULL JOIN (SELECT * FROM counts WHERE sample_id = 'S1') b ON a.feature_id = b.feature_id", "counts")
def _(spark, d):
    one = lambda s: view(spark, d, "counts").where(f"sample_id = '{s.upper()}'").select("feature_id", F.col("value").alias(s))
    return J.positional_align(one("s0"), one("s1"), "feature_id")


@query("j16_lookup_exons", "SELECT concat('G', o_custkey) AS gene, string_agg(o_orderpriority, '' ORDER BY o_orderkey) AS sequence FROM orders GROUP BY 1")
def _(spark, d):
    orders = table(spark, d, "orders").withColumn("contig", F.concat(F.lit("c"), (F.col("o_custkey") % 7).cast("string")))
    exons = orders.select(F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("gene"), "contig", (F.col("o_orderkey") + 1).alias("start"), (F.col("o_orderkey") + 9).alias("stop"))
    return J.lookup_exons(exons, orders.select("contig", F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 9).alias("stop"), F.col("o_orderpriority").alias("seq")))


@query("j17_knn", """WITH s AS (SELECT q.vec_id, v.vec_id AS neighbour, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS similarity FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(similarity, 9) DESC, neighbour) AS rank FROM s)
SELECT vec_id, neighbour, round(similarity, 6) AS similarity, rank FROM r WHERE rank <= 5""")
def _(spark, d):
    vectors = table(spark, d, "embeddings")
    return rounded(J.knn(vectors.where("vec_id % 20 = 0"), vectors, 5), "similarity")


@query("j17_neighbour_graph")
def _(spark, d):
    from ..operators.neighbours import neighbour_graph, neighbour_lists

    return rounded(neighbour_graph(neighbour_lists(table(spark, d, "embeddings"), 15)), "weight")


@query("j18_merge_layers", "SELECT a.sample_id, a.feature_id, a.value AS spliced, b.v AS unspliced FROM counts a JOIN (SELECT concat('S', l_suppkey % 8) AS sample_id, l_partkey AS feature_id, CAST(count(*) AS DOUBLE) AS v FROM lineitem WHERE l_linenumber > 3 GROUP BY 1, 2) b ON a.sample_id = b.sample_id AND a.feature_id = b.feature_id", "counts")
def _(spark, d):
    other = table(spark, d, "lineitem").where("l_linenumber > 3").groupBy(F.concat(F.lit("S"), (F.col("l_suppkey") % 8).cast("string")).alias("sample_id"), F.col("l_partkey").alias("feature_id")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return J.merge_layers(view(spark, d, "counts"), other, ["sample_id", "feature_id"], ("spliced", "unspliced"))


FILES = "SELECT concat('run/', event_type, user_id % 40, '_R', event_id % 3, '.fastq.gz') AS path, user_id % 9 AS size FROM events"


@query("j19_manifest", f"""WITH f AS ({FILES}), p AS (SELECT path, regexp_extract(path, '([^/]+)_R([12])', 1) AS sample, regexp_extract(path, '([^/]+)_R([12])', 2) AS mate FROM f WHERE size > 0)
SELECT sample, min(path) FILTER (mate = '1') AS forward, min(path) FILTER (mate = '2') AS reverse FROM p WHERE sample <> '' GROUP BY 1 HAVING min(path) FILTER (mate = '1') IS NOT NULL AND min(path) FILTER (mate = '2') IS NOT NULL""")
def _(spark, d):
    return J.manifest(spark.sql(FILES.replace("FROM events", "FROM {events}"), events=table(spark, d, "events")), "([^/]+)_R([12])")


@query("j8_missing_ids", "SELECT DISTINCT p_brand FROM part WHERE p_brand NOT IN (SELECT concat('Brand#', n_nationkey) FROM nation WHERE n_regionkey < 3)")
def _(spark, d):
    keys = table(spark, d, "nation").where("n_regionkey < 3").select(F.concat(F.lit("Brand#"), F.col("n_nationkey").cast("string")).alias("p_brand"))
    return J.check_keys(table(spark, d, "part"), keys, "p_brand")
