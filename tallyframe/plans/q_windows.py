"""Queries of windows, orders and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import normalise as N
from ..operators import windows as W
from .registry import query
from .standins import rounded, table, view


@query("w1_share_of_sample", "SELECT sample_id, feature_id, value, round(value / sum(value) OVER (PARTITION BY sample_id) * 1e6, 6) AS share FROM counts", "counts")
def _(spark, d):
    return rounded(N.share_of_sample(view(spark, d, "counts"), 1e6), "share")


@query("w2_cumulative_share", "WITH r AS (SELECT sample_id, feature_id AS key, value, sum(value) OVER (PARTITION BY sample_id) AS total, coalesce(sum(value) OVER (PARTITION BY sample_id ORDER BY value DESC, feature_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counts) SELECT sample_id, key, value FROM r WHERE before < 0.9 * total", "counts")
def _(spark, d):
    return W.cumulative_share(view(spark, d, "counts").withColumnRenamed("feature_id", "key"), "sample_id")


@query("w3_depth_profile", """WITH e AS (SELECT contig, start AS pos, 1 AS d FROM intervals UNION ALL SELECT contig, stop, -1 FROM intervals), s AS (SELECT contig, pos, sum(d) AS d FROM e GROUP BY 1, 2),
r AS (SELECT contig, pos AS start, lead(pos) OVER w AS stop, sum(d) OVER (PARTITION BY contig ORDER BY pos ROWS UNBOUNDED PRECEDING) AS depth FROM s WINDOW w AS (PARTITION BY contig ORDER BY pos)) SELECT contig, start, stop, CAST(depth AS BIGINT) AS depth FROM r WHERE stop IS NOT NULL""", "intervals")
def _(spark, d):
    return W.depth_profile(view(spark, d, "intervals"))


@query("w4_number_rows", "SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) AS number FROM supplier")
def _(spark, d):
    return W.number_rows(table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey")


@query("w5_unique_names", "SELECT p_partkey, CASE WHEN k = 1 THEN p_name ELSE concat(p_name, '_', k - 1) END AS unique_name FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)")
def _(spark, d):
    return W.unique_names(table(spark, d, "part"), "p_name", "p_partkey").select("p_partkey", "unique_name")


@query("w6_dominant_feature", "SELECT sample_id, arg_min(feature_id, (-value, feature_id)) AS feature_id, round(100 * max(value) / sum(value), 6) AS percent FROM counts GROUP BY 1", "counts")
def _(spark, d):
    return rounded(W.dominant_feature(view(spark, d, "counts")), "percent")


@query("w7_first_differences", "SELECT event_id, round(difference, 6) AS difference FROM (SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS difference FROM events) WHERE difference IS NOT NULL")
def _(spark, d):
    return rounded(W.first_differences(table(spark, d, "events"), "user_id", "event_id"), "difference").select("event_id", "difference")


@query("w8_first_distances", """WITH s AS (SELECT n_regionkey AS subject, n_nationkey AS state, concat('S', n_nationkey % 8) AS sample_id FROM nation), p AS (SELECT *, lag(sample_id) OVER (PARTITION BY subject ORDER BY state) AS previous FROM s),
e AS (SELECT x.sample_id AS a, y.sample_id AS b, sqrt(sum(pow(x.value - y.value, 2))) AS distance FROM counts x JOIN counts y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id GROUP BY 1, 2)
SELECT subject, state, sample_id, round(distance, 6) AS distance FROM p JOIN e ON a = least(sample_id, previous) AND b = greatest(sample_id, previous) WHERE previous IS NOT NULL""", "counts")
def _(spark, d):
    states = table(spark, d, "nation").select(F.col("n_regionkey").alias("subject"), F.col("n_nationkey").alias("state"), F.expr("concat('S', n_nationkey % 8)").alias("sample_id"))
    return rounded(W.first_distances(states, N.euclidean(view(spark, d, "counts"))), "distance")


@query("w9_bh_adjust", """WITH p AS (SELECT l_returnflag AS grp, l_partkey AS id, CASE WHEN l_partkey % 9 > 0 THEN round(avg(l_tax) * 2, 6) END AS p FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n, rank() OVER (PARTITION BY grp ORDER BY p) + count(*) OVER (PARTITION BY grp, p) - 1 AS k FROM p WHERE p IS NOT NULL)
SELECT grp, id, p, round(least(1.0, min(p * n / k) OVER (PARTITION BY grp ORDER BY k RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS padj FROM r UNION ALL SELECT grp, id, p, NULL FROM p WHERE p IS NULL""")
def _(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("grp"), F.col("l_partkey").alias("id")).agg(F.when(F.col("l_partkey") % 9 > 0, F.round(F.avg("l_tax") * 2, 6)).alias("p"))
    return rounded(W.bh_adjust(rows, "grp"), "padj")


@query("w10_first_per_key", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1")
def _(spark, d):
    return W.first_per_key(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("w12_chunk_profile", "SELECT contig, CAST(floor(pos / 250) AS BIGINT) AS chunk, round(avg(qual), 6) AS depth FROM positions GROUP BY 1, 2", "positions")
def _(spark, d):
    return rounded(W.chunk_profile(view(spark, d, "positions").withColumnRenamed("qual", "depth"), 250), "depth")


VOTE = "c AS (SELECT barcode, call, count(*) AS n FROM calls GROUP BY 1, 2), u AS (SELECT * FROM c UNION ALL SELECT barcode, 'unassigned', 3 - count(*) FROM calls GROUP BY 1 HAVING count(*) < 3), v AS (SELECT barcode, call, sum(n) AS n FROM u GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY barcode ORDER BY n DESC) AS r FROM v), w AS (SELECT barcode, CASE WHEN count(*) = 1 THEN min(call) ELSE 'unassigned' END AS vote FROM r WHERE r = 1 GROUP BY 1)"


@query("w13_majority_vote", f"WITH {VOTE} SELECT * FROM w", "calls")
def _(spark, d):
    return W.majority_vote(view(spark, d, "calls"), 3)


@query("w14_final_droplet", f"WITH {VOTE}, d AS (SELECT *, CASE WHEN barcode % 3 > 0 THEN concat('d', barcode % 4) END AS donor, CASE WHEN barcode % 2 = 0 THEN concat('b', barcode % 4) END AS best_singlet FROM w) SELECT barcode, vote, CASE WHEN vote = 'singlet' THEN coalesce(donor, best_singlet, 'unassigned') ELSE vote END AS final FROM d", "calls")
def _(spark, d):
    votes = W.majority_vote(view(spark, d, "calls"), 3).withColumn("donor", F.expr("CASE WHEN barcode % 3 > 0 THEN concat('d', barcode % 4) END")).withColumn("best_singlet", F.expr("CASE WHEN barcode % 2 = 0 THEN concat('b', barcode % 4) END"))
    return W.final_droplet(votes).select("barcode", "vote", "final")


@query("w15_clip_percentile", "SELECT event_id, round(greatest(0, least(value, (SELECT quantile_cont(value, 0.995) FROM events))), 6) AS clipped FROM events")
def _(spark, d):
    return rounded(W.clip_percentile(table(spark, d, "events")), "clipped").select("event_id", "clipped")


CALLED = "SELECT l_suppkey % 10 AS chromosome, l_partkey % 50 AS barcode, CASE WHEN l_linenumber < 7 THEN l_orderkey % 900 END AS molecule FROM lineitem"


@query("w15_call_counts", f"WITH c AS ({CALLED}) SELECT 'chromosome' AS what, chromosome AS id, count(DISTINCT molecule) AS molecules, count(*) AS calls FROM c GROUP BY 2 UNION ALL SELECT 'barcode', barcode, count(DISTINCT chromosome * 1000 + molecule), count(*) FROM c GROUP BY 2")
def _(spark, d):
    rows = spark.sql(CALLED.replace("FROM lineitem", "FROM {lineitem}"), lineitem=table(spark, d, "lineitem"))
    both = [W.call_counts(rows, by).select(F.lit(by).alias("what"), F.col(by).alias("id"), "molecules", "calls") for by in ("chromosome", "barcode")]
    return both[0].unionByName(both[1])


@query("w16_merge_intervals", """WITH v AS (SELECT DISTINCT contig, start, stop FROM intervals), m AS (SELECT *, max(stop) OVER (PARTITION BY contig ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR start > before THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM m) SELECT contig, min(start) AS start, max(stop) AS stop FROM i GROUP BY contig, island""", "intervals")
def _(spark, d):
    return W.merge_intervals(view(spark, d, "intervals"))


CDS = "SELECT user_id AS contig, event_id AS line, CASE event_type WHEN 'view' THEN 'gene' WHEN 'purchase' THEN 'start_codon' WHEN 'error' THEN 'stop_codon' ELSE 'CDS' END AS feature, event_id AS start, event_id + 90 AS stop, '+' AS strand, concat(event_type, event_id) AS id FROM events"


@query("w17_expand_cds", f"""WITH r AS ({CDS}), g AS (SELECT *, last_value(CASE WHEN feature = 'gene' THEN {{'id': id, 'start': start, 'stop': stop}} END IGNORE NULLS) OVER (PARTITION BY contig ORDER BY line ROWS UNBOUNDED PRECEDING) AS gene FROM r),
c AS (SELECT *, unnest(['gene', 'CDS', 'transcript', 'exon']) AS part FROM g WHERE feature = 'CDS' AND gene IS NOT NULL)
SELECT contig, line, part AS feature, CASE WHEN part = 'gene' THEN gene.start ELSE start END AS start, CASE WHEN part = 'gene' THEN gene.stop ELSE stop END AS stop, strand, gene.id AS gene_id, id AS transcript_id FROM c
UNION ALL SELECT contig, line, feature, start, stop, strand, gene.id, id FROM g WHERE feature IN ('start_codon', 'stop_codon')""")
def _(spark, d):
    return W.expand_cds(spark.sql(CDS.replace("FROM events", "FROM {events}"), events=table(spark, d, "events")))


REPORT = "SELECT conv_id % 50 AS file, conv_id * 100 + turn AS line, CASE WHEN turn = 0 THEN 'D' WHEN (conv_id + turn) % 4 = 0 THEN 'P' WHEN (conv_id + turn) % 4 = 1 THEN 'C' ELSE 'O' END AS rank, concat('t', conv_id, '_', turn) AS name FROM conversations"


@query("w18_taxon_edges", f"""WITH r AS ({REPORT}), t AS (SELECT *, last_value(CASE WHEN rank = 'D' THEN line END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line ROWS UNBOUNDED PRECEDING) AS top FROM r),
l AS (SELECT *, """ + ", ".join(f"last_value(CASE WHEN rank = '{r}' THEN name END IGNORE NULLS) OVER w AS l{k}" for k, r in enumerate("DPCO")) + """ FROM t WINDOW w AS (PARTITION BY file, top ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT file, line, rank, name, CASE rank WHEN 'P' THEN l0 WHEN 'C' THEN coalesce(l1, l0) WHEN 'O' THEN coalesce(l2, l1) END AS parent, CASE rank WHEN 'P' THEN concat_ws(';', l0, name) WHEN 'C' THEN concat_ws(';', l0, l1, name) WHEN 'O' THEN concat_ws(';', l0, l1, l2, name) ELSE name END AS path FROM l""")
def _(spark, d):
    return W.taxon_edges(spark.sql(REPORT.replace("FROM conversations", "FROM {conversations}"), conversations=table(spark, d, "conversations")), ["D", "P", "C", "O"])


@query("o1_rank_by", "WITH s AS (SELECT feature_id, avg(value) AS amount FROM counts GROUP BY 1) SELECT feature_id, round(amount, 6) AS amount, row_number() OVER (ORDER BY round(amount, 9) DESC, feature_id) AS rank FROM s", "counts")
def _(spark, d):
    return rounded(W.rank_by(view(spark, d, "counts"), "feature_id", F.avg("value")), "amount")


@query("o2_take_with_overflow", "WITH l AS (SELECT p_brand, list(p_partkey ORDER BY p_partkey) AS x FROM part GROUP BY 1) SELECT p_brand, CASE WHEN len(x) > 8 THEN concat(array_to_string(x[1:7], ','), ',(+ ', len(x) - 7, ' more)') ELSE array_to_string(x, ',') END AS items FROM l")
def _(spark, d):
    items = F.transform(F.sort_array(F.collect_list("p_partkey")), lambda x: x.cast("string"))
    return table(spark, d, "part").groupBy("p_brand").agg(items.alias("x")).select("p_brand", F.array_join(W.take_with_overflow(F.col("x")), ",").alias("items"))


@query("o3_order_by_list", "SELECT name, contig, list_position(['chr3', 'chr1', 'chr7'], contig) AS place FROM positions WHERE contig IN ('chr3', 'chr1', 'chr7')", "positions")
def _(spark, d):
    return W.order_by_list(view(spark, d, "positions").select("name", "contig"), "contig", ["chr3", "chr1", "chr7"])


@query("o4_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def _(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", (-F.col("o_totalprice")).alias("low"))
    return W.head(rows, 1000, "low", "o_orderkey").drop("low")


@query("u1_union_fill", "SELECT c_custkey AS id, c_acctbal AS balance, 0.0 AS price FROM customer UNION ALL SELECT p_partkey, 0.0, p_retailprice FROM part")
def _(spark, d):
    return W.union_fill([table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")), table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))])


@query("u2_union_rekey", "SELECT concat(user_id, '-click') AS barcode, value FROM events WHERE event_type = 'click' UNION ALL SELECT concat(user_id, '-view'), value FROM events WHERE event_type = 'view'")
def _(spark, d):
    part = lambda k: table(spark, d, "events").where(F.col("event_type") == k).select(F.col("user_id").alias("barcode"), "value")
    return W.union_rekey({k: part(k) for k in ("click", "view")})


def _ids(spark, d, sample):
    return view(spark, d, "counts").where(F.col("sample_id") == sample).select("feature_id")


@query("u3_intersect_ids", "SELECT feature_id FROM counts WHERE sample_id = 'S0' INTERSECT SELECT feature_id FROM counts WHERE sample_id = 'S1'", "counts")
def _(spark, d):
    return W.intersect_ids(_ids(spark, d, "S0"), _ids(spark, d, "S1"), "feature_id")


@query("u4_difference_ids", "SELECT feature_id FROM counts WHERE sample_id = 'S0' EXCEPT SELECT feature_id FROM counts WHERE sample_id = 'S1'", "counts")
def _(spark, d):
    return W.difference_ids(_ids(spark, d, "S0"), _ids(spark, d, "S1"), "feature_id")


@query("u5_symmetric_difference", "(SELECT feature_id FROM counts WHERE sample_id = 'S0' EXCEPT SELECT feature_id FROM counts WHERE sample_id = 'S1') UNION ALL (SELECT feature_id FROM counts WHERE sample_id = 'S1' EXCEPT SELECT feature_id FROM counts WHERE sample_id = 'S0')", "counts")
def _(spark, d):
    return W.symmetric_difference(_ids(spark, d, "S0"), _ids(spark, d, "S1"), "feature_id")


@query("u6_merge_sorted", "SELECT name, contig, pos, list_position(['chr2', 'chr1'], contig) AS place FROM positions WHERE contig IN ('chr1', 'chr2')", "positions")
def _(spark, d):
    rows = view(spark, d, "positions").select("name", "contig", "pos")
    return W.merge_sorted([rows.where("name % 2 = 0"), rows.where("name % 2 = 1")], ["chr2", "chr1"])
