"""Queries of the statistics and matrix operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import least_squares as L
from ..operators import normalise as N
from ..operators import windows as W
from ..operators.decompose import principal_components
from ..operators.draws import draw_sql
from ..operators.joins import complete_grid
from ..scratch import materialise
from .registry import query
from .standins import rounded, table, view


@query("m1_tpm", """
WITH r AS (SELECT sample_id, feature_id, value, value / (length - 200 + 1.0) AS rate FROM counts JOIN features USING (feature_id) WHERE length - 200 + 1 > 1)
SELECT sample_id, feature_id, value, round(rate / sum(rate) OVER (PARTITION BY sample_id) * 1e6, 6) AS tpm FROM r""", "counts features")
def _(spark, d):
    return rounded(N.tpm(view(spark, d, "counts"), view(spark, d, "features"), 200), "tpm").select("sample_id", "feature_id", "value", "tpm")


@query("m2_cpm", "SELECT sample_id, feature_id, value, round((value + 0.5) / sum(value + 0.5) OVER (PARTITION BY sample_id) * 1e6, 6) AS cpm FROM counts", "counts")
def _(spark, d):
    return rounded(N.cpm(view(spark, d, "counts"), 0.5), "cpm")


@query("m3_size_factors", """
WITH g AS (SELECT feature_id, avg(ln(value)) AS m FROM counts WHERE value > 0 GROUP BY 1),
a AS (SELECT feature_id, sum(ln(value)) / (SELECT count(DISTINCT sample_id) FROM counts) AS m FROM counts WHERE value > 0 GROUP BY 1)
SELECT 'nonzero' AS mode, sample_id, round(quantile_cont(exp(ln(value) - m), 0.5), 6) AS size_factor FROM counts JOIN g USING (feature_id) WHERE value > 0 GROUP BY sample_id
UNION ALL SELECT 'all', sample_id, round(quantile_cont(exp(ln(value) - m), 0.5), 6) FROM counts JOIN a USING (feature_id) WHERE value > 0 GROUP BY sample_id""", "counts")
def _(spark, d):
    counts = view(spark, d, "counts")
    both = [N.size_factors(counts, m).select(F.lit(m).alias("mode"), "sample_id", "size_factor") for m in ("nonzero", "all")]
    return rounded(both[0].union(both[1]), "size_factor")


@query("m4_log_normalise", "SELECT barcode, feature, value, round(ln(1 + value / sum(value) OVER (PARTITION BY barcode) * 1e6), 6) AS log_value FROM cellcounts", "cellcounts")
def _(spark, d):
    return rounded(N.log_normalise(view(spark, d, "cellcounts")), "log_value")


@query("m5_variance_stabilise", """
SELECT sample_id, feature_id, round(sqrt(value) + sqrt(value + 1), 6) AS poisson,
  round(sqrt(4.0) * asinh(sqrt(value / 4.0)) + sqrt(3.0) * asinh(sqrt((value + 0.75) / 2.5)), 6) AS stable FROM counts""", "counts")
def _(spark, d):
    both = N.variance_stabilise(N.variance_stabilise(view(spark, d, "counts")).withColumnRenamed("stable", "poisson"), 4.0)
    return rounded(both, "poisson", "stable").select("sample_id", "feature_id", "poisson", "stable")


@query("m6_two_sample_z", """
WITH p AS (SELECT feature_id, sum(CASE WHEN sample_id = 'S0' THEN value ELSE 0 END) AS baseline, sum(CASE WHEN sample_id = 'S1' THEN value ELSE 0 END) AS value FROM counts GROUP BY 1),
x AS (SELECT *, (value - baseline) / sqrt(2.0) AS d FROM p WHERE baseline + value > 0),
e AS (SELECT quantile_cont(baseline, [0.05,0.1,0.15,0.2,0.25,0.3,0.35,0.4,0.45,0.5,0.55,0.6,0.65,0.7,0.75,0.8,0.85,0.9,0.95]) AS edges FROM x),
b AS (SELECT x.*, len(list_filter(edges, lambda v: v < baseline)) AS bin FROM x, e),
c AS (SELECT bin, quantile_cont(d, 0.5) AS centre, quantile_cont(baseline, 0.5) AS mu FROM b GROUP BY 1),
s AS (SELECT bin, mu, pow(1.4826 * quantile_cont(abs(d - centre), 0.5), 2) AS v FROM b JOIN c USING (bin) GROUP BY 1, 2),
f AS (SELECT sum((v - mu) * mu * mu) / sum(pow(mu, 4)) AS disp FROM s),
z AS (SELECT CASE WHEN disp > 0 THEN 1 / disp ELSE 1e9 END AS size FROM f),
g AS (SELECT feature_id, sqrt(size) * asinh(sqrt(value / size)) - sqrt(size) * asinh(sqrt(baseline / size)) AS diff FROM x, z),
m AS (SELECT quantile_cont(diff, 0.5) AS middle FROM g),
t AS (SELECT 1.4826 * quantile_cont(abs(diff - middle), 0.5) AS scale FROM g, m)
SELECT p.feature_id, round(coalesce(diff / nullif(scale, 0), 0), 5) AS z FROM p LEFT JOIN g USING (feature_id), t""", "counts")
def _(spark, d):
    pick = lambda s: F.sum(F.when(F.col("sample_id") == s, F.col("value")).otherwise(0.0))
    pairs = view(spark, d, "counts").groupBy("feature_id").agg(pick("S0").alias("baseline"), pick("S1").alias("value"))
    return rounded(N.two_sample_z(pairs), "z", digits=5)


@query("m7_scale", "SELECT sample_id, feature_id, round((value - avg(value) OVER (PARTITION BY feature_id)) / nullif(stddev_samp(value) OVER (PARTITION BY feature_id), 0), 6) AS z FROM counts", "counts")
def _(spark, d):
    return rounded(N.scale(view(spark, d, "counts")), "z").select("sample_id", "feature_id", "z")


@query("m8_highly_variable", """
WITH s AS (SELECT feature_id, avg(value) AS mean, var_samp(value) / avg(value) AS dispersion FROM counts GROUP BY 1 HAVING var_samp(value) IS NOT NULL),
e AS (SELECT quantile_cont(mean, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS edges FROM s),
b AS (SELECT s.*, len(list_filter(edges, lambda v: v < mean)) AS bin FROM s, e),
m AS (SELECT bin, quantile_cont(dispersion, 0.5) AS med FROM b GROUP BY 1),
c AS (SELECT b.*, med, abs(dispersion - med) AS off FROM b JOIN m USING (bin)),
k AS (SELECT bin, quantile_cont(off, 0.5) AS mad FROM c GROUP BY 1)
SELECT feature_id, bin, round((dispersion - med) / nullif(mad, 0), 6) AS score FROM c JOIN k USING (bin) WHERE mad <> 0
ORDER BY round((dispersion - med) / mad, 9) DESC, feature_id LIMIT 100""", "counts")
def _(spark, d):
    return rounded(N.highly_variable(view(spark, d, "counts"), 100).select("feature_id", "bin", "score"), "score")


@query("m9_pca", """
WITH g AS (SELECT s.sample_id, f.feature_id, coalesce(value, 0) AS value FROM (SELECT DISTINCT sample_id FROM counts) s CROSS JOIN (SELECT DISTINCT feature_id FROM counts) f LEFT JOIN counts c ON c.sample_id = s.sample_id AND c.feature_id = f.feature_id),
c AS (SELECT sample_id, feature_id, value - avg(value) OVER (PARTITION BY feature_id) AS x FROM g)
SELECT p.sample_id AS a, q.sample_id AS b, round(sum(p.x * q.x), 2) AS gram FROM c p JOIN c q ON p.feature_id = q.feature_id AND p.sample_id <= q.sample_id GROUP BY 1, 2""", "counts")
def _(spark, d):
    """All components' scores, as the products of samples that they must give back."""
    scores = N.pca(complete_grid(view(spark, d, "counts")), 8).select("sample_id", "component", "score")
    other = scores.select(F.col("sample_id").alias("b"), "component", F.col("score").alias("y"))
    pairs = scores.join(other, "component").where("sample_id <= b").groupBy(F.col("sample_id").alias("a"), "b")
    return rounded(pairs.agg(F.sum(F.col("score") * F.col("y")).alias("gram")), "gram", digits=2)


@query("m9_pca_reconstruction", """
WITH g AS (SELECT s.sample_id, f.feature_id, coalesce(value, 0) AS value FROM (SELECT DISTINCT sample_id FROM counts) s CROSS JOIN (SELECT DISTINCT feature_id FROM counts) f LEFT JOIN counts c ON c.sample_id = s.sample_id AND c.feature_id = f.feature_id)
SELECT sample_id, feature_id, round(value - avg(value) OVER (PARTITION BY feature_id), 4) AS centred FROM g""", "counts")
def _(spark, d):
    """Scores times loadings of all components give the centred table back."""
    scores, loadings = principal_components(view(spark, d, "counts"), 8)
    listed = lambda d, key, v: d.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("component", v))), lambda c: c[v]).alias(v))
    product = F.aggregate(F.zip_with("score", "loading", lambda x, y: x * y), F.lit(0.0), lambda a, v: a + v)
    back = listed(loadings, "feature_id", "loading").crossJoin(listed(scores, "sample_id", "score")).select("sample_id", "feature_id", product.alias("centred"))
    return back.withColumn("centred", F.round("centred", 4) + 0.0)


@query("m10_correlation", """
WITH k AS (SELECT sample_id, feature_id, value, rank() OVER (PARTITION BY sample_id ORDER BY value) + (count(*) OVER (PARTITION BY sample_id, value) - 1) / 2.0 AS r FROM counts)
SELECT x.sample_id AS a, y.sample_id AS b, round(corr(x.value, y.value), 6) AS pearson, round(corr(x.r, y.r), 6) AS spearman
FROM k x JOIN k y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id GROUP BY 1, 2""", "counts")
def _(spark, d):
    counts = materialise(view(spark, d, "counts"), "counts")
    one, two = (N.correlation(counts, m).withColumnRenamed("r", m) for m in ("pearson", "spearman"))
    return rounded(one.join(two, ["a", "b"]), "pearson", "spearman")


@query("m11_soft_threshold", """
WITH e AS (SELECT x.sample_id AS a, y.sample_id AS b, corr(x.value, y.value) AS r FROM counts x JOIN counts y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id GROUP BY 1, 2),
n AS (SELECT a AS node, r FROM e UNION ALL SELECT b, r FROM e), p AS (SELECT unnest([1, 2, 6, 12]) AS power)
SELECT power, node, round(sum(pow((1 + r) / 2, power)), 6) AS connectivity FROM n, p GROUP BY 1, 2""", "counts")
def _(spark, d):
    return rounded(N.soft_threshold(N.correlation(view(spark, d, "counts")), [1, 2, 6, 12]), "connectivity")


MODULES = "SELECT feature_id, gene AS module FROM features WHERE biotype = 'PROMO'"


@query("m12_module_profile", f"""
WITH z AS (SELECT sample_id, feature_id, (value - avg(value) OVER (PARTITION BY feature_id)) / nullif(stddev_samp(value) OVER (PARTITION BY feature_id), 0) AS z FROM counts),
m AS ({MODULES})
SELECT module, sample_id, round(avg(z), 6) AS profile FROM z JOIN m USING (feature_id) WHERE z IS NOT NULL GROUP BY 1, 2""", "counts features")
def _(spark, d):
    modules = view(spark, d, "features").where("biotype = 'PROMO'").select("feature_id", F.col("gene").alias("module"))
    return rounded(N.module_profile(view(spark, d, "counts"), modules), "profile")


@query("m12_module_eigenvector")
def _(spark, d):
    modules = view(spark, d, "features").where("biotype = 'PROMO'").select("feature_id", F.col("gene").alias("module"))
    return rounded(N.module_eigenvector(view(spark, d, "counts"), modules), "profile", digits=4)


@query("m13_beta_distance", """
WITH t AS (SELECT sample_id, sum(value) AS total, count(*) AS n FROM otus GROUP BY 1),
s AS (SELECT x.sample_id AS a, y.sample_id AS b, sum(least(x.value, y.value)) AS low, count(*) AS k FROM otus x JOIN otus y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id GROUP BY 1, 2)
SELECT p.sample_id AS a, q.sample_id AS b, round(1 - 2 * coalesce(low, 0) / (p.total + q.total), 6) AS bray, round(1 - coalesce(k, 0) / (p.n + q.n - coalesce(k, 0)), 6) AS jaccard
FROM t p JOIN t q ON p.sample_id < q.sample_id LEFT JOIN s ON s.a = p.sample_id AND s.b = q.sample_id""", "otus")
def _(spark, d):
    otus = materialise(view(spark, d, "otus").select("sample_id", "feature_id", "value"), "otus")
    one, two = (N.beta_distance(otus, m).withColumnRenamed("distance", m) for m in ("bray", "jaccard"))
    return rounded(one.join(two, ["a", "b"]), "bray", "jaccard")


@query("m14_alpha_diversity", """
WITH p AS (SELECT *, value / sum(value) OVER (PARTITION BY sample_id) AS p FROM otus)
SELECT sample_id, count(*) AS observed, round(sum(-p * log2(p)), 6) AS shannon,
  round(count(*) + count(*) FILTER (value = 1) * (count(*) FILTER (value = 1) - 1) / (2.0 * (count(*) FILTER (value = 2) + 1)), 6) AS chao1 FROM p GROUP BY 1""", "otus")
def _(spark, d):
    return rounded(N.alpha_diversity(view(spark, d, "otus")), "shannon", "chao1")


@query("m15_rarefy", """
WITH n AS (SELECT sample_id, value, count(*) AS n FROM otus GROUP BY 1, 2), t AS (SELECT *, sum(value * n) OVER (PARTITION BY sample_id) AS total FROM n), e AS (SELECT *, unnest([10.0, 100.0, 500.0]) AS depth FROM t)
SELECT sample_id, depth, round(sum(n * (1 - CASE WHEN total - value < depth THEN 0 ELSE list_product(list_transform(range(depth::BIGINT), lambda i: 1 - value / (total - i))) END)), 4) AS expected
FROM e WHERE depth <= total GROUP BY 1, 2""", "otus")
def _(spark, d):
    return rounded(N.rarefy_expected(view(spark, d, "otus"), [10, 100, 500]), "expected", digits=4)


RUNS = """SELECT DISTINCT sample_id, i AS run, CAST(round_even(1 + (depth - 1) * k / 3.0, 0) AS BIGINT) AS depth
FROM (SELECT CAST(floor(quantile_cont(t, 0.5) / 2) AS BIGINT) AS depth FROM (SELECT sum(value) AS t FROM otus GROUP BY sample_id)), otus, range(4) AS r(k), range(1, 4) AS q(i)"""


@query("m15_rarefy_draws", f"""WITH {draw_sql("SELECT sample_id, feature_id, value FROM otus", RUNS)}
SELECT sample_id, depth, CAST(run AS INTEGER) AS iteration, count(*) AS observed, round(sum(-drawn / depth::DOUBLE * log2(drawn / depth::DOUBLE)), 6) AS shannon FROM drawn GROUP BY 1, 2, 3""", "otus")
def _(spark, d):
    otus = view(spark, d, "otus").select("sample_id", "feature_id", "value")
    return rounded(N.rarefy(otus, N.rarefaction_depths(otus, steps=4), 3), "shannon")


@query("m16_clr", "SELECT sample_id, feature_id, round(ln(value + 1) - avg(ln(value + 1)) OVER (PARTITION BY sample_id), 6) AS clr FROM counts", "counts")
def _(spark, d):
    return rounded(N.clr(view(spark, d, "counts")), "clr").select("sample_id", "feature_id", "clr")


@query("m16_ilr_balances", """
WITH t AS (SELECT feature_id, biotype AS node, CASE WHEN feature_id % 2 = 0 THEN 'num' ELSE 'den' END AS side FROM features),
s AS (SELECT sample_id, node, sum(ln(value + 1)) FILTER (side = 'num') AS l, count(*) FILTER (side = 'num') AS n, sum(ln(value + 1)) FILTER (side = 'den') AS r, count(*) FILTER (side = 'den') AS m FROM counts JOIN t USING (feature_id) GROUP BY 1, 2)
SELECT sample_id, node, round(sqrt(n * m / (n + m)) * (l / n - r / m), 6) AS balance FROM s WHERE n > 0 AND m > 0""", "counts features")
def _(spark, d):
    tree = view(spark, d, "features").select("feature_id", F.col("biotype").alias("node"), F.when(F.col("feature_id") % 2 == 0, "num").otherwise("den").alias("side"))
    return rounded(N.ilr_balances(view(spark, d, "counts"), tree), "balance")


KRUSKAL = """
WITH x AS (SELECT {g} AS grp, {v} AS value FROM {t}), r AS (SELECT grp, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY value) AS t FROM x),
s AS (SELECT grp, sum(r) AS r, count(*) AS n FROM r GROUP BY 1), k AS (SELECT count(*)::DOUBLE AS n, sum(t * t - 1.0) AS ties FROM r)
SELECT round((12.0 / (k.n * (k.n + 1)) * sum(s.r * s.r / s.n) - 3 * (k.n + 1)) / (1 - k.ties / (k.n * k.n * k.n - k.n)), 5) AS h, count(*) - 1 AS df FROM s, k GROUP BY k.n, k.ties"""


@query("m17_rank_test", KRUSKAL.format(g="event_type", v="value", t="events"))
def _(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("grp"), "value")
    return rounded(N.rank_test(rows).select("h", "df"), "h", digits=5)


# with two degrees of freedom the chi-square tail is exp(-h / 2)
@query("m17_rank_test_p", "WITH k AS (" + KRUSKAL.format(g="l_returnflag", v="l_quantity", t="lineitem").replace(", 5) AS h", ", 12) AS h") + ") SELECT round(h, 5) AS h, df, round(exp(-h / 2), 5) AS p FROM k WHERE df = 2")
def _(spark, d):
    return rounded(N.rank_test(table(spark, d, "lineitem").select(F.col("l_returnflag").alias("grp"), F.col("l_quantity").alias("value"))), "h", "p", digits=5)


@query("m17_rank_markers", """
WITH cells AS (SELECT user_id AS barcode, event_type AS feature, CAST(count(*) AS DOUBLE) AS value FROM events WHERE value > 60 GROUP BY 1, 2),
g AS (SELECT user_id AS barcode, user_id % 3 AS grp FROM events GROUP BY 1, 2),
x AS (SELECT f.feature, g.barcode, g.grp, coalesce(c.value, 0) AS value FROM (SELECT DISTINCT feature FROM cells) f CROSS JOIN g LEFT JOIN cells c ON c.feature = f.feature AND c.barcode = g.barcode),
r AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY feature, value) AS t FROM x),
k AS (SELECT feature, count(*)::DOUBLE AS m, sum(t * t - 1.0) AS ties FROM r GROUP BY 1),
s AS (SELECT feature, grp, count(*)::DOUBLE AS n, count(*) FILTER (value > 0) AS detected, sum(r) AS rank_sum, sum(r) - count(*) * (count(*) + 1) / 2.0 AS u FROM r GROUP BY 1, 2)
SELECT feature, grp, detected, rank_sum, u, round(u / (n * (m - n)), 6) AS auc, round((u - n * (m - n) / 2) / sqrt(n * (m - n) / 12 * (m + 1 - ties / (m * (m - 1)))), 6) AS z FROM s JOIN k USING (feature)""")
def _(spark, d):
    events = table(spark, d, "events")
    cells = events.where("value > 60").groupBy(F.col("user_id").alias("barcode"), F.col("event_type").alias("feature")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    groups = events.select(F.col("user_id").alias("barcode"), (F.col("user_id") % 3).alias("grp")).distinct()
    return rounded(N.rank_markers(cells, groups).drop("n", "p"), "auc", "z")


@query("m18_rank_correlation", """
WITH j AS (SELECT c_acctbal AS x, t.y FROM customer JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS y FROM orders GROUP BY 1) t ON c_custkey = o_custkey),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM j)
SELECT round(corr(rx, ry), 6) AS rho, count(*) AS n FROM r""")
def _(spark, d):
    alpha = table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_acctbal").alias("x"))
    # exact sums of cents: sums of doubles tie or not by their order
    meta = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("sample_id")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("y"))
    return rounded(N.rank_correlation(alpha, meta), "rho")


def _coords(spark, d):
    wide = table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), F.col("c_mktsegment").alias("grp"), F.col("c_acctbal").alias("a"), (F.col("c_custkey") % 97).cast("double").alias("b"))
    return wide.unpivot(["sample_id", "grp"], ["a", "b"], "axis", "value")


@query("m19_permanova_f", """
WITH c AS (SELECT c_custkey AS id, c_mktsegment AS grp, 'a' AS axis, c_acctbal AS value FROM customer UNION ALL SELECT c_custkey, c_mktsegment, 'b', c_custkey % 97 FROM customer),
w AS (SELECT *, value - avg(value) OVER (PARTITION BY grp, axis) AS w, value - avg(value) OVER (PARTITION BY axis) AS t FROM c),
s AS (SELECT sum(w * w) AS within, sum(t * t) AS total, count(DISTINCT grp) AS g, count(DISTINCT id) AS n FROM w)
SELECT round(((total - within) / (g - 1)) / (within / (n - g)), 5) AS f, g, n FROM s""")
def _(spark, d):
    return rounded(N.permanova_f(_coords(spark, d)), "f", digits=5)


@query("m19_permanova", """
WITH c AS (SELECT c_custkey AS id, 'a' AS axis, c_acctbal AS value FROM customer UNION ALL SELECT c_custkey, 'b', c_custkey % 97 FROM customer),
l AS (SELECT c_custkey AS id, c_mktsegment AS grp FROM customer), r AS (SELECT id, run, CASE WHEN run = 0 THEN '' ELSE md5(concat(id, ':', run, ':1')) END AS draw FROM l, range(20) AS t(run)),
k AS (SELECT id, run, row_number() OVER (PARTITION BY run ORDER BY draw, id) AS k FROM r), p AS (SELECT grp, row_number() OVER (ORDER BY id) AS k FROM l),
x AS (SELECT run, p.grp, axis, value, c.id FROM k JOIN p USING (k) JOIN c ON c.id = k.id),
w AS (SELECT *, value - avg(value) OVER (PARTITION BY run, grp, axis) AS w, value - avg(value) OVER (PARTITION BY run, axis) AS t FROM x),
s AS (SELECT run, sum(w * w) AS within, sum(t * t) AS total, count(DISTINCT grp) AS g, count(DISTINCT id) AS n FROM w GROUP BY 1),
f AS (SELECT run, ((total - within) / (g - 1)) / (within / (n - g)) AS f FROM s)
SELECT round(q.f, 5) AS f, round(avg(CASE WHEN f.f >= q.f - 1e-9 THEN 1.0 ELSE 0 END), 5) AS p FROM f, (SELECT f FROM f WHERE run = 0) q GROUP BY q.f""")
def _(spark, d):
    return rounded(N.permanova(_coords(spark, d), 19), "f", "p", digits=5)


GROUPED = "SELECT concat('S', s) AS sample_id, CASE WHEN s < 4 THEN 'a' ELSE 'b' END AS grp FROM range(8) AS r(s)"


def _groups(spark, d):
    samples = view(spark, d, "counts").select("sample_id").distinct()
    return samples.withColumn("grp", F.when(F.expr("CAST(substring(sample_id, 2) AS int)") < 4, "a").otherwise("b"))


FIT = f"""
WITH g AS ({GROUPED}), c AS (SELECT counts.*, log2((value + 0.5) / sum(value + 0.5) OVER (PARTITION BY sample_id) * 1e6) AS y FROM counts),
s AS (SELECT feature_id, count(*) FILTER (grp = 'a') AS na, avg(y) FILTER (grp = 'a') AS ma, var_samp(y) FILTER (grp = 'a') AS va, count(*) FILTER (grp = 'b') AS nb, avg(y) FILTER (grp = 'b') AS mb, var_samp(y) FILTER (grp = 'b') AS vb FROM c JOIN g USING (sample_id) GROUP BY 1)
"""


@query("m20_fit_two_groups", FIT + "SELECT feature_id, round(mb - ma, 6) AS lfc, round((mb - ma) / nullif(sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1 / na + 1 / nb)), 0), 5) AS t, na + nb - 2 AS df FROM s WHERE na > 1 AND nb > 1", "counts")
def _(spark, d):
    return rounded(rounded(N.fit_two_groups(view(spark, d, "counts"), _groups(spark, d)), "lfc"), "t", digits=5)


@query("m20_fit_features", f"""
WITH g AS ({GROUPED}), c AS (SELECT counts.*, log2((value + 0.5) / sum(value + 0.5) OVER (PARTITION BY sample_id) * 1e6) AS y FROM counts),
r AS (SELECT feature_id, y, CASE WHEN grp = 'b' THEN 1.0 ELSE 0 END AS x, CAST(CAST(substr(sample_id, 2) AS INTEGER) % 2 AS DOUBLE) AS z FROM c JOIN g USING (sample_id)),
s AS (SELECT feature_id, count(*)::DOUBLE AS n, sum(x) AS x, sum(z) AS z, sum(x * z) AS xz, sum(y) AS y, sum(x * y) AS xy, sum(z * y) AS zy, sum(y * y) AS yy FROM r GROUP BY 1),
i AS (SELECT *, x * z - xz * xz AS c00, xz * z - x * z AS c01, x * xz - x * z AS c02, n * z - z * z AS c11, x * z - n * xz AS c12, n * x - x * x AS c22, n * (x * z - xz * xz) - x * (x * z - xz * z) + z * (x * xz - x * z) AS det FROM s),
b AS (SELECT *, (c00 * y + c01 * xy + c02 * zy) / det AS b0, (c01 * y + c11 * xy + c12 * zy) / det AS b1, (c02 * y + c12 * xy + c22 * zy) / det AS b2 FROM i WHERE abs(det) > 0.5 AND n > 3),
v AS (SELECT *, (yy - b0 * y - b1 * xy - b2 * zy) / (n - 3) AS sigma FROM b)
SELECT feature_id, term, round(coefficient, 5) AS coefficient, round(coefficient / sqrt(greatest(d / det * sigma, 1e-300)), 3) AS t FROM (
  SELECT feature_id, det, sigma, unnest(['intercept', 'grp_b', 'batch']) AS term, unnest([b0, b1, b2]) AS coefficient, unnest([c00, c11, c22]) AS d FROM v) WHERE sigma > 1e-9""", "counts")
def _(spark, d):
    logged = N.cpm(view(spark, d, "counts"), 0.5).join(_groups(spark, d), "sample_id").withColumn("y", F.log2("cpm"))
    rows = logged.withColumn("grp_b", (F.col("grp") == "b").cast("double")).withColumn("batch", (F.expr("CAST(substring(sample_id, 2) AS int)") % 2).cast("double"))
    fitted = L.fit_features(rows, ["grp_b", "batch"]).where("not isnan(t) and sigma > 1e-9")
    return rounded(rounded(fitted.select("feature_id", "term", "coefficient", "t"), "coefficient", digits=5), "t", digits=3)


@query("m20_significance_counts", """
WITH p AS (SELECT l_returnflag AS term, l_partkey AS id, avg(l_discount) - 0.05 AS lfc, round(avg(l_tax) * 2, 6) AS p FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, count(*) OVER (PARTITION BY term) AS n, rank() OVER (PARTITION BY term ORDER BY p) + count(*) OVER (PARTITION BY term, p) - 1 AS k FROM p),
a AS (SELECT *, least(1.0, min(p * n / k) OVER (PARTITION BY term ORDER BY k RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS padj FROM r)
SELECT term, count(*) FILTER (padj < 0.06 AND lfc < 0) AS down, count(*) FILTER (NOT (padj < 0.06 AND lfc <> 0)) AS not_significant, count(*) FILTER (padj < 0.06 AND lfc > 0) AS up FROM a GROUP BY 1""")
def _(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("term"), F.col("l_partkey").alias("id")).agg((F.avg("l_discount") - 0.05).alias("lfc"), F.round(F.avg("l_tax") * 2, 6).alias("p"))
    return N.significance_counts(W.bh_adjust(rows, "term"), "term", 0.06)


@query("m21_remove_batch", """
WITH b AS (SELECT *, CASE WHEN sample_id IN ('S0', 'S2', 'S4', 'S6') THEN 'even' ELSE 'odd' END AS batch FROM counts)
SELECT sample_id, feature_id, round(value - avg(value) OVER (PARTITION BY feature_id, batch) + avg(value) OVER (PARTITION BY feature_id), 6) AS adjusted FROM b""", "counts")
def _(spark, d):
    rows = view(spark, d, "counts").withColumn("batch", F.when(F.col("sample_id").isin("S0", "S2", "S4", "S6"), "even").otherwise("odd"))
    return rounded(L.remove_batch(rows), "adjusted").select("sample_id", "feature_id", "adjusted")


@query("m21_remove_terms", f"""
WITH g AS ({GROUPED}), r AS (SELECT feature_id, sample_id, value, CASE WHEN grp = 'b' THEN 1.0 ELSE 0 END AS x, CAST(CAST(substr(sample_id, 2) AS INTEGER) % 2 AS DOUBLE) AS z FROM counts JOIN g USING (sample_id)),
s AS (SELECT feature_id, count(*)::DOUBLE AS n, avg(x) AS mx, avg(z) AS mz, avg(value) AS my, sum(x * x) - sum(x) * avg(x) AS xx, sum(z * z) - sum(z) * avg(z) AS zz, sum(x * z) - sum(x) * avg(z) AS xz, sum(x * value) - sum(x) * avg(value) AS xy, sum(z * value) - sum(z) * avg(value) AS zy FROM r GROUP BY 1),
b AS (SELECT feature_id, mz, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM s WHERE xx > 0.01 AND xx * zz - xz * xz > 0.01)
SELECT feature_id, sample_id, round(value - bz * (z - mz), 5) AS adjusted FROM r JOIN b USING (feature_id)""", "counts")
def _(spark, d):
    rows = view(spark, d, "counts").join(_groups(spark, d), "sample_id").withColumn("x", (F.col("grp") == "b").cast("double")).withColumn("z", (F.expr("CAST(substring(sample_id, 2) AS int)") % 2).cast("double"))
    two = rows.groupBy("feature_id").agg((F.sum(F.col("x") * F.col("x")) - F.sum("x") * F.avg("x")).alias("xx"), (F.sum(F.col("z") * F.col("z")) - F.sum("z") * F.avg("z")).alias("zz"), (F.sum(F.col("x") * F.col("z")) - F.sum("x") * F.avg("z")).alias("xz"))
    full = two.where("xx > 0.01 and xx * zz - xz * xz > 0.01")  # elsewhere the group explains the nuisance term
    return rounded(L.remove_terms(rows.join(full, "feature_id", "left_semi"), ["z"], ["x"]).select("feature_id", "sample_id", "adjusted"), "adjusted", digits=5)


@query("m29_significant_lists", """
WITH r AS (SELECT l_returnflag AS contrast, l_partkey AS feature_id, avg(l_discount) - 0.05 AS lfc, round(avg(l_tax), 6) AS padj FROM lineitem GROUP BY 1, 2),
k AS (SELECT *, CASE WHEN lfc > 0 THEN 'up' ELSE 'down' END AS direction FROM r WHERE padj < 0.03 AND abs(lfc) > 1e-9)
SELECT contrast, direction, row_number() OVER (PARTITION BY contrast, direction ORDER BY padj, feature_id) AS place, feature_id, round(lfc, 6) AS lfc, padj FROM k""")
def _(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("contrast"), F.col("l_partkey").alias("feature_id")).agg((F.avg("l_discount") - 0.05).alias("lfc"), F.round(F.avg("l_tax"), 6).alias("padj"))
    return rounded(N.significant_lists(rows.where("abs(lfc) > 1e-9"), alpha=0.03), "lfc")


@query("m12_module_traits", f"""
WITH z AS (SELECT sample_id, feature_id, (value - avg(value) OVER (PARTITION BY feature_id)) / nullif(stddev_samp(value) OVER (PARTITION BY feature_id), 0) AS z FROM counts), m AS ({MODULES}),
p AS (SELECT module, sample_id, avg(z) AS profile FROM z JOIN m USING (feature_id) WHERE z IS NOT NULL GROUP BY 1, 2),
t AS (SELECT sample_id, 'total' AS trait, sum(value) AS value FROM counts GROUP BY 1 UNION ALL SELECT sample_id, 'features', count(*) FROM counts GROUP BY 1)
SELECT module, trait, count(*) AS n, round(corr(profile, value), 6) AS r FROM p JOIN t USING (sample_id) GROUP BY 1, 2 HAVING count(*) > 3""", "counts features")
def _(spark, d):
    counts = view(spark, d, "counts")
    modules = view(spark, d, "features").where("biotype = 'PROMO'").select("feature_id", F.col("gene").alias("module"))
    traits = counts.groupBy("sample_id").agg(F.sum("value").alias("total"), F.count(F.lit(1)).cast("double").alias("features")).unpivot("sample_id", ["total", "features"], "trait", "value")
    return rounded(N.module_traits(N.module_profile(counts, modules), traits).where("n > 3").drop("p"), "r")


#: The classifiers' training rows are those whose id this number divides; all rows are classified.  Their SQL repeats it.
FIT_EVERY = 5


@query("m22_classify_text")
def _(spark, d):
    from ..operators.classify import classify_text

    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("label"))
    return rounded(classify_text(docs.where(F.col("id") % FIT_EVERY == 0), docs.drop("label"), 3), "confidence", digits=4)


@query("m22_classify_lineage", """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), '') AS c, CASE WHEN doc_id % 5 = 0 AND lang <> '' THEN list_filter([lang, source], lambda x: x <> '') END AS leaf FROM documents),
km AS (SELECT doc_id, leaf, kmer, count(*) AS n FROM (SELECT doc_id, leaf, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS kmer FROM d) GROUP BY ALL),
cnt AS (SELECT leaf, kmer, sum(n) AS n FROM km WHERE leaf IS NOT NULL GROUP BY 1, 2),
leaves AS (SELECT leaf, ln(members / sum(members) OVER ()) AS prior, ln(coalesce(total, 0) + (SELECT count(DISTINCT kmer) FROM cnt)) AS rarest FROM (SELECT leaf, count(*) AS members FROM d WHERE leaf IS NOT NULL GROUP BY 1) LEFT JOIN (SELECT leaf, sum(n) AS total FROM cnt GROUP BY 1) USING (leaf)),
words AS (SELECT doc_id, sum(n) AS words FROM km SEMI JOIN cnt USING (kmer) GROUP BY 1),
more AS (SELECT km.doc_id, cnt.leaf, sum(km.n * ln(1 + cnt.n)) AS more FROM km JOIN cnt ON km.kmer = cnt.kmer GROUP BY 1, 2),
s AS (SELECT d.doc_id, l.leaf, prior + coalesce(more, 0) - coalesce(words, 0) * rarest AS score FROM d CROSS JOIN leaves l LEFT JOIN words w ON w.doc_id = d.doc_id LEFT JOIN more m ON m.doc_id = d.doc_id AND m.leaf = l.leaf),
b AS (SELECT doc_id, max(score) AS top, (array_agg(leaf ORDER BY score DESC, leaf))[1] AS best FROM s GROUP BY 1),
p AS (SELECT doc_id, best, sum(CASE WHEN leaf[1] = best[1] THEN exp(score - top) ELSE 0 END) / sum(exp(score - top)) AS p1, CASE WHEN len(best) > 1 THEN sum(CASE WHEN leaf[:2] = best[:2] THEN exp(score - top) ELSE 0 END) / sum(exp(score - top)) END AS p2 FROM s JOIN b USING (doc_id) GROUP BY 1, 2)
SELECT doc_id AS id, array_to_string(CASE WHEN p2 >= 0.7 THEN best WHEN p1 >= 0.7 THEN best[:1] ELSE [] END, '; ') AS lineage, round(CASE WHEN p2 >= 0.7 THEN p2 WHEN p1 >= 0.7 THEN p1 END, 4) AS confidence FROM p""")
def _(spark, d):
    from ..operators.classify import classify_lineage

    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.array("lang", "source").alias("lineage"))
    return rounded(classify_lineage(docs.where(F.col("id") % FIT_EVERY == 0), docs.drop("lineage"), 3), "confidence", digits=4).withColumn("lineage", F.array_join("lineage", "; "))


@query("m28_expression_summary", "SELECT sample_id, min(value) AS min, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.5) AS median, round(avg(value), 6) AS mean, quantile_disc(value, 0.75) AS q3, max(value) AS max FROM counts GROUP BY 1", "counts")
def _(spark, d):
    return rounded(N.expression_summary(view(spark, d, "counts")), "mean")


@query("m29_contrast_tables", f"""
WITH g AS ({GROUPED}), k AS (SELECT feature_id, avg(ln(value)) AS m FROM counts WHERE value > 0 GROUP BY 1),
f AS (SELECT sample_id, quantile_cont(exp(ln(value) - m), 0.5) AS sf FROM counts JOIN k USING (feature_id) WHERE value > 0 GROUP BY 1),
n AS (SELECT feature_id, grp, value / sf AS x FROM counts JOIN f USING (sample_id) JOIN g USING (sample_id)),
b AS (SELECT feature_id, avg(x) AS base_mean FROM n GROUP BY 1), m AS (SELECT feature_id, grp, avg(x) AS mean FROM n GROUP BY 1, 2)
SELECT p.feature_id, p.grp AS level_a, q.grp AS level_b, round(p.mean, 5) AS mean_a, round(q.mean, 5) AS mean_b, round(base_mean, 5) AS base_mean, round(log2(q.mean / p.mean), 5) AS lfc, round(pow(2, log2(q.mean / p.mean)), 3) AS fold_change
FROM m p JOIN m q ON p.feature_id = q.feature_id AND p.grp < q.grp JOIN b ON b.feature_id = p.feature_id""", "counts")
def _(spark, d):
    return rounded(N.contrast_tables(view(spark, d, "counts"), _groups(spark, d)), "mean_a", "mean_b", "base_mean", "lfc", digits=5)


RESULTS = "SELECT l_partkey AS feature_id, concat('c', l_linenumber % 3) AS contrast, round(avg(l_discount), 6) AS lfc, round(avg(l_tax), 6) AS p FROM lineitem GROUP BY l_partkey, l_linenumber % 3"


def _results(spark, d):
    rows = table(spark, d, "lineitem")
    return rows.groupBy(F.col("l_partkey").alias("feature_id"), F.concat(F.lit("c"), (F.col("l_linenumber") % 3).cast("string")).alias("contrast")).agg(F.round(F.avg("l_discount"), 6).alias("lfc"), F.round(F.avg("l_tax"), 6).alias("p"))


@query("m30_wide_contrasts", f"WITH r AS ({RESULTS}) SELECT feature_id, " + ", ".join(f"coalesce(max(lfc) FILTER (contrast = 'c{k}'), 0) AS c{k}_lfc, coalesce(max(p) FILTER (contrast = 'c{k}'), 1) AS c{k}_p" for k in range(3)) + " FROM r GROUP BY 1")
def _(spark, d):
    return N.wide_contrasts(_results(spark, d))


@query("m31_design_checks", """
WITH l AS (SELECT sample_group AS level, count(*) AS n FROM samples GROUP BY 1)
SELECT 'no replicates' AS problem, level FROM l WHERE n < 2 AND level IS NOT NULL UNION ALL SELECT 'null in design', level FROM l WHERE level IS NULL
UNION ALL SELECT 'missing reference', 'CONTROL' WHERE NOT EXISTS (SELECT 1 FROM l WHERE level = 'CONTROL')
UNION ALL SELECT 'pair not of two', batch FROM samples GROUP BY batch HAVING count(*) <> 2
UNION ALL SELECT 'condition repeats in pair', batch FROM (SELECT batch, sample_group, count(*) AS n FROM samples GROUP BY 1, 2) GROUP BY batch HAVING max(n) > 1""", "samples")
def _(spark, d):
    return N.design_checks(view(spark, d, "samples"), "sample_group", "CONTROL", "batch")


@query("m32_euclidean", "SELECT x.sample_id AS a, y.sample_id AS b, round(sqrt(sum(pow(x.value - y.value, 2))), 6) AS distance FROM counts x JOIN counts y ON x.feature_id = y.feature_id AND x.sample_id < y.sample_id GROUP BY 1, 2", "counts")
def _(spark, d):
    return rounded(N.euclidean(view(spark, d, "counts")), "distance")


@query("m33_set_score", """
WITH s AS (SELECT barcode, coalesce(avg(value) FILTER (feature IN ('click', 'view')) - avg(value), 0) AS s_score, coalesce(avg(value) FILTER (feature = 'purchase') - avg(value), 0) AS g2m_score FROM cellcounts GROUP BY 1)
SELECT barcode, round(s_score, 6) AS s_score, round(g2m_score, 6) AS g2m_score, CASE WHEN round(s_score, 9) <= 0 AND round(g2m_score, 9) <= 0 THEN 'G1' WHEN round(s_score, 9) >= round(g2m_score, 9) THEN 'S' ELSE 'G2M' END AS label FROM s""", "cellcounts")
def _(spark, d):
    cells = view(spark, d, "cellcounts")
    kind = F.when(F.col("feature").isin("click", "view"), "s").when(F.col("feature") == "purchase", "g2m")
    sets = cells.select("feature").distinct().withColumn("set", kind).where("set is not null")
    return rounded(N.set_score(cells, sets), "s_score", "g2m_score")


@query("w11_explained_variance", """
WITH v AS (SELECT c_nationkey + 1 AS component, sum(c_acctbal * c_acctbal / (c_nationkey + 1)) AS variance FROM customer GROUP BY 1),
r AS (SELECT component, variance / sum(variance) OVER () AS ratio, sum(variance) OVER (ORDER BY component ROWS UNBOUNDED PRECEDING) / sum(variance) OVER () AS cumulative FROM v),
n AS (SELECT greatest(2, least(20, count(*) FILTER (cumulative < 0.9))) AS n FROM r)
SELECT component, round(ratio, 6) AS ratio, round(cumulative, 6) AS cumulative, component <= n AS kept FROM r, n""")
def _(spark, d):
    parts = table(spark, d, "customer").groupBy((F.col("c_nationkey") + 1).alias("component")).agg(F.sum(F.col("c_acctbal") * F.col("c_acctbal") / (F.col("c_nationkey") + 1)).alias("variance"))
    return rounded(N.explained_variance(parts), "ratio", "cumulative")
