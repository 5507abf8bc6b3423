"""Statistics of groups whose cubes and sums are beyond a long or a double's digits."""

from fractions import Fraction

from pyspark.sql import functions as F

from tallyframe.operators import normalise as N
from tallyframe.plans import ORACLE_SQL, QUERIES


def test_rank_test_of_millions_of_ties(spark):
    rows = spark.range(4_400_000).select((F.col("id") % 3).alias("grp"), (F.col("id") % 2).cast("double").alias("value"))
    found = N.rank_test(rows).first()
    assert found.df == 2 and abs(found.h) < 1e-3 and found.p > 0.99


def test_rarefied_features_keep_their_digits_in_large_samples(spark):
    """A million features of few units in billions: each is missed with a chance next to 1."""
    counts = spark.range(1_000_000).select(F.lit("s").alias("sample_id"), F.col("id").alias("feature_id"), (4000 + F.col("id") % 3).cast("double").alias("value"))
    total, depth = sum(v * len(range(v - 4000, 1_000_000, 3)) for v in (4000, 4001, 4002)), 500
    want = 0.0
    for v in (4000, 4001, 4002):
        missed = Fraction(1)
        for i in range(depth):
            missed *= Fraction(total - v - i, total - i)
        want += len(range(v - 4000, 1_000_000, 3)) * float(1 - missed)
    found = {r.depth: r.expected for r in N.rarefy_expected(counts, [1, depth]).collect()}
    assert abs(found[float(depth)] - want) < 1e-6 and abs(found[1.0] - 1) < 1e-7


def test_rank_correlation_ties_of_sums_are_no_matter_of_order(spark, tmp_path):
    """Sums of equal prices in other orders differ in doubles and must tie."""
    prices = [0.1, 0.2, 0.3, 0.7]
    orders = [(c, p) for c in range(4) for p in (prices if c % 2 else prices[::-1])] + [(c, 5.0 + c) for c in range(4, 8)]
    spark.createDataFrame(orders, "o_custkey long, o_totalprice double").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(c, float(c)) for c in range(8)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    # ranks 1..8 against 2.5 four times, then 5..8
    x, y = list(range(1, 9)), [2.5] * 4 + [5, 6, 7, 8]
    mean = 4.5
    want = sum((a - mean) * (b - mean) for a, b in zip(x, y)) / (sum((a - mean) ** 2 for a in x) * sum((b - mean) ** 2 for b in y)) ** 0.5
    found = QUERIES["m18_rank_correlation"](spark, str(tmp_path)).first()
    assert found.n == 8 and abs(found.rho - want) < 1e-6 and "DECIMAL" in ORACLE_SQL["m18_rank_correlation"]


def test_permanova_joins_no_row_to_a_mean(spark):
    """Axes and groups are few: joined by them, all rows would go to as many tasks."""
    coords = spark.range(400).selectExpr("id AS sample_id", "id % 3 AS grp", "'a' AS axis", "CAST(id % 7 AS double) AS value")
    plan = N.permanova(coords, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "total_grp" not in plan and "var_pop" in plan
