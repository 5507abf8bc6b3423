"""Normal equations against numpy, and interval joins of very different lengths against loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tallyframe.operators import joins as J
from tallyframe.operators import least_squares as L
from tallyframe.operators import normalise as N


def rows_of(rng, n, feature):
    x = (rng.random((n, 4)) < 0.4).astype(float)
    x[:, 3] = rng.standard_normal(n) + 5
    y = x @ [2.0, -1.0, 3.0, 0.5] + 7 + rng.standard_normal(n) / 3
    return [(feature, float(b), *map(float, a)) for a, b in zip(x, y)]


def test_fits_equal_numpy(spark):
    """Unbalanced designs with two nuisance terms, a different number of rows for each feature; too few rows, an aliased term."""
    rng = np.random.default_rng(4)
    data = [r for f, n in enumerate((9, 14, 40, 200)) for r in rows_of(rng, n, f)]
    data += rows_of(rng, 4, 10) + [(11, y, a, a, b, c) for _, y, a, _, b, c in rows_of(rng, 30, 11)] + [(12, None, 1.0, 0.0, 0.0, 1.0)]
    df = spark.createDataFrame(data, "feature_id long, y double, x double, z double, u double, v double")
    terms = ["x", "z", "u", "v"]
    fitted = L.fit_features(df, terms)
    assert "Python" not in fitted._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.feature_id, r.term): r for r in L.with_p(fitted).collect()}
    for f in (0, 1, 2, 3):
        a = np.array([[1.0, *r[2:]] for r in data if r[0] == f])
        y = np.array([r[1] for r in data if r[0] == f])
        if np.linalg.matrix_rank(a) < 5:
            continue
        beta, *_ = np.linalg.lstsq(a, y, rcond=None)
        sigma = ((y - a @ beta) ** 2).sum() / (len(y) - 5)
        t = beta / np.sqrt(np.diag(np.linalg.inv(a.T @ a)) * sigma)
        for k, term in enumerate(["intercept", *terms]):
            r = got[f, term]
            assert math.isclose(r.coefficient, beta[k], rel_tol=1e-7, abs_tol=1e-8) and math.isclose(r.t, t[k], rel_tol=1e-6) and math.isclose(r.sigma, sigma, rel_tol=1e-7)
            assert r.df == len(y) - 5 and math.isclose(r.p, N._t_p(t[k], r.df), rel_tol=1e-4)
    assert all(math.isnan(got[f, t].t) and math.isnan(got[f, t].p) for f in (10, 11) for t in terms) and (12, "x") not in got


def test_removed_terms_equal_numpy(spark):
    rng = np.random.default_rng(5)
    data = [r for f, n in enumerate((20, 60)) for r in rows_of(rng, n, f)]
    df = spark.createDataFrame([(f, k, y, *x) for k, (f, y, *x) in enumerate(data)], "feature_id long, k long, value double, x double, z double, u double, v double")
    got = {r.k: r.adjusted for r in L.remove_terms(df, ["u", "v"], ["x", "z"]).collect()}
    for f in (0, 1):
        own = [k for k, r in enumerate(data) if r[0] == f]
        a = np.array([[1.0, *data[k][2:]] for k in own])
        y = np.array([data[k][1] for k in own])
        beta, *_ = np.linalg.lstsq(a, y, rcond=None)
        want = y - (a[:, 3:] - a[:, 3:].mean(axis=0)) @ beta[3:]
        assert np.allclose([got[k] for k in own], want, atol=1e-7) and math.isclose(want.mean(), y.mean())
    batches = spark.createDataFrame([(1, "p", 1.0), (1, "p", 3.0), (1, "q", 10.0), (2, "q", 4.0), (2, None, 5.0)], "feature_id long, batch string, value double")
    assert sorted((r.feature_id, r.value, round(r.adjusted, 6)) for r in L.remove_batch(batches).where("batch is not null").collect()) == [(1, 1.0, 3.666667), (1, 3.0, 5.666667), (1, 10.0, 4.666667), (2, 4.0, 4.0)]
    assert {r.value: r.adjusted for r in L.remove_batch(batches.where("batch = 'q'")).collect()} == {10.0: 10.0, 4.0: 4.0}


def test_intervals_of_very_different_lengths(spark):
    """Equal to a loop, and no interval is dealt out more than two times on each level."""
    rng = random.Random(6)
    spans = lambda n: [(rng.choice("xy"), a, a + rng.choice([1, 2, 7, 40, 900, 60_000, 2_000_000]), k) for k, a in enumerate(rng.randint(-500, 2_000_000) for _ in range(n))] + [("x", 5, 5, 999)]
    a, b = spans(150), spans(150)
    schema = "contig string, start long, stop long, name long"
    one, two = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    for least in (1, 5):
        want = sorted((p[3], q[3], o) for p in a for q in b if p[0] == q[0] and p[1] < p[2] and q[1] < q[2] and (o := min(p[2], q[2]) - max(p[1], q[1])) >= least)
        assert sorted((r.a_name, r.b_name, r.overlap) for r in J.overlap_join(one, two, 16, least).collect()) == want
    sent = J._visiting(J._levelled(one, "a", 16), "a", J._levelled(two, "b", 16), "b", 16, above=False)
    assert sent.count() <= 2 * 9 * 150
    points = [(rng.choice("xy"), rng.randint(-600, 2_100_000)) for _ in range(300)]
    got = sorted((r.contig, r.pos, r.i_name) for r in J.point_in_interval(spark.createDataFrame(points, "contig string, pos long"), two, 16).collect())
    assert got == sorted((c, p, q[3]) for c, p in points for q in b if q[0] == c and q[1] <= p < q[2])


def test_traits_and_lists(spark):
    rng = np.random.default_rng(7)
    x, y = rng.standard_normal(12), rng.standard_normal(12)
    profiles = spark.createDataFrame([("m", f"s{k}", float(v)) for k, v in enumerate(x)] + [("flat", f"s{k}", 1.0) for k in range(12)], "module string, sample_id string, profile double")
    traits = spark.createDataFrame([(f"s{k}", "t", float(v)) for k, v in enumerate(y)] + [("s0", "same", float(x[0])), ("s1", "same", float(x[1])), ("s2", "same", float(x[2]))], "sample_id string, trait string, value double")
    got = {(r.module, r.trait): r for r in N.module_traits(profiles, traits).collect()}
    r = np.corrcoef(x, y)[0, 1]
    assert math.isclose(got["m", "t"].r, r, rel_tol=1e-9) and math.isclose(got["m", "t"].p, N._t_p(r * math.sqrt(10 / (1 - r * r)), 10), rel_tol=1e-6)
    assert got["flat", "t"].r is None and got["flat", "t"].p is None and got["m", "same"].n == 3
    results = spark.createDataFrame([("c", 1, 1.0, 0.01), ("c", 2, 2.0, 0.01), ("c", 3, -1.0, 0.001), ("c", 4, 3.0, 0.2), ("c", 5, 1.0, None), ("c", 6, 4.0, 0.001)], "contrast string, feature_id long, lfc double, padj double")
    assert sorted((r.direction, r.place, r.feature_id) for r in N.significant_lists(results).collect()) == [("down", 1, 3), ("up", 1, 6), ("up", 2, 1), ("up", 3, 2)]


def test_equal_intervals_meet_as_blocks_and_every_pair_stays(spark):
    """Copies of one interval are a row for each ``BLOCK`` of them in the join; pairs, other columns and nulls stay."""
    some = spark.range(2500).select(F.col("id").alias("name"), F.lit("c").alias("contig"), F.lit(5).alias("start"), F.lit(9).alias("stop"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("tag"))
    waiting = J._waiting(J._levelled(some, "b", 16), "b", 16)
    assert sorted(len(r.b_rows) for r in J._blocks(waiting, "b").collect()) == [2500 - 2 * J.BLOCK, J.BLOCK, J.BLOCK]
    one = spark.createDataFrame([(1, "c", 0, 6), (2, "c", 7, 40), (3, "c", 9, 12), (4, None, 0, 6)], "name long, contig string, start int, stop int")
    got = J.overlap_join(one, some, 16)
    assert got.columns == ["a_name", "a_contig", "a_start", "a_stop", "b_name", "b_contig", "b_start", "b_stop", "b_tag", "overlap"]
    counted = got.groupBy("a_name", "overlap").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("b_name").alias("kinds"), F.count("b_tag").alias("tags")).collect()
    assert sorted(map(tuple, counted)) == [(1, 1, 2500, 2500, 1250), (2, 2, 2500, 2500, 1250)]
    points = spark.createDataFrame([(10, "c", 5), (11, "c", 9), (12, "c", 8)], "name long, contig string, pos long")
    got = J.point_in_interval(points, some, 16)
    assert got.columns == ["name", "contig", "pos", "i_name", "i_contig", "i_start", "i_stop", "i_tag"]
    assert sorted(map(tuple, got.groupBy("name").agg(F.count(F.lit(1)), F.countDistinct("i_name"), F.count("i_tag")).collect())) == [(10, 2500, 2500, 1250), (12, 2500, 2500, 1250)]


def test_pairs_of_places_take_few_bytes_in_files(spark, tmp_path):
    """Pairs come in an order that Parquet holds in a part of a byte: before, points came in the order of the input, at over one byte."""
    points = spark.range(40_000).select(F.col("id").alias("name"), F.lit("c").alias("contig"), F.pmod(F.hash("id"), F.lit(40)).alias("pos"))
    some = spark.range(4000).select(F.col("id").alias("name"), F.lit("c").alias("contig"), F.pmod(F.hash(F.col("id") + 1), F.lit(40)).alias("start")).withColumn("stop", F.col("start") + 1 + F.col("name") % 4)
    got = J.point_in_interval(points, some, 16).select("name", "i_name")
    got.write.parquet(f"{tmp_path}/held")
    size = sum(p.stat().st_size for p in (tmp_path / "held").glob("*.parquet"))
    held = spark.read.parquet(f"{tmp_path}/held")
    want = points.join(some.withColumnRenamed("name", "i_name"), "contig").where("pos >= start and pos < stop").select("name", "i_name")
    both = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("name", "i_name").cast("decimal(38,0)"))).first()
    assert both(held) == both(want)
    assert size < 0.5 * held.count()


def test_large_bins_are_dealt_over_tasks(spark, monkeypatch):
    """A bin of many rows on both sides is several parts, each pair of parts meets once, and no pair is lost or doubled; before, it was one task."""
    monkeypatch.setattr(J, "HELD", 50, raising=False)
    tasks = lambda df: [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    a = spark.range(450).select(F.col("id").alias("name"), F.when(F.col("id") >= 0, "c").alias("contig"), (F.col("id") % 3).alias("start"), (F.col("id") % 3 + 2).alias("stop"))
    b = spark.range(350).select(F.col("id").alias("name"), F.when(F.col("id") >= 0, "c").alias("contig"), (F.col("id") % 5).alias("start"), (F.col("id") % 5 + 1 + F.col("id") % 2 * 90).alias("stop"))
    want = sorted((p.name, q.name, o) for p in a.collect() for q in b.collect() if (o := min(p.stop, q.stop) - max(p.start, q.start)) >= 1)
    got = J.overlap_join(a, b, 16)
    assert sorted((r.a_name, r.b_name, r.overlap) for r in got.select("a_name", "b_name", "overlap").collect()) == want
    assert len(tasks(got)) > 1
    points = a.select("name", "contig", F.col("start").alias("pos"))
    got = J.point_in_interval(points, b, 16)
    assert sorted((r.name, r.i_name) for r in got.collect()) == sorted((p.name, q.name) for p in points.collect() for q in b.collect() if q.start <= p.pos < q.stop)
    assert len(tasks(got)) > 1
    one, _ = J._split(points.select(F.col("name").alias("p_name"), F.col("contig").alias("p_contig"), F.col("pos").alias("p_start"), F.lit(0).alias("p_level"), F.lit(0).alias("p_bin")), "p", J._waiting(J._levelled(b, "i", 16), "i", 16), "i")
    sizes = one.groupBy("p_one", "p_two").count().collect()
    assert len({r.p_one for r in sizes}) == 9 and max(r["count"] for r in sizes) < 100
