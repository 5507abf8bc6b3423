"""Normalisation, statistics and matrix operators over long tables.

``counts`` is (sample_id, feature_id, value).  Long tables leave zeros out;
operators that need them say so and take the complete grid (see
:func:`tallyframe.operators.joins.complete_grid`).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import discard, materialise, written
from .ranges import quantiles, running_sum, with_totals


def _over(column: Column, key: str) -> Column:
    return column.over(Window.partitionBy(key))


def share_of_sample(counts: DataFrame, scale: float = 1.0) -> DataFrame:
    """Adds ``share``: value over the sample's total, times ``scale``; null where the total is 0."""
    rows = with_totals(counts, ["sample_id"], total=F.sum("value"))
    return rows.withColumn("share", F.col("value") / F.nullif(F.col("total"), F.lit(0.0)) * scale).drop("total")


def cpm(counts: DataFrame, prior: float = 0.0) -> DataFrame:
    """Adds ``cpm``: counts per million of (value + prior)."""
    x = F.col("value") + prior
    return with_totals(counts, ["sample_id"], total=F.sum(x)).withColumn("cpm", x / F.col("total") * 1e6).drop("total")


def tpm(counts: DataFrame, features: DataFrame, fragment_length: float) -> DataFrame:
    """Adds ``tpm`` by effective length; features whose effective length is 1 or less are dropped."""
    effective = F.col("length") - F.lit(fragment_length) + 1
    rows = counts.join(features.select("feature_id", effective.alias("effective")), "feature_id").where("effective > 1")
    rate = F.col("value") / F.col("effective")
    return with_totals(rows, ["sample_id"], total=F.sum(rate)).withColumn("tpm", rate / F.col("total") * 1e6).drop("effective", "total")


def size_factors(counts: DataFrame, mode: str = "nonzero") -> DataFrame:
    """``(sample_id, size_factor)``: median ratio to the features' geometric means.

    "nonzero" averages the logs of positive values; "all" divides their sum by
    the number of samples.  Features without a positive value are skipped.
    """
    positive = counts.where("value > 0")
    if mode == "nonzero":
        means = positive.groupBy("feature_id").agg(F.avg(F.ln("value")).alias("log_mean"))
    else:
        n = counts.agg(F.countDistinct("sample_id").alias("n"))
        means = positive.groupBy("feature_id").agg(F.sum(F.ln("value")).alias("s")).crossJoin(F.broadcast(n)).select("feature_id", (F.col("s") / F.col("n")).alias("log_mean"))
    ratio = F.exp(F.ln("value") - F.col("log_mean"))
    return quantiles(positive.join(means, "feature_id"), ["sample_id"], ratio, [0.5]).select("sample_id", F.get("quantiles", F.lit(0)).alias("size_factor"))


def log_normalise(cells: DataFrame, target: float | None = 1e6) -> DataFrame:
    """Adds ``log_value``: log1p of counts scaled to ``target`` per barcode; None: to the median of the barcodes' totals above 0.  Null where a total is 0."""
    rows = with_totals(cells, ["barcode"], total=F.sum("value"))
    if target is not None:
        return rows.withColumn("log_value", F.log1p(F.col("value") / F.nullif(F.col("total"), F.lit(0.0)) * target)).drop("total")
    totals = cells.groupBy("barcode").agg(F.sum("value").cast("double").alias("value")).where("value > 0")
    middle = quantiles(totals, [], "value", [0.5]).select(F.get("quantiles", 0).alias("middle"))
    return rows.crossJoin(middle).withColumn("log_value", F.log1p(F.col("value") / F.nullif(F.col("total"), F.lit(0.0)) * F.col("middle"))).drop("total", "middle")


def variance_stabilise(counts: DataFrame, size: float | None = None) -> DataFrame:
    """Adds ``stable``: Poisson (no size) or negative binomial variance-stabilised values."""
    x = F.col("value")
    if size is None:
        return counts.withColumn("stable", F.sqrt(x) + F.sqrt(x + 1))
    y = math.sqrt(size) * F.asinh(F.sqrt(x / size))
    if size > 1.5:
        y = y + math.sqrt(size - 1) * F.asinh(F.sqrt((x + 0.75) / (size - 1.5)))
    return counts.withColumn("stable", y)


def scale(counts: DataFrame) -> DataFrame:
    """Adds ``z``: z-score per feature over the rows given; null where the deviation is 0."""
    rows = with_totals(counts, ["feature_id"], centre=F.avg("value"), spread=F.stddev_samp("value"))
    return rows.withColumn("z", (F.col("value") - F.col("centre")) / F.nullif(F.col("spread"), F.lit(0.0))).drop("centre", "spread")


def median_by(rows: DataFrame, group: str, value: Column | str, name: str) -> DataFrame:
    """``(group, name)``: the exact median of each group."""
    return quantiles(rows, [group], value, [0.5]).select(group, F.get("quantiles", F.lit(0)).alias(name))


def highly_variable(counts: DataFrame, n: int, bins: int = 10) -> DataFrame:
    """The ``n`` features with the largest dispersion, normalised by median and MAD within bins of the mean."""
    stats = counts.groupBy("feature_id").agg(F.avg("value").alias("mean"), (F.var_samp("value") / F.avg("value")).alias("dispersion")).where("dispersion is not null")
    stats = materialise(stats, "feature-dispersions")
    edges = quantiles(stats, [], "mean", [k / bins for k in range(1, bins)]).withColumnRenamed("quantiles", "edges")
    binned = stats.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("mean")))).drop("edges")
    medians = median_by(binned, "bin", "dispersion", "median")
    centred = binned.join(F.broadcast(medians), "bin").withColumn("off", F.abs(F.col("dispersion") - F.col("median")))
    mads = median_by(centred, "bin", "off", "mad")
    score = (F.col("dispersion") - F.col("median")) / F.nullif(F.col("mad"), F.lit(0.0))
    ranked = centred.join(F.broadcast(mads), "bin").withColumn("score", score).where("score is not null")
    return ranked.select("feature_id", "mean", "dispersion", "bin", "score").orderBy(F.desc(F.round("score", 9)), "feature_id").limit(n)


def correlation(counts: DataFrame, method: str = "pearson", least: float | None = None) -> DataFrame:
    """``(a, b, r)`` for each pair of samples over the features both have, null where one doesn't vary; of at least ``least`` in size, if given."""
    x = counts.select("sample_id", "feature_id", "value")
    if method == "spearman":
        tied = counts.groupBy("sample_id", "value").agg(F.count(F.lit(1)).alias("t"))
        ranks = running_sum(tied, ["sample_id"], ["value"], "t").select("sample_id", "value", (F.col("before") + (F.col("t") + 1) / 2.0).alias("rank"))
        x = counts.join(ranks, ["sample_id", "value"]).select("sample_id", "feature_id", F.col("rank").alias("value"))
    from .pairs import pair_sums

    # values about their sample's mean, so that sums of squares keep their digits
    x = with_totals(x, ["sample_id"], mean=F.avg("value")).withColumn("value", F.col("value") - F.col("mean"))
    n = F.col("n").cast("double")
    spread = lambda s, ss: n * F.col(ss) - F.col(s) * F.col(s)
    flat = lambda s, ss: F.when(spread(s, ss) > 1e-12 * n * F.col(ss), F.sqrt(spread(s, ss)))
    r = (n * F.col("xy") - F.col("x") * F.col("y")) / (flat("x", "xx") * flat("y", "yy"))
    edges = pair_sums(x, ["x", "y", "xx", "yy", "xy"]).select("a", "b", r.alias("r"))
    return edges if least is None else edges.where(F.abs("r") >= least)


def soft_threshold(edges: DataFrame, powers: list[int]) -> DataFrame:
    """``(power, node, connectivity)``: sum of ((1 + r) / 2) ** power over a node's edges, for each power."""
    both = edges.select(F.col("a").alias("node"), "r").unionByName(edges.select(F.col("b").alias("node"), "r"))
    each = both.withColumn("power", F.explode(F.array(*[F.lit(p) for p in powers])))
    return each.groupBy("power", "node").agg(F.sum(F.pow((1 + F.col("r")) / 2, F.col("power"))).alias("connectivity"))


def beta_distance(counts: DataFrame, metric: str = "bray") -> DataFrame:
    """``(a, b, distance)`` for each pair of samples: Bray-Curtis or Jaccard."""
    from .pairs import pair_sums

    shared = pair_sums(counts.where("value > 0"), ["low"] if metric == "bray" else []).withColumnRenamed("n", "both")
    if metric != "bray":
        shared = shared.withColumn("low", F.lit(0.0))
    totals = counts.where("value > 0").groupBy("sample_id").agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    one = totals.select(F.col("sample_id").alias("a"), F.col("total").alias("ta"), F.col("n").alias("na"))
    two = totals.select(F.col("sample_id").alias("b"), F.col("total").alias("tb"), F.col("n").alias("nb"))
    pairs = one.join(two, F.col("a") < F.col("b")).join(shared, ["a", "b"], "left").fillna(0, ["low", "both"])
    if metric == "bray":
        distance = 1 - 2 * F.col("low") / (F.col("ta") + F.col("tb"))
    else:
        distance = 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    return pairs.select("a", "b", distance.alias("distance"))


def alpha_diversity(counts: DataFrame) -> DataFrame:
    """Observed features, Shannon index (base 2) and Chao1 (bias-corrected) of each sample."""
    p = F.col("value") / F.col("total")
    rows = with_totals(counts.where("value > 0"), ["sample_id"], total=F.sum("value"))
    agg = rows.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("observed"),
        F.sum(-p * F.log2(p)).alias("shannon"),
        F.count_if(F.col("value") == 1).alias("f1"),
        F.count_if(F.col("value") == 2).alias("f2"),
    )
    chao = F.col("observed") + F.col("f1") * (F.col("f1") - 1) / (2.0 * (F.col("f2") + 1))
    return agg.select("sample_id", "observed", "shannon", chao.alias("chao1"))


def rarefy_expected(counts: DataFrame, depths: list[int]) -> DataFrame:
    """``(sample_id, depth, expected)``: expected distinct features in a subsample of each depth (hypergeometric).

    Features of equal value in a sample are one row with their number.
    """
    each = counts.where("value > 0").groupBy("sample_id", "value").agg(F.count(F.lit(1)).alias("n"))
    rows = with_totals(each, ["sample_id"], total=F.sum(F.col("value") * F.col("n"))).withColumn("depth", F.explode(F.array(*[F.lit(float(d)) for d in depths])))
    rows = rows.where("depth <= total")
    seen = F.when(F.col("total") - F.col("value") < F.col("depth"), F.lit(1.0)).otherwise(-F.expm1(_log_missed(F.col("total"), F.col("value"), F.col("depth"))))
    return rows.groupBy("sample_id", "depth").agg(F.sum(F.col("n") * seen).alias("expected"))


def rarefaction_depths(counts: DataFrame, depth: int | None = None, steps: int = 20) -> list[int]:
    """Depths from 1 to ``depth`` in equal steps; without one, half the median of the samples' totals.  Runs a query."""
    if depth is None:
        totals = counts.groupBy("sample_id").agg(F.sum("value").alias("t"))
        depth = int((quantiles(totals, [], "t", [0.5]).first().quantiles[0] or 0) / 2)
    return sorted({round(1 + (depth - 1) * k / max(1, steps - 1)) for k in range(steps)} - {0}) if depth >= 1 else []


def rarefy(counts: DataFrame, depths: list[int], iterations: int = 30, seed: int = 0) -> DataFrame:
    """``(sample_id, depth, iteration, observed, shannon)`` of random subsamples without replacement; depths above a sample's total are left out.

    Draws are those of :func:`tallyframe.operators.draws.draw`, run by iteration.
    """
    from .draws import draw

    runs = counts.select("sample_id").distinct().withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(iterations))))
    runs = runs.withColumn("depth", F.explode(F.array(*[F.lit(d).cast("long") for d in depths]).cast("array<bigint>")))
    p = F.col("drawn") / F.col("depth")
    some = draw(counts, runs, seed=seed).groupBy("sample_id", "depth", F.col("run").alias("iteration"))
    return some.agg(F.count(F.lit(1)).alias("observed"), F.sum(-p * F.log2(p)).alias("shannon"))


def _log_missed(total: Column, value: Column, depth: Column) -> Column:
    """Log of the share of draws of ``depth`` from ``total`` units that hold none of ``value`` units.

    Four factorials by Stirling's series, shifted by 8 for small numbers; what
    they have in common is taken out, so large totals cost no digits.
    """
    a = total + 8
    part = lambda less: (a - less + 0.5) * F.log1p(-less / a)
    rest = lambda x: 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    out = part(value) + part(depth) - part(value + depth) + (rest(a - value) - rest(a)) + (rest(a - depth) - rest(a - value - depth))
    for k in range(1, 9):
        out = out - F.log1p(value * depth / ((total - value - depth + k) * (total + k)))
    return out


def clr(counts: DataFrame, pseudocount: float = 1.0) -> DataFrame:
    """Adds ``clr``: log of (value + pseudocount) minus the sample's mean log."""
    log = F.ln(F.col("value") + pseudocount)
    return with_totals(counts, ["sample_id"], mean_log=F.avg(log)).withColumn("clr", log - F.col("mean_log")).drop("mean_log")


def ilr_balances(counts: DataFrame, tree: DataFrame, pseudocount: float = 1.0) -> DataFrame:
    """``(sample_id, node, balance)`` over ``tree(node, feature_id, side)``: scaled difference of mean logs of both sides."""
    log = F.ln(F.col("value") + pseudocount)
    side = lambda s: (F.sum(F.when(F.col("side") == s, log)), F.count(F.when(F.col("side") == s, log)))
    (left, n), (right, m) = side("num"), side("den")
    sums = counts.join(tree, "feature_id").groupBy("sample_id", "node").agg(left.alias("l"), n.alias("n"), right.alias("r"), m.alias("m"))
    balance = F.sqrt(F.col("n") * F.col("m") / (F.col("n") + F.col("m"))) * (F.col("l") / F.col("n") - F.col("r") / F.col("m"))
    return sums.where("n > 0 and m > 0").select("sample_id", "node", balance.alias("balance"))


def rank_test(rows: DataFrame, group: str = "grp", value: str = "value") -> DataFrame:
    """Kruskal-Wallis statistic over all rows (with tie correction), degrees of freedom and p-value.

    Ranks are counted from the distinct values, so only those are sorted in one
    sequence; each value's rows are pre-aggregated.
    """
    per = rows.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("t"))
    ranked = running_sum(per, [], ["v"], "t").withColumn("rank", F.col("before") + (F.col("t") + 1) / 2.0)
    sums = rows.join(ranked, rows[value] == ranked.v).groupBy(group).agg(F.sum("rank").alias("r"), F.count(F.lit(1)).alias("n"))
    t = F.col("t").cast("double")  # cubes of large groups are beyond a long
    ties = per.agg(F.sum("t").alias("total"), F.sum(t * t * t - t).alias("ties"))
    joined = sums.agg(F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"), (F.count(F.lit(1)) - 1).alias("df")).crossJoin(ties)
    n = F.col("total").cast("double")
    h = (12.0 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    out = joined.select(h.alias("h"), "df")
    return out.withColumn("p", chi2_sf(F.col("h"), F.col("df")))


def rank_markers(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Wilcoxon rank-sum of each feature, each group of cells against all other cells.

    ``cells`` is (barcode, feature, value), zeros left out or not; ``groups`` is
    (barcode, grp), one row for every cell that counts, also for those without
    a value.  Returns ``(feature, grp, n, detected, rank_sum, u, auc, z, p)``: z
    with tie correction, p two-sided; null where all cells tie or a group has
    all cells.  Cells without a group are left out; null values are 0.

    A feature's values are a histogram by value and group, and its zeros one
    block of ties that is never a row: rank sums are closed sums over the
    histogram, whose running totals go by value ranges.
    """
    sizes = groups.where("grp is not null").groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    everyone = sizes.agg(F.sum("n").alias("all_cells"))
    rows = cells.where(F.col("value") != 0).join(groups, "barcode").where("grp is not null")
    each = materialise(rows.groupBy("feature", "value", "grp").agg(F.count(F.lit(1)).alias("c")), "marker-histogram")
    values = running_sum(each.groupBy("feature", "value").agg(F.sum("c").alias("t")), ["feature"], ["value"], "t")
    t = F.col("t").cast("double")
    blocks = values.groupBy("feature").agg(F.sum("t").alias("some"), F.coalesce(F.sum(F.when(F.col("value") < 0, F.col("t"))), F.lit(0)).alias("negative"), F.sum(t * t * t - t).alias("ties"))
    silent = cells.select("feature").distinct().join(blocks, "feature", "left").fillna(0, ["some", "negative"]).fillna(0.0, ["ties"]).crossJoin(everyone)
    zeros = (F.col("all_cells") - F.col("some")).cast("double")
    blocks = silent.select("feature", "all_cells", zeros.alias("zeros"), (F.col("negative") + (zeros + 1) / 2).alias("zero_rank"), (F.col("ties") + zeros * zeros * zeros - zeros).alias("ties"))
    ranked = values.join(blocks.select("feature", "zeros"), "feature").select("feature", "value", (F.col("before") + (t + 1) / 2 + F.when(F.col("value") > 0, F.col("zeros")).otherwise(0.0)).alias("rank"))
    held = each.join(ranked, ["feature", "value"]).groupBy("feature", "grp").agg(F.sum(F.col("c") * F.col("rank")).alias("r"), F.sum("c").alias("detected"))
    grid = blocks.crossJoin(sizes).join(held, ["feature", "grp"], "left").fillna(0, ["detected"]).fillna(0.0, ["r"])
    n, total = F.col("n").cast("double"), F.col("all_cells").cast("double")
    rank_sum = F.col("r") + (n - F.col("detected")) * F.col("zero_rank")
    u = F.col("rank_sum") - n * (n + 1) / 2
    spread = n * (total - n) / 12 * (total + 1 - F.col("ties") / F.nullif(total * (total - 1), F.lit(0.0)))
    z = (F.col("u") - n * (total - n) / 2) / F.nullif(F.sqrt(F.greatest(spread, F.lit(0.0))), F.lit(0.0))
    out = grid.withColumn("rank_sum", rank_sum).withColumn("u", u).withColumn("auc", F.col("u") / F.nullif(n * (total - n), F.lit(0.0))).withColumn("z", z)
    return out.select("feature", "grp", "n", "detected", "rank_sum", "u", "auc", "z", normal_p(F.col("z")).alias("p"))


def normal_p(z: Column) -> Column:
    """Two-sided p-value of a standard normal."""

    @F.pandas_udf("double")
    def tail(v: pd.Series) -> pd.Series:
        return (v.abs() / math.sqrt(2)).map(math.erfc, na_action="ignore").astype("float64")

    return tail(z.cast("double"))


def _log_gamma(a: np.ndarray) -> np.ndarray:
    """Logarithms of the gamma function, one call for each distinct value (degrees of freedom are few)."""
    values, at = np.unique(a, return_inverse=True)
    return np.array([math.lgamma(v) for v in values])[at.reshape(a.shape)]


def _fraction(terms: Iterator[tuple[np.ndarray, np.ndarray]], start: float, first: np.ndarray, exact: float) -> np.ndarray:
    """A continued fraction by its steps (numerator, denominator), for many arguments at once; ``start`` and ``first`` are what the ratios of numerators and denominators begin with."""
    tiny = 1e-300
    sure = lambda v: np.where(v == 0, tiny, v)
    c, d = np.full_like(first, start), 1 / sure(first)
    h, open_ = d.copy(), np.ones(first.shape, dtype=bool)
    for above, below in terms:
        d = 1 / sure(above * d + below)
        c = sure(below + above / c)
        h = np.where(open_, h * d * c, h)
        open_ &= np.abs(d * c - 1) >= exact
        if not open_.any():
            break
    return h


def _gamma_q(a: float | np.ndarray, x: float | np.ndarray) -> np.ndarray:
    """Upper regularised incomplete gamma function."""
    shape = np.broadcast(a, x).shape
    a, x = (np.array(np.broadcast_to(v, shape), dtype=float).ravel() for v in (a, x))
    out = np.where(np.isnan(a + x), np.nan, np.where((x > 0) & (a <= 0), 0.0, 1.0))
    near, far = (a > 0) & (x > 0) & (x < a + 1), (a > 0) & (x > 0) & (x >= a + 1)
    front = lambda a, x: np.exp(-x + a * np.log(x) - _log_gamma(a))
    if near.any():
        p, q = a[near], x[near]
        term = total = 1 / p
        k = p
        while (np.abs(term) > np.abs(total) * 1e-16).any():
            k = k + 1
            term = term * q / k
            total = total + term
        out[near] = 1 - total * front(p, q)
    if far.any():
        p, q = a[far], x[far]
        out[far] = _fraction(((-i * (i - p), q + 1 - p + 2 * i) for i in range(1, 500)), 1e300, q + 1 - p, 1e-16) * front(p, q)
    return out.reshape(shape)[()]


def chi2_sf(x: Column, df: Column) -> Column:
    """Upper tail of the chi-square distribution; null where either is."""

    @F.pandas_udf("double")
    def tail(v: pd.Series, n: pd.Series) -> pd.Series:
        p = pd.Series(_gamma_q(n.to_numpy(dtype=float) / 2, v.to_numpy(dtype=float) / 2), index=v.index)
        return p.where(v.notna() & n.notna())

    return tail(x.cast("double"), df.cast("double"))


def _beta_cf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    one = np.ones_like(x)

    def steps() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for m in range(1, 500):
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), one
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), one

    return _fraction(steps(), 1.0, 1 - (a + b) * x / (a + 1), 1e-15)


def _t_p(t: float | np.ndarray, df: float | np.ndarray) -> np.ndarray:
    """Two-sided p-value of Student's t."""
    shape = np.broadcast(t, df).shape
    t, df = (np.array(np.broadcast_to(v, shape), dtype=float).ravel() for v in (t, df))
    x, a, b = df / (df + t * t), df / 2, np.full(t.shape, 0.5)
    out = np.where(np.isnan(t + df), np.nan, np.where(x >= 1, 1.0, 0.0))
    inner = (x > 0) & (x < 1)
    direct = inner & (x < (a + 1) / (a + b + 2))
    for some, p, q, y in ((direct, a, b, x), (inner & ~direct, b, a, 1 - x)):
        if some.any():
            p, q, y = p[some], q[some], y[some]
            share = np.exp(_log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * np.log(y) + q * np.log1p(-y)) * _beta_cf(p, q, y) / p
            out[some] = share if some is direct else 1 - share
    return out.reshape(shape)[()]


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t; null where either is, or without degrees of freedom."""

    @F.pandas_udf("double")
    def tail(v: pd.Series, n: pd.Series) -> pd.Series:
        n = n.where(n > 0)
        return pd.Series(_t_p(v.to_numpy(dtype=float), n.to_numpy(dtype=float)), index=v.index).where(v.notna() & n.notna())

    return tail(t.cast("double"), df.cast("double"))


def rank_correlation(alpha: DataFrame, metadata: DataFrame) -> DataFrame:
    """Spearman correlation of ``alpha(sample_id, x)`` and ``metadata(sample_id, y)`` over shared ids."""
    rows = alpha.join(metadata, "sample_id")
    ranked = rows
    for c in ("x", "y"):
        per = rows.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("t"))
        ranks = running_sum(per, [], ["v"], "t").select("v", (F.col("before") + (F.col("t") + 1) / 2.0).alias(f"r{c}"))
        ranked = ranked.join(ranks, F.col(c) == F.col("v")).drop("v")
    return ranked.agg(F.corr("rx", "ry").alias("rho"), F.count(F.lit(1)).alias("n"))


def _squares(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys..., within, total)``: squares about the means of group and axis and about those of the axis, for each of ``keys``.

    They are put together from counts, means and variances of the groups, so no
    row is joined to the mean of a group or an axis, of which there are few.
    """
    cells = rows.groupBy(*keys, "grp", "axis").agg(F.count("value").alias("cells"), F.avg("value").alias("mean"), F.var_pop("value").alias("var"))
    about = with_totals(cells, [*keys, "axis"], all_mean=F.sum(F.col("cells") * F.col("mean")) / F.nullif(F.sum("cells"), F.lit(0)))
    off = F.col("mean") - F.col("all_mean")
    return about.groupBy(*keys).agg(F.sum(F.col("cells") * F.col("var")).alias("within"), F.sum(F.col("cells") * (F.col("var") + off * off)).alias("total"))


def permanova_f(coords: DataFrame) -> DataFrame:
    """Pseudo-F of ``coords(sample_id, grp, axis, value)``: between over within sums of squares."""
    sums = _squares(coords, []).crossJoin(coords.agg(F.countDistinct("grp").alias("g"), F.countDistinct("sample_id").alias("n")))
    f = ((F.col("total") - F.col("within")) / (F.col("g") - 1)) / (F.col("within") / (F.col("n") - F.col("g")))
    return sums.select(f.alias("f"), "g", "n")


def permanova(coords: DataFrame, permutations: int = 99, seed: int = 1) -> DataFrame:
    """As :func:`permanova_f` with ``p``: the share of label permutations with an F as large (the real one included).

    A permutation sorts the samples by the md5 of sample, run and seed and deals
    the labels in that order.
    """
    groups = coords.select("sample_id", "grp").distinct()
    runs = groups.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(permutations))))
    named = F.col("sample_id").cast("string")
    draw = F.when(F.col("run") == 0, F.lit("")).otherwise(F.md5(F.concat_ws(":", named, F.col("run").cast("string"), F.lit(str(seed)))))
    shuffled = running_sum(runs.withColumn("draw", draw), ["run"], ["draw", "sample_id"], F.lit(1), "k")
    plain = running_sum(groups, [], ["sample_id"], F.lit(1), "k").select("k", F.col("grp").alias("new"))
    relabelled = shuffled.join(plain, "k").select("run", "sample_id", F.col("new").alias("grp"))
    rows = coords.drop("grp").join(relabelled, "sample_id")
    counted = relabelled.groupBy("run").agg(F.countDistinct("grp").alias("g"), F.countDistinct("sample_id").alias("n"))
    sums = _squares(rows, ["run"]).join(counted, "run")
    f = ((F.col("total") - F.col("within")) / (F.col("g") - 1)) / (F.col("within") / (F.col("n") - F.col("g")))
    tested = sums.select("run", f.alias("f"))
    real = tested.where("run = 0").select(F.col("f").alias("real"))
    return tested.crossJoin(F.broadcast(real)).agg(F.first("real").alias("f"), F.avg((F.col("f") >= F.col("real") - 1e-9).cast("double")).alias("p"))


def fit_two_groups(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """Per feature: log2-CPM difference of two groups ("a", "b"), pooled t and degrees of freedom, over the rows given."""
    logged = cpm(counts, 0.5).withColumn("y", F.log2("cpm")).join(groups, "sample_id")
    side = lambda g, f: f(F.when(F.col("grp") == g, F.col("y")))
    stats = logged.groupBy("feature_id").agg(
        *[side(g, f).alias(f"{n}_{g}") for g in ("a", "b") for n, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))]
    )
    stats = stats.where("n_a > 1 and n_b > 1")
    df = F.col("n_a") + F.col("n_b") - 2
    pooled = ((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b")) / df
    lfc = F.col("mean_b") - F.col("mean_a")
    t = lfc / F.nullif(F.sqrt(pooled * (1 / F.col("n_a") + 1 / F.col("n_b"))), F.lit(0.0))
    return stats.select("feature_id", lfc.alias("lfc"), t.alias("t"), df.alias("df"))


def significance_counts(results: DataFrame, group: str = "term", alpha: float = 0.05) -> DataFrame:
    """``(group, down, not_significant, up)`` of ``(group, lfc, padj)``: features below alpha by the sign of their change."""
    low = F.coalesce(F.col("padj") < alpha, F.lit(False))
    up, down = low & (F.col("lfc") > 0), low & (F.col("lfc") < 0)
    return results.groupBy(group).agg(F.count_if(down).alias("down"), F.count_if(~up & ~down).alias("not_significant"), F.count_if(up).alias("up"))


def significant_lists(results: DataFrame, group: str = "contrast", alpha: float = 0.05) -> DataFrame:
    """``(group, direction, place, feature_id, lfc, padj)``: features below alpha as a list up and a list down, by padj, then id."""
    low = results.where((F.col("padj") < alpha) & (F.col("lfc") != 0)).withColumn("direction", F.when(F.col("lfc") > 0, "up").otherwise("down"))
    placed = running_sum(low, [group, "direction"], ["padj", "feature_id"], F.lit(1), "before")
    return placed.select(group, "direction", (F.col("before") + 1).alias("place"), "feature_id", "lfc", "padj")


def module_traits(profiles: DataFrame, traits: DataFrame) -> DataFrame:
    """``(module, trait, n, r, p)``: Pearson correlation of ``(module, sample_id, profile)`` with numeric ``(sample_id, trait, value)`` over shared samples.

    r is null where either doesn't vary, p where n is below 3.
    """
    rows = profiles.join(traits.where("value is not null"), "sample_id").where("profile is not null")
    sums = rows.groupBy("module", "trait").agg(F.count(F.lit(1)).alias("n"), (F.covar_pop("profile", "value") / F.nullif(F.stddev_pop("profile") * F.stddev_pop("value"), F.lit(0.0))).alias("r"))
    sums = sums.withColumn("r", F.when(F.col("r").isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "r"))))
    t = F.col("r") * F.sqrt((F.col("n") - 2) / F.nullif(1 - F.col("r") * F.col("r"), F.lit(0.0)))
    p = F.when((F.abs("r") == 1) & (F.col("n") > 2), F.lit(0.0)).when(F.col("n") > 2, t_p_value(t, F.col("n") - 2))
    return sums.select("module", "trait", "n", "r", p.alias("p"))


def pca(counts: DataFrame, k: int) -> DataFrame:
    """``(sample_id, component, score, variance)`` of centred features; loadings are in :mod:`tallyframe.operators.decompose`."""
    from .decompose import principal_components

    return principal_components(counts, k)[0]


def explained_variance(variances: DataFrame, most: int = 20, least: int = 2, share: float = 0.9) -> DataFrame:
    """``(component, ratio, cumulative, kept)`` of ``(component, variance)``: components below ``share``, between the bounds."""
    ratio = F.col("variance") / F.sum("variance").over(Window.partitionBy())
    rows = variances.withColumn("ratio", ratio)
    rows = rows.withColumn("cumulative", F.sum("ratio").over(Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)))
    n = F.greatest(F.lit(least), F.least(F.lit(most), F.count_if(F.col("cumulative") < share).over(Window.partitionBy())))
    return rows.select("component", "ratio", "cumulative", (F.col("component") <= n).alias("kept"))


def module_profile(counts: DataFrame, modules: DataFrame) -> DataFrame:
    """``(module, sample_id, profile)``: a module's mean of its features' z-scores."""
    return scale(counts).join(modules, "feature_id").where("z is not null").groupBy("module", "sample_id").agg(F.avg("z").alias("profile"))


#: Directions of a module that :func:`module_eigenvector` follows at once, its rounds at the most, and the relative change of the greatest eigenvalue at which they end.
DIRECTIONS = 12
ROUNDS = 40
SETTLED = 1e-12


def _orthonormal(products: pd.Series) -> pd.DataFrame:
    """For each module: what turns its directions, given their products, into orthonormal ones, strongest first, and the greatest length."""
    at = np.triu_indices(DIRECTIONS)
    grams = np.zeros((len(products), DIRECTIONS, DIRECTIONS))
    grams[:, at[0], at[1]] = grams[:, at[1], at[0]] = np.stack(products.to_list()) if len(products) else 0.0
    values, turns = np.linalg.eigh(grams)
    values, turns = values[:, ::-1], turns[:, :, ::-1]
    lasting = values > 1e-14 * values[:, :1]  # a module has no more directions than samples
    turns = np.where(lasting[:, None, :], turns / np.sqrt(np.where(lasting, values, 1.0))[:, None, :], 0.0)
    return pd.DataFrame({"turn": list(turns.reshape(len(turns), -1)), "top": np.sqrt(np.maximum(values[:, 0], 0.0))})


def module_eigenvector(counts: DataFrame, modules: DataFrame) -> DataFrame:
    """``(module, sample_id, profile)``: first principal component of a module, signed like its mean profile.

    Power iteration of a few directions of all modules at once: a round sums
    cells to (module, feature), then to (module, sample), and makes each
    module's directions orthonormal by their products, so no module is a group
    of its own, and all that a module has alone is one row of products.  Rounds
    are written; cells that are left out are 0; features of a null module are
    left out.  Runs jobs when called.
    """
    cells = scale(counts).join(modules.where("module is not null"), "feature_id").where("z is not null").select("module", "feature_id", "sample_id", "z")
    cells = materialise(cells, "module-cells")
    names = [f"b{k}" for k in range(DIRECTIONS)]
    sums = lambda: [F.sum(F.col("z") * F.col(c)).alias(c) for c in names]
    # the mean profile, and others of no direction
    drawn = [F.xxhash64(F.lit(k), "sample_id").cast("double") / 2.0**63 for k in range(1, DIRECTIONS)]
    means = cells.groupBy("module", "sample_id").agg(F.sum("z").alias("mean"))
    block, old = written(means.select("module", "sample_id", F.col("mean").alias("b0"), *[d.alias(c) for d, c in zip(drawn, names[1:])]), "module-directions")
    orthonormal = F.pandas_udf(_orthonormal, "struct<turn:array<double>,top:double>")
    last = None
    for _ in range(ROUNDS):
        features = cells.join(block, ["module", "sample_id"]).groupBy("module", "feature_id").agg(*sums())
        raw, path = written(cells.join(features, ["module", "feature_id"]).groupBy("module", "sample_id").agg(*sums()), "module-products")
        products = F.array(*[F.sum(F.col(a) * F.col(b)) for k, a in enumerate(names) for b in names[k:]])
        turns = raw.groupBy("module").agg(products.alias("products")).select("module", orthonormal("products").alias("turn")).select("module", "turn.turn", "turn.top")
        turned = [sum(F.col(a) * F.get("turn", i * DIRECTIONS + k) for i, a in enumerate(names)).alias(c) for k, c in enumerate(names)]
        block, new = written(raw.join(turns, "module").select("module", "sample_id", "top", *turned), "module-directions")
        tops = block.groupBy("module").agg(F.first("top").alias("top"))
        if last is not None:
            still = F.max(F.abs(F.col("top") - F.col("before")) / F.greatest("top", F.lit(1e-300)))
            if (tops.join(last, "module").agg(still.alias("moved")).first().moved or 0.0) <= SETTLED:
                break
        last = materialise(tops.withColumnRenamed("top", "before"), "module-tops")
        for gone in (old, path):
            discard(cells.sparkSession, gone)
        old, block = new, block.drop("top")
    rows = block.join(means, ["module", "sample_id"])
    signed = rows.groupBy("module").agg(F.sum(F.col("b0") * F.col("mean")).alias("along"))
    return rows.join(signed, "module").select("module", "sample_id", F.when(F.col("along") < 0, -F.col("b0")).otherwise(F.col("b0")).alias("profile"))


def expression_summary(counts: DataFrame) -> DataFrame:
    """Minimum, quartiles (of the values themselves), median, mean and maximum of each sample."""
    four = quantiles(counts, ["sample_id"], "value", [0.25, 0.5, 0.75], discrete=True).withColumnRenamed("sample_id", "of")
    q = lambda k, n: F.get("quantiles", F.lit(k)).alias(n)
    plain = counts.groupBy("sample_id").agg(F.min("value").alias("min"), F.avg("value").alias("mean"), F.max("value").alias("max"))
    return plain.join(four, F.col("sample_id").eqNullSafe(F.col("of")), "left").select("sample_id", "min", q(0, "q1"), q(1, "median"), "mean", q(2, "q3"), "max")


def contrast_tables(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """For each pair of group levels and each feature: base mean, group means of normalised counts, fold change (3 digits)."""
    normal = counts.join(size_factors(counts), "sample_id").withColumn("normal", F.col("value") / F.col("size_factor")).join(groups, "sample_id")
    base = normal.groupBy("feature_id").agg(F.avg("normal").alias("base_mean"))
    means = normal.groupBy("feature_id", "grp").agg(F.avg("normal").alias("mean"))
    one = means.select("feature_id", F.col("grp").alias("level_a"), F.col("mean").alias("mean_a"))
    two = means.select("feature_id", F.col("grp").alias("level_b"), F.col("mean").alias("mean_b"))
    pairs = one.join(two, "feature_id").where("level_a < level_b").join(base, "feature_id")
    return pairs.withColumn("lfc", F.log2(F.col("mean_b") / F.col("mean_a"))).withColumn("fold_change", F.round(F.pow(F.lit(2.0), F.col("lfc")), 3))


def wide_contrasts(results: DataFrame) -> DataFrame:
    """One row per feature over ``(feature_id, contrast, lfc, p)``: missing log fold changes 0, missing p-values 1.  Asks for the contrasts when it is called."""
    contrasts = [r.contrast for r in results.select("contrast").distinct().orderBy("contrast").collect()]
    wide = results.groupBy("feature_id").pivot("contrast", contrasts).agg(F.first("lfc").alias("lfc"), F.first("p").alias("p"))
    return wide.fillna(0.0, [f"{c}_lfc" for c in contrasts]).fillna(1.0, [f"{c}_p" for c in contrasts])


def design_checks(samples: DataFrame, column: str, reference: str | None = None, pairs: str | None = None) -> DataFrame:
    """``(problem, level)``: levels without replicates, missing reference level, nulls in the design.

    With a column of ``pairs``: pairs that aren't of two samples, and pairs that
    hold a level more than once.
    """
    levels = samples.groupBy(F.col(column).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    single = levels.where("n < 2 and level is not null").select(F.lit("no replicates").alias("problem"), "level")
    nulls = levels.where("level is null").select(F.lit("null in design").alias("problem"), "level")
    out = single.unionByName(nulls)
    if reference is not None:
        seen = levels.agg(F.coalesce(F.max((F.col("level") == reference).cast("int")), F.lit(0)).alias("seen"))
        out = out.unionByName(seen.where("seen = 0").select(F.lit("missing reference").alias("problem"), F.lit(reference).alias("level")))
    if pairs is not None:
        inside = samples.groupBy(F.col(pairs).cast("string").alias("level"), F.col(column).alias("condition")).agg(F.count(F.lit(1)).alias("n"))
        of_two = inside.groupBy("level").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
        for problem, broken in (("pair not of two", "n <> 2"), ("condition repeats in pair", "most > 1")):
            out = out.unionByName(of_two.where(broken).select(F.lit(problem).alias("problem"), "level"))
    return out


def euclidean(counts: DataFrame) -> DataFrame:
    """``(a, b, distance)`` of samples over the features both have."""
    from .pairs import pair_sums

    return pair_sums(counts, ["off"]).select("a", "b", F.sqrt("off").alias("distance"))


def set_score(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """Per barcode: mean of each of two marker sets minus the mean of all features; the label is the larger positive one."""
    rows = cells.join(sets, "feature", "left")
    mean = lambda s: F.avg(F.when(F.col("set") == s, F.col("value"))) - F.avg("value")
    scored = rows.groupBy("barcode").agg(F.coalesce(mean("s"), F.lit(0.0)).alias("s_score"), F.coalesce(mean("g2m"), F.lit(0.0)).alias("g2m_score"))
    s, g = F.round("s_score", 9), F.round("g2m_score", 9)
    return scored.withColumn("label", F.when((s <= 0) & (g <= 0), "G1").when(s >= g, "S").otherwise("G2M"))


def two_sample_z(pairs: DataFrame, bins: int = 20) -> DataFrame:
    """``(feature_id, z)`` of ``(feature_id, baseline, value)`` counts: the difference of variance-stabilised
    values over a robust spread; features that are 0 in both get 0.

    Features are binned by quantiles of the baseline; each bin gives a robust
    variance of the difference and a median, and a line through the origin of
    excess variance on the squared median gives the dispersion.
    """
    x = pairs.withColumn("d", (F.col("value") - F.col("baseline")) / math.sqrt(2)).where("baseline + value > 0")
    edges = quantiles(x, [], "baseline", [k / bins for k in range(1, bins)]).withColumnRenamed("quantiles", "edges")
    binned = x.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("baseline"))))
    centre = median_by(binned, "bin", "d", "centre").join(median_by(binned, "bin", "baseline", "mu"), "bin")
    spread = median_by(binned.join(F.broadcast(centre), "bin"), "bin", F.abs(F.col("d") - F.col("centre")), "off").join(centre, "bin").withColumn("v", F.pow(1.4826 * F.col("off"), 2))
    fit = spread.agg((F.sum((F.col("v") - F.col("mu")) * F.col("mu") * F.col("mu")) / F.sum(F.pow("mu", F.lit(4.0)))).alias("dispersion"))
    size = F.when(F.col("dispersion") > 0, 1 / F.col("dispersion")).otherwise(1e9)
    stable = lambda c: F.sqrt("size") * F.asinh(F.sqrt(F.col(c) / F.col("size")))
    diff = x.crossJoin(F.broadcast(fit.select(size.alias("size")))).withColumn("diff", stable("value") - stable("baseline"))
    diff = materialise(diff, "two-sample-differences")
    middle = lambda rows, v, n: quantiles(rows, [], v, [0.5]).select(F.get("quantiles", F.lit(0)).alias(n))
    mad = middle(diff, "diff", "middle")
    off = diff.crossJoin(F.broadcast(mad))
    scale_ = middle(off, 1.4826 * F.abs(F.col("diff") - F.col("middle")), "scale")
    tested = off.crossJoin(F.broadcast(scale_)).select("feature_id", (F.col("diff") / F.nullif(F.col("scale"), F.lit(0.0))).alias("z"))
    return pairs.select("feature_id").join(tested, "feature_id", "left").fillna(0.0, ["z"])
