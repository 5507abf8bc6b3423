"""Least squares for many features at once, by their joint normal equations.

Sums of squares and products of the design's columns and of ``y`` are ordinary
aggregates, so a feature's rows are never gathered.  Each feature's small
matrix is then solved by the sweep operator, one pivot after the other, in an
array of the feature's row: sweeping the nuisance terms first projects them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import with_totals

#: A pivot below this share of its column's own sum of squares is a column that the ones before it explain.
ALIASED = 1e-10


def swept(matrix: Column, k: int) -> Column:
    """The symmetric (k + 1) x (k + 1) ``matrix`` (an array by rows) swept on its first ``k`` columns, then their number that could be.

    The first k rows and columns hold the inverse, the last column the
    coefficients, the last cell what is left of y's square.  A column that the
    ones before explain gets zeros: it has no coefficient of its own.
    """
    w = k + 1
    cells = w * w
    at = lambda a, i: F.get(a, i)

    def step(acc: Column, p: Column) -> Column:
        d = at(acc, p * w + p)
        ok = d > F.lit(ALIASED) * at(acc, p + cells)

        def cell(x: Column, i: Column) -> Column:
            r, c = F.floor(i / w).cast("int"), (i % w).cast("int")
            turned = (
                F.when((r == p) & (c == p), 1 / d)
                .when(r == p, x / d)
                .when(c == p, -x / d)
                .otherwise(x - at(acc, r * w + p) * at(acc, p * w + c) / d)
            )
            kept = F.when(ok, turned).when((r == p) | (c == p), F.lit(0.0)).otherwise(x)
            return F.when(i < cells, kept).when(i < cells + k, x).otherwise(x + ok.cast("double"))

        return F.transform(acc, cell)

    diagonal = [at(matrix, F.lit(p * w + p)) for p in range(k)]
    start = F.concat(matrix, F.array(*diagonal, F.lit(0.0)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), start, step)


def solved(rows: DataFrame, terms: list[str], key: str = "feature_id", y: str = "y") -> DataFrame:
    """``(key, n, coefficients, inverse, rest, rank)`` of each key's rows: arrays by term, the intercept first; rows with a null are left out."""
    names = ["one_", *terms, y]
    w = len(names)
    x = [F.lit(1.0), *[F.col(t).cast("double") for t in terms], F.col(y).cast("double")]
    pairs = [(i, j) for i in range(w) for j in range(i, w)]
    whole = rows.dropna(subset=[*terms, y])
    sums = whole.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[F.sum(x[i] * x[j]).alias(f"s_{i}_{j}") for i, j in pairs])
    matrix = F.array(*[F.col(f"s_{min(i, j)}_{max(i, j)}") for i in range(w) for j in range(w)])
    k = w - 1
    out = sums.select(key, "n", matrix.alias("m")).select(key, "n", swept(F.col("m"), k).alias("m"))
    get = lambda i: F.get("m", F.lit(i))
    return out.select(
        key, "n",
        F.array(*[get(i * w + k) for i in range(k)]).alias("coefficients"),
        F.array(*[get(i * w + i) for i in range(k)]).alias("inverse"),
        F.greatest(get(k * w + k), F.lit(0.0)).alias("rest"),
        get(w * w + k).cast("int").alias("rank"),
    )


def fit_features(rows: DataFrame, terms: list[str]) -> DataFrame:
    """``(feature_id, term, coefficient, t, df, sigma)``: least squares of ``y`` on an intercept and numeric ``terms`` for each feature.

    sigma is the residual variance.  NaN where the terms aren't independent or
    no degree of freedom is left.  :func:`with_p` adds p-values.
    """
    fitted = solved(rows, terms)
    k = len(terms) + 1
    df = F.col("n") - k
    good = (F.col("rank") == k) & (df > 0)
    sigma = F.col("rest") / F.nullif(df.cast("double"), F.lit(0.0))
    each = F.arrays_zip(F.array(*map(F.lit, ["intercept", *terms])).alias("term"), F.col("coefficients").alias("coefficient"), F.col("inverse").alias("inverse"))
    out = fitted.select("feature_id", df.cast("int").alias("df"), good.alias("good"), sigma.alias("sigma"), F.explode(each).alias("e"))
    t = F.col("e.coefficient") / F.sqrt(F.greatest(F.col("e.inverse") * F.col("sigma"), F.lit(1e-300)))
    or_nan = lambda c: F.when(F.col("good"), c).otherwise(F.lit(float("nan")))
    return out.select("feature_id", "e.term", or_nan(F.col("e.coefficient")).alias("coefficient"), or_nan(t).alias("t"), "df", or_nan(F.col("sigma")).alias("sigma"))


def with_p(fitted: DataFrame) -> DataFrame:
    """Adds ``p``, two-sided, of ``t`` and ``df``."""
    from .normalise import t_p_value

    return fitted.withColumn("p", F.when(F.isnan("t"), F.lit(float("nan"))).otherwise(t_p_value(F.col("t"), F.col("df"))))


def remove_terms(rows: DataFrame, nuisance: list[str], design: list[str] | None = None) -> DataFrame:
    """Adds ``adjusted``: ``value`` without what the ``nuisance`` columns add to it in a fit with the ``design`` columns beside them.

    Per feature, on numeric columns; each nuisance column is taken from its mean
    over the feature's rows, so the feature's mean stays.  The design comes
    first: what it explains as well stays in.
    """
    design = design or []
    terms = [*design, *nuisance]
    fitted = solved(rows.withColumn("y", F.col("value")), terms).select(F.col("feature_id").alias("of"), "coefficients")
    means = with_totals(rows, ["feature_id"], **{f"mean_{k}": F.avg(F.when(F.col("value").isNotNull(), F.col(t).cast("double"))) for k, t in enumerate(nuisance)})
    joined = means.join(fitted, F.col("feature_id").eqNullSafe(F.col("of")), "left")
    added = sum((F.get("coefficients", F.lit(1 + len(design) + k)) * (F.col(t) - F.col(f"mean_{k}")) for k, t in enumerate(nuisance)), F.lit(0.0))
    return joined.withColumn("adjusted", F.col("value") - added).drop("of", "coefficients", *[f"mean_{k}" for k in range(len(nuisance))])


def remove_batch(rows: DataFrame, design: list[str] | None = None, batch: str = "batch") -> DataFrame:
    """:func:`remove_terms` of a batch column's levels, which are asked for when this is called; without a design, batch means move to the feature's mean."""
    levels = [r[0] for r in rows.where(F.col(batch).isNotNull()).select(batch).distinct().orderBy(batch).collect()]
    marks = {f"batch_level_{k}": (F.col(batch) == v).cast("double") for k, v in enumerate(levels[1:])}
    return remove_terms(rows.withColumns(marks), list(marks), design).drop(*marks) if marks else rows.withColumn("adjusted", F.col("value").cast("double"))
