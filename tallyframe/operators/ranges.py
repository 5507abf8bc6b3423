"""Global orders, running sums and numbers by value ranges, so that no window gathers a table or a large group.

Rows are dealt into ranges of the order by Spark's range partitioning (its
edges are quantiles of a sample, so skewed values give equal ranges) and
written once, as edges are drawn anew by each run of a plan.  A window then
sees one range of one group; the ranges themselves, a few for each group, are
summed up in a second window.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise

#: The column that holds a row's range.
PART = "range_part"


def _small(rows: DataFrame) -> bool:
    """Whether Spark's own estimate would let the rows be broadcast, and nothing in their plan multiplies rows unseen or may differ when run again."""
    limit = rows.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    plan = rows._jdf.queryExecution().optimizedPlan()
    return plan.deterministic() and plan.stats().sizeInBytes() <= limit and not re.search(r"\b(Generate|Expand|MapIn\w+|FlatMap\w+|\w+EvalPython|Sample)\b", plan.toString())


def ranged(rows: DataFrame, *order: Column | str, write: bool = False) -> DataFrame:
    """``rows`` with their range of the order; equal keys share a range.

    Rows of so small a plan that Spark would send them whole to each task are
    one range, which needs no edges and so isn't written unless asked for.
    """
    if not write and _small(rows):
        return rows.repartition(1).withColumn(PART, F.spark_partition_id())
    return materialise(rows.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), "ranges")


def running_sum(rows: DataFrame, group: list[str], order: list[Column | str], value: Column | str, name: str = "before", write: bool = False) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over rows of the same group that sort earlier (0 for the first).

    Rows that tie in ``order`` come in any order, one after the other.
    """
    return sum_before(ranged(rows, *group, *order, write=write), group, order, value, name).drop(PART)


def sum_before(parts: DataFrame, group: list[str], order: list[Column | str], value: Column | str, name: str) -> DataFrame:
    """As :func:`running_sum`, over rows that :func:`ranged` has dealt out by group and order."""
    keys = [*group, PART]
    earlier = Window.unboundedPreceding, -1
    value = F.col(value) if isinstance(value, str) else value
    sums = parts.groupBy(*keys).agg(F.sum(value).alias("range_sum"))
    sums = sums.withColumn("range_before", F.coalesce(F.sum("range_sum").over(Window.partitionBy(*group).orderBy(PART).rowsBetween(*earlier)), F.lit(0))).drop("range_sum")
    inner = F.coalesce(F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*earlier)), F.lit(0))
    return by_range(parts.withColumn("range_within", inner), sums, keys).withColumn(name, F.col("range_before") + F.col("range_within")).drop("range_before", "range_within")


def running_max(parts: DataFrame, group: list[str], order: list[str], **values: Column) -> DataFrame:
    """Adds the greatest of each value over the rows of the same group that sort earlier (null for none), over rows that :func:`ranged` has dealt out by group and order."""
    keys, earlier = [*group, PART], (Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(*earlier)
    tops = parts.groupBy(*keys).agg(*[F.max(v).alias(f"range_{n}") for n, v in values.items()])
    tops = tops.withColumns({f"range_{n}": F.max(f"range_{n}").over(before) for n in values})
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*earlier)
    met = by_range(parts.withColumns({n: F.max(v).over(inner) for n, v in values.items()}), tops, keys)
    return met.withColumns({n: F.greatest(n, f"range_{n}") for n in values}).drop(*[f"range_{n}" for n in values])


def by_range(parts: DataFrame, sums: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what is known of their group's range; null groups are groups."""
    named = sums.withColumnsRenamed({k: f"range_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"range_{k}")) for k in keys]
    return parts.join(named, same).drop(*[f"range_{k}" for k in keys])


def carried(rows: DataFrame, group: list[str], order: list[str], **values: Column) -> DataFrame:
    """Adds the last non-null of each value over the rows of the same group that sort earlier (a scan with the last value as its sum).

    Rows should not tie in ``order``.
    """
    parts = ranged(rows.withColumns(values), *group, *order)
    keys, earlier = [*group, PART], (Window.unboundedPreceding, -1)
    place = F.struct(*order)
    ends = parts.groupBy(*keys).agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), place)).alias(f"range_{n}") for n in values])
    ranges_ = Window.partitionBy(*group).orderBy(PART).rowsBetween(*earlier)
    ends = ends.withColumns({f"range_{n}": F.last(f"range_{n}", ignorenulls=True).over(ranges_) for n in values})
    inner = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*earlier)
    met = by_range(parts.withColumns({n: F.last(n, ignorenulls=True).over(inner) for n in values}), ends, keys)
    return met.withColumns({n: F.coalesce(n, f"range_{n}") for n in values}).drop(PART, *[f"range_{n}" for n in values])


def numbered(rows: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """Adds consecutive numbers from 1 in the order given, which should have no ties."""
    return running_sum(rows, [], list(order), F.lit(1), name).withColumn(name, F.col(name) + 1)


def first_keys(rows: DataFrame, key: str, order: Column, n: int) -> DataFrame:
    """Rows of the first ``n`` keys by ``order``, an expression of the key."""
    keys = running_sum(rows.select(key).distinct().withColumn("place", order), [], ["place", key], F.lit(1))
    return rows.join(keys.where(F.col("before") < n).select(key), key, "left_semi")


def with_totals(rows: DataFrame, keys: list[str], **totals: Column) -> DataFrame:
    """Adds aggregates of each row's group: summed up first and joined back, so a large group is no shuffle partition."""
    sums = rows.groupBy(*[F.col(k).alias(f"total_{k}") for k in keys]).agg(*[v.alias(n) for n, v in totals.items()])
    if not keys:
        return rows.crossJoin(sums)  # one row
    return rows.join(sums, [F.col(k).eqNullSafe(F.col(f"total_{k}")) for k in keys]).drop(*[f"total_{k}" for k in keys])


def quantiles(rows: DataFrame, group: list[str], value: Column | str, shares: list[float], discrete: bool = False) -> DataFrame:
    """``(group..., quantiles array<double>)``: exact quantiles of the non-null values, by selection.

    Continuous ones lie between two values of neighbouring rank, discrete ones
    are the first value whose share of rows is reached.  Values are counted,
    the counts summed over value ranges, and the wanted ranks picked from the
    running sums, so a group of any size is never one task; without values, no
    row (without ``group``: one row of nulls).
    """
    value = F.col(value) if isinstance(value, str) else value
    each = rows.select(*group, value.cast("double").alias("quantile_value")).where("quantile_value is not null").groupBy(*group, "quantile_value").agg(F.count(F.lit(1)).alias("quantile_count"))
    placed = running_sum(each, group, ["quantile_value"], "quantile_count", "quantile_before")
    sized = with_totals(placed, group, quantile_rows=F.sum("quantile_count"))
    n, before, count = F.col("quantile_rows"), F.col("quantile_before"), F.col("quantile_count")
    # ranks from 0; a value holds those from before to below before + count
    holds = lambda rank: (before <= rank) & (rank < before + count)
    picked, found = [], []
    for k, share in enumerate(shares):
        if discrete:
            place = F.greatest(F.ceil(n * F.lit(share)) - 1, F.lit(0))
            picked.append(F.max(F.when(holds(place), F.col("quantile_value"))).alias(f"q{k}"))
            found.append(F.col(f"q{k}"))
        else:
            place = (n - 1) * F.lit(float(share))
            low, high = (F.max(F.when(holds(f(place)), F.col("quantile_value"))) for f in (F.floor, F.ceil))
            part = F.max(place - F.floor(place))
            picked += [low.alias(f"l{k}"), high.alias(f"h{k}"), part.alias(f"p{k}")]
            found.append(F.col(f"l{k}") + (F.col(f"h{k}") - F.col(f"l{k}")) * F.col(f"p{k}"))
    return sized.groupBy(*group).agg(*picked).select(*group, F.array(*found).alias("quantiles"))
