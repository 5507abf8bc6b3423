"""Random draws of units from groups of counted features, by a splitting tree.

A group's features stand in order of their ids and are the leaves of a binary
tree.  A node's draws are split between its halves by one hypergeometric (with
replacement: binomial) variate, which is the inverse distribution function at a
uniform number from the md5 of seed, group, run, depth, level and index.  The
draws of the leaves then have exactly the distribution of drawing unit by unit,
totals are exact, and any engine can repeat them.

On Spark, ``FAN`` neighbours are one row: totals go up by aggregations, draws go
down by one join for each ``FAN``-fold of features.  A feature is read once for
a run that reaches it, however large its count is.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .ranges import running_sum

#: Binary levels in one row, and the children that it has at most.
BITS = 10
FAN = 1 << BITS
#: Terms of distribution functions that are held at once.
TERMS = 1 << 20


def variates(total: np.ndarray, left: np.ndarray, draws: np.ndarray, u: np.ndarray, replace: bool) -> np.ndarray:
    """How many of ``draws`` from ``total`` units fall on the ``left`` ones, for uniform ``u``.

    The distribution function is summed over twelve deviations to both sides of
    the mean, and twelve more; what lies beyond is below the rounding of ``u``.
    Needs 0 < left < total and draws > 0.
    """
    out = np.zeros(len(total), dtype=np.int64)
    share = left / total
    mean = draws * share
    spread = mean * (1 - share) if replace else mean * (1 - share) * (total - draws) / np.maximum(total - 1, 1)
    reach = 12 * np.sqrt(spread) + 12
    low = np.floor(mean - reach).astype(np.int64)
    high = np.ceil(mean + reach).astype(np.int64)
    low = np.maximum(low, 0 if replace else np.maximum(draws - (total - left), 0))
    high = np.minimum(high, draws if replace else np.minimum(draws, left))
    size = high - low + 1
    part = np.cumsum(size) // TERMS
    for k in np.unique(part):
        own = np.flatnonzero(part == k)
        n = size[own]
        first = np.cumsum(n) - n
        of = np.repeat(own, n)
        x = low[of] + np.arange(len(of)) - np.repeat(first, n)
        t, a, d = total[of].astype(float), left[of].astype(float), draws[of].astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            step = (d - x + 1) / x * a / (t - a) if replace else (a - x + 1) * (d - x + 1) / (x * (t - a - d + x))
            logs = np.log(step)
        logs[first] = 0.0
        logs = np.cumsum(logs)
        logs -= np.repeat(np.maximum.reduceat(logs, first), n)
        sums = np.cumsum(np.exp(logs))
        before = np.concatenate([[0.0], sums[first[1:] - 1]])
        whole = sums[first + n - 1] - before
        passed = (sums - np.repeat(before, n)) <= np.repeat(u[own] * whole, n)
        out[own] = np.minimum(low[own] + np.add.reduceat(passed.astype(np.int64), first), high[own])
    return out


def uniform(key: str) -> float:
    """52 bits of the key's md5, as a number from 0 to below 1."""
    return int(md5(key.encode()).hexdigest()[:13], 16) / 4503599627370496.0


def shared_out(totals: np.ndarray, draws: np.ndarray, keys: list[str], nodes: list[int], height: int, replace: bool) -> np.ndarray:
    """Draws of the ``FAN`` children in each row of ``totals``; row r is node ``nodes[r]``, ``height`` rows above the features."""
    sums = [totals]
    for _ in range(BITS):
        sums.append(sums[-1][:, ::2] + sums[-1][:, 1::2])
    at = draws.reshape(-1, 1)
    for up in range(BITS, 0, -1):
        total, left = sums[up], sums[up - 1][:, ::2]
        got = np.where(left == total, at, 0)
        if not replace:
            got = np.where(at == total, left, got)
        open_ = (left > 0) & (left < total) & (at > 0) & (replace | (at < total))
        row, k = np.nonzero(open_)
        level = BITS * height + up
        u = np.array([uniform(f"{keys[r]}:{level}:{(nodes[r] << BITS - up) + j}") for r, j in zip(row.tolist(), k.tolist())])
        got[row, k] = variates(total[row, k], left[row, k], at[row, k], u, replace)
        at = np.stack([got, at - got], axis=2).reshape(len(at), -1)
    return at


def _down(rows: DataFrame, height: int, replace: bool, kinds: str, child: str, kind: str) -> DataFrame:
    """From ``(grp, run, depth, key, node, draws, items)`` the children that got draws, named by ``child`` of their items, of type ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                items = part.column("items")
                of = np.repeat(np.arange(part.num_rows), items.value_lengths().to_numpy())
                flat = items.flatten()
                totals = np.zeros((part.num_rows, FAN), dtype=np.int64)
                place = flat.field("pos").to_numpy() % FAN
                totals[of, place] = flat.field("value").to_numpy()
                got = shared_out(totals, part.column("draws").to_numpy(), part.column("key").to_pylist(), part.column("node").to_pylist(), height, replace)[of, place]
                some = pa.array(np.flatnonzero(got))
                names = [part.column(c).take(pa.array(of)).take(some) for c in ("grp", "run", "depth", "key")]
                yield pa.RecordBatch.from_arrays([*names, flat.field(child).take(some), pa.array(got).take(some)], ["grp", "run", "depth", "key", "child", "draws"])

    return rows.select("grp", "run", "depth", "key", "node", "draws", "items").mapInArrow(run, f"{kinds}, key string, child {kind}, draws long")


def draw(counts: DataFrame, runs: DataFrame, group: str = "sample_id", seed: int = 0, replace: bool = False) -> DataFrame:
    """``(group, run, depth, feature_id, drawn)`` of the features that ``depth`` random units of a group fall on.

    ``counts`` is (group, feature_id, value): whole numbers above 0 count, a
    feature once in a group.  ``runs`` is (group, run, depth); without
    replacement, depths above a group's total are left out.  Null groups are a
    group.
    """
    kind = counts.schema[group].dataType.simpleString()
    run_kind = runs.schema["run"].dataType.simpleString()
    kinds = f"grp {kind}, run {run_kind}, depth long"
    rows = counts.where("value >= 1").select(F.col(group).alias("grp"), "feature_id", F.col("value").cast("long").alias("value"))
    placed = running_sum(rows, ["grp"], ["feature_id"], F.lit(1).cast("long"), "pos")
    up = lambda d, *item: d.groupBy("grp", F.shiftright("pos", BITS).alias("node")).agg(F.sort_array(F.collect_list(F.struct("pos", "value", *item))).alias("items"), F.sum("value").alias("total"))
    heights = [materialise(up(placed, "feature_id"), "draw-features")]
    while (heights[-1].agg(F.max("node")).first()[0] or 0) > 0:
        below = heights[-1].select("grp", F.col("node").alias("pos"), F.col("total").alias("value"))
        heights.append(materialise(up(below), "draw-nodes"))
    wanted = runs.select(F.col(group).alias("of"), "run", F.col("depth").cast("long").alias("depth")).where("depth > 0")
    top = heights[-1]
    at = wanted.join(top, F.col("of").eqNullSafe(F.col("grp")))
    at = (at if replace else at.where("depth <= total")).withColumn("draws", F.col("depth"))
    at = at.withColumn("key", F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("grp").cast("string"), F.lit("")), F.col("run").cast("string"), F.col("depth").cast("string")))
    for height in range(len(heights) - 1, 0, -1):
        found = _down(at, height, replace, kinds, "pos", "long").withColumnRenamed("grp", "of")
        at = found.join(heights[height - 1].withColumnRenamed("node", "below"), F.col("of").eqNullSafe(F.col("grp")) & (F.col("child") == F.col("below"))).withColumn("node", F.col("child"))
    found = _down(at, 0, replace, kinds, "feature_id", counts.schema["feature_id"].dataType.simpleString())
    return found.select(F.col("grp").alias(group), "run", "depth", F.col("child").alias("feature_id"), F.col("draws").alias("drawn"))


def draw_sql(counts: str, runs: str, group: str = "sample_id", seed: int = 0, replace: bool = False, levels: int = 30) -> str:
    """CTEs of DuckDB that end in ``drawn(group, run, depth, feature_id, drawn)``: the same tree, level by level.

    ``counts`` and ``runs`` are SELECTs of the tables of :func:`draw`; features
    of a group may be 2 ** ``levels`` at most.  Levels above all of a group draw
    nothing, so more of them give the same draws.
    """
    keys = f"{group}, run, depth, k"
    part = f"PARTITION BY {keys}"
    share = '("left" / total::DOUBLE)'
    spread = f"d * {share} * (1 - {share})" + ("" if replace else " * (total - d) / greatest(total - 1, 1)")
    low = "0" if replace else 'greatest(d - (total - "left"), 0)'
    high = "d" if replace else 'least(d, "left")'
    step = '(d - x + 1) / x::DOUBLE * "left" / (total - "left")' if replace else '("left" - x + 1) * (d - x + 1)::DOUBLE / (x * (total - "left" - d + x)::DOUBLE)'
    whole = "" if replace else ' WHEN n.d = n.total THEN n."left"'
    ctes = [
        f"draw_counts AS MATERIALIZED (SELECT {group}, feature_id, value::BIGINT AS value, row_number() OVER (PARTITION BY {group} ORDER BY feature_id) - 1 AS pos FROM ({counts}) WHERE value >= 1)",
        f"draw_sums AS MATERIALIZED (SELECT {group}, l::INTEGER AS level, pos >> l::INTEGER AS k, sum(value)::BIGINT AS total FROM draw_counts, range({levels + 1}) r(l) GROUP BY ALL)",
        f"draw_{levels} AS MATERIALIZED (SELECT r.{group}, run, depth::BIGINT AS depth, 0::BIGINT AS k, depth::BIGINT AS d FROM ({runs}) r" + ("" if replace else f" JOIN draw_sums s ON s.{group} = r.{group} AND level = {levels} AND depth <= total") + " WHERE depth > 0)",
    ]
    for level in range(levels, 0, -1):
        key = f"concat_ws(':', '{seed}', {group}, run, depth, '{level}', k)"
        ctes += [
            f'draw_n{level} AS MATERIALIZED (SELECT t.*, p.total, coalesce(c.total, 0) AS "left" FROM draw_{level} t JOIN draw_sums p ON p.{group} = t.{group} AND p.level = {level} AND p.k = t.k LEFT JOIN draw_sums c ON c.{group} = t.{group} AND c.level = {level - 1} AND c.k = 2 * t.k)',
            f"draw_w{level} AS (SELECT *, greatest(floor(d * {share} - 12 * sqrt({spread}) - 12)::BIGINT, {low}) AS a, least(ceil(d * {share} + 12 * sqrt({spread}) + 12)::BIGINT, {high}) AS b, ('0x' || substr(md5({key}), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM draw_n{level} WHERE \"left\" > 0 AND \"left\" < total{'' if replace else ' AND d < total'})",
            f'draw_l{level} AS (SELECT {keys}, a, b, u, x, sum(CASE WHEN x = a THEN 0 ELSE ln({step}) END) OVER ({part} ORDER BY x) AS lg FROM (SELECT *, unnest(range(a, b + 1)) AS x FROM draw_w{level}))',
            f"draw_e{level} AS (SELECT {keys}, a, b, u, x, exp(lg - max(lg) OVER ({part})) AS e FROM draw_l{level})",
            f"draw_c{level} AS (SELECT {keys}, a, b, u, sum(e) OVER ({part} ORDER BY x) AS cum, sum(e) OVER ({part}) AS whole FROM draw_e{level})",
            f"draw_x{level} AS (SELECT {keys}, least(any_value(a) + count(*) FILTER (cum <= u * whole), any_value(b)) AS got FROM draw_c{level} GROUP BY {keys})",
            f'draw_g{level} AS MATERIALIZED (SELECT n.*, CASE WHEN n."left" = n.total THEN n.d WHEN n."left" = 0 THEN 0{whole} ELSE got END AS got FROM draw_n{level} n LEFT JOIN draw_x{level} x USING ({keys}))',
            f"draw_{level - 1} AS MATERIALIZED (SELECT {group}, run, depth, 2 * k AS k, got AS d FROM draw_g{level} WHERE got > 0 UNION ALL SELECT {group}, run, depth, 2 * k + 1, d - got FROM draw_g{level} WHERE d > got)",
        ]
    ctes.append(f"drawn AS MATERIALIZED (SELECT t.{group}, run, depth, feature_id, d AS drawn FROM draw_0 t JOIN draw_counts c ON c.{group} = t.{group} AND c.pos = t.k)")
    return ",\n".join(ctes)
