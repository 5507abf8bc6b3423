"""Nearest-neighbour lists of all vectors by descent over neighbours of neighbours, and the weighted graph of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import discard, materialise, written
from .ranges import numbered

#: Vectors compared with one another at the start of the descent.
LEAF = 256
_EDGE = pa.schema([("vec_id", pa.int64()), ("neighbour", pa.int64()), ("similarity", pa.float64())])


def neighbour_lists(vectors: DataFrame, k: int = 15, trees: int = 6, stop: float = 0.001, rounds: int = 20, seed: int = 1) -> DataFrame:
    """``(vec_id, neighbour, similarity, rank)``: about the k nearest of ``vectors(vec_id, embedding)`` to each of them, by cosine.

    Starts from leaves: vectors in the order of their signs to random planes
    through the mean, cut into runs of ``LEAF``, ``trees`` times with other
    planes.  A round compares the members of each vector's surroundings (its
    neighbours and at most k that name it) of which one is new, and keeps the k
    best.  It ends when a round changes fewer than ``stop`` of all places, or
    after ``rounds``.  Similarities are exact, the choice isn't: the tests ask
    for 0.95 of the places of exact lists.

    What is shuffled in a round is at most 2k + 1 vectors for each vector; a
    leaf or surroundings is the most a task compares at once, however many
    equal vectors there are.  Vectors that are null, zero or hold null or
    non-finite components get no list; a list is shorter than k only where
    fewer vectors are left.  Ids are unique; vectors of different lengths raise
    an error.  Equally near ones are ranked by a hash of the pair, so a group of
    equal vectors has no favourite.
    """
    spark = vectors.sparkSession
    value = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v")).where(F.col("vec_id").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    units = materialise(rows.withColumn("length", length).where("length > 0").select("vec_id", F.transform("v", lambda x: x / F.col("length")).alias("unit")), "units")
    n, short, long = units.agg(F.count(F.lit(1)), F.min(F.size("unit")), F.max(F.size("unit"))).first()
    if short != long:
        raise ValueError(f"vectors of {short} to {long} components")
    mean = [r[1] for r in units.select(F.posexplode("unit")).groupBy("pos").agg(F.avg("col")).orderBy("pos").collect()]
    found = [_leaves(units, np.array(mean), n, np.random.default_rng([seed, t]), k) for t in range(trees if n > LEAF else 1)]
    lists, path = written(_best(_union(found), k).withColumn("fresh", F.lit(True)), "lists")
    for _ in range(rounds if n > LEAF else 0):
        joined = _union([lists.select("vec_id", "neighbour", "similarity", F.lit(False).alias("fresh")), _round(lists, units, k).withColumn("fresh", F.lit(True))])
        (lists, new), old = written(_best(joined, k), "lists"), path
        discard(spark, old)
        path = new
        if lists.where("fresh").count() <= stop * n * k:
            break
    return lists.drop("fresh")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The k most similar of each vector, a pair counted once (and not fresh if it was there); tasks keep k before the shuffle."""
    flag = [F.min("fresh").alias("fresh")] if "fresh" in pairs.columns else []
    once = pairs.groupBy("vec_id", "neighbour").agg(F.max("similarity").alias("similarity"), *flag)
    order = Window.partitionBy("vec_id").orderBy(F.desc(F.round("similarity", 9)), F.xxhash64("vec_id", "neighbour"), "neighbour")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _leaves(units: DataFrame, mean: np.ndarray, n: int, rng: np.random.Generator, k: int) -> DataFrame:
    """Pairs within runs of ``LEAF`` vectors in the order of their signs."""
    bits = min(62, max(8, int(np.ceil(np.log2(max(n, 2) / LEAF))) + 6))
    planes = rng.normal(size=(len(mean), bits))
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)

    @F.pandas_udf("long")
    def signs(unit: pd.Series) -> pd.Series:
        if not len(unit):
            return pd.Series([], dtype="int64")
        return pd.Series(((np.stack(unit.to_numpy()) - mean) @ planes > 0) @ weights)

    placed = numbered(units.withColumn("signs", signs("unit")), "signs", "vec_id", name="place")
    leaf = F.floor((F.col("place") - 1) / LEAF).cast("long")
    return _compared(placed.select(leaf.alias("key"), F.col("vec_id").alias("member"), F.lit(True).alias("fresh"), F.lit(-2.0).alias("least"), "unit"), k)


def _round(lists: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """Pairs within the surroundings of each vector that beat the last place of a list."""
    forward = lists.select(F.col("vec_id").alias("key"), F.col("neighbour").alias("member"), "fresh")
    order = Window.partitionBy("neighbour").orderBy(F.desc("fresh"), F.xxhash64("vec_id", "neighbour"), "vec_id")
    backward = lists.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k).select(F.col("neighbour").alias("key"), F.col("vec_id").alias("member"), "fresh")
    own = units.select(F.col("vec_id").alias("key"), F.col("vec_id").alias("member"), F.lit(False).alias("fresh"))
    around = _union([forward, backward, own]).repartition("key").groupBy("key", "member").agg(F.max("fresh").alias("fresh"))
    # two members that are both old were compared before, so surroundings without a new one send no vectors
    around = around.withColumn("any", F.max("fresh").over(Window.partitionBy("key"))).where("any").drop("any")
    least = lists.groupBy(F.col("vec_id").alias("member")).agg(F.when(F.count(F.lit(1)) >= k, F.min("similarity")).otherwise(-2.0).alias("least"))
    known = units.withColumnRenamed("vec_id", "member").join(least, "member", "left").fillna(-2.0, ["least"])
    return _compared(around.join(known, "member").select("key", "member", "fresh", "least", "unit"), k)


def _compared(rows: DataFrame, k: int) -> DataFrame:
    """Within each key, up to k other members for a member that are more similar than its ``least``, one of the two being fresh."""
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(lambda batches: _pairs(batches, k), "vec_id long, neighbour long, similarity double")


def _pairs(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Keys come in order; the last one of a batch may go on in the next, so its rows wait."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        rest = part if rest is None else pa.concat_tables([rest, part])
        last = np.flatnonzero(np.diff(rest.column("key").to_numpy()))
        if len(last):
            yield _keys(rest.slice(0, last[-1] + 1), k)
            rest = rest.slice(last[-1] + 1)
    if rest is not None and rest.num_rows:
        yield _keys(rest, k)


def _keys(rows: pa.Table, k: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    key, member, fresh, least = (rows.column(c).to_numpy() for c in ("key", "member", "fresh", "least"))
    unit = rows.column("unit").combine_chunks()
    unit = unit.chunk(0) if isinstance(unit, pa.ChunkedArray) else unit
    x = unit.flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)
    edges = np.r_[0, np.flatnonzero(np.diff(key)) + 1, rows.num_rows]
    found = []
    for a, b in zip(edges, edges[1:]):
        s = x[a:b] @ x[a:b].T
        s[~(fresh[a:b, None] | fresh[None, a:b])] = -3.0
        np.fill_diagonal(s, -3.0)
        take = min(k, b - a)
        top = np.argpartition(-s, take - 1, axis=1)[:, :take]
        near = np.take_along_axis(s, top, axis=1)
        i, j = np.nonzero(near > np.maximum(least[a:b, None], -2.5))
        found.append((member[a + i], member[a + top[i, j]], near[i, j]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[c] for f in found]), type=t) for c, t in enumerate(_EDGE.types)], schema=_EDGE)


def neighbour_graph(lists: DataFrame, steps: int = 48) -> DataFrame:
    """``(a, b, weight)``: a symmetric graph of lists ``(vec_id, neighbour, similarity)``, each edge once with a < b.

    A vector's nearest neighbour above distance zero has weight 1 and the
    others exp(-(distance beyond it) / width), the width such that a list of k
    sums up to log2(k).  An edge named from both sides gets a + b - a * b.
    """
    at = F.struct((1 - F.col("similarity")).alias("distance"), "neighbour")
    rows = lists.groupBy("vec_id").agg(F.sort_array(F.collect_list(at)).alias("near"))
    distances = F.transform("near", lambda x: F.greatest(x["distance"], F.lit(0.0)))

    @F.pandas_udf("array<double>")
    def weights(found: pd.Series) -> pd.Series:
        return pd.Series([_weights(np.asarray(d, dtype=float), steps) for d in found])

    edges = rows.select("vec_id", F.explode(F.arrays_zip(F.col("near.neighbour").alias("neighbour"), weights(distances).alias("w"))).alias("e"))
    each = edges.select(F.least("vec_id", "e.neighbour").alias("a"), F.greatest("vec_id", "e.neighbour").alias("b"), F.col("e.w").alias("w"))
    both = F.when(F.count(F.lit(1)) > 1, F.min("w") * F.max("w")).otherwise(0.0)
    return each.groupBy("a", "b").agg((F.sum("w") - both).alias("weight"))


def _weights(d: np.ndarray, steps: int) -> np.ndarray:
    """Weights of one list; a width is at least a thousandth of the mean distance."""
    beyond = np.maximum(d - (d[d > 0].min() if (d > 0).any() else 0.0), 0.0)
    if not beyond.any():
        return np.ones(len(d))
    # a sum over k of terms up to 1 that rises with the width; the nearest adds 1, so log2(k) lies within reach
    low, high, goal = 0.0, 1.0, np.log2(len(d))
    while np.exp(-beyond / high).sum() < goal:
        high *= 2
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (low, mid) if np.exp(-beyond / mid).sum() >= goal else (mid, high)
    return np.exp(-beyond / max(high, 1e-3 * d.mean()))
