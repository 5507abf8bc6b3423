"""Principal components of tables with many samples: scores and loadings.

A randomised range finder: the side of which there are fewer, features or
samples, keeps a matrix of its members x (components and some more), which each
pass over the members of the other side multiplies by the centred table and its
transpose until the space stands still.  The longer side is never squared or
gathered: its triangular factor comes from a QR of every run of rows and a tree
of QRs over these.  What the driver and each task hold grows with the shorter
side, not with the longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .ranges import running_sum

#: Directions beyond the wanted ones.
MORE = 10
#: Passes at the most, and the largest change of a wanted direction (sine of the angle) at which they end.
PASSES = 60
STILL = 1e-8
#: Triangular factors that are stacked at once.
FAN = 64
#: Rows that are multiplied at once.
RUN = 1024


def _packed(counts: DataFrame, long: str, short: str) -> tuple[DataFrame, DataFrame]:
    """The longer side as rows ``(long, at, x, mean)`` of places, values and their mean, the shorter as ``(place, short, total)``."""
    rows = counts.where(F.col("value") != 0).select(long, short, F.col("value").cast("double").alias("value"))
    sums = counts.groupBy(short).agg(F.sum(F.coalesce(F.col("value").cast("double"), F.lit(0.0))).alias("total"))
    names = materialise(running_sum(sums, [], [short], F.lit(1), "place"), "pca-places")
    placed = rows.join(names.select(short, "place"), short).groupBy(long).agg(F.collect_list(F.struct("place", "value")).alias("cells"), F.sum("value").alias("sum"))
    every = counts.select(long).distinct().join(placed, long, "left")
    empty = F.array().cast("array<struct<place:int,value:double>>")
    packed = every.withColumn("cells", F.coalesce(F.col("cells").cast("array<struct<place:int,value:double>>"), empty))
    mean = F.coalesce(F.col("sum"), F.lit(0.0)) / F.lit(max(names.count(), 1))
    return materialise(packed.select(long, F.col("cells.place").alias("at"), F.col("cells.value").alias("x"), mean.alias("mean")), "pca-rows"), names


class _Shift:
    """What centring takes from a row of the longer side: the features' means, or a feature's own mean from all samples."""

    def __init__(self, means: np.ndarray | None, n: int):
        self.own, self.along = means is None, np.ones(n) if means is None else means

    def times(self, part: pa.RecordBatch) -> np.ndarray:
        return part.column("mean").to_numpy() if self.own else np.ones(part.num_rows)


def _runs(batches: Iterator[pa.RecordBatch], w: np.ndarray, shift: _Shift) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each run of rows: the batch, the cells' rows, places and values, and the run's product with ``w``, centred."""
    off = shift.along @ w
    for batch in batches:
        for k in range(0, batch.num_rows, RUN):
            part = batch.slice(k, RUN)
            of = np.repeat(np.arange(part.num_rows), part.column("at").value_lengths().to_numpy())
            at, x = part.column("at").flatten().to_numpy(), part.column("x").flatten().to_numpy()
            y = -np.outer(shift.times(part), off)
            np.add.at(y, of, x[:, None] * w[at])
            yield part, of, at, x, y


def _multiplied(packed: DataFrame, w: np.ndarray, shift: _Shift) -> np.ndarray:
    """The centred table's transpose times the table times ``w``: summed in each task, then by place."""
    spark, (p, width) = packed.sparkSession, w.shape
    shared = spark.sparkContext.broadcast((w, shift))
    names = [f"c{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shift = shared.value
        z, total, some = np.zeros((p, width)), np.zeros(width), False
        for part, of, at, x, y in _runs(batches, own, shift):
            np.add.at(z, at, x[:, None] * y[of])
            total, some = total + shift.times(part) @ y, True
        if some:
            z = np.vstack([z, total])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p + 1, dtype=np.int32)), *map(pa.array, z.T.copy())], ["place", *names])

    sums = packed.mapInArrow(run, "place int, " + ", ".join(f"{c} double" for c in names)).groupBy("place").agg(*[F.sum(c).alias(c) for c in names])
    z = np.zeros((p + 1, width))
    table = sums.toArrow()
    z[table.column("place").to_numpy()] = np.stack([table.column(c).to_numpy() for c in names], axis=1)
    return z[:p] - np.outer(shift.along, z[p])


def _triangle(packed: DataFrame, w: np.ndarray, shift: _Shift) -> np.ndarray:
    """Triangular factor of the centred table times ``w``, by a tree of QRs."""
    width = w.shape[1]
    shared = packed.sparkSession.sparkContext.broadcast((w, shift))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shift = shared.value
        r = np.zeros((0, width))
        for *_, y in _runs(batches, own, shift):
            r = np.linalg.qr(np.vstack([r, y]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], type=pa.binary())], ["r"])

    def stacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            for one in batch.column("r").to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(one).reshape(-1, width)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], type=pa.binary())], ["r"])

    at = materialise(packed.mapInArrow(leaves, "r binary"), "pca-factors")
    n = at.count()
    while n > FAN:
        n = -(-n // FAN)
        at = materialise(at.repartition(n).mapInArrow(stacked, "r binary"), "pca-factors")
    r = np.vstack([np.frombuffer(x.r).reshape(-1, width) for x in at.collect()] + [np.zeros((1, width))])
    return np.linalg.qr(r, mode="r")


def _orthonormal(basis: DataFrame, k: int) -> np.ndarray:
    """What turns the rows' ``b``, k columns over the longer side, into orthonormal columns, the first ones kept most: Cholesky of their products, twice."""
    turn = np.eye(k)
    for _ in range(2):
        shared = basis.sparkSession.sparkContext.broadcast(turn)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            gram = np.zeros((k, k))
            for batch in batches:
                b = batch.column("b").flatten().to_numpy().reshape(-1, k) @ shared.value
                gram += b.T @ b
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k, dtype=np.int32)), pa.array(gram.ravel())], ["at", "g"])

        table = basis.mapInArrow(run, "at int, g double").groupBy("at").agg(F.sum("g").alias("g")).toArrow()
        gram = np.zeros(k * k)
        gram[table.column("at").to_numpy()] = table.column("g").to_numpy()
        turn = turn @ np.linalg.inv(np.linalg.cholesky(gram.reshape(k, k)).T)
    return turn


def _long_loadings(packed: DataFrame, w: np.ndarray, shift: _Shift, sizes: np.ndarray, kind: str) -> tuple[DataFrame, np.ndarray]:
    """``(feature_id, l array<double>)`` of the features as the longer side, and the signs taken into it; ``w`` are the samples' directions.

    Components without variance get directions of no cell, from hashes of the ids.
    """
    k = w.shape[1]
    real = sizes > 1e-13 * max(sizes.max(initial=0.0), 1e-300)
    shared = packed.sparkSession.sparkContext.broadcast((w, shift, np.where(real, sizes, 1.0)))
    drawn = F.array(*[F.xxhash64(F.lit(c), "feature_id").cast("double") / 2.0**63 for c in range(k)])

    def based(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shift, by = shared.value
        for part, *_, y in _runs(batches, own, shift):
            h = part.column("drawn").flatten().to_numpy().reshape(-1, k)
            b = np.where(real, y / by, h)
            yield pa.RecordBatch.from_arrays([part.column("feature_id"), pa.ListArray.from_arrays(np.arange(0, b.size + 1, k, dtype=np.int32), pa.array(b.ravel()))], ["feature_id", "b"])

    basis = materialise(packed.withColumn("drawn", drawn).mapInArrow(based, f"feature_id {kind}, b array<double>"), "pca-basis")
    turned = packed.sparkSession.sparkContext.broadcast(_orthonormal(basis, k))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column("b").flatten().to_numpy().reshape(-1, k) @ turned.value
            yield pa.RecordBatch.from_arrays([batch.column("feature_id"), pa.ListArray.from_arrays(np.arange(0, b.size + 1, k, dtype=np.int32), pa.array(b.ravel()))], ["feature_id", "l"])

    loadings = basis.mapInArrow(turn, f"feature_id {kind}, l array<double>")
    greatest = [F.min(F.struct((-F.round(F.abs(F.get("l", F.lit(c))), 9)).alias("size"), "feature_id", F.get("l", F.lit(c)).alias("l"))).alias(f"g{c}") for c in range(k)]
    signs = np.array([-1.0 if g.l < 0 else 1.0 for g in loadings.agg(*greatest).first()])
    return loadings.select("feature_id", F.transform("l", lambda v, i: v * F.get(F.lit(signs.tolist()), i)).alias("l")), signs


def principal_components(counts: DataFrame, k: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(sample_id, component, score, variance)`` and ``(feature_id, component, loading)`` of centred features.

    ``counts`` is (sample_id, feature_id, value); cells that are left out are 0.
    Components are numbered from 1 by falling variance (sum of squared scores);
    the loading of the greatest size is positive (of equal ones the first).
    There are at most as many as samples or features.  Runs jobs when called.
    """
    spark = counts.sparkSession
    sample_kind, feature_kind = (counts.schema[c].dataType.simpleString() for c in ("sample_id", "feature_id"))
    n, p = (counts.select(c).distinct().count() for c in ("sample_id", "feature_id"))
    k = min(k, n, p)
    if k < 1:
        none = spark.createDataFrame([], f"sample_id {sample_kind}, component int, score double, variance double")
        return none, spark.createDataFrame([], f"feature_id {feature_kind}, component int, loading double")
    wide = n <= p
    packed, names = _packed(counts, *(("feature_id", "sample_id") if wide else ("sample_id", "feature_id")))
    shift = _Shift(None, n)
    if not wide:
        table, means = names.select("place", "total").toArrow(), np.zeros(p)
        means[table.column("place").to_numpy()] = table.column("total").to_numpy() / n
        shift = _Shift(means, p)
    width = min(k + MORE, n, p)
    w = np.linalg.qr(np.random.default_rng(seed).standard_normal((min(n, p), width)))[0]
    last = None
    for _ in range(PASSES):
        z = _multiplied(packed, w, shift)
        # Ritz directions of this pass, the wanted ones first
        values, turn = np.linalg.eigh((w.T @ z + z.T @ w) / 2)
        top = w @ turn[:, ::-1][:, :k]
        if last is not None and np.linalg.norm(top - last @ (last.T @ top), axis=0)[values[::-1][:k] > 1e-12 * max(values[-1], 1e-300)].max(initial=0.0) < STILL:
            break
        last, w = top, np.linalg.qr(z)[0]
        if width == min(n, p) and _ >= 1:
            break
    _, sizes, turn = np.linalg.svd(_triangle(packed, w, shift))
    directions = (w @ turn.T)[:, :k]
    sizes = np.concatenate([sizes, np.zeros(k)])[:k]
    variance = sizes**2
    components = np.arange(1, k + 1, dtype=np.int32)

    def split(of: str, ids: pa.Array, values: np.ndarray, value: str, **more: np.ndarray) -> pa.RecordBatch:
        """A row for each member and component."""
        each = lambda v: pa.array(np.tile(v, len(ids)))
        columns = [ids.take(pa.array(np.repeat(np.arange(len(ids)), k))), each(components), pa.array(values.ravel()), *map(each, more.values())]
        return pa.RecordBatch.from_arrays(columns, [of, "component", value, *more])

    scores_kind, loadings_kind = f"sample_id {sample_kind}, component int, score double, variance double", f"feature_id {feature_kind}, component int, loading double"
    if wide:
        loadings, signs = _long_loadings(packed, directions, shift, sizes, feature_kind)
        held = spark.sparkContext.broadcast(directions * sizes * signs)

        def short_scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield split("sample_id", batch.column("sample_id"), held.value[batch.column("place").to_numpy()], "score", variance=variance)

        loadings = loadings.select("feature_id", F.posexplode("l").alias("component", "loading")).withColumn("component", F.col("component") + 1)
        return names.select("sample_id", "place").mapInArrow(short_scored, scores_kind), loadings
    directions *= np.where(directions[np.abs(directions).round(9).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    shared = spark.sparkContext.broadcast((directions, shift))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shift = shared.value
        for part, *_, y in _runs(batches, own, shift):
            yield split("sample_id", part.column("sample_id"), y, "score", variance=variance)

    def loaded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = shared.value
        for batch in batches:
            yield split("feature_id", batch.column("feature_id"), own[batch.column("place").to_numpy()], "loading")

    return packed.mapInArrow(scored, scores_kind), names.select("feature_id", "place").mapInArrow(loaded, loadings_kind)
