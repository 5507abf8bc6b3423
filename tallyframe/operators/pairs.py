"""Sums over the features that two samples share, for all pairs of samples, block by block.

Samples and features are numbered; a record holds the values of ``SAMPLES``
samples in ``FEATURES`` features.  Each pair of sample blocks is a place for
each run of ``PARTS`` records, to which the records of both blocks are sent, in
order of their features; there they are multiplied as matrices of the samples
they hold and added up, and the places' sums by pair are added by Spark.  So a
value is shuffled once for each block of samples, not once for each sample, and
what is shuffled per pair is one row for ``PARTS * FEATURES`` features.  A place
holds two records and its sums, however many features there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .ranges import running_sum

#: Samples of a block, features of a record, and records that one place adds up.
SAMPLES = 256
FEATURES = 1024
PARTS = 64
#: Sums over shared features: their number, of the first and second sample's values, squares, products, smaller values, squared differences.
SUMS = ("n", "x", "y", "xx", "yy", "xy", "low", "off")
#: Sample pairs of two records up to which smaller values and differences are taken for all features at once, and numbers taken at once.
FEW_PAIRS, AT_ONCE = 4096, 1 << 20


def _dense(sample: np.ndarray, feature: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The samples of one record, their values and presence."""
    kept, at = np.unique(sample, return_inverse=True)
    values, held = np.zeros((len(kept), FEATURES)), np.zeros((len(kept), FEATURES))
    values[at, feature] = value
    held[at, feature] = 1.0
    return kept, values, held


def block_sums(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], wanted: list[str]) -> dict[str, np.ndarray]:
    """The wanted sums of all sample pairs of two records over the same features."""
    (x, in_x), (y, in_y) = left, right
    plain = {"n": (in_x, in_y), "x": (x, in_y), "y": (in_x, y), "xx": (x * x, in_y), "yy": (in_x, y * y), "xy": (x, y)}
    out = {k: plain[k][0] @ plain[k][1].T for k in wanted if k in plain}
    rest = [k for k in wanted if k not in plain]
    for k in rest:
        out[k] = np.zeros((len(x), len(y)))
    both = np.flatnonzero(in_x.any(axis=0) & in_y.any(axis=0)) if rest else np.array([], dtype=int)
    pairs = len(x) * len(y)
    if pairs <= FEW_PAIRS:
        step = max(1, AT_ONCE // max(pairs, 1))
        for f in (both[i : i + step] for i in range(0, len(both), step)):
            u, v = x[:, None, f], y[None, :, f]
            met = (in_x[:, None, f] > 0) & (in_y[None, :, f] > 0)
            for k in rest:
                out[k] += (np.minimum(u, v) if k == "low" else (u - v) ** 2).sum(axis=2, where=met)
        return out
    for f in both.tolist():
        a, b = np.flatnonzero(in_x[:, f]), np.flatnonzero(in_y[:, f])
        u, v = x[a, f][:, None], y[b, f][None, :]
        for k in rest:
            out[k][np.ix_(a, b)] += np.minimum(u, v) if k == "low" else (u - v) ** 2
    return out


def pair_sums(counts: DataFrame, wanted: list[str]) -> DataFrame:
    """``(a, b, n, wanted...)`` for sample pairs a < b that share a feature; ``wanted`` are names of ``SUMS``.

    ``counts`` is (sample_id, feature_id, value), a feature once in a sample;
    rows with a null in any of these are left out.
    """
    rows = counts.where("sample_id is not null and feature_id is not null and value is not null").select("sample_id", "feature_id", F.col("value").cast("double").alias("value"))
    rows = materialise(rows, "pair-values")
    names = materialise(running_sum(rows.select("sample_id").distinct(), [], ["sample_id"], F.lit(1).cast("long"), "s"), "pair-samples")
    places = running_sum(rows.select("feature_id").distinct(), [], ["feature_id"], F.lit(1).cast("long"), "f")
    n_blocks = -(-names.count() // SAMPLES)
    cell = F.struct((F.col("s") % SAMPLES).cast("int").alias("s"), (F.col("f") % FEATURES).cast("int").alias("f"), "value")
    placed = rows.join(names, "sample_id").join(places, "feature_id")
    records = placed.groupBy((F.col("s") / SAMPLES).cast("long").alias("block"), (F.col("f") / FEATURES).cast("long").alias("part")).agg(F.collect_list(cell).alias("cells"))
    records = materialise(records, "pair-records")
    other = records.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_blocks - 1, 0)).cast("long"))))
    sent = other.select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("part") / PARTS).cast("long").alias("run"), "part", (F.col("block") > F.col("other")).alias("second"), "cells")
    wanted = list(dict.fromkeys(["n", *wanted]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total, first = None, {}, None

        def finished() -> Iterator[pa.RecordBatch]:
            if place is None or not total:
                return
            i, j, _ = place
            met = total["n"] > 0
            if i == j:
                met &= np.triu(np.ones_like(met), 1)
            a, b = np.nonzero(met)
            columns = [pa.array(a + i * SAMPLES), pa.array(b + j * SAMPLES), *[pa.array(total[k][a, b]) for k in wanted]]
            yield pa.RecordBatch.from_arrays(columns, ["sa", "sb", *wanted])

        for batch in batches:
            for r in range(batch.num_rows):
                at = tuple(batch.column(c)[r].as_py() for c in ("i", "j", "run"))
                if at != place:
                    yield from finished()
                    place, total, first = at, {}, None
                cells = batch.column("cells").slice(r, 1).flatten()
                record = batch.column("part")[r].as_py(), _dense(*(cells.field(k).to_numpy() for k in ("s", "f", "value")))
                pair = (record, record) if at[0] == at[1] else (first, record) if batch.column("second")[r].as_py() else None
                if pair is None:
                    first = record
                elif pair[0] is not None and pair[0][0] == pair[1][0]:
                    (one, *left), (two, *right) = pair[0][1], pair[1][1]
                    for k, v in block_sums(left, right, wanted).items():
                        total.setdefault(k, np.zeros((SAMPLES, SAMPLES)))[np.ix_(one, two)] += v
        yield from finished()

    dealt = sent.repartition("i", "j", "run").sortWithinPartitions("i", "j", "run", "part", "second")
    found = dealt.mapInArrow(run, "sa long, sb long, " + ", ".join(f"{k} double" for k in wanted))
    found = found.groupBy("sa", "sb").agg(*[F.sum(k).alias(k) for k in wanted])
    a, b = (names.select(F.col("s").alias(f"s{k}"), F.col("sample_id").alias(k)) for k in "ab")
    return found.join(a, "sa").join(b, "sb").select("a", "b", F.col("n").cast("long").alias("n"), *[k for k in wanted if k != "n"])
