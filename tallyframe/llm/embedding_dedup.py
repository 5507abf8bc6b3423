"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation is learned on a bounded sample so that the signs of the rotated,
centred unit vectors are balanced bits with a small quantisation error.  Codes
are cut into chunks of about log2(rows) - 3 bits, one table for each; two
vectors meet in a table if they agree on its chunk, as all pairs do that differ
in fewer bits than there are chunks.  The number of tables (and of further
rotations, where one code has too few chunks) follows from the recall wanted at
the threshold: a first number from the angle at the threshold, which grows
until pairs at the threshold meet often enough in the codes of the sample, as
centring widens angles where vectors share a direction.

Equal vectors are one: only distinct vectors are indexed, with the number of
rows that hold each.  In a bucket codes are compared first, by the Hamming
distance of all bits against the largest that pairs at the threshold show in
the sample (all but a thousandth of them); only vectors with such a partner
are joined with their components, and their pairs are reranked in double
precision.

Pairs are never rows.  A bucket is dealt into blocks of at most about
``BLOCK`` vectors, pairs of blocks are compared inside tasks, a pair is counted
only in the first table it shares, and a task sends one row per vector: its
number of links there and the smallest member of its linked group.  The number
of links of every vector is exact over the pairs found, so comparing a group of
different vectors that are all linked takes the square of its size.

Defined results: vectors that are null, zero or hold null or non-finite
components, or whose length isn't the sample's, link with nothing; ids may be
null or repeat; every row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, written
from .components import components

#: Vectors the rotation is learned on, chosen by hash; all vectors are indexed.
SAMPLE = 20_000
BLOCK = 256
#: Rows a task compares at once, by their codes and with their components; bounds memory only.
FLUSH_CODES, FLUSH_VECTORS = 40_000, 4_000
WORD = 64
#: Share of pairs at the threshold that the largest Hamming distance compared may leave out.
FAR = 0.001
#: Vectors of the sample whose pairs at the threshold measure the recall of a plan; bounds the driver's work only.
PROBES = 2_000


def learn_rotations(x: np.ndarray, words: int, rounds: int = 30, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection ``(dim, words * 64)`` for unit rows ``x``: principal axes, then learned rotations."""
    mean, dim = x.mean(axis=0), x.shape[1]
    centred = x - mean
    bits = min(dim, WORD)
    _, axes = np.linalg.eigh(centred.T @ centred / len(x))
    axes = axes[:, ::-1][:, :bits]
    low, rng, parts = centred @ axes, np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < words * WORD:
        rotation, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
        for _ in range(rounds):
            signs = np.where(low @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(low.T @ signs)
            rotation = u @ v
        parts.append(axes @ rotation)
    return mean, np.hstack(parts)[:, : words * WORD]


def plan_tables(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a chunk and number of tables for the wanted recall of pairs just at the threshold."""
    bits = int(np.clip(np.ceil(np.log2(max(rows, 2))) - 3, 8, 32))
    meet = (1 - np.arccos(threshold) / np.pi) ** bits
    return bits, max(2, int(np.ceil(np.log(1 - recall) / np.log(1 - meet))))


def threshold_pairs(x: np.ndarray, threshold: float, seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sets of pairs of unit vectors at the threshold: the sample's own near it, and made ones.

    Made pairs have a cosine of just ``threshold`` and differ in any direction
    or as two vectors of the sample do; the sample's own reach half way from
    the threshold to 1 and count if they are 100 or more.
    """
    rng = np.random.default_rng(seed)
    n = len(x)
    probe = x[rng.permutation(n)[:PROBES]]
    sets, most = [], 20 * PROBES
    left, right = [], []
    for at in range(0, len(probe), 250):
        cosine = probe[at : at + 250] @ x.T
        i, j = np.nonzero((cosine >= threshold) & (cosine <= (1 + threshold) / 2))
        if len(i) > most // 8:
            some = rng.permutation(len(i))[: most // 8]
            i, j = i[some], j[some]
        left.append(probe[at + i])
        right.append(x[j])
    if sum(map(len, left)) >= 100:
        sets.append((np.concatenate(left), np.concatenate(right)))
    for step in (rng.normal(size=probe.shape), x[rng.integers(n, size=len(probe))] - x[rng.integers(n, size=len(probe))]):
        step = step - np.einsum("ij,ij->i", step, probe)[:, None] * probe
        size = np.linalg.norm(step, axis=1)
        good = size > 1e-6
        if good.any():
            a = probe[good]
            sets.append((a, threshold * a + np.sqrt(max(0.0, 1 - threshold**2)) * step[good] / size[good][:, None]))
    return sets


def measured(pairs: list[tuple[np.ndarray, np.ndarray]], mean: np.ndarray, projection: np.ndarray, bits: int, tables: int) -> tuple[float, int]:
    """Share of pairs that meet in one table at least, in the set where it is smallest, and the distance to compare."""
    per, worst, far = WORD // bits, 1.0, 0
    for a, b in pairs:
        differ = ((a - mean) @ projection >= 0) != ((b - mean) @ projection >= 0)
        far = max(far, int(np.quantile(differ.sum(axis=1), 1 - FAR, method="higher")))
        meet = np.zeros(len(a), dtype=bool)
        for k in range(tables):
            at = WORD * (k // per) + bits * (k % per)
            meet |= ~differ[:, at : at + bits].any(axis=1)
        worst = min(worst, float(meet.mean()))
    return worst, far


class Codes:
    """A plan: bits of a chunk, number of tables, largest distance compared, mean and projection."""

    def __init__(self, x: np.ndarray, rows: int, threshold: float, recall: float) -> None:
        """Planned from the angle, then grown until the recall wanted is measured on the sample ``x``."""
        self.bits, self.tables = plan_tables(rows, threshold, recall)
        self.per, pairs = WORD // self.bits, threshold_pairs(x, threshold)
        while True:
            self.mean, self.projection = learn_rotations(x, -(-self.tables // self.per))
            found, self.far = measured(pairs, self.mean, self.projection, self.bits, self.tables)
            if found >= recall:
                return
            if self.tables >= rows:  # comparing all pairs costs no more: one table, one chunk, any distance
                self.tables, self.bits, self.far = 1, 0, WORD * self.projection.shape[1]
                return
            miss = np.log(1 - recall) / np.log(1 - found) if found > 0 else 2.0
            self.tables = min(max(rows, self.tables + 1), int(np.ceil(self.tables * np.clip(miss, 1 + 1 / self.tables, 2))))

    def of(self, x: np.ndarray) -> list[bytes]:
        return [r.tobytes() for r in np.packbits((x - self.mean) @ self.projection >= 0, axis=1, bitorder="little")]

    def chunk(self, codes: np.ndarray, k: int) -> np.ndarray:
        return codes[:, k // self.per] >> np.uint64(self.bits * (k % self.per)) & np.uint64((1 << self.bits) - 1)


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Valid vectors as doubles; None for those that link with nothing."""
    out = []
    for v in column.to_pylist():
        x = None if v is None or any(e is None for e in v) else np.array(v, dtype=float)
        out.append(x if x is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    return out


def _unit(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
    x = np.frombuffer(b"".join(batch.column("v").to_pylist()), dtype="<f8").reshape(batch.num_rows, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _runs(rows: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys in sorted rows."""
    n = rows.num_rows
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for k in keys:
        change |= np.diff(rows.column(k).to_numpy()) != 0
    cuts = np.flatnonzero(change) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [n]])


def _pairs(rows: pa.Table, plan: Codes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs inside each bucket of sorted rows whose codes are near enough, each in the first table it shares only."""
    t, p, q, own = (rows.column(n).to_numpy().astype(np.int64) for n in ("t", "p", "q", "own"))
    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), dtype="<u8").reshape(len(t), -1)
    starts, ends = _runs(rows, KEYS)
    after = np.repeat(ends, ends - starts) - np.arange(len(t)) - 1
    chunks = [plan.chunk(codes, k) for k in range(plan.tables)]
    step, active = 1, np.flatnonzero(after >= 1)
    while len(active):
        i, j = active, active + step
        far = sum(np.bitwise_count(codes[i, w] ^ codes[j, w]).astype(np.int32) for w in range(codes.shape[1]))
        near = (far <= plan.far) & ((p[i] == q[i]) | (own[i] != own[j]))
        i, j = i[near], j[near]
        first = np.full(len(i), plan.tables)
        for k in reversed(range(plan.tables)):
            first[chunks[k][i] == chunks[k][j]] = k
        mine = first == t[i]
        if mine.any():
            yield i[mine], j[mine]
        step += 1
        active = active[after[active] >= step]


KEYS = ["t", "chunk", "p", "q"]


def _by_runs(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Tables of about ``least`` sorted rows that end with a run of equal keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, least):
            held.append(batch.slice(at, least))
            if sum(b.num_rows for b in held) < least:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(_runs(table, KEYS)[0][-1])
            if cut:
                yield table.slice(0, cut).combine_chunks()
                held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def link_counts(distinct: DataFrame, coded: DataFrame, plan: Codes, threshold: float) -> DataFrame:
    """``(uid, links, root)``: partial counts of linked rows and linked group heads.

    ``distinct(uid, weight, code)`` has one row of each vector, ``coded(uid, v)`` its components.
    """
    spark = distinct.sparkSession
    shared = spark.sparkContext.broadcast(plan)  # a few numbers for each table and dimension

    def chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            n = batch.num_rows
            if n:
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype="<u8").reshape(n, -1)
                chunks = np.stack([plan.chunk(codes, k) for k in range(plan.tables)], axis=1).astype(np.int64)
                which = pa.array(np.repeat(np.arange(n), plan.tables))
                t = np.tile(np.arange(plan.tables, dtype=np.int32), n)
                yield pa.RecordBatch.from_arrays([batch.column("uid").take(which), batch.column("code").take(which), pa.array(t), pa.array(chunks.ravel())], ["uid", "code", "t", "chunk"])

    placed = distinct.select("uid", "code").mapInArrow(chunk_rows, "uid long, code binary, t int, chunk long")
    full = placed.groupBy("t", "chunk").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    dealt = (
        placed.join(full, ["t", "chunk"])
        .withColumn("nb", F.ceil(F.col("c") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("uid"), F.col("nb")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("t", "chunk", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "uid", "code")
    )

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_runs(batches, FLUSH_CODES):
            some = np.zeros(table.num_rows, dtype=bool)
            for i, j in _pairs(table, shared.value):
                some[i] = some[j] = True
            yield from table.filter(pa.array(some)).to_batches()

    schema = "t int, chunk long, p int, q int, own int, uid long, code binary"
    found = dealt.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(near, schema)
    rows = found.join(coded.select("uid", "v"), "uid").join(distinct.select("uid", "weight"), "uid")
    rows = rows.repartition(*KEYS).sortWithinPartitions(*KEYS)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_runs(batches, FLUSH_VECTORS):
            x, left, right = _unit(table), [], []
            for i, j in _pairs(table, shared.value):
                linked = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
                left.append(i[linked])
                right.append(j[linked])
            a, b = (np.concatenate(s) if s else np.zeros(0, dtype=np.int64) for s in (left, right))
            weight = table.column("weight").to_numpy()
            names, at = np.unique(table.column("uid").to_numpy(), return_inverse=True)
            count = np.bincount(np.concatenate([at[a], at[b]]), weights=np.concatenate([weight[b], weight[a]]), minlength=len(names)).astype(np.int64)
            root = names[_forest(len(names), at[a], at[b])]
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(count[some]), pa.array(root[some])], ["uid", "links", "root"])

    return rows.select(*KEYS, "own", "uid", "code", "weight", "v").mapInArrow(compare, "uid long, links long, root long")


def _coded(first: DataFrame, plan: Codes) -> DataFrame:
    """``first(uid, weight, v)`` with the plan's ``code``."""
    shared = first.sparkSession.sparkContext.broadcast(plan)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("weight"), batch.column("v"), pa.array(shared.value.of(_unit(batch)), type=pa.binary())], ["uid", "weight", "v", "code"])

    return first.mapInArrow(code, "uid long, weight long, v binary, code binary")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """``(id_col, n_links, component_id, kept)``: one row per vector.

    ``recall`` is that wanted of pairs exactly at ``threshold``; closer pairs
    are found more surely.  ``sample`` bounds the vectors the rotation is
    learned on and the number of tables is measured on.  Vectors are equal if
    128 bits of hashes of their components are.  Vectors of different lengths
    don't link; each length has an index of its own, one after the other.
    """
    kind = vectors.schema[id_col].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = [None if x is None else x.astype("<f8").tobytes() for x in _vectors(batch.column("v"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(v, type=pa.binary())], ["id", "v"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInArrow(pack, f"id {kind}, v binary")
    # rows without a vector get keys of their own, so that they are no hot key of the last joins
    keys = {"h": F.when(F.col("v").isNull(), F.col("uid")).otherwise(F.xxhash64("v")), "g": F.when(F.col("v").isNull(), F.lit(0)).otherwise(F.xxhash64(F.lit(1), "v"))}
    rows = materialise(rows.withColumn("uid", F.monotonically_increasing_id()).withColumns(keys), "vectors")
    valid = rows.where("v is not null")
    spark = vectors.sparkSession
    found = spark.createDataFrame([], "uid long, links long, root long")
    copies = materialise(valid.groupBy("h", "g").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min(F.octet_length("v")).alias("size")), "distinct-vectors")
    # a length with one vector only has nothing to compare
    for length in copies.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), "size").collect():
        own = copies.where(F.col("size") == length["size"])
        first = valid.join(own, valid.uid == own.rep).select("uid", "weight", "v")
        some = first.orderBy(F.xxhash64("v"), "uid").limit(sample).select("v").toArrow()
        plan = Codes(_unit(some), length["n"], threshold, recall)
        coded, path = written(_coded(first, plan), "vector-codes")
        found = found.union(materialise(link_counts(coded.select("uid", "weight", "code"), coded, plan, threshold), "vector-links"))
        discard(spark, path)
    counts = found.groupBy("uid").agg(F.sum("links").alias("n"))
    groups = materialise(components(found.select(F.col("uid").alias("a"), F.col("root").alias("b")), "vector-components"), "vector-groups")
    # of each distinct vector: links of a row of it, and the smallest id of its component's rows
    heads = copies.join(counts, copies.rep == counts.uid, "left").join(groups, copies.rep == groups.node, "left")
    heads = heads.select("h", "g", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    ids = rows.join(heads, ["h", "g"], "left").select("id", "n_links", F.coalesce("component", "uid").alias("component"))
    out = ids.join(ids.groupBy("component").agg(F.min("id").alias("component_id")), "component")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept"))
