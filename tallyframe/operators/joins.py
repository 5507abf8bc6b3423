"""Joins: annotation, alignment of key sets, intervals, substrings and neighbours.

A side is broadcast only by Spark's own size check or where its size is fixed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_annotation(rows: DataFrame, annotation: DataFrame, key: str) -> DataFrame:
    """Left join; rows without annotation stay with nulls."""
    return rows.join(annotation, key, "left")


def remap_ids(rows: DataFrame, clusters: DataFrame, key: str) -> DataFrame:
    """Members of ``clusters(cluster, members array)`` get their cluster's id; others keep their own."""
    members = clusters.select("cluster", F.explode("members").alias("member"))
    return rows.join(members, F.col(key) == F.col("member"), "left").withColumn("mapped", F.coalesce("cluster", key)).drop("cluster", "member")


def check_keys(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Keys of ``rows`` that ``other`` lacks: empty if the check holds."""
    return rows.select(key).distinct().join(other, key, "left_anti")


def align_samples(counts: DataFrame, samples: DataFrame, strict: bool = True) -> DataFrame:
    """Inner join on sample ids; with ``strict`` a sample without counts is an error, looked for when this is called."""
    if strict and check_keys(samples, counts, "sample_id").take(1):
        raise ValueError("samples without counts")
    return counts.join(samples, "sample_id")


def align_features(counts: DataFrame, features: DataFrame) -> DataFrame:
    """Left join with ``missing``: whether a feature has no annotation."""
    marked = features.withColumn("known", F.lit(True))
    return counts.join(marked, "feature_id", "left").withColumn("missing", F.col("known").isNull()).drop("known")


def complete_grid(counts: DataFrame, fill: float = 0.0) -> DataFrame:
    """Every sample with every feature; absent values are ``fill``.  The result is as large as the wide matrix.

    Samples, the columns of the wide form, are one row of names beside each feature.
    """
    samples = counts.agg(F.array_sort(F.collect_set("sample_id")).alias("samples"))
    features = counts.select("feature_id").distinct()
    grid = features.crossJoin(F.broadcast(samples)).select("feature_id", F.explode("samples").alias("sample_id"))
    return grid.join(counts, ["sample_id", "feature_id"], "left").fillna(fill, ["value"])


def merge_calls(calls: DataFrame, callers: list) -> DataFrame:
    """One row per barcode, a column per caller; callers without a call are "unassigned"."""
    wide = calls.groupBy("barcode").pivot("caller", callers).agg(F.first("call"))
    names = [F.coalesce(F.col(f"`{c}`"), F.lit("unassigned")).alias(f"caller_{c}") for c in callers]
    return wide.select("barcode", *names)


def attach_one_to_one(rows: DataFrame, info: DataFrame, key: str, suffix: str) -> DataFrame:
    """Left join that fails, when it is called, on repeated keys of ``info``; its other columns get the suffix."""
    if info.groupBy(key).count().where("count > 1").take(1):
        raise ValueError(f"{key} is not unique")
    return rows.join(info.withColumnsRenamed({c: f"{c}{suffix}" for c in info.columns if c != key}), key, "left")


def semi_join_list(rows: DataFrame, keys: DataFrame, key: str, invert: bool = False) -> DataFrame:
    return rows.join(keys.select(key), key, "left_anti" if invert else "left_semi")


def overlap_join(a: DataFrame, b: DataFrame, bin_size: int, min_overlap: int = 1) -> DataFrame:
    """Pairs of half-open intervals (contig, start, stop) that share ``min_overlap`` positions or more.

    Bins are of ``bin_size`` positions on level 0 and ``WIDER`` times as many on
    each level above.  An interval's own level is the lowest whose bins are as
    long as it is, so it touches two bins at the most there and on any level
    above.  An interval stands on its own level and on those of the other side
    above it; a pair meets on the longer one's level and is emitted only in the
    bin of the later start, so it appears once and no theta join is needed.
    Intervals of a side with equal coordinates meet as blocks (:func:`_blocks`).
    """
    one, two = _levelled(a, "a", bin_size), _levelled(b, "b", bin_size)
    size = bin_size * F.pow(F.lit(float(WIDER)), F.col("a_level"))
    shared = F.least("a_stop", "b_stop") - F.greatest("a_start", "b_start")
    first = F.floor(F.greatest("a_start", "b_start") / size) == F.col("a_bin")
    held = (F.col("a_level") == F.greatest("a_own", "b_own")) & (shared >= min_overlap) & first
    mine, theirs = _visiting(one, "a", two, "b", bin_size, above=False), _visiting(two, "b", one, "a", bin_size, above=False)
    found = _unfolded(_paired(mine, "a", theirs, "b", held).withColumn("overlap", shared), "a", "b")
    return found.select(*_unpacked(a, "a"), *_unpacked(b, "b"), "overlap")


#: How much longer the bins of the next level are.
WIDER = 4


def _levelled(rows: DataFrame, side: str, bin_size: int) -> DataFrame:
    """Columns named by side, and ``own``, the lowest level whose bins are as long as the interval."""
    length = (F.col("stop") - F.col("start")).cast("double")
    own = F.greatest(F.lit(0.0), F.ceil(F.log(length / bin_size) / math.log(WIDER))).cast("int")
    return rows.where("start < stop").select(*[F.col(c).alias(f"{side}_{c}") for c in rows.columns], own.alias(f"{side}_own"))


def _bins(side: str, bin_size: int) -> Column:
    size = bin_size * F.pow(F.lit(float(WIDER)), F.col(f"{side}_level"))
    return F.explode(F.sequence(F.floor(F.col(f"{side}_start") / size), F.floor((F.col(f"{side}_stop") - 1) / size))).alias(f"{side}_bin")


def _waiting(rows: DataFrame, side: str, bin_size: int) -> DataFrame:
    """Intervals in the bins of their own level."""
    return rows.withColumn(f"{side}_level", F.col(f"{side}_own")).select("*", _bins(side, bin_size))


def _visiting(rows: DataFrame, side: str, others: DataFrame, other: str, bin_size: int, above: bool) -> DataFrame:
    """Intervals in the bins of their own level (``above``: not of that) and of every level above it that the other side has."""
    there = others.agg(F.collect_set(f"{other}_own").alias("levels_there"))  # one row of a few dozen numbers
    own = F.col(f"{side}_own")
    levels = F.filter("levels_there", lambda v: v > own)
    levels = levels if above else F.concat(F.array(own), levels)
    placed = rows.crossJoin(F.broadcast(there)).withColumn(f"{side}_level", F.explode(levels)).drop("levels_there")
    return placed.select("*", _bins(side, bin_size))


#: Rows of one place that a row of a join holds at most, and those of the side in the inner loop.
BLOCK = 1024
RUN = 256
#: Rows of a side of one bin that a task takes, about.
HELD = 32_768
#: What rows of a join are dealt by: the bin, and which parts of it meet.
BIN = ("contig", "level", "bin")
DEAL = (*BIN, "one", "two")


def _parts(rows: DataFrame) -> int:
    """Parts of a join: as many as Spark's shuffles have, however small the rows are, as what they yield isn't told by their size."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _split(one: DataFrame, a: str, two: DataFrame, b: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``one`` and ``two``: of a bin with more than ``HELD`` rows of a side, each part of one side meets each part of the other once.

    Rows go to parts by the hash of their values, and are repeated for each
    part of the other side.  Bins of several parts are one row for ``HELD``
    rows of a side at most.
    """

    def joined(rows: DataFrame, side: str, counted: DataFrame, of: str) -> DataFrame:
        count = F.ceil(F.count(F.lit(1)) / HELD).cast("int").alias(f"{of}_parts")
        large = counted.groupBy(*[F.col(f"{of}_{c}").alias(f"large_{c}") for c in BIN]).agg(count).where(f"{of}_parts > 1")
        same = [F.col(f"{side}_{c}") == F.col(f"large_{c}") for c in BIN]
        return rows.join(F.broadcast(large), same, "left").drop(*[f"large_{c}" for c in BIN]).fillna(1, f"{of}_parts")

    def dealt(rows: DataFrame, side: str, others: DataFrame, other: str, mine: str, theirs: str) -> DataFrame:
        values = [c for c, kind in rows.dtypes if "map<" not in kind]  # maps have no hash
        part = F.pmod(F.xxhash64(*values), f"{side}_parts").cast("int").alias(f"{side}_{mine}")
        parts = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)).alias(f"{side}_{theirs}")
        return joined(joined(rows, side, rows, side), side, others, other).select(*rows.columns, part, parts)

    return dealt(one, a, two, b, "one", "two"), dealt(two, b, one, a, "two", "one")


def _blocks(rows: DataFrame, side: str, most: int = BLOCK, deal: tuple[str, ...] = BIN) -> DataFrame:
    """Rows of a bin with the same start and stop as arrays ``rows`` of ``most`` at most, so a pair of places is compared once.

    They are numbered where they are dealt, so this takes no other shuffle.
    """
    keys = [f"{side}_{c}" for c in deal]
    place = [*keys, *[c for c in (f"{side}_start", f"{side}_stop", f"{side}_own") if c in rows.columns]]
    number = F.row_number().over(Window.partitionBy(*place).orderBy(f"{side}_start"))
    rest = [c for c in rows.columns if c not in place]
    numbered = rows.repartition(_parts(rows), *keys).withColumn("block", F.floor((number - 1) / most))
    return numbered.groupBy(*place, "block").agg(F.collect_list(F.struct(*rest)).alias(f"{side}_rows")).drop("block")


def _paired(outer: DataFrame, o: str, inner: DataFrame, i: str, held: Column) -> DataFrame:
    """Blocks of two sides that meet in a bin and for which ``held``, to be :func:`_unfolded`.

    They are dealt alike, so a merge takes no shuffle; it meets a block of the
    inner side with all of the outer one, one after the other.
    """
    outer, inner = _split(outer, o, inner, i)
    met = reduce(lambda x, y: x & y, [F.col(f"{o}_{c}") == F.col(f"{i}_{c}") for c in DEAL], held)
    return _blocks(inner, i, RUN, DEAL).join(_blocks(outer, o, BLOCK, DEAL).hint("merge"), met)


def _unfolded(pairs: DataFrame, o: str, i: str) -> DataFrame:
    """The pairs of rows of each pair of blocks: each row of the outer one with all of the inner.

    So a column of the outer side comes in runs of one value and one of the
    inner side as a short sequence over and over, which files of columns hold
    in a part of a byte for each pair.  The transform changes nothing, but
    keeps Spark from compiling both loops and the join as one, which would hold
    all pairs of a block with its bin in memory at once; so it holds ``RUN``.
    """
    return pairs.withColumn(f"{o}_row", F.explode(F.transform(f"{o}_rows", lambda r: r))).withColumn(f"{i}_row", F.explode(f"{i}_rows"))


def _unpacked(rows: DataFrame, side: str) -> list[Column]:
    """The columns of one row of :func:`_blocks`."""
    return [F.col(f"{side}_{c}") if c in ("contig", "start", "stop") else F.col(f"{side}_row.{side}_{c}").alias(f"{side}_{c}") for c in rows.columns]


def point_in_interval(points: DataFrame, intervals: DataFrame, bin_size: int) -> DataFrame:
    """Points (contig, pos) with each interval that holds them.

    Points of one position meet intervals of one place as blocks; the points
    are in the inner loop, as there are usually more of them.
    """
    two = _levelled(intervals, "i", bin_size)
    there = two.agg(F.collect_set("i_own").alias("levels_there"))  # one row of a few dozen numbers
    size = bin_size * F.pow(F.lit(float(WIDER)), F.col("p_level"))
    one = points.where("pos is not null").select(*[F.col(c).alias(f"p_{c}") for c in points.columns if c != "pos"], F.col("pos").alias("p_start"))
    one = one.crossJoin(F.broadcast(there)).withColumn("p_level", F.explode("levels_there")).drop("levels_there").withColumn("p_bin", F.floor(F.col("p_start") / size))
    held = (F.col("p_start") >= F.col("i_start")) & (F.col("p_start") < F.col("i_stop"))
    found = _unfolded(_paired(_waiting(two, "i", bin_size), "i", one, "p", held), "i", "p")
    mine = {"contig": "p_contig", "pos": "p_start"}
    return found.select(*[F.col(mine.get(c, f"p_row.p_{c}")).alias(c) for c in points.columns], *_unpacked(intervals, "i"))


def cluster_sizes(points: DataFrame, window: int) -> DataFrame:
    """Adds ``near``: points of the same contig within ``window`` positions before and after, itself included.

    Positions are counted first; each meets those of its own and the two
    neighbouring bins of ``window`` positions, so no window holds a contig.
    """
    per = points.groupBy("contig", "pos").agg(F.count(F.lit(1)).alias("n")).withColumn("bin", F.floor(F.col("pos") / (window or 1)))
    other = per.select("contig", F.col("pos").alias("near_pos"), "n", F.explode(F.array(F.col("bin") - 1, "bin", F.col("bin") + 1)).alias("bin"))
    sums = per.drop("n").join(other, ["contig", "bin"]).where(F.abs(F.col("pos") - F.col("near_pos")) <= window).groupBy("contig", "pos").agg(F.sum("n").alias("near"))
    return points.join(sums, ["contig", "pos"])


#: Letters of a seed by which texts and probes of twice as many letters or more meet.
SEED = 16


def contains_join(reads: DataFrame, panel: DataFrame, seed: int = SEED) -> DataFrame:
    """``(read_id, probe)`` where a read's text contains a probe, each pair of different ones once.

    A probe of ``2 * n - 1`` letters or more covers one of the consecutive
    pieces of ``n`` letters of a text that contains it, so texts and probes
    meet on such pieces and are then compared.  Probes are taken together by
    length, each group from one length to less than twice of it, the longest
    with pieces of ``seed`` letters; their lengths up to ``2 * seed - 1`` are
    asked for when the query is built.
    """
    probes = panel.select("probe").where("probe is not null").distinct()
    top = 2 * seed - 1
    lengths = [r[0] for r in probes.select(F.least(F.length("probe"), F.lit(top)).alias("n")).distinct().orderBy("n").collect()]
    found = reads.where("text = ''").select("read_id", F.col("text").alias("probe")).limit(0)
    while lengths:
        low = lengths[0]
        high = low if low == 0 else min(2 * low, top) - 1 if low < top else None
        lengths = [n for n in lengths if high is not None and n > high]
        some = probes.where(F.length("probe") >= low) if high is None else probes.where(F.length("probe").between(low, high))
        if low == 0:
            found = found.unionByName(reads.where("text is not null").select("read_id", F.lit("").alias("probe")))
            continue
        size = (low + 1) // 2
        pieces = F.array_distinct(F.regexp_extract_all("text", F.lit(f"(?s).{{{size}}}"), F.lit(0)))
        mine = reads.select("read_id", F.explode(pieces).alias("piece"))
        theirs = some.select("probe", F.explode(kmers(F.col("probe"), size)).alias("piece"))
        met = mine.join(theirs, "piece").select("read_id", "probe").distinct()
        found = found.unionByName(reads.join(met, "read_id").where(F.col("text").contains(F.col("probe"))).select("read_id", "probe"))
    return found.distinct()


def kmers(text: Column, k: int) -> Column:
    """Distinct substrings of length k, cut from the text's characters."""
    return F.array_distinct(all_kmers(text, k))


def all_kmers(text: Column, k: int) -> Column:
    """Substrings of length k in order; none for shorter and null texts.

    An empty match looks ahead at each place, so a text is read once; places
    inside a surrogate pair are no places.
    """
    found = F.regexp_extract_all(text, F.lit(rf"(?s)(?!\p{{InLow_Surrogates}})(?=(.{{{k}}}))"), 1)
    return F.coalesce(found, F.array().cast("array<string>"))


def ngram_screen(docs: DataFrame, panel: DataFrame, k: int) -> DataFrame:
    """``(panel_id, hits, share)``: documents that share a k-mer with each panel entry.

    A shared k-mer covers one of the consecutive pieces of ``(k + 1) // 2``
    letters of the document, so only pieces are shuffled: they meet the panel's
    substrings of that length, and the letters around both decide.
    """
    size = (k + 1) // 2
    piece = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    around = lambda p, x, i: F.struct(x.alias("piece"), F.coalesce(F.get(p, i - 1), F.lit("")).alias("left"), F.coalesce(F.get(p, i + 1), F.lit("")).alias("right"))
    mine = docs.select("read_id", piece.alias("p")).select("read_id", F.explode(F.transform("p", lambda x, i: around(F.col("p"), x, i))).alias("s")).select("read_id", "s.*").where(F.length("piece") == size)
    cut = panel.select("panel_id", "text", all_kmers(F.col("text"), size).alias("p"))
    before = lambda i: F.coalesce(F.get("p", i - size), F.substring(F.col("text"), F.lit(1), i))
    after = lambda i: F.coalesce(F.get("p", i + size), F.substring(F.col("text"), i + size + 1, F.lit(size)))
    placed = F.transform("p", lambda x, i: F.struct(x.alias("piece"), before(i).alias("before"), after(i).alias("after")))
    theirs = cut.select("panel_id", F.explode(F.array_distinct(placed)).alias("s")).select("panel_id", "s.*")
    rest = k - size
    same = lambda a, b, n, side: (F.length(a) >= n) & (F.length(b) >= n) & (F.call_function(side, F.col(a), n) == F.call_function(side, F.col(b), n))
    grown = F.exists(F.sequence(F.lit(0), F.lit(rest)), lambda n: same("left", "before", n, "right") & same("right", "after", F.lit(rest) - n, "left"))
    total = docs.agg(F.count(F.lit(1)).alias("n"))
    hits = mine.join(theirs, "piece").where(grown).groupBy("panel_id").agg(F.countDistinct("read_id").alias("hits"))
    return hits.crossJoin(F.broadcast(total)).select("panel_id", "hits", (F.col("hits") / F.col("n")).alias("share"))


def pairwise_self(counts: DataFrame) -> DataFrame:
    """``(a, b, feature_id, x, y)`` for sample pairs a < b that share a feature.

    A feature has at most samples squared pairs, as distances have rows: for
    tens or hundreds of samples, not for single cells.  Pairs are summed where
    they are made, so what is shuffled after that is one row a task and pair.
    """
    one = counts.select(F.col("sample_id").alias("a"), "feature_id", F.col("value").alias("x"))
    two = counts.select(F.col("sample_id").alias("b"), "feature_id", F.col("value").alias("y"))
    return one.join(two, "feature_id").where("a < b")


def cross_expand(rows: DataFrame, tags: list[str], column: str = "tag") -> DataFrame:
    """Each row once with every tag."""
    return rows.withColumn(column, F.explode(F.array(*[F.lit(t) for t in tags])))


def positional_align(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Columns of two tables by key (never by row order); keys of one side only are kept with nulls."""
    return a.join(b, key, "full")


def lookup_exons(exons: DataFrame, sequences: DataFrame) -> DataFrame:
    """``(gene, sequence)``: the sequences at (contig, start - 1, stop) of a gene's exons, in order of start."""
    keyed = exons.withColumn("from", F.col("start") - 1).join(sequences.withColumnRenamed("start", "from"), ["contig", "from", "stop"])
    parts = F.sort_array(F.collect_list(F.struct("start", "seq")))
    return keyed.groupBy("gene").agg(F.array_join(F.transform(parts, lambda x: x["seq"]), "").alias("sequence"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


#: Queries that a nearest-neighbour pass compares with all rows at once.
QUERY_BLOCK = 4096
#: Rows that are compared with a block of queries at a time: a task holds so many similarities of each.
ROW_BLOCK = 512


def knn(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k nearest of ``vectors(vec_id, embedding)`` to each query by cosine; ties go to the smaller id.

    Queries are a stated set, taken in blocks of about ``QUERY_BLOCK``: each
    block is one pass over the vectors in which a task keeps its own k best of
    every query.  With more than one block the passes' results are written, so
    the driver holds one block at a time.
    """
    from ..scratch import materialise

    n = -(-queries.count() // QUERY_BLOCK) or 1
    parts = []
    for part in range(n):
        asked = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == part).select("vec_id", "embedding").toArrow()
        found = _nearest(asked, vectors, k)
        parts.append(materialise(found, "nearest") if n > 1 else found)
    order = Window.partitionBy("vec_id").orderBy(F.desc(F.round("similarity", 9)), "neighbour")
    return reduce(lambda a, b: a.union(b), parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``ROW_BLOCK`` rows at the most, none empty."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROW_BLOCK):
            yield batch.slice(at, ROW_BLOCK)


def _nearest(asked: pa.Table, vectors: DataFrame, k: int) -> DataFrame:
    ids = asked.column("vec_id").to_numpy()
    q = np.array(asked.column("embedding").to_pylist(), dtype=float).reshape(len(ids), -1)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: dict[int, list] = {}
        for batch in _sliced(batches) if len(ids) else ():
            x = np.array(batch.column("embedding").to_pylist(), dtype=float)
            names = batch.column("vec_id").to_numpy()
            scores = q @ (x / np.linalg.norm(x, axis=1, keepdims=True)).T
            for row, own in enumerate(ids):
                s = np.where(names == own, -2.0, scores[row])
                some = np.lexsort((names, -np.round(s, 9)))[:k]
                top[row] = sorted([*top.get(row, []), *((-round(s[i], 9), int(names[i]), float(s[i])) for i in some if s[i] > -2)])[:k]
        rows = [(int(ids[r]), n, s) for r, found in top.items() for _, n, s in found]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], type=t) for c, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], ["vec_id", "neighbour", "similarity"])

    return vectors.select("vec_id", "embedding").mapInArrow(best, "vec_id long, neighbour long, similarity double")


def merge_layers(a: DataFrame, b: DataFrame, keys: list[str], names: tuple[str, str]) -> DataFrame:
    """Values of two matrices over the keys both have, one column for each layer."""
    return a.withColumnRenamed("value", names[0]).join(b.withColumnRenamed("value", names[1]), keys)


def manifest(files: DataFrame, pattern: str) -> DataFrame:
    """``(sample, forward, reverse)`` of paths whose pattern gives sample and mate; unpaired and empty files are left out."""
    parts = files.where("size > 0").select("path", F.regexp_extract("path", pattern, 1).alias("sample"), F.regexp_extract("path", pattern, 2).alias("mate"))
    pick = lambda m: F.min(F.when(F.col("mate") == m, F.col("path")))
    return parts.where("sample <> ''").groupBy("sample").agg(pick("1").alias("forward"), pick("2").alias("reverse")).where("forward is not null and reverse is not null")
