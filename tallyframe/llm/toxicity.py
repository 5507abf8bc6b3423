"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Labelled rows of the training fold are the examples: all of them up to
``EXAMPLES``, beyond that those of the smallest hashes.  Terms are lower-cased
words of letters.  The index keeps the terms that tell the labels apart: those
whose likelihood ratio (G squared, one degree of freedom) over the examples is
at least twice the logarithm of the number of terms tried, so that chance finds
stay out, and at least ``GAIN`` for each example that holds it, so that common
words which lean a little to one label stay out too.  The vectors of long texts
aren't filler then, and texts without such terms have no neighbours to search.  Examples are numbered by label and length of their vectors
and cut into blocks; each block has its postings by term, and each term its
greatest weight in every block.

A text's terms and a block's greatest weights bound the cosine with each
example of the block.  Blocks are opened from the highest bound down, until no
bound reaches the k-th best cosine found, so the ``NEIGHBOURS`` nearest are
exact.  Their votes, weighted by closeness, and a vote for the share of toxic
examples give a raw score.  Calibration is a monotone table from raw scores to
shares, fitted to the examples' own votes without themselves.

The index is broadcast; ``EXAMPLES`` and ``TERMS`` bound it to 170 MB.  Every
document is scored where it stands, by its whole text.

Defined results: null text counts as empty; a text without a term of the index
has no neighbours and gets the calibrated share; a null id is held out; of
repeated label rows the greatest counts; repeated rows are examples as often as
they stand; without any example, scores are 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, materialise

#: Most labelled rows that are examples, and most terms: the bound of what is broadcast.
EXAMPLES = 16_384
TERMS = 1_024
#: Fewest examples that hold a kept term.
LEAST_EXAMPLES = 3
#: Least G squared of a kept term for each example that holds it; a term of toxic examples only has 4.5 where a tenth are.
GAIN = 0.2
NEIGHBOURS = 16
#: Examples in a block.
BLOCK = 64
#: Votes that the share of toxic examples counts for.
PRIOR_VOTES = 0.5
#: Bounds are sums in another order than cosines.
MARGIN = 1e-10
#: Cells of the calibration.
CELLS = 20
_WORDS = re.compile(r"[^\W\d_]+")


def held_out(id_col: str | Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text is divisible by ``folds``, and for null ids."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % folds == 0, F.lit(True))


def terms(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


class Index(NamedTuple):
    """Examples by number, with ids and labels; terms with their place and weight; postings by block, then term.

    The postings of block ``b`` stand in rows ``at[b] : at[b + 1]``.
    """

    ids: list
    labels: np.ndarray
    vocabulary: dict[str, int]
    idf: np.ndarray
    at: np.ndarray
    term: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    peaks: np.ndarray  # terms x blocks: the greatest weight

    def vector(self, words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a text and their weights, of length 1."""
        held = [t for t in map(self.vocabulary.get, words) if t is not None]
        found, times = np.unique(np.array(held, dtype=np.int64), return_counts=True)
        weights = (1 + np.log(times)) * self.idf[found]
        norm = np.sqrt(weights @ weights)
        return found, weights / norm if norm else weights

    def nearest(self, found: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of the greatest cosine above 0 and their cosines to twelve digits, ties by number; ``skip`` is no candidate."""
        best, cosine = np.zeros(0, dtype=np.int64), np.zeros(0)
        if not len(found) or not self.peaks.shape[1]:
            return best, cosine
        bound = weights @ self.peaks[found]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        query = np.zeros(len(self.idf))
        query[found] = weights
        opened, step = 0, 16
        while opened < len(order):
            some = order[opened : opened + step]
            if len(best) == k:
                if bound[some[0]] < cosine[-1] - MARGIN:
                    break
                # a block that can only tie has something to add if its numbers come first
                some = some[(bound[some] > cosine[-1] + MARGIN) | (some * BLOCK < best[-1])]
            numbers, scores = self._open(query, some)
            new = numbers != skip
            best, cosine = np.concatenate([best, numbers[new]]), np.concatenate([cosine, scores[new]])
            keep = np.lexsort((best, -cosine))[:k]
            best, cosine = best[keep], cosine[keep]
            opened, step = opened + step, 2 * step
        return best, cosine

    def _open(self, query: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Examples of the blocks ``some`` that share a term with the query, and their cosines."""
        size = self.at[some + 1] - self.at[some]
        rows = np.repeat(self.at[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
        scores = np.round(np.bincount(self.example[rows], query[self.term[rows]] * self.weight[rows]), 12)
        numbers = np.flatnonzero(scores)
        return numbers, scores[numbers]

    def vote(self, best: np.ndarray, cosine: np.ndarray) -> float:
        """Share of toxic votes; a neighbour's vote falls with its distance, and none counts more than 20."""
        closeness = cosine / (1.05 - np.minimum(cosine, 1.0))
        prior = self.labels.mean() if len(self.labels) else 0.0
        return float((closeness @ self.labels[best] + PRIOR_VOTES * prior) / (closeness.sum() + PRIOR_VOTES))


def build(ids: list, labels: list[int], counts: list[dict[str, int]], chosen: dict[str, int]) -> Index:
    """Index of examples, given the counts of their terms, and of ``chosen`` terms with the number of examples that hold each."""
    names = sorted(chosen)
    vocabulary = {t: k for k, t in enumerate(names)}
    idf = np.log1p(len(ids) / np.array([chosen[t] for t in names], dtype=float)) if names else np.zeros(0)
    vectors = []
    for c in counts:
        found = np.array(sorted(vocabulary[t] for t in c if t in vocabulary), dtype=np.int64)
        w = (1 + np.log([float(c[names[t]]) for t in found])) * idf[found] if len(found) else np.zeros(0)
        vectors.append((found, w / np.sqrt(w @ w) if len(w) else w))
    # like examples side by side: blocks of one label and of vectors that lead with the same term
    lead = [int(v[0][v[1].argmax()]) if len(v[0]) else -1 for v in vectors]
    order = sorted(range(len(ids)), key=lambda k: (-labels[k], lead[k], len(vectors[k][0]), str(ids[k])))
    example = np.concatenate([np.full(len(vectors[k][0]), n) for n, k in enumerate(order)] + [np.zeros(0, dtype=np.int64)]).astype(np.int64)
    term = np.concatenate([vectors[k][0] for k in order] + [np.zeros(0, dtype=np.int64)]).astype(np.int64)
    weight = np.concatenate([vectors[k][1] for k in order] + [np.zeros(0)])
    n_blocks = -(-len(ids) // BLOCK)
    by_block = np.lexsort((example, term, example // BLOCK))
    example, term, weight = example[by_block], term[by_block], weight[by_block]
    peaks = np.zeros((len(names), n_blocks))
    np.maximum.at(peaks, (term, example // BLOCK), weight)
    at = np.searchsorted(example // BLOCK, np.arange(n_blocks + 1))
    return Index([ids[k] for k in order], np.array([labels[k] for k in order], dtype=float), vocabulary, idf, at, term.astype(np.int32), example.astype(np.int32), weight, peaks)


def _counted(examples: DataFrame) -> DataFrame:
    """``(id, label, terms map<string,int>)`` of the examples' whole texts."""
    kind = examples.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            maps = [list(Counter(terms(t)).items()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(maps, type=pa.map_(pa.string(), pa.int32()))], ["id", "label", "terms"])

    return examples.mapInArrow(run, f"id {kind}, label int, terms map<string,int>")


def _only(counted: DataFrame, names: set[str]) -> DataFrame:
    """``counted`` with the terms ``names`` only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [[(t, c) for t, c in m if t in names] for m in batch.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(maps, type=pa.map_(pa.string(), pa.int32()))], ["id", "label", "terms"])

    return counted.mapInArrow(run, counted.schema)


def apart(n: Column, n1: Column, rows: float, ones: float) -> Column:
    """G squared of a term in ``n`` of ``rows`` examples, ``n1`` of them among the ``ones`` toxic ones."""
    cells = ((n1, n, ones), (n - n1, n, rows - ones), (F.lit(ones) - n1, F.lit(rows) - n, ones), (F.lit(rows - ones) - (n - n1), F.lit(rows) - n, rows - ones))
    return 2 * sum((F.when(seen > 0, seen * F.log(seen * rows / (line * column))).otherwise(0.0) for seen, line, column in cells), F.lit(0.0))


def sample(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str, text_col: str, label_col: str, most: int) -> DataFrame:
    """``(id, text, label)`` of the labelled training rows; the ``most`` of the smallest hashes if there are more."""
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("of")).agg(F.max(label_col).cast("int").alias("label"))
    rows = docs.where(train_rows).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # ids first: texts travel for the chosen only
    chosen = known.join(rows.select("id"), F.col("of") == F.col("id")).select("of", "label").distinct()
    chosen = chosen.orderBy(F.xxhash64(F.col("of").cast("string"), F.lit("toxicity")), "of").limit(most)
    return rows.join(F.broadcast(chosen), F.col("id") == F.col("of")).select("id", "text", "label")  # at most ``most`` rows


def train(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = EXAMPLES, most_terms: int = TERMS) -> Index:
    """The index of the examples.

    Terms are counted and chosen by Spark; what is gathered are the ``most``
    examples' counts of ``most_terms`` terms.  Where an id stands in several
    rows, the rows after the first ``most`` in order of hash are left out.
    """
    examples = sample(docs, labels, F.coalesce(train_rows, F.lit(False)), id_col, text_col, label_col, most)
    counted = materialise(_counted(examples), "toxicity-examples")
    n, toxic = (counted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0))).first()) or (0, 0)
    held = counted.select("label", F.explode(F.map_keys("terms")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("n1"))
    held = materialise(held.where((F.col("n") >= LEAST_EXAMPLES) & (F.col("n") < n)), "toxicity-terms")
    ratio = apart(F.col("n").cast("double"), F.col("n1").cast("double"), float(n), float(toxic))
    kept = held.withColumn("ratio", ratio).where((F.col("ratio") >= 2 * math.log(max(held.count(), 1))) & (F.col("ratio") >= GAIN * F.col("n")))
    chosen = {r.term: r.n for r in kept.orderBy(F.desc("ratio"), "term").limit(most_terms).collect()}
    rows = _only(counted, set(chosen)).orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("toxicity")), "id").limit(most).collect()
    return build([r.id for r in rows], [r.label for r in rows], [r.terms for r in rows], chosen)


class Calibration(NamedTuple):
    """A monotone table from raw scores to shares, read between its points."""

    raw: np.ndarray
    share: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.raw, self.share), 0, 1) if len(self.raw) else np.clip(raw, 0, 1)


def calibrated(raw: np.ndarray, labels: np.ndarray) -> Calibration:
    """Pool-adjacent-violators over at most ``CELLS`` cells of equal width; each cell counts one more example at its mean raw score."""
    points: list[list[float]] = []
    for cell in range(CELLS):
        own = (np.minimum(raw * CELLS, CELLS - 1).astype(int)) == cell
        if own.any():
            mean = raw[own].mean()
            points.append([own.sum() + 1.0, mean, (labels[own].sum() + mean) / (own.sum() + 1)])
            while len(points) > 1 and points[-2][2] > points[-1][2]:
                (a, x, s), (b, y, t) = points[-2:]
                points[-2:] = [[a + b, (a * x + b * y) / (a + b), (a * s + b * t) / (a + b)]]
    return Calibration(np.array([p[1] for p in points]), np.array([p[2] for p in points]))


def calibrate(index: Index, spark, k: int = NEIGHBOURS) -> Calibration:
    """Votes of each example's neighbours without itself, one task for each run of examples, against its label."""
    n = len(index.labels)
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        term = own.term.astype(np.int64)
        by_example = np.lexsort((term, own.example))
        edges = np.searchsorted(own.example[by_example], np.arange(n + 1))
        for batch in batches:
            numbers = batch.column("id").to_pylist()
            raw = []
            for e in numbers:
                rows = by_example[edges[e] : edges[e + 1]]
                raw.append(own.vote(*own.nearest(term[rows], own.weight[rows], k, skip=e)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(raw, type=pa.float64())], ["id", "raw"])

    rows = spark.range(0, n, 1, max(1, n // 1024)).mapInArrow(run, "id long, raw double").collect()
    rows.sort(key=lambda r: r.id)
    return calibrated(np.array([r.raw for r in rows], dtype=float), index.labels)


def score(docs: DataFrame, index: Index, calibration: Calibration, id_col: str = "doc_id", text_col: str = "text", k: int = NEIGHBOURS) -> DataFrame:
    """``(id_col, score, evidence array<struct<example,label,cosine>>)``: evidence are the nearest examples, nearest first."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in blocks(batches, "text"):
            raw, seen = [], []
            for text in batch.column("text").to_pylist():
                best, cosine = own.nearest(*own.vector(terms(text)), k)
                raw.append(own.vote(best, cosine))
                seen.append([{"example": own.ids[e], "label": int(own.labels[e]), "cosine": c} for e, c in zip(best.tolist(), cosine.tolist())])
            found = calibration(np.array(raw, dtype=float))
            evidence = pa.array(seen, type=pa.list_(pa.struct([("example", batch.schema.field("id").type), ("label", pa.int32()), ("cosine", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found), evidence], ["id", "score", "evidence"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, f"id {kind}, score double, evidence array<struct<example:{kind},label:int,cosine:double>>")
    return found.withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """:func:`score` of every document by the examples among ``train_rows`` (a Column over ``docs``), calibrated on these."""
    index = train(docs, labels, train_rows, id_col, text_col, label_col)
    return score(docs, index, calibrate(index, docs.sparkSession), id_col, text_col)
