"""Language identification by multilingual mixture inference.

A document's letter trigrams are draws from a mixture of the languages' trigram
distributions.  Expectation-maximisation estimates each document's language
proportions; the set of languages grows by one as long as the penalised
likelihood (BIC, over non-overlapping trigrams) rises.  The languages'
distributions are counted over all labelled training documents.

Only the model, languages x buckets numbers, is gathered and broadcast.  It
holds at most ``MODEL_CELLS`` of them: the trigrams' hash buckets are halved
until it does, so a table with very many labels gives coarser distributions,
yet of every label, and neither a task nor the driver holds more for it.

Defined results: text that is null or has no letter gives ``und`` with score 0
and no proportions; a null id counts as held out, since it has no fold; rows
with null ``lang`` teach nothing; repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks

#: Hash buckets of trigrams, the most that a model has.
BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Probabilities of a model: 128 MB; 512 languages have all buckets.
MODEL_CELLS = 1 << 24
#: Languages whose counts a task holds at once before it hands them on.
HELD_LANGUAGES = 256
EM_ROUNDS = 8


def held_out(id_col: str | Column) -> Column:
    """True where crc32 of the id as text leaves remainder 1 modulo 3, and for null ids."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % 3 == 1, F.lit(True))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Document number and bucket of each letter trigram; words are lower-cased and padded by a space."""
    lowered = [f" {t.lower()} " if t else " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    letter = _letters()[codes]
    keep = letter | np.concatenate(([True], letter[:-1] | (doc[1:] != doc[:-1])))
    codes, doc = np.where(letter, codes, 32)[keep].astype(np.uint32), doc[keep]
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    bucket = ((mixed ^ mixed >> np.uint32(15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(17)
    inside = (doc[:-2] == doc[2:]) & (codes[1:-1] != 32)
    return doc[:-2][inside], bucket[inside].astype(np.int64)


def gram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, bucket, n)`` over all rows with a language; counted in each task first."""

    def given(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), type=pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])], ["lang", "bucket", "n"])
        sums.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in blocks(batches, "text"):
            coded = batch.column("lang").dictionary_encode()
            doc, bucket = grams(batch.column("text").to_pylist())
            keys, counts = np.unique(coded.indices.to_numpy()[doc].astype(np.int64) * BUCKETS + bucket, return_counts=True)
            names = coded.dictionary.to_pylist()
            edges = np.searchsorted(keys, np.arange(len(names) + 1) * BUCKETS)
            for lang, a, b in zip(names, edges, edges[1:]):
                if lang not in sums:
                    if len(sums) == HELD_LANGUAGES:
                        yield from given(sums)
                    sums[lang] = np.zeros(BUCKETS, dtype=np.int64)
                sums[lang][keys[a:b] % BUCKETS] += counts[a:b]
        yield from given(sums)

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def buckets_of(languages: int) -> int:
    """Buckets of a model: ``BUCKETS``, halved until all languages fit in ``MODEL_CELLS``."""
    width = BUCKETS
    while width > 1 and width * languages > MODEL_CELLS:
        width //= 2
    return width


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their smoothed trigram probabilities, shape (languages, buckets).

    Buckets are as many as :func:`buckets_of` says; two halves of a bucket's number are folded onto each other.
    """
    width = buckets_of(docs.where(F.col(lang_col).isNotNull()).select(lang_col).distinct().count())
    folded = gram_counts(docs, text_col, lang_col).groupBy("lang", (F.col("bucket") % width).alias("bucket")).agg(F.sum("n").alias("n"))
    counted = folded.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).toArrow().sort_by("lang").combine_chunks()
    langs = counted.column("lang").to_pylist()
    table = np.full((len(langs), width), SMOOTHING)
    for lists, first in _lists(counted.column("counts")):
        cells = lists.flatten()
        of = first + np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        table[of, cells.field("bucket").to_numpy()] += cells.field("n").to_numpy()
    table /= table.sum(axis=1, keepdims=True)
    return langs, table


def _lists(column: pa.ChunkedArray) -> Iterator[tuple[pa.ListArray, int]]:
    """Chunks of a column with the number of their first row."""
    first = 0
    for chunk in column.chunks:
        yield chunk, first
        first += len(chunk)


def _em(theta: np.ndarray, probs: np.ndarray, count: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document after ``rounds`` steps; rows are sorted by document."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    total = np.add.reduceat(count, starts)
    for _ in range(rounds):
        joint = theta[of] * probs
        joint *= (count / joint.sum(axis=1))[:, None]
        theta = np.add.reduceat(joint, starts, axis=0) / total[:, None]
    return theta, np.add.reduceat(count * np.log(np.einsum("ij,ij->i", theta[of], probs)), starts)


def mixtures(texts: list[str | None], table: np.ndarray) -> np.ndarray:
    """Language proportions of each text, shape (texts, languages); all 0 for texts without letters."""
    out = np.zeros((len(texts), len(table)))
    doc, bucket = grams(texts)
    if not len(doc) or not len(table):
        return out
    width = table.shape[1]
    keys, count = np.unique(doc * width + bucket % width, return_counts=True)
    doc, bucket, count = keys // width, keys % width, count.astype(float)
    present, starts, sizes = np.unique(doc, return_index=True, return_counts=True)
    probs = table.T[bucket]
    uniform = np.full((len(present), len(table)), 1 / len(table))
    soft, _ = _em(uniform, probs, count, starts, sizes, EM_ROUNDS)
    single = np.add.reduceat(count[:, None] * np.log(probs), starts, axis=0)
    best = np.zeros_like(soft)
    best[np.arange(len(present)), single.argmax(axis=1)] = 1
    score = single.max(axis=1)
    penalty = np.log(np.maximum(np.add.reduceat(count, starts) / 3, 2)) / 2
    members = best > 0
    growing = np.arange(len(present))  # documents whose set may still gain a language
    for size in range(2, len(table) + 1):
        if not len(growing):
            break
        tried = np.argsort(-np.where(members[growing], 2.0, soft[growing]), axis=1)[:, :size]
        theta = np.zeros((len(growing), len(table)))
        np.put_along_axis(theta, tried, 1 / size, axis=1)
        rows = np.isin(doc, present[growing])
        theta, fit = _em(theta, probs[rows], count[rows], np.cumsum(sizes[growing]) - sizes[growing], sizes[growing], EM_ROUNDS)
        better = (fit - score[growing]) / 3 > penalty[growing]
        growing, theta, fit, tried = growing[better], theta[better], fit[better], tried[better]
        best[growing], score[growing] = theta, fit
        members[growing[:, None], tried] = True
    out[present] = best
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score, proportions map<string,double>)`` of every whole text."""
    langs, table = model
    limit = 8 * BLOCK_BYTES // max(8, len(langs))  # a block holds a number for each trigram and language
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text", limit):
            share = mixtures(batch.column("text").to_pylist(), shared.value)
            known = share.sum(axis=1) > 0 if len(langs) else np.zeros(len(share), dtype=bool)
            top = share.argmax(axis=1) if len(langs) else known
            pred = [langs[k] if ok else "und" for k, ok in zip(top, known)]
            score = share.max(axis=1) if len(langs) else np.zeros(len(share))
            maps = [[(langs[k], row[k]) for k in np.flatnonzero(row)] for row in share]
            columns = [batch.column("id"), pa.array(pred, type=pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(maps, type=pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "lang_pred", "score", "proportions"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, proportions map<string,double>").withColumnRenamed("id", id_col)
