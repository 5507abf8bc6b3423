"""Periodic runs of words: stretches in which words a fixed distance apart are identical.

A run of period ``q`` shows as equal words ``x[i] == x[i + q]`` over a stretch of
places ``i``, its diagonal, of at least ``max(MIN_LENGTH - q, q)`` places.  Lags
are taken in classes that double.  For each class the k-grams of the guaranteed
overlap are indexed: ``k`` and the distance of the anchors are such that every
diagonal of the class holds a whole anchored k-gram.  Anchors are paired with
the same document's equal k-grams at the class's lags.  Along a lag, a pair
that starts within the place covered furthest so far belongs to the stretch
being followed, so each stretch is extended once, at its first and last pair.

K-grams have exact names, by doubling: only grams that repeat within their
document are named, so most texts are done after a few words.  An anchor has at
most as many partners as its class has lags, and anchors thin out as lags grow:
a text of n words has O(n log n) pairs at the worst (one word over and over).
Documents are searched where they stand; nothing is shuffled.  A task holds a
block of about ``BLOCK_BYTES`` of text, or one longer text, with one number a
word for each doubling that still has repeats.

Defined results: null and wordless texts have no words, no runs and an empty
collapsed text; ids may be null or repeat; nothing is dropped but what
:func:`collapse` says.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

#: Words that a run has at least, beside two periods.
MIN_LENGTH = 12
#: Lags below this are the first class; its overlaps are 6 or more.
FIRST = 8


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, equal only for equal words of one text, and each text's first place."""
    numbers, base, starts = [], 0, [0]
    for words in texts:
        seen: dict[bytes, int] = {}
        numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words)) + base)
        base += len(seen)
        starts.append(starts[-1] + len(words))
    return np.concatenate([*numbers, np.zeros(0, dtype=np.int64)]), np.array(starts)


def _repeated(keys: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names (-1: the key stands once) of all ``size`` places, and the places that have one."""
    names = np.full(size, -1, dtype=np.int32)
    if not len(keys):
        return names, places
    _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
    often = count[number] > 1
    names[places[often]] = number[often]
    return names, places[often]


def _pairs(names: np.ndarray, places: np.ndarray, step: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``(lag, anchor)`` of equal grams at lags from ``low`` to below ``high``, sorted; anchors are multiples of ``step``."""
    width = len(names) + high + 1
    keys = np.sort(names[places].astype(np.int64) * width + places)
    anchors = places[places % step == 0]
    at = names[anchors].astype(np.int64) * width + anchors
    first, last = np.searchsorted(keys, at + low), np.searchsorted(keys, at + high)
    count = last - first
    anchor = np.repeat(anchors, count)
    lag = keys[np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)] % width - anchor
    order = np.lexsort((anchor, lag))
    return lag[order], anchor[order]


def _extended(named: list[np.ndarray], at: np.ndarray, lag: np.ndarray, left: bool) -> np.ndarray:
    """Number of equal words of both places of each pair, before ``at`` or from it on; less than twice the longest gram."""
    far, size = np.zeros(len(at), dtype=np.int64), len(named[0])
    for k in range(len(named) - 1, -1, -1):
        gram = 1 << k
        a = at - far - gram if left else at + far
        b = a + lag
        inside = (a >= 0) & (b < size)
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        far += gram * (inside & (named[k][a] == named[k][b]) & (named[k][a] >= 0))
    return far


def runs_of(numbers: np.ndarray) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs, by start, then period; places are those of ``numbers``."""
    size = len(numbers)
    names, places = _repeated(numbers, np.arange(size), size)
    named, found = [names], [np.zeros((0, 3), dtype=np.int64)]
    low, high, gram = 1, FIRST, 1
    while len(places):
        while gram < max(high // 4, 4) and len(places):
            ahead = places[places < size - gram]
            ahead = ahead[names[ahead + gram] >= 0]
            names, places = _repeated(names[ahead].astype(np.int64) * size + names[ahead + gram], ahead, size)
            named.append(names)
            gram *= 2
        step = 3 if low == 1 else gram
        lag, anchor = _pairs(names, places, step, low, high)
        # a pair of the same lag that starts within what the one before covers goes on with its stretch
        head = np.ones(len(lag), dtype=bool)
        head[1:] = (lag[1:] != lag[:-1]) | (anchor[1:] > anchor[:-1] + gram)
        tail = np.append(head[1:], True)[: len(head)]
        q, start, stop = lag[head], anchor[head], anchor[tail] + gram
        start = start - _extended(named, start, q, True)
        stop = stop + _extended(named, stop, q, False)
        length = stop - start + q
        long = length >= np.maximum(MIN_LENGTH, 2 * q)
        found.append(np.stack([start, length, q], axis=1)[long])
        low, high = high, 2 * high
        if low > size // 2:
            break
    rows = np.concatenate(found)
    # a multiple of the smallest period is the same stretch again
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, runs array<struct<start,length,period>>, collapsed)`` of every whole text, runs by start, then period.

    Words are what stands between white space of ASCII.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    runs_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            texts = [(t or b"").split() for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            numbers, starts = word_numbers(texts)
            rows = runs_of(numbers)
            cuts = np.searchsorted(rows[:, 0], starts)
            left = []
            for k, words in enumerate(texts):
                own = rows[cuts[k] : cuts[k + 1]]
                own[:, 0] -= starts[k]
                left.append(b" ".join(collapse(words, own) if len(own) else words))
            fields = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)]
            runs = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.StructArray.from_arrays(fields, ["start", "length", "period"])).cast(runs_type)
            collapsed = pa.array(left, type=pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.diff(starts)), runs, collapsed], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
