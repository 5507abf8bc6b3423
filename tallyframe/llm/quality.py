"""Quality classifier by positive-unlabelled learning.

A logistic model over character, word and line statistics is fitted to trusted
positives and unlabelled text by the non-negative unbiased risk

    prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]).

With the logistic loss the unbiased part is convex, so damped Newton steps fit
it.  Where the negatives' risk is below zero it counts as zero, and the next
step goes up that risk's own gradient until it is positive again; the result is
the best point seen whose negatives' risk is not clamped.  The class prior is estimated before that from a positive-against-
unlabelled model, as the smallest ratio of unlabelled to positive mass above a
score threshold, with a confidence margin for thin tails.

Features of every document are computed once and written; each Newton step is
one pass over that table which sends one row of sums per task.  Nothing is
sampled: positives and unlabelled rows are all of the training fold.

Defined results: null text counts as empty; empty texts are scored; a null id
counts as held out; repeated label rows of a document count once (the largest
quality); without any positive or unlabelled row the score is the prior 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import blocks, discard, materialise, written

#: Characters with a class of their own; others fall in lower, upper, other letter, digit, space, punctuation or rest.
MARKS = "\n.,;:!?|*#$%&<>/\\{}[]()=_-\"'@+~^`"
_REST = len(MARKS)
CLASSES = _REST + 7
WORDS = 12
DIM = CLASSES + WORDS + 1
RIDGE = 1e-3
STEPS = 12
BINS = 1000


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    table = np.empty(1 << 16, dtype=np.int64)
    for code in range(1 << 16):
        c = chr(code)
        table[code] = (
            MARKS.index(c) if c in MARKS
            else _REST if c.islower()
            else _REST + 1 if c.isupper()
            else _REST + 2 if c.isalpha()
            else _REST + 3 if c.isdigit()
            else _REST + 4 if c.isspace()
            else _REST + 5 if code < 256
            else _REST + 6
        )
    return table


def features(texts: list[str | None]) -> np.ndarray:
    """Rows of DIM numbers, the last of them 1: roots of class shares, then word and line statistics."""
    texts = [t or "" for t in texts]
    sizes = np.array([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(texts)), sizes)
    counts = np.bincount(doc * CLASSES + _classes()[np.minimum(codes, 0xFFFF)], minlength=len(texts) * CLASSES).reshape(-1, CLASSES)
    shares = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    more = np.zeros((len(texts), WORDS))
    for k, text in enumerate(texts):
        words, lines = text.split(), [x for x in text.split("\n") if x]
        n, m = max(len(words), 1), max(len(lines), 1)
        letters = int(counts[k, _REST : _REST + 3].sum())
        marked = sum(not x[-1].isalnum() and x[-1] not in ".,;:!?'\")" for x in words)
        more[k] = (
            np.log1p(len(words)),
            np.log1p(len(lines)),
            np.log1p(len(words) / m),
            letters / max(len(text), 1),
            counts[k, _REST + 1] / max(letters, 1),
            len(set(words)) / n,
            len(set(zip(words, words[1:]))) / n,
            sum(a == b for a, b in zip(words, words[1:])) / n,
            len(set(lines)) / m,
            sum(x[-1] in ".!?…\"'" for x in lines) / m,
            marked / n,
            sum(len(x) for x in words) / n / 10,
        )
    return np.hstack([shares, more, np.ones((len(texts), 1))])


def featurise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: Column | None = None) -> DataFrame:
    """``(id_col, train, x binary)``: the features of every whole text as little-endian 32-bit floats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            x = features(batch.column("text").to_pylist()).astype("<f4")
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("train"), pa.array([r.tobytes() for r in x], type=pa.binary())], ["id", "train", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    train = F.coalesce(F.lit(True) if train_rows is None else train_rows, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), train.alias("train"))
    return rows.mapInArrow(run, f"id {kind}, train boolean, x binary").withColumnRenamed("id", id_col)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), dtype="<f4").reshape(-1, DIM).astype(float)


def _sums(rows: DataFrame, per_batch, size: int) -> np.ndarray:
    """Sum over all rows of a vector that ``per_batch(x, positive)`` gives for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += per_batch(_matrix(batch), batch.column("positive").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["k", "v"])

    out = np.zeros(size)
    for row in rows.select("x", "positive").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        out[row.k] = row.v
    return out


_UPPER = np.triu_indices(DIM)


def _pass(rows: DataFrame, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> dict:
    """Over unlabelled rows (all) and positives: means of loss, gradient and curvature at ``w``."""

    def one(x: np.ndarray, positive: np.ndarray) -> np.ndarray:
        z = (x - mean) / scale
        f = z @ w
        s = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
        soft = np.logaddexp(0, f)
        p = positive.astype(float)
        curve_u, curve_p = ((z * (s * (1 - s) * k)[:, None]).T @ z for k in (1, p))
        return np.concatenate([[len(f), p.sum(), soft.sum(), p @ soft, p @ f], s @ z, p @ z, (p * s) @ z, curve_u[_UPPER], curve_p[_UPPER]])

    v = _sums(rows, one, 5 + 3 * DIM + 2 * len(_UPPER[0]))
    n, m = max(v[0], 1), max(v[1], 1)
    square = lambda upper: (lambda a: a + np.triu(a, 1).T)(_full(upper))
    grads = v[5 : 5 + 3 * DIM].reshape(3, DIM)
    half = len(_UPPER[0])
    return {
        "n_u": v[0], "n_p": v[1], "soft_u": v[2] / n, "soft_p": v[3] / m, "f_p": v[4] / m,
        "s_u": grads[0] / n, "x_p": grads[1] / m, "s_p": grads[2] / m,
        "curve_u": square(v[5 + 3 * DIM : 5 + 3 * DIM + half]) / n, "curve_p": square(v[5 + 3 * DIM + half :]) / m,
    }


def _full(upper: np.ndarray) -> np.ndarray:
    a = np.zeros((DIM, DIM))
    a[_UPPER] = upper
    return a


def _newton(at, evaluate, steps: int = STEPS) -> np.ndarray:
    """Minimise by damped Newton steps; ``evaluate(w)`` gives objective, gradient, curvature and whether it is clamped.

    From a clamped point the gradient is that of the correction, which is always
    taken; the best point that isn't clamped is returned, the last one if all are.
    """
    state, size = evaluate(at), 1.0
    best = None if state[3] else (state[0], at)
    for _ in range(steps):
        value, grad, curve, clamped = state
        step = np.linalg.solve(curve, grad)
        if abs(grad @ step) < 1e-7:
            break
        new = at - size * step
        found = evaluate(new)
        if clamped or found[3] or found[0] < value:
            at, state, size = new, found, size / 2 if found[3] else min(1.0, 2 * size)
            if not found[3] and (best is None or found[0] < best[0]):
                best = found[0], new
        else:
            size /= 4
    return at if best is None else best[1]


def nonnegative_risk(r: dict, w: np.ndarray, prior: float, ridge: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, bool]:
    """Objective at ``w`` with the negatives' risk clamped at zero, and the step that descends it or, if clamped, corrects it."""
    negative = r["soft_u"] - prior * r["soft_p"]
    value = prior * (r["soft_p"] - r["f_p"]) + max(0.0, negative) + w @ ridge @ w / 2
    if negative < 0:
        return value, prior * r["s_p"] - r["s_u"], r["curve_u"] + prior * r["curve_p"] + ridge, True
    return value, r["s_u"] - prior * r["x_p"] + ridge @ w, r["curve_u"] + ridge, False


class Model:
    """Weights over standardised features, and the estimated class prior."""

    def __init__(self, w: np.ndarray, mean: np.ndarray, scale: np.ndarray, prior: float) -> None:
        self.w, self.mean, self.scale, self.prior = w, mean, scale, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(((x - self.mean) / self.scale) @ self.w, -500, 500)))


def estimate_prior(rows: DataFrame, model: Model, delta: float = 0.1) -> float:
    """Smallest ratio of unlabelled to positive mass above a threshold, chosen with a confidence margin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * BINS, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                bins = np.minimum((model.score(_matrix(batch)) * BINS).astype(int), BINS - 1)
                positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)
                total += np.bincount(np.concatenate([bins, BINS + bins[positive]]), minlength=2 * BINS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * BINS, dtype=np.int32)), pa.array(total)], ["k", "v"])

    counts = np.zeros(2 * BINS)
    for row in rows.select("x", "positive").mapInArrow(run, "k int, v long").groupBy("k").agg(F.sum("v").alias("v")).collect():
        counts[row.k] = row.v
    u, p = (np.cumsum(c[::-1]) for c in counts.reshape(2, BINS))
    q_u, q_p = u / max(u[-1], 1), p / max(p[-1], 1)
    margin = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(max(u[-1], 1)) + 1 / np.sqrt(max(p[-1], 1)))
    some = q_p > 0
    if not some.any():
        return 0.5
    best = np.argmin(((q_u + margin) / np.where(some, q_p, 1) + ~some * 1e9))
    return float(np.clip(q_u[best] / q_p[best], 0.01, 0.99))


def fit(rows: DataFrame) -> Model:
    """Model from ``rows(x, positive boolean)``: every row is unlabelled text, those with ``positive`` are trusted too."""
    moments = _sums(rows, lambda x, _: np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]), 1 + 2 * DIM)
    n = max(moments[0], 1)
    mean = moments[1 : 1 + DIM] / n
    scale = np.sqrt(np.maximum(moments[1 + DIM :] / n - mean**2, 1e-12))
    scale = np.where(scale < 1e-5, 1.0, scale)
    mean[-1], scale[-1] = 0.0, 1.0
    ridge = RIDGE * np.diag([*[1.0] * (DIM - 1), 1e-3])

    def against(w: np.ndarray):
        r = _pass(rows, w, mean, scale)
        value = r["soft_p"] - r["f_p"] + r["soft_u"] + w @ ridge @ w / 2
        return value, r["s_p"] - r["x_p"] + r["s_u"] + ridge @ w, r["curve_p"] + r["curve_u"] + ridge, False

    first = Model(_newton(np.zeros(DIM), against, 6), mean, scale, 0.5)
    prior = estimate_prior(rows, first)

    def risk(w: np.ndarray):
        return nonnegative_risk(_pass(rows, w, mean, scale), w, prior, ridge)

    start = np.zeros(DIM)
    start[-1] = np.log(prior / (1 - prior))
    return Model(_newton(start, risk), mean, scale, prior)


def _trained(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, Model]:
    x = materialise(featurise(docs, id_col, text_col, train_rows), "quality-features")
    positives = labels.groupBy(F.col(id_col).alias("labelled")).agg(F.max(label_col).alias("q")).where("q = 1")
    rows = x.where("train").join(positives, F.col(id_col) == F.col("labelled"), "left")
    training, path = written(rows.select("x", F.col("labelled").isNotNull().alias("positive")), "quality-training")
    model = fit(training)
    discard(docs.sparkSession, path)
    return x, model


def train(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of :func:`classify`, to score rows that it leaves in place with :func:`score`."""
    return _trained(docs, labels, train_rows, id_col, text_col, label_col)[1]


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, which replaces a column of that name: every row is scored where it stands, whatever its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, text_col):
            found = model.score(features(batch.column(text_col).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "score"])

    rows = docs.drop("score")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("score", DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(id_col, train boolean, score double)`` for every document.

    ``train_rows`` is a Column over ``docs``: only documents and labels where
    it holds teach the model.  A row of ``labels`` with ``label_col`` = 1 is a
    trusted positive; other labels are not used.
    """
    x, model = _trained(docs, labels, train_rows, id_col, text_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.score(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("train"), pa.array(found)], ["id", "train", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return x.withColumnRenamed(id_col, "id").mapInArrow(run, f"id {kind}, train boolean, score double").withColumnRenamed("id", id_col)
