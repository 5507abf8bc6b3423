"""Mixture-controlled packing by deficit round-robin over source queues.

Documents are tokenised once into a written table.  Every source is a queue;
its documents stand in the order of that table.  In each round a queue earns
its share of a window as a deficit, sends the whole tokens of it and carries
the fraction to the next round, so that after ``r`` rounds a queue that holds
``T`` of ``N`` tokens has sent ``r * window * T // N``.  That closed form needs only the queue
totals and each document's place in its queue (a distributed prefix sum), so
deficits carry across windows, tasks and machines without one sequential
scheduler.  The stream of rounds is cut into windows; what is left at its end
goes into windows of power-of-two sizes, which need no padding.

With target weights that the corpus can't keep to its end, queues run dry one
after the other; each such phase shares its windows among the queues left.

Defined results: null text is packed as empty text (its end id alone); a null
source is a queue of its own; null or repeated ids stay separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, written

#: Chunks between white space that a task keeps with their ids; bounds memory only.
CACHE_CHUNKS = 400_000
#: Numbers of a table of rounds and queues that a task holds at once; bounds memory only.
TABLE = 1 << 20


class ChunkTokenizer:
    """Ids of the chunks between white space, each distinct chunk encoded once per worker.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its chunks' ids in order.  Chunks of Latin-1 characters are normalised
    and split here in bulk, and the vocabulary's merges are replayed by rank
    with a byte as the end-of-word mark; the result is the library's as long as
    every token is what its own merges make of its characters (the tests hold
    the vocabulary to that).  Any other chunk goes through the library itself,
    and so does a whole text that holds a special token's string.
    """

    END = "\x01"

    def __init__(self, path: str) -> None:
        import tiktoken

        self.path, settings = path, _settings(path)
        pattern = next(r["pattern"]["Regex"] for r in settings["pre_tokenizer"]["pretokenizers"] if r["type"] == "Split")
        self.pieces = regex.compile(pattern + "|\n").findall
        ranks = end_ranks(settings["model"]["merges"])
        ids = np.zeros(len(ranks), dtype=np.int64)
        special = {t["content"] for t in settings["added_tokens"]}
        # texts with one of these strings are read by the library, which makes them one token each
        self.marked = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or "(?!)").search
        for token, number in settings["model"]["vocab"].items():
            if token not in special:
                ids[ranks[_as_bytes(token)]] = number
        self.width = np.dtype(np.uint16 if max(settings["model"]["vocab"].values()) < 1 << 16 else np.uint32)
        self.ids = ids.astype(self.width)
        self.mark = ranks[b"\n" + self.END.encode()]
        self.merge = tiktoken.Encoding("chunks", pat_str="[^\x01]+\x01", mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, bytes] = {}

    @cached_property
    def whole(self):
        """The library's tokenizer, loaded where a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def learn(self, chunks: set[str]) -> None:
        if len(self.cache) + len(chunks) > CACHE_CHUNKS:
            self.cache.clear()
        missing = [c for c in chunks if c not in self.cache]
        size = self.width.itemsize
        for at in range(0, len(missing), 20_000):
            part = missing[at : at + 20_000]
            text = "\n".join(part)
            if not _latin(text):
                for chunk in part:
                    if not _latin(chunk):
                        self.cache[chunk] = self.all(chunk)
                part = [c for c in part if c not in self.cache]
                text = "\n".join(part)
            if not part:
                continue
            ranks = np.asarray(self.merge.encode_to_numpy(self.END.join(self.pieces(text.lower())) + self.END, disallowed_special=()))
            ids = self.ids[ranks].tobytes()
            cuts = (np.flatnonzero(ranks == self.mark) * size).tolist()
            for chunk, a, b in zip(part, [0, *(c + size for c in cuts)], [*cuts, len(ids)], strict=True):
                self.cache[chunk] = ids[a:b]

    def all(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=self.width).tobytes()


#: Separators that str.split() takes for white space and the tokenizer does not.
ODD = regex.compile("[\x1c-\x1f]")


def _latin(chunk: str) -> bool:
    if ChunkTokenizer.END in chunk:
        return False
    try:
        chunk.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=1)
def _shown() -> dict[str, int]:
    """The byte that each visible stand-in of byte-level vocabularies means."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _as_bytes(token: str, end: str = "</w>") -> bytes:
    """A token's bytes, with the end mark as one byte more."""
    body = token.removesuffix(end)
    return bytes(map(_shown().__getitem__, body)) + (ChunkTokenizer.END.encode() if body != token else b"")


def end_ranks(merges: list) -> dict[bytes, int]:
    """Ranks by bytes: single bytes, bytes at a word's end, then the merges in their order."""
    out = {bytes([b]): b for b in range(256)} | {bytes([b]) + ChunkTokenizer.END.encode(): 256 + b for b in range(256)}
    for merge in merges:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        out.setdefault(_as_bytes(left) + _as_bytes(right), len(out))
    return out


def _settings(path: str) -> dict:
    import json

    with open(path) as file:
        return json.load(file)


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id, source, n long, ids binary, width int)``: little-endian ids of each whole text and the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        model = _tokenizer(tokenizer_path)
        end, size = np.array([end_id], dtype=model.width).tobytes(), model.width.itemsize
        for batch in blocks(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            chunks = [None if ODD.search(t) or model.marked(t) else t.split() for t in texts]
            model.learn(set().union(*(c for c in chunks if c)))
            find = model.cache.__getitem__
            ids = [(model.all(t) if c is None else b"".join(map(find, c))) + end for t, c in zip(texts, chunks)]
            n = pa.array([len(i) // size for i in ids], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("source"), n, pa.array(ids, type=pa.binary()), pa.array([size] * len(ids), type=pa.int32())], ["id", "source", "n", "ids", "width"])
        model.cache.clear()  # workers live on after a task

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, source string, n long, ids binary, width int")


def phases(totals: list[int], weights: list[Fraction]) -> list[list[int]]:
    """Tokens each queue sends in each phase: until the first of the queues left runs dry, and so on."""
    left, out = list(totals), []
    while any(left):
        live = [q for q, n in enumerate(left) if n]
        if not any(weights[q] for q in live):  # none of the rest is wanted: they follow by size
            weights = [Fraction(n) for n in left]
        live = [q for q in live if weights[q]]
        t = min(left[q] / weights[q] for q in live)
        sent = [0] * len(left)
        for q in live:
            sent[q] = left[q] if left[q] == t * weights[q] else int(t * weights[q])
        left = [a - b for a, b in zip(left, sent)]
        out.append(sent)
    return out


def _tail(tokens: int, window: int) -> list[int]:
    """Starts of the windows after the last full one: power-of-two sizes, largest first, and the end."""
    starts, at = [0], 0
    for bit in reversed(range(window.bit_length())):
        if tokens >> bit & 1:
            at += 1 << bit
            starts.append(at)
    return starts


class Schedule:
    """Where each token of each queue goes; all it holds is numbers of each queue in each phase."""

    def __init__(self, totals: list[int], weights: list[Fraction], window: int) -> None:
        self.window, self.total = window, sum(totals)
        self.phases = phases(totals, weights)
        self.exact = np.int64 if self.total * (self.total // window + 2) < 1 << 62 else object
        self.full = self.total // window
        self.tail = np.array(_tail(self.total % window, window), dtype=np.int64) + self.full * window

    def sequence(self, at: np.ndarray) -> np.ndarray:
        return np.where(at < self.full * self.window, at // self.window, self.full + np.searchsorted(self.tail, at, side="right") - 1)

    def begin(self, sequence: np.ndarray) -> np.ndarray:
        return np.where(sequence <= self.full, sequence * self.window, self.tail[np.clip(sequence - self.full, 0, len(self.tail) - 1)])

    def sent(self, r: np.ndarray, share: np.ndarray, total: int) -> np.ndarray:
        """``r * window * share // total``, the tokens sent in ``r`` whole rounds, without the large product."""
        earned = share * self.window
        return np.minimum(r * (earned // total) + r * (earned % total) // total, share)

    def ahead(self, r: np.ndarray, queue: np.ndarray, sent: np.ndarray, total: int) -> np.ndarray:
        """Tokens that stand before round ``r`` of ``queue``: all earlier rounds, and earlier queues' of this one."""
        live = np.flatnonzero(sent)
        shares = sent[live].astype(self.exact)
        rounds, at = np.unique(r, return_inverse=True)
        order = np.argsort(at, kind="stable")
        out, column = np.zeros(len(r), dtype=self.exact), np.searchsorted(live, queue)
        size = max(1, TABLE // max(1, len(live)))
        for k in range(0, len(rounds), size):
            some = rounds[k : k + size].astype(self.exact)[:, None]
            mine = order[np.searchsorted(at[order], k) : np.searchsorted(at[order], k + size)]
            low = self.sent(some, shares, total)
            inside = np.cumsum(self.sent(some + 1, shares, total) - low, axis=1)
            base, row, c = low.sum(axis=1), at[mine] - k, column[mine]
            out[mine] = base[row] + np.where(c > 0, inside[row, np.maximum(c - 1, 0)], 0)
        return out

    def pieces(self, queue: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of documents at places ``first`` of their queues: document number, start, length, sequence and offset of each piece."""
        found, before, base = [], np.zeros(len(self.phases[0]), dtype=np.int64), 0
        for sent in self.phases:
            sent_to, total = np.array(sent, dtype=np.int64), sum(sent)
            a, b = np.maximum(first, before[queue]), np.minimum(first + n, (before + sent_to)[queue])
            doc = np.flatnonzero(a < b)
            if len(doc):
                a, b = ((x - before[queue])[doc].astype(object) for x in (a, b))
                share = sent_to[queue[doc]].astype(object)
                r0, r1 = (((x * total - 1) // (share * self.window)).astype(self.exact) for x in (a + 1, b))
                a, b, share = (x.astype(self.exact) for x in (a, b, share))
                times = (r1 - r0 + 1).astype(np.int64)
                part = np.repeat(np.arange(len(doc)), times)
                r = r0[part] + (np.arange(len(part)) - np.repeat(np.cumsum(times) - times, times))
                share, q = share[part], queue[doc][part]
                low, high = self.sent(r, share, total), self.sent(r + 1, share, total)
                start, stop = np.maximum(low, a[part]), np.minimum(high, b[part])
                ahead = self.ahead(r, q, sent_to, total)
                keep = start < stop
                where = (base + ahead + start - low)[keep].astype(np.int64)
                found.append((doc[part][keep], (start + before[q] - first[doc][part])[keep].astype(np.int64), (stop - start)[keep].astype(np.int64), where))
            before, base = before + sent_to, base + sum(sent)
        doc, start, length, where = (np.concatenate(x) for x in zip(*found))
        s0, s1 = self.sequence(where), self.sequence(where + length - 1)
        times = s1 - s0 + 1
        part = np.repeat(np.arange(len(doc)), times)
        seq = s0[part] + (np.arange(len(part)) - np.repeat(np.cumsum(times) - times, times))
        a, b = np.maximum(where[part], self.begin(seq)), np.minimum((where + length)[part], self.begin(seq + 1))
        doc, start, length, offset = doc[part], start[part] + a - where[part], b - a, a - self.begin(seq)
        order = np.lexsort((start, doc))
        return tuple(x[order] for x in (doc, start, length, seq, offset))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    window: int = 2048,
    weights: Mapping[str | None, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per piece: ``(id_col, start, length, ids binary, doc_tokens, sequence_id, offset)``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.
    ``weights`` are the target token proportions by source (missing sources: 0,
    packed last); None takes the corpus's own, which hold to the last window.
    Every source is a queue; the driver holds one name and total for each.  A
    document's place in its queue is summed up in a window over one source's
    documents of one partition of the token table, then over the partitions.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    coded, _ = written(tokenize(docs, tokenizer_path, end_id, id_col, text_col, source_col).withColumn("uid", F.monotonically_increasing_id()), "tokens")
    meta = coded.select("uid", "source", "n", F.shiftright("uid", 33).alias("part"))
    largest = meta.groupBy("source").agg(F.sum("n").alias("tokens")).orderBy(F.desc("tokens"), "source")
    names, totals = zip(*((r.source, r.tokens) for r in largest.collect())) if coded.take(1) else ((), ())
    spark = docs.sparkSession
    if not names:
        return spark.createDataFrame([], f"{id_col} {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    known = F.broadcast(spark.createDataFrame(list(enumerate(names)), "queue int, name string"))  # the driver holds it anyway
    meta = meta.join(known, F.col("source").eqNullSafe(F.col("name"))).select("uid", "n", "part", "queue")
    parts = meta.groupBy("queue", "part").agg(F.sum("n").alias("n"))
    given = [Fraction(t if weights is None else str(weights.get(name, 0))) for name, t in zip(names, totals)]
    plan = Schedule(list(totals), given, window)

    earlier = (Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(*earlier)), F.lit(0))
    within = F.coalesce(F.sum("n").over(Window.partitionBy("queue", "part").orderBy("uid").rowsBetween(*earlier)), F.lit(0))
    placed = (
        meta.withColumn("within", within)
        .join(parts.select("queue", "part", before.alias("before")), ["queue", "part"])
        .select("uid", "queue", (F.col("before") + F.col("within")).alias("first"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "ids"):
            n = batch.column("n").to_numpy()
            doc, start, length, seq, offset = plan.pieces(batch.column("queue").to_numpy().astype(np.int64), batch.column("first").to_numpy(), n)
            width = np.dtype(f"<u{batch.column('width')[0].as_py()}")
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=width).astype("<u4")
            ends = (4 * np.cumsum([0, *length.tolist()])).astype(np.int32)
            blobs = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(ids.tobytes())])
            columns = [batch.column("id").take(pa.array(doc)), start, length, blobs, n[doc], seq, offset]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=pa.int64()) for c in columns], ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    rows = coded.join(placed, "uid").select("id", "n", "ids", "width", "queue", "first")
    out = rows.mapInArrow(cut, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
