"""Byte-level BPE by corpus-level merge replay.

Texts are cut into pre-tokens by blocks, and a block's distinct words are dealt
into buckets by hash, so that every distinct word of the corpus stands in one
bucket.  A bucket is one vocabulary: its words' bytes lie in one linked
sequence with an inverted index from the rank of a token pair to the word
positions where that pair stands.  Merges are applied in rank order over the
whole vocabulary; a merge touches its two neighbours only, whose new pairs
enter the index.  So a word is merged once in a run, however often it occurs.
The finished words go back to the blocks that hold them, where documents, kept
as numbers of their block's words, are put together.

What is shuffled is a block's distinct words, their ids, and the documents as
compressed word numbers (about a byte and a half for each pre-token); the
number of buckets and of tasks follows the number of input partitions, so
neither grows with the table.

Defined results: null text is encoded as empty text (no ids); null or repeated
ids stay as they are, one output row per input row; columns that are not named
are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from .common import materialise

#: Characters of text whose distinct words are numbered together.
BLOCK = 32_000_000
#: Pre-tokens of documents that one row holds, and words that a task replays at once; bound its memory only.
GROUP, VOCABULARY = 1 << 20, 200_000


class Merges:
    """Ranks of a tiktoken file, as a pair table for replay and a list of bytes for decoding."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.size = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.width = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.byte_ids = [self.ranks[bytes([b])] for b in range(256)]
        ranks, size = self.ranks, self.size
        self.pairs = {
            ranks[token[:cut]] * size + ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; a word that is a token itself is that token."""
        size, find = self.size, self.pairs.get
        token: list[int] = []
        after: list[int] = []
        before: list[int] = []
        index: dict[int, list[int]] = {}
        starts = []
        for word in words:
            start = len(token)
            starts.append(start)
            whole = self.ranks.get(word)
            ids = [self.byte_ids[b] for b in word] if whole is None else [whole]
            token += ids
            stop = start + len(ids)
            after += range(start + 1, stop + 1)
            before += range(start - 1, stop - 1)
            if stop > start:
                after[-1] = before[start] = -1
            for at in range(start, stop - 1):
                rank = find(token[at] * size + token[at + 1])
                if rank is not None:
                    index.setdefault(rank, []).append(at)
        heap = list(index)
        heapify(heap)
        while heap:
            rank = heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for done, at in enumerate(places):
                right = after[at]
                if right < 0 or find(token[at] * size + token[right]) != rank:
                    continue
                token[at] = rank
                beyond = after[at] = after[right]
                after[right] = -1
                earlier = rank
                if beyond >= 0:
                    before[beyond] = at
                    new = find(rank * size + token[beyond])
                    if new is not None:
                        if new in index:
                            index[new].append(at)
                        else:
                            index[new] = [at]
                            heappush(heap, new)
                        earlier = min(earlier, new)
                left = before[at]
                if left >= 0:
                    new = find(token[left] * size + rank)
                    if new is not None:
                        if new in index:
                            index[new].append(left)
                        else:
                            index[new] = [left]
                            heappush(heap, new)
                        earlier = min(earlier, new)
                if earlier < rank:  # a lower rank arose: it goes before what is left of this one
                    index.setdefault(rank, []).extend(places[done + 1 :])
                    heappush(heap, rank)
                    break
        out = []
        for start, word in zip(starts, words):
            ids, at = [], start if word else -1
            while at >= 0:
                ids.append(token[at])
                at = after[at]
            out.append(ids)
        return out


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


def to_varints(values: np.ndarray) -> bytes:
    """Numbers below 2**28 as little-endian groups of seven bits, the high bit set on all but a number's last."""
    size = 1 + sum((values >> 7 * k > 0).astype(np.int64) for k in (1, 2, 3))
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), dtype=np.uint8)
    for k in range(4):
        some = size > k
        out[at[some] + k] = (values[some] >> 7 * k & 127) | np.where(size[some] > k + 1, 128, 0)
    return out.tobytes()


def from_varints(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, dtype=np.uint8)
    stop = np.flatnonzero(parts < 128)
    start = np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop
    out = np.zeros(len(stop), dtype=np.int64)
    for k in range(4):
        some = start + k <= stop
        out[some] |= (parts[start[some] + k] & 127).astype(np.int64) << 7 * k
    return out


def _ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``picks`` of ``flat`` one after the other, and where each ends."""
    n = sizes[picks]
    ends = np.cumsum(n)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[picks] - (ends - n), n)], ends


class _Numbers(dict):
    """Numbers of words in the order they first appear."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _close(block: int, held: list[np.ndarray], numbers: _Numbers, buckets: int) -> Iterator[dict]:
    """Rows of a finished block: groups of documents as numbers of its words, frequent words first, and its words by bucket."""
    words = np.array([*(w.encode() for w in numbers), None], dtype=object)[:-1]
    by_count = np.argsort(-np.bincount(np.concatenate(held), minlength=len(words)), kind="stable")
    number = np.empty(len(words), dtype=np.int64)
    number[by_count] = np.arange(len(words))
    sizes, pack = np.array([len(d) for d in held]), zstandard.ZstdCompressor(level=9).compress
    part = np.cumsum(sizes) // GROUP
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(held)]
    for a, b in zip(cuts, cuts[1:]):
        yield {"block": block, "docs": (a, b), "sizes": to_varints(sizes[a:b]), "data": pack(to_varints(number[np.concatenate(held[a:b])]))}
    words = words[by_count]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        mine = order[a:b]
        yield {"block": block, "bucket": int(bucket[mine[0]]), "at": to_varints(np.diff(mine, prepend=0)), "sizes": to_varints(np.array([len(w) for w in words[mine]])), "data": pack(b"".join(words[mine]))}


def word_blocks(docs: DataFrame, pattern: str, buckets: int, limit: int = BLOCK) -> DataFrame:
    """Of ``docs(id, text)``, cut into blocks of about ``limit`` characters, two kinds of rows.

    Documents: ``(block, ids array, sizes, data)``, the words of each document
    in order as numbers of the block's words, and how many each has.
    Words, with a ``bucket``: ``(block, bucket, at, sizes, data)``, the numbers
    of the block's words in that bucket (as differences), their lengths and bytes.
    ``data`` is compressed in both.
    """
    schema = StructType().add("block", "long").add("ids", ArrayType(docs.schema["id"].dataType)).add("bucket", "integer").add("at", "binary").add("sizes", "binary").add("data", "binary")
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, part = regex.compile(pattern).findall, TaskContext.get().partitionId()
        ids, held, numbers, size, count = [], [], _Numbers(), 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            names = pa.concat_arrays(ids)
            rows = list(_close((part << 32) + count, held, numbers, buckets))
            cuts = [r["docs"] for r in rows if "docs" in r]
            lists = pa.ListArray.from_arrays(pa.array([0, *(b for _, b in cuts)], type=pa.int32()), names)
            lists = pa.concat_arrays([lists, pa.nulls(len(rows) - len(cuts), lists.type)]).cast(target.field("ids").type)
            yield pa.RecordBatch.from_arrays([lists if f.name == "ids" else pa.array([r.get(f.name) for r in rows], type=f.type) for f in target], schema=target)

        for some in batches:
            for k, text in enumerate(some.column("text")):
                text = text.as_py() or ""
                ids.append(some.column("id").slice(k, 1))
                held.append(np.fromiter(map(numbers.__getitem__, split(text)), dtype=np.int64))
                size += len(text)
                if size >= limit:
                    yield from close()
                    ids, held, numbers, size, count = [], [], _Numbers(), 0, count + 1
        if held:
            yield from close()

    return docs.select("id", "text").mapInArrow(run, schema)


def replay_words(words: DataFrame, path: str) -> DataFrame:
    """``(block, at, sizes, data, merged)``: the words' ids instead of their bytes.

    Each bucket is one vocabulary, replayed once; ``merged`` counts the words
    that a row is the first of its bucket to hold, so its sum is the number of
    distinct words of the corpus.
    """

    def run(table: pa.Table) -> pa.Table:
        model, known, out = merges(path), {}, {"sizes": [], "data": [], "merged": []}
        pack, unpack = zstandard.ZstdCompressor().compress, zstandard.ZstdDecompressor().decompress
        rows = []
        for sizes, data in zip(table.column("sizes").to_pylist(), table.column("data").to_pylist()):
            ends, data = np.cumsum(from_varints(sizes)).tolist(), unpack(data)
            rows.append([data[a:b] for a, b in zip([0, *ends], ends)])
            before = len(known)
            known.update(dict.fromkeys(rows[-1]))
            out["merged"].append(len(known) - before)
        vocabulary = list(known)
        for at in range(0, len(vocabulary), VOCABULARY):
            part = vocabulary[at : at + VOCABULARY]
            known.update(zip(part, model.replay(part)))
        for row in rows:
            ids = [known[w] for w in row]
            out["sizes"].append(to_varints(np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))))
            out["data"].append(pack(np.fromiter(chain.from_iterable(ids), dtype=model.width).tobytes()))
        return pa.table({"block": table.column("block"), "at": table.column("at"), "sizes": pa.array(out["sizes"], type=pa.binary()), "data": pa.array(out["data"], type=pa.binary()), "merged": pa.array(out["merged"], type=pa.int64())})

    return words.select("block", "bucket", "at", "sizes", "data").groupBy("bucket").applyInArrow(run, "block long, at binary, sizes binary, data binary, merged long")


class _Dictionary:
    """Ids of a block's words, by number."""

    def __init__(self, rows: list[dict], width: np.dtype) -> None:
        unpack = zstandard.ZstdDecompressor().decompress
        at = np.concatenate([np.cumsum(from_varints(r["at"])) for r in rows] or [np.zeros(0, dtype=np.int64)])
        sizes = np.concatenate([from_varints(r["sizes"]) for r in rows] or [at])
        self.flat = np.frombuffer(b"".join(unpack(r["data"]) for r in rows), dtype=width).astype(np.int32)
        self.starts, self.sizes = np.empty(len(at), dtype=np.int64), np.empty(len(at), dtype=np.int64)
        self.starts[at], self.sizes[at] = np.cumsum(sizes) - sizes, sizes


def _assembled(path: str, decoded: bool):
    """Of each block its words' rows, then its documents' rows: one row for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, unpack = merges(path), zstandard.ZstdDecompressor().decompress
        block, held, words = None, [], None
        for batch in batches:
            for k in range(batch.num_rows):
                if batch.column("block")[k].as_py() != block:
                    block, held, words = batch.column("block")[k].as_py(), [], None
                if batch.column("at")[k].is_valid:
                    held.append({c: batch.column(c)[k].as_py() for c in ("at", "sizes", "data")})
                    continue
                if words is None:
                    words, held = _Dictionary(held, model.width), []
                names = batch.column("ids").slice(k, 1).flatten()
                found = from_varints(unpack(batch.column("data")[k].as_py()))
                ids, ends = _ragged(words.flat, words.starts, words.sizes, found)
                counts = np.concatenate([[0], np.cumsum(from_varints(batch.column("sizes")[k].as_py()))])
                stops = np.concatenate([[0], ends])[counts]
                columns = [names, pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(ids))]
                if decoded:
                    data, ends = _ragged(model.flat, model.starts, model.sizes, ids)
                    ends = np.concatenate([[0], ends])[stops].astype(np.int32)
                    columns.append(pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]))
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "decoded"][: len(columns)])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, limit: int = BLOCK) -> DataFrame:
    """``(id_col, ids array<int>)`` of every whole text; with ``decoded`` also the bytes the ids stand for.

    ``limit`` is the size of a block in characters; a longer text is a block of its own.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = max(1, rows.rdd.getNumPartitions())  # asks for the plan's partitions, runs nothing
    coded = materialise(word_blocks(rows, pattern, parts, limit), "word-blocks")
    words = replay_words(coded.where("bucket is not null").repartition(parts, "bucket"), ranks_path)
    texts = coded.where("bucket is null").select("block", "ids", "sizes", "data")
    # a block's words, then its documents, in one task
    rows = words.select("block", "at", "sizes", "data").unionByName(texts, allowMissingColumns=True).repartition(parts, "block").sortWithinPartitions("block", F.col("at").isNull())
    schema = f"id {kind}, ids array<int>" + (", decoded binary" if decoded else "")
    return rows.mapInArrow(_assembled(ranks_path, decoded), schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, decoded binary)``: the bytes of each row's ids; null ids give no bytes.  An unknown id is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = merges(ranks_path).tokens.__getitem__
        for batch in batches:
            out = [b"".join(map(back, ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, type=pa.binary())], ["id", "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_col)
