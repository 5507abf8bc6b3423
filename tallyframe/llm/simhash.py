"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius; the
variants are shuffled, and two fingerprints within the radius always meet at
one.  A variant's bucket can hold no more fingerprints than the ball has
members (65 for 64 bits and radius 2), however many copies a text has, so no
bucket grows with the data and no candidate is dropped.  Within a bucket the
smallest fingerprint is linked to every other one; the triangle inequality
puts all of them within the radius, and the link is verified all the same.
Components of the links give the near-duplicate classes.

Defined results: null or wordless text has fingerprint zero, linked like any
other; a null id takes part in its class but is no candidate for the smallest
id; repeated rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, materialise
from .components import components

#: A-Z to a-z; the words' separators are the ASCII white space of bytes.split().
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = [0, *ends[: len(words) - shingle].tolist()]
    hashes = [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    # 16-bit lanes of the packed bits: counts of each bit without unpacking all at once
    data = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(data), 8192):
        counts += np.unpackbits(data[at : at + 8192], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id_col, fp long)`` of every whole text; fp holds the 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            fps = np.array([fingerprint(t or b"", shingle, seed) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ball_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` that join all distinct ``fp`` within ``radius`` bits, directly or through a shared variant."""
    half = (radius + 1) // 2
    masks = [0] + [_signed(sum(1 << b for b in bits)) for k in range(1, half + 1) for bits in combinations(range(BITS), k)]
    ball = F.explode(F.array(*[F.lit(m).cast("long") for m in masks]))
    variants = prints.select("fp", ball.alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    # a bucket has at most len(masks) members: each is the variant with one mask on it
    met = variants.groupBy("variant").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    if radius % 2 == 0:
        stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    else:  # two half balls reach one bit too far: all pairs of the bounded bucket, verified below
        stars = met.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b")).where("a < b")
    return stars.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id_col, fp long, component_id)``: one row per document; component_id is the smallest id reachable."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle, seed).withColumnRenamed(id_col, "id"), "fingerprints")
    firsts = materialise(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    found = components(ball_links(firsts, radius), "fingerprint-links")
    linked = firsts.join(found, firsts.fp == found.node).select("fp", "component", "first")
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    merged = linked.join(smallest, "component").select(F.col("fp").alias("own"), "component_id")
    by_fp = firsts.join(merged, firsts.fp == merged.own, "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return prints.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
