"""Merkle manifest of a dataset: a tree for each group of rows, a tree over the groups, and a proof for each row.

Rows become leaves, sorted within their group and numbered by value ranges, so
no group is ever one task.  A leaf partition is an aligned run of ``LEAVES``
leaves: it folds its own subtree and passes only the top on; tops are folded
the same way, ``LEAVES`` at a time, until each group has one node.

Proofs go by octopus multiproof.  A partition climbs from its own leaves and
notes each sibling it can't derive: the minimal union of missing coordinates
for all its leaves.  These are fetched in one join with the stored nodes, the
shared interiors are derived once, and each leaf's path is read from them.

Defined results: rows of a null group are a group of their own, which sorts
first; null ids sort first; equal rows are equal leaves, side by side; a lone
leaf is its group's subroot, a lone subroot is the root; the last node of a
level that has no partner is hashed alone.  An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import running_sum
from .common import materialise

#: A partition has 2 ** BITS leaves at most.
BITS = 9
LEAVES = 1 << BITS
#: Level and index.
Node = tuple[int, int]


def leaf_digest(columns: Iterable[Column]) -> Column:
    """Digest (32 bytes) of a row's values: each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def _hash(parts: Iterable[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def levels(n: int) -> int:
    """Levels above ``n`` leaves."""
    return (n - 1).bit_length()


def folded(nodes: list[bytes], steps: int) -> list[list[bytes]]:
    """The nodes, then each level above them, ``steps`` levels in all."""
    found = [nodes]
    for _ in range(steps):
        below = found[-1]
        found.append([_hash(below[k : k + 2]) for k in range(0, len(below), 2)])
    return found


def missing(places: list[int], n: int) -> list[Node]:
    """Smallest set of ``(level, index)`` that, with the leaves at ``places``, gives every path to the top of a tree of ``n`` leaves."""
    known, found = sorted(set(places)), []
    for level in range(levels(n)):
        size, have = -(-n >> level) if level else n, set(known)
        found += [(level, k ^ 1) for k in known if k ^ 1 < size and k ^ 1 not in have]
        known = sorted({k >> 1 for k in known})
    return found


class Path(NamedTuple):
    """Siblings from a leaf to the top; ``sides`` has L or R for each level's sibling, ``-`` where there is none."""

    siblings: tuple[bytes, ...]
    sides: str

    def root(self, leaf: bytes) -> bytes:
        """What the path folds ``leaf`` to."""
        more = iter(self.siblings)
        for side in self.sides:
            leaf = _hash((next(more), leaf) if side == "L" else (leaf, next(more)) if side == "R" else (leaf,))
        return leaf


def expanded(places: list[int], leaves: list[bytes], n: int, fetched: dict[Node, bytes]) -> tuple[list[Path], bytes]:
    """Each leaf's path and the top of its tree, from a partition's leaves and its fetched nodes."""
    nodes: list[dict[int, bytes]] = [dict(zip(places, leaves))]
    for (level, k), digest in fetched.items():
        while len(nodes) <= level:
            nodes.append({})
        nodes[level][k] = digest
    for level in range(levels(n)):
        if len(nodes) < level + 2:
            nodes.append({})
        size, here, above = -(-n >> level) if level else n, nodes[level], nodes[level + 1]
        for k in here:
            if k >> 1 not in above and (k ^ 1 in here or k ^ 1 >= size):
                above[k >> 1] = _hash(here[j] for j in sorted({k, k ^ 1}) if j < size)
    known: dict[Node, Path] = {}

    def path(level: int, k: int) -> Path:
        if level == levels(n):
            return Path((), "")
        if (level, k) not in known:
            rest, other = path(level + 1, k >> 1), nodes[level].get(k ^ 1)
            side = "-" if other is None else "L" if k & 1 else "R"
            known[level, k] = Path(((other,) if other else ()) + rest.siblings, side + rest.sides)
        return known[level, k]

    return [path(0, k) for k in places], nodes[levels(n)][0]


def _hex(column: pa.Array) -> list[bytes]:
    return [x.hex().encode() for x in column.to_pylist()]


def _binary(digests: Iterable[bytes]) -> list[bytes]:
    return [bytes.fromhex(d.decode()) for d in digests]


def _blocks(rows: DataFrame, name: str, *more: str) -> DataFrame:
    """``(grp, block, n, nodes)``: the numbered nodes of each aligned run, with what else is named of them."""
    sizes = rows.groupBy(F.col("grp").alias("of")).agg((F.max("pos") + 1).alias("n"))
    runs = rows.groupBy("grp", F.shiftright("pos", BITS).alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "node", *more))).alias("nodes"))
    return materialise(runs.join(sizes, F.col("grp").eqNullSafe(F.col("of"))).select("grp", "block", "n", "nodes"), name)


def _folds(blocks: DataFrame, level: int, whole: bool, kind: str) -> DataFrame:
    """``(grp, level, k, node, n)``: tops of the blocks, whose nodes stand at ``level``; ``whole``: with all nodes below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for grp, block, n, nodes in zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "n", "nodes"))):
                steps = min(BITS, levels(n))
                for up, digests in enumerate(folded([x.hex().encode() for x in nodes], steps)):
                    if whole or up == steps:
                        first = block << BITS >> up
                        for k, digest in enumerate(_binary(digests)):
                            for column, value in zip(out, (grp, level + up, first + k, digest, -(-n >> up))):
                                column.append(value)
            types = (batch.schema.field("grp").type, pa.int32(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, types)], ["grp", "level", "k", "node", "n"])

    return blocks.select("grp", "block", "n", F.col("nodes.node").alias("nodes")).mapInArrow(run, f"grp {kind}, level int, k long, node binary, n long")


def _tree(blocks: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """The nodes that leaf partitions may have to fetch, ``(grp, level, k, node)``, and each group's ``(grp, top)``."""
    at = _folds(blocks, 0, False, kind)
    at = materialise(at, "merkle-tops")
    tables, level = [at], BITS
    while at.where("n > 1").limit(1).count():
        runs = _blocks(at.where("n > 1").select("grp", F.col("k").alias("pos"), "node"), "merkle-blocks")
        above = materialise(_folds(runs, level, True, kind), "merkle-nodes")
        tables.append(above.where(f"level > {level}"))
        at, level = above.where(f"level = {level + BITS} or n = 1"), level + BITS
    nodes = tables[0]
    for t in tables[1:]:
        nodes = nodes.union(t)
    return nodes.select("grp", "level", "k", "node"), nodes.where("n = 1").select("grp", F.col("node").alias("top"))


def _fetched(blocks: DataFrame, nodes: DataFrame, kind: str) -> DataFrame:
    """``blocks`` with ``fetched``, the nodes a partition misses: one request for each, whatever number of leaves needs it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("grp", "block", "n", "places")))
            asked = [(grp, block, level, k) for grp, block, n, places in rows for level, k in missing(places, n)]
            types = (batch.schema.field("grp").type, pa.int64(), pa.int32(), pa.int64())
            columns = zip(*asked) if asked else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(columns, types)], ["grp", "block", "level", "k"])

    asked = blocks.select("grp", "block", "n", F.col("nodes.pos").alias("places")).mapInArrow(run, f"grp {kind}, block long, level int, k long")
    there = nodes.select(F.col("grp").alias("of"), F.col("level").alias("at"), F.col("k").alias("index"), "node")
    met = asked.join(there, F.col("grp").eqNullSafe(F.col("of")) & (F.col("level") == F.col("at")) & (F.col("k") == F.col("index")))
    sent = met.groupBy(F.col("grp").alias("of"), F.col("block").alias("to")).agg(F.collect_list(F.struct("level", "k", "node")).alias("fetched"))
    return blocks.join(sent, F.col("grp").eqNullSafe(F.col("of")) & (F.col("block") == F.col("to")), "left").drop("of", "to")


def _proven(blocks: DataFrame, kind: str, more: str) -> DataFrame:
    """A row for each leaf of ``blocks(grp, n, nodes, fetched)``: its path, with what else its node holds.

    Where blocks have ``rest`` and ``rest_sides``, the path goes on by these.
    ``folded`` is what a path makes of the node's ``claimed`` digest, or of the node where that is null.
    """
    fields = [x.split(":")[0] for x in more.split(",")]
    schema = f"grp {kind}, pos long, node binary, proof array<binary>, sides string, folded binary, {more.replace(':', ' ')}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                nodes = one.column("nodes").flatten()
                digests = _hex(nodes.field("node"))
                places = nodes.field("pos").to_pylist()
                fetched = {(x["level"], x["k"]): x["node"].hex().encode() for x in one.column("fetched")[0].as_py() or []}
                paths, _ = expanded(places, digests, one.column("n")[0].as_py(), fetched)
                rest = Path(tuple(_hex(one.column("rest")[0].values)), one.column("rest_sides")[0].as_py())
                paths = [Path(p.siblings + rest.siblings, p.sides + rest.sides) for p in paths]
                claims = [d if c is None else c.hex().encode() for c, d in zip(nodes.field("claimed").to_pylist(), digests)]
                known = pa.array([_binary(p.siblings) for p in paths], type=pa.list_(pa.binary()))
                columns = [
                    pa.array([one.column("grp")[0].as_py()] * len(places), type=batch.schema.field("grp").type), nodes.field("pos"), nodes.field("node"), known,
                    pa.array([p.sides for p in paths], type=pa.string()), pa.array(_binary(p.root(c) for p, c in zip(paths, claims)), type=pa.binary()), *[nodes.field(f) for f in fields],
                ]
                yield pa.RecordBatch.from_arrays(columns, ["grp", "pos", "node", "proof", "sides", "folded", *fields])

    return blocks.select("grp", "n", "nodes", "fetched", "rest", "rest_sides").mapInArrow(run, schema)


def manifest(rows: DataFrame, id_col: str, group_col: str, leaf: Column, claimed: Column | None = None) -> DataFrame:
    """A leaf, its group's subroot, the root and a proof for each row.

    ``leaf`` and ``claimed`` give 32-byte digests of a row (see
    :func:`leaf_digest`); ``claimed``, the leaf itself where null or not given,
    is what the proof is tried on.  Returns ``(id_col, group_col, pos, leaf, subroot, root,
    proof array<binary>, sides, folded)``: ``folded`` equals ``root`` where the
    claim holds.
    """
    key, kind = rows.schema[id_col].dataType.simpleString(), rows.schema[group_col].dataType.simpleString()
    other = F.lit(None) if claimed is None else claimed
    leaves = rows.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf.alias("node"), other.cast("binary").alias("claimed"))
    leaves = running_sum(leaves, ["grp"], ["id", "node"], F.lit(1).cast("long"), "pos", write=True)
    blocks = _blocks(leaves, "merkle-leaves", "claimed", "id")
    nodes, subroots = _tree(blocks, kind)

    tops = running_sum(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), F.col("top").alias("node")), ["grp"], ["name"], F.lit(1).cast("long"), "pos", write=True)
    over = _blocks(tops.withColumn("claimed", F.lit(None).cast("binary")), "merkle-subroots", "claimed", "name")
    upper, root = _tree(over, "int")
    ends = _fetched(over, upper, "int").withColumns({"rest": F.array().cast("array<binary>"), "rest_sides": F.lit("")})
    ends = _proven(ends, "int", f"name:{kind}").crossJoin(root.select(F.col("top").alias("root")))
    ends = materialise(ends.select("name", F.col("node").alias("subroot"), "root", F.col("proof").alias("rest"), F.col("sides").alias("rest_sides")), "merkle-ends")

    full = _fetched(blocks, nodes, kind).join(ends.select("name", "rest", "rest_sides"), F.col("grp").eqNullSafe(F.col("name"))).drop("name")
    proven = _proven(full, kind, f"id:{key}").join(ends.select("name", "subroot", "root"), F.col("grp").eqNullSafe(F.col("name")))
    return proven.select(F.col("id").alias(id_col), F.col("grp").alias(group_col), "pos", F.col("node").alias("leaf"), "subroot", "root", "proof", "sides", "folded")


#: Hexadecimal text of a CRC-32 in SQL, bit by bit.
_CRC = "list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(length({0})), lambda i: ascii(substr({0}, i + 1, 1))::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END))"

_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang")) + " || " + _FIELD.format("{n}") + " || " + _FIELD.format("text") + ")"

#: Trees level by level in a recursion, siblings by joins, tampered leaves folded in a second recursion.
ORACLE_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('+' || lang, '-') AS tree, {_LEAF.format(n="n_chars")} AS leaf, {_LEAF.format(n="(n_chars + 1)")} AS other,
        xor(4294967295::UBIGINT, {_CRC.format("doc_id::VARCHAR")}) % 7 = 0 AS tampered
    FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
    SELECT tree, 0 AS level, pos AS k, n, leaf AS node FROM placed
    UNION ALL
    SELECT tree, level + 1, k // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY k)) FROM nodes WHERE n > 1 GROUP BY tree, level, k // 2),
subroots AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY CASE WHEN tree = '-' THEN 0 ELSE 1 END, encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
    SELECT 0 AS level, pos AS k, n, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, k // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY k)) FROM upper WHERE n > 1 GROUP BY level, k // 2),
steps AS (
    SELECT p.doc_id, p.leaf, x.level, x.k % 2 AS side, s.node AS sibling
    FROM placed p JOIN nodes x ON x.tree = p.tree AND x.k = p.pos >> x.level AND x.n > 1
    LEFT JOIN nodes s ON s.tree = p.tree AND s.level = x.level AND s.k = xor(x.k, 1)
    UNION ALL
    SELECT p.doc_id, p.leaf, 1000 + x.level, x.k % 2, s.node
    FROM placed p JOIN subroots r ON r.tree = p.tree JOIN upper x ON x.k = r.pos >> x.level AND x.n > 1
    LEFT JOIN upper s ON s.level = x.level AND s.k = xor(x.k, 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY doc_id, leaf ORDER BY level) AS step FROM steps),
proofs AS (SELECT doc_id, leaf, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY doc_id, leaf),
climb AS (
    SELECT doc_id, leaf, 0::BIGINT AS step, CASE WHEN tampered THEN other ELSE leaf END AS node FROM placed
    UNION ALL
    SELECT c.doc_id, c.leaf, c.step + 1, sha256(CASE WHEN s.sibling IS NULL THEN c.node WHEN s.side = 1 THEN s.sibling || c.node ELSE c.node || s.sibling END)
    FROM climb c JOIN numbered s ON s.doc_id = c.doc_id AND s.leaf = c.leaf AND s.step = c.step + 1),
ends AS (SELECT doc_id, leaf, max_by(node, step) AS folded_root FROM climb GROUP BY doc_id, leaf)
SELECT p.doc_id, p.leaf, r.subroot, u.node AS root, coalesce(f.proof_sha256, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = u.node AS verified
FROM placed p JOIN subroots r USING (tree) JOIN upper u ON u.n = 1 JOIN ends e USING (doc_id, leaf) LEFT JOIN proofs f USING (doc_id, leaf)
"""
