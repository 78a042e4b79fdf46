"""A Merkle tree over a dataset, stored in blocks of the van Emde Boas layout.

Every source is a tree over its documents in ``doc_id`` order, 16 nodes to a parent; the
roots of the sources are the leaves of one more tree. A tree is cut into aligned blocks of
4096 leaves, which Spark groups and builds one by one; the block roots are the leaves of the
next round's blocks, so a source of any size takes a few rounds and no task sees more
than one block. Inside a block the nodes lie in one byte string: the levels are split at
half height, the upper subtree comes first, then each lower subtree as a whole, and the
same holds inside them. The place of a node follows from arithmetic alone.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.operators import ordering

FANOUT = 16
#: Levels of parents in a block; it has FANOUT ** BLOCK_HEIGHT leaves.
BLOCK_HEIGHT = 3
_BITS = 4
_BLOCK_BITS = _BITS * BLOCK_HEIGHT
_DIGEST = 32
#: The tree that joins the sources; trees of sources are named by ``_tree``.
TOP = "top"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---------------------------------------------------------------- layout

@functools.cache
def _tree_size(levels: int) -> int:
    return (FANOUT**levels - 1) // (FANOUT - 1)


def slots(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (0 is the root) in a tree of so many levels."""
    if levels == 1:
        return np.zeros(len(index), dtype=np.int64)
    upper = levels // 2
    if depth < upper:
        return slots(depth, index, upper)
    under = FANOUT ** (depth - upper)
    inside = slots(depth - upper, index % under, levels - upper)
    return _tree_size(upper) + index // under * _tree_size(levels - upper) + inside


@functools.cache
def _level_slots(height: int) -> tuple[np.ndarray, ...]:
    """Places of the nodes of each level of a block, leaves first."""
    return tuple(slots(height - up, np.arange(FANOUT ** (height - up)), height + 1) for up in range(height + 1))


def height_of(size: int) -> int:
    """Levels of parents that a block needs for ``size`` nodes of its level of the tree."""
    if size > FANOUT**BLOCK_HEIGHT:
        return BLOCK_HEIGHT
    return next(h for h in range(BLOCK_HEIGHT + 1) if FANOUT**h >= size)


def built(leaves: list[bytes], height: int) -> bytes:
    """The nodes of a block over these digests; places without a node are zero, none at the end."""
    store = np.zeros((_tree_size(height + 1), _DIGEST), dtype=np.uint8)
    level = leaves
    for up, places in enumerate(_level_slots(height)):
        if up:
            texts = [d.hex() for d in level]
            level = [
                hashlib.sha256("".join(texts[i : i + FANOUT]).encode()).digest() for i in range(0, len(texts), FANOUT)
            ]
        store[places[: len(level)]] = np.frombuffer(b"".join(level), dtype=np.uint8).reshape(-1, _DIGEST)
    used = max(int(places[-(-len(leaves) // FANOUT**up) - 1]) for up, places in enumerate(_level_slots(height)))
    return store[: used + 1].tobytes()


def levels_of(nodes: bytes, size: int, height: int) -> list[list[str]]:
    """The hex digests of each level of a stored block, leaves first."""
    store = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, _DIGEST)
    found = []
    for up, places in enumerate(_level_slots(height)):
        text = store[places[: -(-size // FANOUT**up)]].tobytes().hex()
        found.append([text[i : i + 2 * _DIGEST] for i in range(0, len(text), 2 * _DIGEST)])
    return found


def siblings(levels: list[list[str]], index: int) -> list[tuple[str, str]]:
    """What stands before and after the node in its run, at each level below the block root."""
    found = []
    for level in levels[:-1]:
        first = index - index % FANOUT
        found.append(("".join(level[first:index]), "".join(level[index + 1 : first + FANOUT])))
        index //= FANOUT
    return found


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a node with this digest leads to."""
    for before, after in path:
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


# ---------------------------------------------------------------- leaves

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(**changed: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in FIELDS]), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``doc_id``, ``source``, the digest of each row, and that of the altered row."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = docs.select(*FIELDS)
    return rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        _leaf().alias("digest"),
        F.when(tampered, _leaf(text=F.translate("text", upper, lower))).alias("altered"),
    )


def every_fifth() -> Column:
    """Rows whose decimal ``doc_id`` has a CRC-32 that 5 divides."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def _tree(source: Column) -> Column:
    """A name without nulls, in the order of sources: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("-"))


# ---------------------------------------------------------------- building

BLOCKS = "tree string, round int, block bigint, size bigint, height int, leaves int, nodes binary, root binary"


def _block_of(round_: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        digests, size = table.column("digest").to_pylist(), table.column("size")[0].as_py()
        height = height_of(size)
        nodes = built(digests, height)
        root = nodes[:_DIGEST]
        row = {
            "tree": table.column("tree")[0].as_py(), "round": round_, "size": size, "height": height,
            "block": table.column("index")[0].as_py() >> _BLOCK_BITS, "leaves": len(digests), "nodes": nodes, "root": root,
        }
        return pa.Table.from_pylist([row], schema=_BLOCK_SCHEMA)

    return run


_BLOCK_SCHEMA = pa.schema(
    [
        ("tree", pa.string()), ("round", pa.int32()), ("block", pa.int64()), ("size", pa.int64()),
        ("height", pa.int32()), ("leaves", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary()),
    ]
)


def _blocks(nodes: DataFrame, round_: int) -> DataFrame:
    """One row per block of ``nodes`` (``tree``, ``index`` from 0, ``size`` of the tree's level, ``digest``)."""
    grouped = nodes.select("tree", "index", "size", "digest").groupBy(
        "tree", F.shiftright("index", _BLOCK_BITS).alias("block")
    )
    return grouped.applyInArrow(_block_of(round_), BLOCKS)


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Stored blocks of every round; the roots of one round are the leaves of the next."""
    found = []
    while True:
        found.append(scratch.stored(_blocks(nodes, len(found)), "merkle"))
        above = found[-1].where(F.col("size") > FANOUT**BLOCK_HEIGHT)
        if above.isEmpty():
            return found
        size = F.shiftright(F.col("size") + (FANOUT**BLOCK_HEIGHT - 1), _BLOCK_BITS)
        nodes = above.select("tree", F.col("block").alias("index"), size.alias("size"), F.col("root").alias("digest"))


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """The root of each tree."""
    found = None
    for blocks in rounds:
        own = blocks.where(F.col("size") <= FANOUT**BLOCK_HEIGHT).select("tree", F.col("root").alias("digest"))
        found = own if found is None else found.union(own)
    return found


# ---------------------------------------------------------------- paths

PATH = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _path(value: list[dict] | None) -> list[tuple[str, str]]:
    return [(s["before"], s["after"]) for s in value or []]


def _downward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The way to the root from each leaf of a block, from the block's own way."""
    for batch in batches:
        for row in batch.to_pylist():
            levels, upper = levels_of(row["nodes"], row["leaves"], row["height"]), _path(row["path"])
            for first in range(0, row["leaves"], 512):
                some = range(first, min(first + 512, row["leaves"]))
                steps = [[{"before": b, "after": a} for b, a in siblings(levels, i) + upper] for i in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["tree"]] * len(some)),
                        pa.array([(row["block"] << _BLOCK_BITS) + i for i in some], pa.int64()),
                        pa.array(steps, _STEPS),
                    ],
                    names=["tree", "index", "path"],
                )


def _ways(blocks: DataFrame) -> DataFrame:
    return blocks.mapInArrow(_downward, f"tree string, index bigint, path {PATH}")


def _with_ways(rounds: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The blocks of the first round with their ``path``; ``roots`` has that of each tree's root."""
    above = None
    for blocks in reversed(rounds):
        is_top = F.col("size") <= FANOUT**BLOCK_HEIGHT
        own = blocks.where(is_top).join(roots, "tree")
        if above is not None:
            ways = _ways(above).withColumnRenamed("index", "block")
            own = own.unionByName(blocks.where(~is_top).join(ways, ["tree", "block"]))
        above = own
    return above


# ---------------------------------------------------------------- result

RESULT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)
_RESULT_SCHEMA = pa.schema(
    [(n, pa.int64() if n == "doc_id" else pa.bool_() if n == "verified" else pa.string()) for n in
     ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")]
)


def _proved(root: str):
    def run(docs: pa.Table, blocks: pa.Table) -> pa.Table:
        (block,) = blocks.to_pylist()
        levels, upper = levels_of(block["nodes"], block["leaves"], block["height"]), _path(block["path"])
        subroot, rows = block["subroot"].hex(), []
        for doc, index, altered in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "index", "altered"))):
            at = index & ((1 << _BLOCK_BITS) - 1)
            path, leaf = siblings(levels, at) + upper, levels[0][at]
            proof = hashlib.sha256("".join([b + a for b, a in path]).encode()).hexdigest()
            end = folded(altered.hex() if altered is not None else leaf, path)
            rows.append((doc, leaf, subroot, root, proof, end, end == root))
        columns = zip(*rows)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT_SCHEMA)], schema=_RESULT_SCHEMA)

    return run


class Manifest:
    """The stored tree of a dataset.

    ``nodes`` are the placed leaves, ``rounds`` and ``top_rounds`` the blocks of the sources' trees
    and of the tree over them, ``root`` the digest of the whole (None without rows).
    """

    def __init__(self, docs: DataFrame, tampered: Column | None = None):
        rows = leaves(docs, F.lit(False) if tampered is None else tampered)
        rows = rows.withColumn("tree", _tree(F.col("source"))).drop("source")
        placed = ordering.sorted_positions(rows, ["doc_id", "digest"], keys=["tree"], position="index", total="size")
        self.nodes = placed.withColumn("index", F.col("index") - 1)
        self.rounds = _rounds(self.nodes)
        tops = scratch.stored(_tops(self.rounds), "merkle")
        joined = ordering.sorted_positions(
            tops.select(F.col("tree").alias("source"), F.lit(TOP).alias("tree"), "digest"),
            ["source"], keys=["tree"], position="index", total="size",
        )
        self.sources = joined.withColumn("index", F.col("index") - 1)
        self.top_rounds = _rounds(self.sources)
        found = _tops(self.top_rounds).first()
        self.root = found["digest"].hex() if found else None

    def blocks(self) -> DataFrame:
        """All stored blocks."""
        first, *others = [*self.rounds, *self.top_rounds]
        return functools.reduce(DataFrame.unionByName, others, first)

    def proofs(self) -> DataFrame:
        """One row per document: its leaf, the roots, its proof, and what its altered row leads to.

        Siblings are looked up in the stored blocks: from the top down each round hands its
        leaves the way from there to the root, a few kB for each block of the round below.
        """
        if self.root is None:
            return self.nodes.sparkSession.createDataFrame([], RESULT)
        no_way = F.array().cast(PATH)
        whole = self.top_rounds[-1].select("tree").distinct().withColumn("path", no_way)
        ways = _ways(_with_ways(self.top_rounds, whole)).drop("tree")
        own = self.sources.join(ways, "index").select(F.col("source").alias("tree"), "path")
        subroots = self.sources.select(F.col("source").alias("tree"), F.col("digest").alias("subroot"))
        blocks = _with_ways(self.rounds, own).join(subroots, "tree")
        blocks = blocks.select("tree", "block", "leaves", "height", "nodes", "path", "subroot")
        return (
            self.nodes.select("doc_id", "index", "altered", "tree", F.shiftright("index", _BLOCK_BITS).alias("block"))
            .groupBy("tree", "block")
            .cogroup(blocks.groupBy("tree", "block"))
            .applyInArrow(_proved(self.root), RESULT)
        )


def verified(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Proof and verdict of every row of ``docs``, with some of them altered after the tree was made.

    ``docs`` has ``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text``; other columns are not read.
    Any of them may be null; a null source is a source of its own and comes first, as does a null
    ``doc_id`` in its source. Rows with one ``doc_id`` stand in the order of their digests, and equal
    rows are leaves of their own. ``tampered`` marks the rows whose text is put in lower case (A-Z)
    for ``folded_root``; by default none is. An empty table gives no rows.
    """
    return Manifest(docs, tampered).proofs()


# ---------------------------------------------------------------- SQL

def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(_sql_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _sql_tree(name: str, rounds: int) -> list[str]:
    """Levels ``name0`` to ``nameN`` (tree, i, digest, n), and each node's siblings at every level.

    A tree of one node stays as it is.
    """
    parts = []
    for k in range(rounds):
        parts.append(f"""{name}{k + 1} AS (
    SELECT tree, i // {FANOUT} AS i, (n + {FANOUT - 1}) // {FANOUT} AS n,
           CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest
    FROM {name}{k} k{k} GROUP BY tree, k{k}.i // {FANOUT}, n)""")
        parts.append(f"""{name}_sides{k} AS (
    SELECT a.tree, a.i, a.n, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS bef,
           coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS aft
    FROM {name}{k} a JOIN {name}{k} b ON a.tree = b.tree AND a.i // {FANOUT} = b.i // {FANOUT}
    GROUP BY a.tree, a.i, a.n)""")
    return parts


def _sql_walk(start: str, name: str, sides: str, rounds: int, tree: str, index: str) -> list[str]:
    """``name0`` to ``nameN``: proof and folded digest after each level."""
    parts, before = [], start
    for k in range(rounds):
        parts.append(f"""{name}{k} AS (
    SELECT w.* REPLACE (w.proof || s.bef || s.aft AS proof,
               CASE WHEN s.n = 1 THEN w.fold ELSE sha256(s.bef || w.fold || s.aft) END AS fold)
    FROM {before} w JOIN {sides}_sides{k} s ON s.tree = w.{tree} AND s.i = w.{index} // {FANOUT**k})""")
        before = f"{name}{k}"
    return parts


_TABLE = f"[{', '.join('0' for _ in range(8))}]"
#: Trees of up to 16 ** 5 documents a source and 16 ** 3 sources.
_DOC_ROUNDS, _TOP_ROUNDS = 5, 3
SQL = ",\n".join(
    [
        f"""
WITH crc_table AS (
    SELECT list(list_reduce(list_prepend(k, {_TABLE}), lambda c, z: CASE WHEN c % 2 = 1
                THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY k) AS t
    FROM (SELECT unnest(range(256)) AS k))""",
        """crc AS (
    SELECT doc_id, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS v
    FROM documents, crc_table)""",
        f"""leaves AS (
    SELECT d.doc_id, coalesce('=' || source, '-') AS tree, {_sql_leaf('text')} AS digest,
           CASE WHEN c.v % 5 = 0 THEN {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
    FROM (SELECT *, row_number() OVER () AS r FROM documents) d
    JOIN (SELECT doc_id, any_value(v) AS v FROM crc GROUP BY doc_id) c USING (doc_id))""",
        """l0 AS (
    SELECT doc_id, altered, tree, digest, count(*) OVER (PARTITION BY tree) AS n,
           row_number() OVER (PARTITION BY tree ORDER BY doc_id, digest) - 1 AS i
    FROM leaves)""",
        *_sql_tree("l", _DOC_ROUNDS),
        f"""t0 AS (
    SELECT tree AS source, 'top' AS tree, digest, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS i
    FROM l{_DOC_ROUNDS})""",
        *_sql_tree("t", _TOP_ROUNDS),
        """start AS (
    SELECT l0.doc_id, l0.tree, l0.i, l0.digest AS leaf, t0.digest AS subroot, 'top' AS top, t0.i AS source_i,
           '' AS proof, coalesce(l0.altered, l0.digest) AS fold
    FROM l0 JOIN t0 ON l0.tree = t0.source)""",
        *_sql_walk("start", "w", "l", _DOC_ROUNDS, "tree", "i"),
        *_sql_walk(f"w{_DOC_ROUNDS - 1}", "v", "t", _TOP_ROUNDS, "top", "source_i"),
    ]
) + f"""
SELECT w.doc_id, w.leaf, w.subroot, r.digest AS root, sha256(w.proof) AS proof_sha256,
       w.fold AS folded_root, w.fold = r.digest AS verified
FROM v{_TOP_ROUNDS - 1} w, t{_TOP_ROUNDS} r
"""
