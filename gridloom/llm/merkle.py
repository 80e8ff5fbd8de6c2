"""A manifest of a table: a tree of SHA-256 digests whose parents keep copies of their hash state.

Rows become leaves, ordered in the tree of their ``lang``; the roots of these trees are the leaves of a last one. Every
``arity`` nodes in a row become one parent, the digest of their digests as hex text. A hex digest is one block of
SHA-256, so the hash state before each child slot is a state between blocks: 32 bytes that can be copied, kept in a
table and taken up again, which a parent does for each of its slots. A changed child is then folded into its parent from the
state before its slot, with the replacement and the siblings to its right only; those to its left are in the state.

Trees are cut into blocks of ``arity ** height`` neighbours. A task works on one block at a time, for all its nodes at
once; the roots of the blocks are the nodes of the next tier, of which there is a 4,096th. So no tree, however large,
passes through one task, and there are as many tiers as the logarithm of the rows to that base.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.session import settle, ship_package

#: Nodes of a block, at most.
BLOCK = 4_096

# ---- SHA-256 between blocks, for many messages at once ------------------------------------------------------------


def _root(n: int, k: int) -> int:
    """The whole part of the k-th root."""
    low, high = 0, 1 << (n.bit_length() // k + 1)
    while low < high - 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**k <= n else (low, middle)
    return low


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, math.isqrt(p) + 1))]
#: First 32 bits of the fractions of square and cube roots of the first primes, as the standard lays down.
START = np.array([_root(p << 64, 2) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)
_ROUNDS = [np.uint32(_root(p << 96, 3) & 0xFFFFFFFF) for p in _PRIMES]
_HEX = np.array([list(b"%02x" % b) for b in range(256)], np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) each."""
    w = list(np.ascontiguousarray(block.T))
    a, b, c, d, e, f, g, h = own = list(np.ascontiguousarray(state.T))
    for i, k in enumerate(_ROUNDS):
        if i >= 16:
            near, far = w[i - 2], w[i - 15]
            mixed = _turn(far, 7) ^ _turn(far, 18) ^ (far >> np.uint32(3))
            w.append(w[i - 16] + mixed + w[i - 7] + (_turn(near, 17) ^ _turn(near, 19) ^ (near >> np.uint32(10))))
        first = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + k + w[i]
        second = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return np.stack([x + y for x, y in zip(own, (a, b, c, d, e, f, g, h), strict=True)], axis=1)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests of messages of so many whole blocks."""
    last = np.zeros((len(state), 16), np.uint32)
    last[:, 0] = 1 << 31
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return compress(state, last)


def as_text(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 8) as the blocks (n, 16) of their hex text."""
    return _HEX[_bytes(digests)].reshape(len(digests), 64).view(">u4").astype(np.uint32)


def _bytes(words: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(words).astype(">u4").view(np.uint8).reshape(len(words), 4 * words.shape[1])


def _words(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">u4").astype(np.uint32).reshape(-1, 8)


def _column(digests: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in _bytes(digests)]


# ---- one block -----------------------------------------------------------------------------------------------------


def levels_of(n: int, arity: int) -> int:
    """Levels above n nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // arity), levels + 1
    return levels


def raise_level(nodes: np.ndarray, arity: int) -> tuple[np.ndarray, np.ndarray]:
    """Parents of a level, and their states before each child slot: (parents, 8) and (parents, arity, 8)."""
    n = -(-len(nodes) // arity)
    text, state, kept = as_text(nodes), np.tile(START, (n, 1)), np.empty((n, arity, 8), np.uint32)
    for slot in range(arity):
        kept[:, slot] = state
        own = text[slot::arity]
        state[: len(own)] = compress(state[: len(own)], own)
    return finish(state, np.minimum(arity, len(nodes) - arity * np.arange(n))), kept


@dataclass
class Step:
    """A way up by one level: the parent's state before the slot, the siblings, and how many stand to the left."""

    state: np.ndarray
    siblings: np.ndarray
    left: int


def resume(digests: np.ndarray, states: np.ndarray, right: list[tuple[np.ndarray, np.ndarray]], run: np.ndarray) -> np.ndarray:
    """Parents of replaced children: from the state before the slot, with the replacement and the siblings to its right.

    ``right`` has, per place to the right, which children have a sibling there and the text of these siblings;
    ``run`` is the number of children of each parent.
    """
    state = compress(states, as_text(digests))
    for has, text in right:
        state[has] = compress(state[has], text)
    return finish(state, run)


def climb(nodes: np.ndarray, kept: list[np.ndarray], replaced: np.ndarray, at: np.ndarray, above: list[Step], arity: int) -> tuple[np.ndarray, np.ndarray]:
    """Root digests after replacing one leaf each, and digests of all siblings on its way, for many leaves of a block."""
    place, digests = at.copy(), replaced
    proof, length = np.tile(START, (len(at), 1)), np.zeros(len(at), np.int64)

    def prove(has: np.ndarray, text: np.ndarray) -> None:
        proof[has] = compress(proof[has], text)
        length[has] += 1

    for states in kept:
        text, parent, slot = as_text(nodes), place // arity, place % arity
        right = []
        for other in range(arity):
            has = np.flatnonzero((other != slot) & (parent * arity + other < len(nodes)))
            if not len(has):
                continue
            theirs = text[parent[has] * arity + other]
            prove(has, theirs)
            after = slot[has] < other
            right.append((has[after], theirs[after]))
        run = np.minimum(arity, len(nodes) - parent * arity)
        digests = resume(digests, states[parent, slot], right, run)
        nodes, place = raise_level(nodes, arity)[0], parent
    every = np.arange(len(at))
    for step in above:  # the same for all leaves of the block
        text = np.repeat(as_text(step.siblings)[:, None], len(at), axis=1)
        for one in text:
            prove(every, one)
        states = np.tile(step.state, (len(at), 1))
        digests = resume(digests, states, [(every, one) for one in text[step.left :]], np.full(len(at), len(step.siblings) + 1))
    return digests, finish(proof, length)


# ---- the tree as tables ---------------------------------------------------------------------------------------------

_TIER = "tree string, block long, total long, digest binary, nodes binary, states binary"
_PATH = "array<struct<state: binary, siblings: array<binary>, at: int>>"


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place in the tree from 0, and ``total``, the tree's rows; no task holds a whole tree.

    Rows are written in ranges of tree and order, one per task, numbered inside their range and shifted by the rows of
    the tree in earlier ranges.
    """
    ranged = settle(rows.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id()))
    counts = ranged.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    shifts = counts.select("tree", "range", (F.sum("n").over(tree.orderBy("range")) - F.col("n")).alias("shift"), F.sum("n").over(tree).alias("total"))
    inside = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*order)) - 1
    numbered = ranged.withColumn("inside", inside).join(shifts, ["tree", "range"])
    return settle(numbered.withColumn("pos", F.col("shift") + F.col("inside")).drop("range", "shift", "inside"))


def _height(arity: int) -> int:
    return max(1, int(math.log(BLOCK, arity) + 1e-9))


def build(nodes: DataFrame, arity: int) -> list[DataFrame]:
    """The tiers of trees over ``tree, pos, total, digest``, each a written table with a row per block."""
    height = _height(arity)
    size = arity**height
    tiers: list[DataFrame] = []

    def raised(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        level, total = _words(b"".join(rows["digest"])), int(rows["total"].iloc[0])
        leaves, kept = level, []
        for _ in range(min(height, levels_of(total, arity))):
            level, states = raise_level(level, arity)
            kept.append(states)
        states = b"".join(_bytes(s.reshape(-1, 8)).tobytes() for s in kept)
        return pd.DataFrame([(*key, total, _column(level)[0], _bytes(leaves).tobytes(), states)], columns=["tree", "block", "total", "digest", "nodes", "states"])

    while True:
        block = F.floor(F.col("pos") / size).alias("block")
        tiers.append(settle(nodes.select("tree", "pos", "total", "digest", block).groupBy("tree", "block").applyInPandas(raised, _TIER)))
        largest = tiers[-1].agg(F.max("total")).first()[0]
        nodes = tiers[-1].select("tree", F.col("block").alias("pos"), F.ceil(F.col("total") / size).alias("total"), "digest")
        if largest is None or largest <= size:
            return tiers


def _kept(states: bytes, n: int, arity: int) -> list[np.ndarray]:
    """The states of a block of n leaves, by level."""
    every, out, at = _words(states), [], 0
    while at < len(every):
        n = -(-n // arity)
        out.append(every[at : at + n * arity].reshape(n, arity, 8))
        at += n * arity
    return out


def _ways(nodes: np.ndarray, kept: list[np.ndarray], arity: int) -> list[list[dict]]:
    """Per leaf of a block, its steps up to the block's root."""
    ways: list[list[dict]] = [[] for _ in nodes]
    place = np.arange(len(nodes))
    for states in kept:
        own = _column(nodes)
        for way, p in zip(ways, place.tolist(), strict=True):
            parent, slot = divmod(p, arity)
            run = own[parent * arity : (parent + 1) * arity]
            way.append({"state": _column(states[parent, slot][None])[0], "siblings": run[:slot] + run[slot + 1 :], "at": slot})
        nodes, place = raise_level(nodes, arity)[0], place // arity
    return ways


def _descend(tier: DataFrame, paths: DataFrame, more: list[str], arity: int) -> DataFrame:
    """``tree, block, path`` of the nodes of a tier (blocks of the tier below), from those of its blocks."""
    size = arity ** _height(arity)

    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                nodes = _words(r.nodes)
                above = [{"state": s["state"], "siblings": list(s["siblings"]), "at": s["at"]} for s in r.path]
                ways = [way + above for way in _ways(nodes, _kept(r.states, len(nodes), arity), arity)]
                fixed = {name: [getattr(r, name)] * len(nodes) for name in more}
                yield pd.DataFrame({"tree": [r.tree] * len(nodes), "block": np.arange(len(nodes)) + r.block * size, "path": ways, **fixed})

    wide = tier.drop("total", "digest").join(paths, ["tree", "block"])
    return wide.mapInPandas(children, f"tree string, block long, path {_PATH}" + "".join(f", {name} binary" for name in more))


def leaf_of(n_chars: Column | None = None) -> Column:
    """The leaf of a row of documents, as hex text: its fields, each with its length in bytes, or a dash for null."""

    def said(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    chars = F.col("n_chars") if n_chars is None else n_chars
    return F.sha2(F.concat(*[said(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), chars, F.col("text"))]), 256)


@dataclass
class Manifest:
    """Written tables: leaves in their places, the tiers of the trees per language, their roots in places, the tiers above."""

    leaves: DataFrame  # tree, pos, total, doc_id, digest, replaced
    tiers: list[DataFrame]
    subroots: DataFrame  # tree '', pos, total, name, digest
    top: list[DataFrame]
    arity: int


def manifest(docs: DataFrame, replaced: Column, arity: int = 2) -> Manifest:
    """The tree over ``docs``; ``replaced`` is the leaf (hex text) that is to be folded in for a row, null for its own."""
    ship_package(docs.sparkSession)
    # Null before any text, texts by their bytes.
    tree = F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), F.col("lang").cast("string")))
    rows = docs.select(tree.alias("tree"), "doc_id", F.unhex(leaf_of()).alias("digest"), F.unhex(replaced).alias("replaced"))
    leaves = placed(rows, ["doc_id", "digest"])
    tiers = build(leaves, arity)
    roots = tiers[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = placed(roots, ["name"])
    return Manifest(leaves, tiers, subroots, build(subroots, arity), arity)


def folded(tree: Manifest) -> DataFrame:
    """Per leaf, the root after its replacement; see ``prove``."""
    arity = tree.arity
    none = F.from_json(F.lit("[]"), _PATH)
    paths = tree.top[-1].select("tree", "block", none.alias("path"), F.col("digest").alias("root"))
    for tier in reversed(tree.top):
        paths = _descend(tier, paths, ["root"], arity)
    names = tree.subroots.select(F.col("pos").alias("block"), "name", F.col("digest").alias("subroot"))
    paths = settle(paths.drop("tree").join(names, "block").select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "root", "subroot"))
    for tier in reversed(tree.tiers[1:]):
        paths = settle(_descend(tier, paths, ["root", "subroot"], arity))
    size = arity ** _height(arity)
    blocks = tree.tiers[0].drop("total", "digest").join(paths, ["tree", "block"])
    rows = tree.leaves.select("tree", "pos", "doc_id", "digest", "replaced", F.floor(F.col("pos") / size).alias("block"))

    def fold(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        (r,) = block.itertuples(index=False)
        nodes = _words(r.nodes)
        above = [Step(_words(s["state"])[0], _words(b"".join(s["siblings"])), int(s["at"])) for s in r.path]
        fresh = _words(b"".join(d if d is not None else own for d, own in zip(rows["replaced"], rows["digest"], strict=True)))
        at = rows["pos"].to_numpy(np.int64) - r.block * size
        roots, proofs = climb(nodes, _kept(r.states, len(nodes), arity), fresh, at, above, arity)
        hexed = [b.hex() for b in _column(roots)]
        return pd.DataFrame({
            "doc_id": rows["doc_id"],
            "leaf": [d.hex() for d in rows["digest"]],
            "subroot": r.subroot.hex(),
            "root": r.root.hex(),
            "proof_sha256": [b.hex() for b in _column(proofs)],
            "folded_root": hexed,
            "verified": [h == r.root.hex() for h in hexed],
        })

    doc_id = tree.leaves.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return rows.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(fold, schema)


def prove(docs: DataFrame, arity: int = 2) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of documents.

    A row whose id's crc32 is divisible by 7 is tampered with: its ``n_chars`` grows by 1, where it is not null. Nulls in
    any column are dashes in the leaf, apart from empty texts; a null id comes first and is not tampered with; a null lang has a tree
    of its own. Rows of equal ids follow each other by their leaves, whole copies stand side by side; an empty table
    gives no rows; other columns are not read.
    """
    seven = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    touched = F.when(seven & F.col("n_chars").isNotNull(), leaf_of(F.col("n_chars") + 1))
    return folded(manifest(docs.select("doc_id", "source", "lang", "n_chars", "text"), touched, arity))
