"""Shards by a hierarchical weighted hash tree.

A row walks from the root to a shard. On each level every child draws ``-ln(u) / weight`` with ``u`` from a hash of the
row's key and the child's name, and the smallest draw wins; a subtree weighs what its shards weigh. A draw depends on
the key and the child alone, so changing weights moves rows into subtrees that grew or out of those that shrank, and
nothing else moves. A new shard comes as a branch of its own, thus takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import text_of
from gridloom.session import settle


@dataclass(frozen=True)
class Node:
    """A subtree (region, rack) or, with a ``shard``, a leaf; names are unique and all leaves are on one level."""

    name: str
    shard: int | None = None
    weight: float = 1.0
    children: tuple[Node, ...] = field(default=())

    @property
    def total(self) -> float:
        return sum(c.total for c in self.children) if self.children else self.weight


def tree(regions: int, racks: int, shards: int) -> Node:
    """Equal shards, numbered depth first."""
    region = []
    for g in range(regions):
        rack = []
        for k in range(racks):
            first = (g * racks + k) * shards
            rack.append(Node(f"g{g}k{k}", children=tuple(Node(f"s{first + s}", first + s) for s in range(shards))))
        region.append(Node(f"g{g}", children=tuple(rack)))
    return Node("root", children=tuple(region))


def grown(root: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and a rack of its own."""
    leaf = Node(f"s{shard}", shard, weight)
    return Node(root.name, children=(*root.children, Node(f"g+{shard}", children=(Node(f"g+{shard}k", children=(leaf,)),))))


def draw(key: Column, name: Column, weight: Column) -> Column:
    """``-ln(u) / weight``, u in (0, 1) from the first 52 bits of an MD5 digest."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), name).cast("binary")), 1, 13), 16, 10).cast("long")
    return -F.log((bits.cast("double") + 0.5) / float(2**52)) / weight


def place(key: Column, root: Node) -> Column:
    """The shard of a key: from the root down, the child with the smallest draw (ties: the first name)."""
    inner, leaves, level, depth = [], [], [root], 0
    while level:
        inner += [n for n in level if n.children]
        leaves += [n for n in level if n.shard is not None]
        level = [c for n in level for c in n.children]
        depth += bool(level)
    below = F.create_map(*[x for n in inner for x in (F.lit(n.name), F.array(*[F.struct(F.lit(c.name).alias("name"), F.lit(float(c.total)).alias("weight")) for c in n.children]))])
    at = F.lit(root.name)
    for _ in range(depth):
        draws = F.transform(F.try_element_at(below, at), lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["name"].alias("name")))
        at = F.array_min(draws)["name"]
    return F.try_element_at(F.create_map(*[x for n in leaves for x in (F.lit(n.name), F.lit(n.shard))]), at)


def slots(placed: DataFrame, group: str, slot: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, with no task that sees a whole group.

    Rows are written with the number of the task that wrote them, numbered inside (group, task), and shifted by the
    rows of the group in earlier tasks, from a table of one row per group and task.
    """
    rows = settle(placed.withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    counts = rows.groupBy(group, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(group, "_task", (F.sum("_n").over(Window.partitionBy(group).orderBy("_task")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy(group, "_task").orderBy("_row")
    numbered = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    return numbered.join(before, [group, "_task"]).withColumn(slot, (F.col("_before") + F.col("_inside")).cast("long")).drop("_task", "_row", "_before", "_inside", "_n")


def shard_documents(docs: DataFrame, root: Node, root_grown: Node | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard`` per row.

    The id alone decides the shard, so rows with equal ids share one; a null id counts as empty text. Null texts are
    empty: size 8, checksum 0. An empty table gives no rows; other columns are not read.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 8).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        place(key, root).cast("int").alias("shard"),
        (place(key, root_grown) if root_grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    return slots(placed, "shard", "slot")
