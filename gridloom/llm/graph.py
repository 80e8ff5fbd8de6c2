"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import settle


#: Places in which a node meets its facts.
SALTS = 16


def beside(rows: DataFrame, facts: DataFrame, key: str, by: str) -> DataFrame:
    """The facts of a key beside its rows, which ``by`` deals to ``SALTS`` places, so that no task holds a whole key.

    A merge join: Spark does not count the copies of the facts when it takes their size, and would broadcast them.
    """
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(salted.hint("merge"), [key, "_salt"]).drop("_salt")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to its smallest neighbour or itself."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return beside(both, least, "a", "b").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = beside(down, least, "a", "b").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of an edge list ``a, b``; the root is the smallest node of the component.

    Large and small stars in turn, until the edges are stars. Each round goes to the shared checkpoint folder. Only
    the number of edges and a checksum of them come to the driver.
    """
    edges = settle(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    before = None
    while True:
        row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if not row["n"] or before == (row["n"], row["s"]):
            break
        before = (row["n"], row["s"])
        edges = settle(_small_star(_large_star(edges)))
    root = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
