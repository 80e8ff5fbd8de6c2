"""Distinct rows and unions of tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.ordered import over_blocks, running_total, whole_first
from gridloom.functions.text import parent_folder


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_subset(df: DataFrame, subset: Sequence[str], order: str) -> DataFrame:
    """One row per key, the first in ``order``.

    ``min_by`` aggregates before the shuffle; a window would sort all copies
    of a hot key in one task.
    """
    rest = [c for c in df.columns if c not in subset]
    first = F.min_by(F.struct(*rest), order)
    picked = df.groupBy(*subset).agg(first.alias("__first"))
    return picked.select(*[F.col(c) if c in subset else F.col("__first")[c].alias(c) for c in df.columns])


def distinct_folders(paths: DataFrame, path: str, order: str) -> DataFrame:
    """Parent folders with the place of their first file (``first_seen``)."""
    return paths.groupBy(parent_folder(F.col(path)).alias("folder")).agg(F.min(order).alias("first_seen"))


def union_by_name_merge(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables; columns are matched by name without case, missing ones are NULL.

    The merged columns are worked out first. Every table is brought to them and tables are stacked two by two, so the
    plan of n tables is log n deep, not n.
    """
    merged: dict[str, str] = {}
    for t in tables:
        for c in t.columns:
            merged.setdefault(c.lower(), c)

    def whole(t: DataFrame) -> DataFrame:
        own = {c.lower(): c for c in t.columns}
        quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
        return t.select(*[(quoted(own[k]) if k in own else F.lit(None)).alias(name) for k, name in merged.items()])

    level = [whole(t) for t in tables]
    while len(level) > 1:
        level = [level[i].unionAll(level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def union_stored(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Stack stored tables as ``union_by_name_merge`` does: their schemas are merged from the footers, then one scan reads all.

    Columns of one name must have types that merge.
    """
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def concat_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    return union_by_name_merge(tables)


def union_positional(tables: Sequence[DataFrame], names: Sequence[str] = ("Code", "Desription", "Name")) -> DataFrame:
    """Stack two-column code tables, named after the first column of each."""
    as_codes = [
        t.select(
            F.col(t.columns[0]).cast("string").alias(names[0]),
            F.col(t.columns[1]).cast("string").alias(names[1]),
            F.lit(t.columns[0]).alias(names[2]),
        )
        for t in tables
    ]
    return reduce(DataFrame.union, as_codes)


def union_same_key(tables: DataFrame, keys: Sequence[str] = ("key",)) -> DataFrame:
    """Which tables of one key go into one output.

    Input: one row per table, ``(key…, table_id, n_cols)``. Tables as wide as
    the first of their key share its output; others get ``<key>_<i>``, ``i``
    being the 0-based place among the later tables. ``out_place`` orders the
    outputs of a key: separate ones first, the union last.
    """
    key = keys[-1]
    numbered = over_blocks(
        tables,
        keys,
        "table_id",
        {
            "__first": whole_first(F.col("n_cols"), "table_id"),
            "__at": running_total(F.lit(1).cast("long"), inclusive=False),
        },
    )
    joins = F.col("n_cols") == F.col("__first")
    output = F.when(joins, F.col(key)).otherwise(F.concat_ws("_", F.col(key), (F.col("__at") - 1).cast("string")))
    place = F.when(joins, F.lit(2147483647)).otherwise(F.col("__at") - 1)
    return numbered.select(*tables.columns, output.alias("output"), place.cast("int").alias("out_place"))


def output_group(tables: DataFrame, path: str = "source", marker: str = "NSDUHDetTabsSect") -> DataFrame:
    """``output_group`` by file name."""
    group = F.when(F.col(path).contains(marker), "NSDUHDetTabsSect").otherwise("NSDUHDetTabsApp")
    return tables.withColumn("output_group", group)


def route_outputs(tables: DataFrame, path: str = "source", marker: str = "NSDUHDetTabsSect") -> DataFrame:
    """Output group by file name, and a numbered name for tables without a caption.

    Input: one row per output table, ``(source, folder, key, table_id)``.
    """
    grouped = output_group(tables, path, marker)
    empty = F.trim("key") == ""
    counted = over_blocks(
        grouped, ["folder", "output_group"], "table_id", {"__index": running_total(empty.cast("int"))}
    )
    numbered = F.concat(F.lit("index_"), F.col("__index").cast("string"))
    return counted.withColumn("table_name", F.when(empty, numbered).otherwise(F.col("key"))).drop("__index")
