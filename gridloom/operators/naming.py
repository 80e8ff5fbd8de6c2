"""Column names as rows: ``names(source, sheet, col_idx, raw)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions import text
from gridloom.operators.grid import SHEET

CLEANERS = {
    "excel": text.clean_name_excel,
    "html": text.clean_name_html,
    "dl": text.clean_name_dl,
}


def clean_names(names: DataFrame, family: str) -> DataFrame:
    """Add ``name`` by the rule of a file family."""
    if family in CLEANERS:
        return names.withColumn("name", CLEANERS[family](F.col("raw"), F.col("col_idx")))
    simple = {"text": text.clean_name_text, "csv": text.clean_name_csv, "layout": text.clean_name_layout}[family]
    return names.withColumn("name", simple(F.col("raw")))


def dedupe_names(names: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The second use of a name gets ``_2``, the third ``_3`` …, or the next suffix that is free.

    From left to right a name stays if no column before it has it; else it gets
    the number of its use, or the first number after that which gives a name no
    column before it has (``a, a, a_2`` → ``a, a_2, a_2_2``). Names are compared
    without case, as the parquet reader does. The names of one table meet in
    one row; tables without a repeated name are left alone.
    """
    keys = SHEET if keys is None else keys
    ordered = F.sort_array(F.collect_list(F.struct("col_idx", "name")))
    # Lists leave NULL names out.
    tables = names.groupBy(*keys).agg(ordered.alias("__names"), F.collect_list(F.lower("name")).alias("__folded"))
    repeated = F.size(F.array_distinct("__folded")) < F.size("__folded")

    def step(done: Column, n: Column) -> Column:
        taken, seen, fold = done["taken"], done["seen"], F.lower(n["name"])
        use = F.size(F.filter(seen, lambda s: s == fold)) + 1
        numbers = F.sequence(F.greatest(use, F.lit(2)), use + F.size(taken) + 2)
        free = F.aggregate(
            numbers,
            F.lit(None).cast("int"),
            lambda found, k: F.when(found.isNotNull(), found).when(~F.array_contains(taken, F.concat_ws("_", fold, k)), k),
        )
        name = F.when(~F.array_contains(taken, fold), n["name"]).otherwise(F.concat_ws("_", n["name"], free))
        kept = F.when(n["name"].isNull(), n["name"]).otherwise(name)
        row = F.struct(n["col_idx"].alias("col_idx"), kept.alias("name"))
        grown = F.struct(
            F.concat(taken, F.array(F.coalesce(F.lower(kept), F.lit("")))).alias("taken"),
            F.concat(seen, F.array(F.coalesce(fold, F.lit("")))).alias("seen"),
            F.concat(done["out"], F.array(row)).alias("out"),
        )
        return grown

    kind = names.select(F.struct("col_idx", "name")).schema[0].dataType.simpleString()
    empty = F.struct(
        F.array().cast("array<string>").alias("taken"),
        F.array().cast("array<string>").alias("seen"),
        F.array().cast(f"array<{kind}>").alias("out"),
    )
    resolved = F.aggregate("__names", empty, step, lambda done: done["out"])
    unique = tables.select(*keys, F.explode(F.when(repeated, resolved).otherwise(F.col("__names"))).alias("__unique"))
    unique = unique.select(*keys, F.col("__unique.col_idx").alias("col_idx"), F.col("__unique.name").alias("__name"))
    return names.join(unique, [*keys, "col_idx"]).withColumn("name", F.col("__name")).select(*names.columns)


def truncate_names(names: DataFrame, length: int = text.MAX_NAME_LENGTH) -> DataFrame:
    return dedupe_names(names.withColumn("name", text.truncate_name(F.col("name"), length)))


def numeric_header_guard(names: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Where any name is all digits, all become ``col_1 … col_n``.

    ``header_is_data`` then tells that the heading line stays a data row.
    """
    keys = SHEET if keys is None else keys
    group = Window.partitionBy(*keys)
    numeric = F.coalesce(F.bool_or(text.is_digits(F.col("name"))).over(group), F.lit(False))
    position = F.row_number().over(group.orderBy("col_idx"))
    return names.withColumn("header_is_data", numeric).withColumn(
        "name",
        F.when(F.col("header_is_data"), F.concat(F.lit("col_"), position.cast("string"))).otherwise(F.col("name")),
    )


def positional_names(names: DataFrame) -> DataFrame:
    return names.withColumn("name", F.concat(F.lit("col_"), F.col("col_idx").cast("string")))


def dl_header_guard(names: DataFrame) -> DataFrame:
    """``keep_positional`` for headings that are no headings in the DL family.

    One of: a purely alphabetic name next to one with ``=``; no alphabetic
    name, no ``-`` and no ``(`` after the first, which is not empty; a name
    with ``Sheet``.
    """
    bare = F.regexp_replace(text.strip(F.col("raw")), "[^a-zA-Z0-9=()-]", "")
    marked = names.withColumn("__bare", bare)
    rest = F.col("col_idx") > 0
    # One aggregate row per table, joined back by its key.
    verdict = marked.groupBy(*SHEET).agg(
        F.coalesce(F.bool_or(text.is_alpha(F.col("__bare"))), F.lit(False)).alias("alpha"),
        F.coalesce(F.bool_or(F.col("__bare").contains("=")), F.lit(False)).alias("equals"),
        F.coalesce(F.bool_and(F.when(rest, F.col("__bare").isNotNull() & ~text.is_alpha(F.col("__bare")))), F.lit(True)).alias("no_alpha"),
        F.coalesce(F.bool_or(F.when(rest, F.col("__bare").contains("-") | F.col("__bare").contains("("))), F.lit(False)).alias("marks"),
        F.coalesce(F.bool_or(F.when(~rest, F.coalesce(F.col("__bare"), F.lit("x")) == "")), F.lit(False)).alias("first_empty"),
        F.coalesce(F.bool_or(F.col("__bare").contains("Sheet")), F.lit(False)).alias("sheet_word"),
    )
    positional = (
        (F.col("alpha") & F.col("equals"))
        | (F.col("no_alpha") & ~F.col("marks") & ~F.col("first_empty"))
        | F.col("sheet_word")
    )
    return names.join(verdict.select(*SHEET, positional.alias("keep_positional")), SHEET)
