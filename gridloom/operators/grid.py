"""The grid model and the operators that look at whole rows or columns.

Two forms of the same data:

* ``rows(source, sheet, row_idx, vals)`` with ``vals array<string>``, one entry
  per column and NULL where the cell is empty;
* ``cells(source, sheet, row_idx, col_idx, value)``, one row per grid position.

Column tests need one aggregate over all columns at once (partial aggregation,
so a large sheet is reduced where it is read) instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import over_blocks, whole_first, whole_min
from gridloom.functions.text import null_normalise
from gridloom.session import settle

SHEET = ["source", "sheet"]
ROW = [*SHEET, "row_idx"]
COLUMN = [*SHEET, "col_idx"]


def to_cells(rows: DataFrame) -> DataFrame:
    return rows.select(*ROW, F.posexplode("vals").alias("col_idx", "value"))


def to_rows(cells: DataFrame) -> DataFrame:
    """Grouping is per row, so the size of a group is the width of the sheet."""
    ordered = F.array_sort(F.collect_list(F.struct("col_idx", "value")))
    return cells.groupBy(*ROW).agg(F.transform(ordered, lambda c: c["value"]).alias("vals"))


def normalise_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("vals", F.transform("vals", null_normalise))


def normalise_cells(cells: DataFrame) -> DataFrame:
    return cells.withColumn("value", null_normalise(F.col("value")))


# ---- row level ----------------------------------------------------------


def non_null(vals: Column) -> Column:
    return F.filter(vals, lambda v: v.isNotNull())


def n_cells(vals: Column) -> Column:
    return F.size(non_null(vals))


def n_nulls(vals: Column) -> Column:
    return F.size(vals) - n_cells(vals)


def cell(vals: Column, position: int) -> Column:
    """Cell at a 0-based position, negative ones counted from the end."""
    return F.try_element_at(vals, F.lit(position + 1 if position >= 0 else position))


def first_value(vals: Column) -> Column:
    return F.try_element_at(non_null(vals), F.lit(1))


def cell_counts(cells: DataFrame) -> DataFrame:
    """Non-empty and empty cells per row."""
    return cells.groupBy(*ROW).agg(
        F.count("value").alias("n_cells"), (F.count(F.lit(1)) - F.count("value")).alias("n_nulls")
    )


def drop_blank_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.exists("vals", lambda v: v.isNotNull()))


def keep_rows_with(rows: DataFrame, minimum: int) -> DataFrame:
    return rows.filter(n_cells(F.col("vals")) >= minimum)


# ---- column level -------------------------------------------------------


def column_profile(cells: DataFrame) -> DataFrame:
    """One row per column of every sheet, from a single aggregate."""
    return cells.groupBy(*COLUMN).agg(
        F.count("value").alias("n_values"),
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bool_or(F.col("value") == "*"), F.lit(False)).alias("has_star"),
        F.coalesce(F.bool_or(F.col("value") == "Line"), F.lit(False)).alias("has_line"),
        F.coalesce(F.bool_or(F.col("value").startswith("Table")), F.lit(False)).alias("has_table_mark"),
    )


def keep_columns(cells: DataFrame, condition: Column) -> DataFrame:
    """Cells of the columns whose profile meets ``condition``.

    The profile is written first, a row per column. Spark then knows its size:
    it broadcasts a small one, so that the cells are not shuffled at all, and
    sort-merges beyond its limit, splitting skewed columns.
    """
    kept = settle(column_profile(cells).filter(condition).select(*COLUMN))
    return cells.join(kept, COLUMN, "left_semi")


def select_columns(rows: DataFrame, condition: Column) -> DataFrame:
    """The same on whole rows: unwanted columns leave ``vals``, the rest close up.

    Sheets without a column left drop out.
    """
    kept = column_profile(to_cells(rows)).filter(condition)
    keep = settle(kept.groupBy(*SHEET).agg(F.array_sort(F.collect_list("col_idx")).alias("__keep")))
    picked = F.transform("__keep", lambda i: F.try_element_at("vals", i + 1))
    return rows.join(keep, SHEET).withColumn("vals", picked).drop("__keep")


def drop_empty_columns(cells: DataFrame) -> DataFrame:
    return keep_columns(cells, F.col("n_values") > 0)


def drop_sparse_columns(cells: DataFrame, minimum: int = 2) -> DataFrame:
    return keep_columns(cells, F.col("n_values") >= minimum)


def drop_star_columns(cells: DataFrame) -> DataFrame:
    return keep_columns(cells, ~(F.col("n_values").isin(1, 2) & F.col("has_star")))


def drop_marker_columns(cells: DataFrame) -> DataFrame:
    return keep_columns(cells, ~F.col("has_line"))


def drop_empty_rows(cells: DataFrame) -> DataFrame:
    filled = cells.groupBy(*ROW).agg(F.count("value").alias("n")).filter("n > 0").select(*ROW)
    return cells.join(filled, ROW, "left_semi")


def drop_empty_rows_cols(cells: DataFrame) -> DataFrame:
    """All-empty columns and rows removed; the order of the two does not matter."""
    return drop_empty_rows(drop_empty_columns(cells))


def compact_columns(cells: DataFrame) -> DataFrame:
    """Renumber the columns of every sheet from 0 after some were dropped."""
    # The window sees one row per column, not per cell.
    columns = cells.select(*COLUMN).distinct()
    numbered = settle(
        columns.withColumn("__new", F.row_number().over(Window.partitionBy(*SHEET).orderBy("col_idx")) - 1)
    )
    return cells.join(numbered, COLUMN).select(*ROW, F.col("__new").alias("col_idx"), "value")


def drop_leading_gap_column(rows: DataFrame) -> DataFrame:
    """Drop the first column of a sheet whose first row starts empty, filled."""
    marked = over_blocks(rows, SHEET, "row_idx", {"__first": whole_first(F.col("vals"), "row_idx")})
    gap = cell(F.col("__first"), 0).isNull() & cell(F.col("__first"), 1).isNotNull()
    vals = F.when(gap, F.slice("vals", 2, F.greatest(F.size("vals") - 1, F.lit(0)))).otherwise(F.col("vals"))
    return marked.withColumn("vals", vals).drop("__first")


def drop_description_marker_rows(rows: DataFrame) -> DataFrame:
    """Rows that repeat a machine heading: ``Description`` followed by ``C1``."""
    second, third = cell(F.col("vals"), 1), cell(F.col("vals"), 2)
    marker = (second == "Description") & third.isin("C1", "c1")
    return rows.filter(~F.coalesce(marker, F.lit(False)))


def first_rows(rows: DataFrame) -> DataFrame:
    """``is_first`` marks the first row of every sheet."""
    out = over_blocks(rows, SHEET, "row_idx", {"__first": whole_min(F.col("row_idx"))})
    return out.withColumn("is_first", F.col("row_idx") == F.col("__first")).drop("__first")
