"""Pages with tables, end to end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import join_by_row
from gridloom.operators import combine, html_tables, naming, structure
from gridloom.operators.grid import COLUMN, ROW, SHEET, normalise_rows
from gridloom.plans.workbook import SheetTables
from gridloom.session import settle
from gridloom.sources import html


def page_tables(pages: DataFrame, keys: Sequence[str] = ("url",)) -> SheetTables:
    """Every table of every page: caption and foot as notes, labels by indentation."""
    return cell_tables(settle(html.html_table_cells(pages, keys)), keys)


def cell_tables(cells: DataFrame, keys: Sequence[str] = ("url",)) -> SheetTables:
    """The same from the cells of the tables."""
    marked = settle(html_tables.page_grid(cells, keys))
    classified = structure.classify_rows_html(normalise_rows(marked.select(*ROW, "vals", "is_header")))
    heads = classified.filter("is_header").select(*SHEET, F.posexplode("vals").alias("col_idx", "raw"))
    names = naming.dedupe_names(naming.clean_names(heads, "html").select(*COLUMN, "name"))
    body = classified.filter("role = 'body' and not is_header").select(*ROW, "vals")
    rows = structure.drop_label_rows(structure.indent_path(body))
    return SheetTables(settle(names), settle(rows), settle(structure.notes_concat(classified)))


def page_outputs(cells: DataFrame, names: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Where every table goes: group by file name, tables of one caption and width together.

    Captions meet twice: the tables of a page, then the outputs of all pages of a folder and group, in the order of
    pages and tables. ``table_id`` numbers the tables of a page, ``place`` the outputs of pages in their folder.
    """
    found = html_tables.captions(cells, keys).select(
        F.concat_ws("|", *keys).alias("source"), F.col("table_idx").cast("string").alias("sheet"), "key", "table_idx"
    )
    widths = names.groupBy(*SHEET).agg(F.count(F.lit(1)).alias("n_cols"))
    tables = found.join(widths, SHEET).withColumn("table_id", F.col("table_idx").cast("long")).drop("table_idx")
    folder = F.regexp_extract("source", r"^(.*/)[^/]*$", 1)
    first = F.min("table_id").over(Window.partitionBy("source", "key"))
    same = settle(combine.union_same_key(tables, ["source", "key"]).withColumns({"folder": folder, "__first": first}))
    # One row per output of a page, in the order in which the page yields them.
    of_pages = combine.output_group(same).groupBy("folder", "output_group", "source", "output").agg(
        F.min("n_cols").alias("n_cols"), F.min(F.struct("__first", "out_place")).alias("__at")
    )
    in_folder = Window.partitionBy("folder", "output_group").orderBy("source", "__at")
    numbered = of_pages.withColumns({"key": F.col("output"), "table_id": F.row_number().over(in_folder).cast("long")})
    joined = combine.union_same_key(numbered.drop("output"), ["folder", "output_group", "key"])
    named = combine.route_outputs(joined.withColumnsRenamed({"key": "__page_key", "output": "key"}))
    routes = named.select("source", F.col("__page_key").alias("output"), "output_group", "table_name", F.col("table_id").alias("place"))
    return same.join(routes, ["source", "output"]).select(*SHEET, "folder", "output_group", "table_name", "place", "table_id", "n_cols")


def page_unions(found: SheetTables, outputs: DataFrame) -> DataFrame:
    """The rows of all tables beside their output; columns of an output are matched by position.

    ``place``, ``table_id`` and ``row_idx`` keep the order; ``sinks.route_write`` writes one folder per output.
    """
    return join_by_row(found.rows, outputs, SHEET).select("folder", "output_group", "table_name", "place", "table_id", "row_idx", "source", "vals")


def simple_tables(pages: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Rows of the first table of every page beside its notes; row 0 holds the names."""
    cells = html.html_table_cells(pages, keys)
    return html.simple_table_rows(cells, keys).join(html.page_notes(pages, keys), list(keys))
