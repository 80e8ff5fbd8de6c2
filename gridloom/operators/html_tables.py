"""From table cells of a page to grid rows: spans, headings, indentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import join_by_row
from gridloom.functions.text import caption_key

# Row classes that tell the depth of a label.
INDENT_CLASSES = ["subhead", "sub"]


def class_indent(cells: DataFrame) -> DataFrame:
    """Class ``subhead<n>`` or ``sub<n>`` of a row puts n blanks before its label."""
    depth = F.lit(None).cast("int")
    for name in reversed(INDENT_CLASSES):
        depth = F.when(F.col("row_class").contains(name), F.regexp_extract("row_class", rf"{name}(\d+)$", 1).try_cast("int")).otherwise(depth)
    indented = F.concat(F.repeat(F.lit(" "), F.coalesce(depth, F.lit(0))), F.col("text"))
    label = (F.col("part") == "tbody") & (F.col("cell_idx") == 0)
    return cells.withColumn("text", F.when(label, indented).otherwise(F.col("text")))


def repeat_colspan(cells: DataFrame) -> DataFrame:
    """A cell over several columns is repeated; ``place`` counts the copies of a row."""
    return cells.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("colspan", F.lit(1)))))


def spanned_rows(cells: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Rows of ``struct<text, rowspan>`` arrays, column spans repeated."""
    ordered = F.array_sort(F.collect_list(F.struct("cell_idx", "copy", "text", "rowspan")))
    body = repeat_colspan(cells.filter(F.col("part").isin("thead", "tbody")))
    return body.groupBy(*keys, "table_idx", "part", "row_idx").agg(
        F.transform(ordered, lambda c: F.struct(c["text"].alias("text"), c["rowspan"].alias("rowspan"))).alias("cells")
    )


def insert_rowspans(rows: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """A cell over several rows inserts empty cells below it, at its own index.

    Every such cell names the rows it reaches; these collect the indexes, in
    the order of the cells, and insert one after the other. Rows are counted
    inside one table, which is a piece of one page record. A heading of one
    row ignores row spans.
    """
    part = [*keys, "table_idx", "part"]
    table = Window.partitionBy(*part)
    placed = rows.withColumn("__at", F.row_number().over(table.orderBy("row_idx", "slice_idx"))).withColumn(
        "__of", F.count(F.lit(1)).over(table)
    )
    spans = placed.filter(
        F.exists("cells", lambda c: c["rowspan"] > 1) & ((F.col("part") != "thead") | (F.col("__of") > 1))
    ).select(*part, "__at", "__of", F.posexplode("cells").alias("__index", "__cell"))
    # A span never reaches below the last row of its part.
    last = F.least(F.col("__at") + F.col("__cell.rowspan") - 1, F.col("__of"))
    reached = spans.filter((F.col("__cell.rowspan") > 1) & (F.col("__at") < F.col("__of"))).select(
        *part, F.struct("__at", "__index").alias("__from"), F.explode(F.sequence(F.col("__at") + 1, last)).alias("__at")
    )
    inserts = reached.groupBy(*part, "__at").agg(
        F.transform(F.array_sort(F.collect_list("__from")), lambda f: f["__index"]).alias("__inserts")
    )
    texts = F.transform("cells", lambda c: c["text"])
    insert = lambda acc, i: F.concat(
        F.slice(acc, F.lit(1), i), F.array(F.lit("")), F.slice(acc, i + 1, F.greatest(F.size(acc) - i, F.lit(0)))
    )
    filled = F.aggregate(F.coalesce("__inserts", F.array().cast("array<int>")), texts, insert)
    return join_by_row(placed, inserts, [*part, "__at"], "left").select(*part, "row_idx", "slice_idx", filled.alias("vals"))


def span_expand(cells: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Rows ``(keys…, table_idx, part, row_idx, vals)`` with spans resolved."""
    whole = spanned_rows(cells, keys).withColumn("slice_idx", F.lit(0))
    return insert_rowspans(whole, keys).drop("slice_idx")


def header_row(expanded: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """One heading per table: its rows joined by a space, as wide as the narrowest."""
    ordered = F.array_sort(F.collect_list(F.struct("row_idx", "vals")))
    head = expanded.filter("part = 'thead'")
    return head.groupBy(*keys, "table_idx").agg(ordered.alias("__rows")).select(
        *keys, "table_idx", _fold("__rows").alias("header")
    )


def _fold(rows: str):
    first = F.element_at(rows, 1)["vals"]
    rest = F.slice(rows, F.lit(2), F.greatest(F.size(rows) - 1, F.lit(0)))
    width = lambda a, b: F.least(F.size(a), F.size(b))
    step = lambda acc, r: F.zip_with(
        F.slice(acc, F.lit(1), width(acc, r["vals"])),
        F.slice(r["vals"], F.lit(1), width(acc, r["vals"])),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.aggregate(rest, first, step)


def wide_row_slice(
    body: DataFrame, header: DataFrame, keys: Sequence[str] = ("url",), chunks: bool = False, cells: str = "vals"
) -> DataFrame:
    """Body rows wider than the heading, except the first, as prefixes.

    For every multiple of the heading's width below the row's width the first
    that many cells come out, so later parts repeat the first; ``chunks`` gives
    the pieces in between instead.
    """
    table = [*keys, "table_idx"]
    facts = body.groupBy(*table).agg(F.min("row_idx").alias("__first")).join(
        header.select(*table, F.size("header").alias("__w")), table
    )
    wide = join_by_row(body, facts, table)
    width = F.size(cells)
    sliced = (F.col("row_idx") > F.col("__first")) & (width > F.col("__w")) & (F.col("__w") > 0)
    ends = F.when(sliced, F.sequence(F.col("__w"), width - 1, F.col("__w"))).otherwise(F.array(width))
    out = wide.select("*", F.posexplode(ends).alias("slice_idx", "__end"))
    start = F.when(sliced & F.lit(chunks), F.col("__end") - F.col("__w") + 1).otherwise(F.lit(1))
    piece = F.slice(cells, start, F.col("__end") - start + 1)
    return out.withColumn(cells, piece).drop("__first", "__w", "__end")


def page_grid(cells: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    """Grid rows per table: caption, heading, body, foot, in this order.

    ``source`` is the page, ``sheet`` the table; the heading is the row marked
    ``is_header``. Wide rows are sliced before row spans are resolved.
    """
    keys = list(keys)
    table = [*keys, "table_idx"]
    marked = class_indent(cells)
    rows = spanned_rows(marked, keys)
    head = insert_rowspans(rows.filter("part = 'thead'").withColumn("slice_idx", F.lit(0)), keys)
    header = header_row(head, keys)
    sliced = wide_row_slice(rows.filter("part = 'tbody'"), header, keys, cells="cells")
    body = insert_rowspans(sliced, keys)
    note = lambda part: cells.filter(F.col("part") == part).select(*table, F.array("text").alias("vals"))
    pieces = [
        note("caption").select(*table, F.lit(0).alias("o"), F.lit(0).alias("row_idx"), F.lit(0).alias("slice_idx"), "vals"),
        header.select(*table, F.lit(1).alias("o"), F.lit(0).alias("row_idx"), F.lit(0).alias("slice_idx"), F.col("header").alias("vals")),
        body.select(*table, F.lit(2).alias("o"), "row_idx", "slice_idx", "vals"),
        note("tfoot").select(*table, F.lit(3).alias("o"), F.lit(0).alias("row_idx"), F.lit(0).alias("slice_idx"), "vals"),
    ]
    rows = pieces[0]
    for piece in pieces[1:]:
        rows = rows.unionByName(piece)
    # A table is a piece of one page record, so its rows are numbered inside one small window.
    inside = Window.partitionBy(*table).orderBy("o", "row_idx", "slice_idx")
    place = (F.row_number().over(inside) - 1).cast("long")
    return rows.select(
        F.concat_ws("|", *keys).alias("source"),
        F.col("table_idx").cast("string").alias("sheet"),
        place.alias("row_idx"),
        "vals",
        (F.col("o") == 1).alias("is_header"),
    )


def captions(cells: DataFrame, keys: Sequence[str] = ("url",)) -> DataFrame:
    return cells.filter("part = 'caption'").select(*keys, "table_idx", "text", caption_key(F.col("text")).alias("key"))
