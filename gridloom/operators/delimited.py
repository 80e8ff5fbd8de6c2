"""Delimited text of uneven shape: find the heading and the width of a file.

Rows come as ``rows(source, sheet, row_idx, vals)`` from ``delimited_layout``.
All decisions about a file look at its first lines only; these travel beside
the rows as one decision per file (``join_facts``), so no file is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.ordered import (
    dense_position,
    join_facts,
    no_blocks,
    over_blocks,
    whole_min,
    with_blocks,
)
from gridloom.functions.text import clean_name_text, is_digits, strip
from gridloom.operators.grid import ROW, SHEET, cell

RULER = r"^[- ]*$"
# Lines searched for a ruler; lines the decisions may look at.
RULER_LINES = 10
HEAD_LINES = RULER_LINES + 2
ERROR_MAP_SUFFIX = ".MapErrors"
ERROR_MAP_WIDTH = 5


def _drop_blank(lines: DataFrame) -> DataFrame:
    return lines.filter(strip(F.col("value")) != "")


def delimited_layout(lines: DataFrame) -> DataFrame:
    """Tab fields, each split again on runs of two or more blanks, in one array."""
    fields = F.flatten(F.transform(F.split("value", "\t"), lambda w: F.split(strip(w), r"(?U)\s\s+")))
    return _drop_blank(lines).select(*SHEET, "row_idx", fields.alias("vals"))


def tab_fields(lines: DataFrame) -> DataFrame:
    return _drop_blank(lines).select(*SHEET, "row_idx", F.split("value", "\t").alias("vals"))


def drop_last(vals: Column) -> Column:
    return F.slice(vals, F.lit(1), F.greatest(F.size(vals) - 1, F.lit(0)))


def file_heads(placed: DataFrame) -> DataFrame:
    """``head`` (the first rows, in order) and ``n_rows`` per file; needs ``position``.

    The partial aggregate keeps at most ``HEAD_LINES`` rows of a file.
    """
    early = F.when(F.col("position") < HEAD_LINES, F.struct("position", "vals"))
    heads = placed.groupBy(*SHEET).agg(F.collect_list(early).alias("head"), F.count(F.lit(1)).alias("n_rows"))
    return heads.withColumn("head", F.transform(F.array_sort("head"), lambda h: h["vals"]))


def _at(i: int) -> Column:
    return F.try_element_at("head", F.lit(i + 1))


def _placed(rows: DataFrame) -> DataFrame:
    return dense_position(with_blocks(rows, "row_idx"), SHEET, "row_idx")


def _file_layout(heads: DataFrame) -> DataFrame:
    """Mode, heading and what to do with the rows: one decision per file."""
    header, one, two = _at(0), _at(1), _at(2)
    is_ruler = lambda v: F.coalesce(cell(v, 0).rlike(RULER), F.lit(False))
    window = F.slice("head", 1, RULER_LINES)
    ruler = F.array_position(F.transform(window, is_ruler), True).cast("int") - 1
    seen = heads.withColumn("__ruler", F.when((F.size(header) <= 2) & (ruler >= 1), ruler))
    above = F.try_element_at("head", F.col("__ruler"))
    below = F.try_element_at("head", F.col("__ruler") + 2)
    words = F.split(F.regexp_replace(strip(cell(above, 0)), r"\s+", " "), " ")
    ruled = F.when(F.size(above) < F.size(below), words).otherwise(above)
    use_ruler = F.coalesce(F.size(ruled) == F.size(below), F.lit(False))

    ends_empty = F.coalesce(cell(one, -1) == "", F.lit(False))
    cut = lambda v: F.when(ends_empty, drop_last(v)).otherwise(v)
    one_cut, two_cut = cut(one), cut(two)
    # Columns whose cell in the second line is empty have no name and go.
    named = F.transform(one_cut, lambda v: strip(v) != "")
    n_named = F.size(F.filter(named, lambda v: v))
    narrow = F.size(header) < F.size(one)
    mode = (
        F.when(F.col("n_rows") == 1, "header_only")
        .when(use_ruler, "ruler")
        .when(~narrow, "plain")
        .when(F.size(header) == F.size(one_cut), "trim")
        .when((F.size(one_cut) == F.size(two_cut)) & (F.size(header) == n_named), "unnamed")
        .otherwise("bad")
    )
    return seen.select(
        *SHEET,
        "n_rows",
        mode.alias("mode"),
        F.when(mode == "ruler", ruled).otherwise(header).alias("header"),
        F.when(mode == "ruler", F.col("__ruler")).otherwise(0).alias("header_end"),
        ends_empty.alias("__cut"),
        named.alias("__named"),
    )


def sniff_table(rows: DataFrame) -> DataFrame:
    """Settle heading and width of every file.

    Adds ``mode``, ``header`` (raw names) and sets ``vals`` of the data rows;
    ``position`` tells data rows from the heading: only rows after
    ``header_end`` are data. Modes: ``header_only`` (one line), ``ruler`` (a
    line of dashes under the heading), ``plain``, ``trim`` (rows end in an
    empty field), ``unnamed`` (columns without a name in the second line) and
    ``bad`` (none fits; the rows go to the quarantine).
    """
    placed = _placed(rows)
    seen = join_facts(placed, _file_layout(file_heads(placed)), SHEET)
    cut = F.when(F.col("__cut"), drop_last(F.col("vals"))).otherwise(F.col("vals"))
    named_cells = F.filter(cut, lambda x, i: F.coalesce(F.try_element_at("__named", i + 1), F.lit(False)))
    vals = (
        F.when(F.col("mode") == "trim", cut).when(F.col("mode") == "unnamed", named_cells).otherwise(F.col("vals"))
    )
    return no_blocks(seen.withColumn("vals", vals)).drop("__cut", "__named")


def ruler_header(rows: DataFrame) -> DataFrame:
    """Data rows under a ruled heading, with the heading as ``header``."""
    out = sniff_table(rows).filter("mode = 'ruler' and position > header_end")
    return out.select(*ROW, "header", "vals")


def ragged_trim(rows: DataFrame) -> DataFrame:
    """Data rows of files narrower in their heading than below it."""
    out = sniff_table(rows).filter("mode in ('trim', 'unnamed') and position > header_end")
    return out.select(*ROW, "mode", "header", "vals")


def header_only_table(rows: DataFrame) -> DataFrame:
    """Names of the files that have one line: tables without rows."""
    only = sniff_table(rows).filter("mode = 'header_only'")
    named = only.select(*SHEET, F.posexplode("header").alias("col_idx", "raw"))
    return named.withColumn("name", clean_name_text(F.col("raw"))).filter("name is not null")


def text_names(sniffed: DataFrame) -> DataFrame:
    """Cleaned names per file, ``col_1 …`` where one of them is a number.

    ``header_is_data`` then says that the heading is a row as well.
    """
    heads = sniffed.filter(F.col("position") == 0).select(*SHEET, "mode", "header")
    names = F.filter(F.transform("header", clean_name_text), lambda v: v.isNotNull())
    numeric = F.exists(names, is_digits)
    positional = F.transform(names, lambda v, i: F.concat(F.lit("col_"), (i + 1).cast("string")))
    return heads.select(
        *SHEET, "mode", numeric.alias("header_is_data"), F.when(numeric, positional).otherwise(names).alias("names")
    )


def _fit(vals: Column, width: Column) -> Column:
    """Remove empty fields from the left until the row is as wide as the heading."""
    empties = F.filter(F.transform(vals, lambda v, i: F.when(v == "", i)), lambda i: i.isNotNull())
    excess = F.greatest(F.lit(1), F.size(vals) - width)
    gone = F.slice(empties, F.lit(1), F.least(excess, F.greatest(F.size(empties), F.lit(1))))
    fitted = F.filter(vals, lambda v, i: ~F.array_contains(gone, i))
    return F.when((F.size(empties) > 0) & (F.size(vals) != width), fitted).otherwise(vals)


def retry_parse(tab_rows: DataFrame) -> DataFrame:
    """Second attempt for files ``sniff_table`` could not settle.

    Tab fields only. Where the first data row is as wide as the heading, empty
    fields are removed from the left until a row fits. Otherwise either the
    rows lose a trailing empty field, or names become ``col_1 …`` and the
    heading, padded with blanks, stays as a row. Output: ``names`` and data
    rows ``vals``; ``fits`` is false for rows of another width.
    """
    placed = _placed(tab_rows)
    seen = join_facts(placed, _retry_layout(file_heads(placed)), SHEET)
    padding = F.array_repeat(F.lit(" "), F.greatest(F.col("__width") - F.size("vals"), F.lit(0)))
    heading = F.when(F.col("position") == 0, F.concat("vals", padding)).otherwise(F.col("vals"))
    vals = (
        F.when(F.col("route") == "fit", _fit(F.col("vals"), F.col("__named")))
        .when(F.col("route") == "trim", _chop(F.col("vals")))
        .otherwise(heading)
    )
    kept = seen.filter((F.col("position") > 0) | F.col("__stays")).withColumn("vals", vals)
    return kept.select(*ROW, "route", "names", "vals", (F.size("vals") == F.size("names")).alias("fits"))


def _chop(vals: Column) -> Column:
    return F.when(cell(vals, -1) == "", drop_last(vals)).otherwise(vals)


def _retry_layout(heads: DataFrame) -> DataFrame:
    """Route and names of the second attempt: one decision per file."""
    header, one, two = _at(0), _at(1), _at(2)
    clean = F.filter(F.transform(header, clean_name_text), lambda n: n.isNotNull())
    trimmed = F.transform(_chop(header), lambda v: F.regexp_replace(strip(v), "[^A-Za-z0-9]+", "_"))
    seen = heads.withColumns({"__clean": clean, "__one": one, "__trimmed": trimmed, "__two": two})
    names = F.col("__clean")
    # NULL where the file has no second line: such a file has no names and goes to the quarantine.
    numbered = lambda n: F.when(
        n >= 1,
        F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.lit("col_"), i.cast("string"))),
    )
    # A heading whose last name opens with "_" had nothing but marks there.
    odd = F.try_element_at(names, F.lit(-1)).startswith("_") | (F.size("__one") != F.size(names))
    trailing = F.coalesce(cell(F.col("__two"), -1) == "", F.lit(False))
    route = F.when(~F.coalesce(odd, F.lit(False)), "fit").when(trailing, "trim").otherwise("pad")
    seen = seen.withColumn("route", route)
    base = F.when(F.col("route") == "fit", names).when(F.col("route") == "trim", F.col("__trimmed"))
    numeric = F.coalesce(F.exists(base, is_digits), F.lit(False))
    final = (
        F.when(F.col("route") == "pad", numbered(F.size("__one")))
        .when(numeric, numbered(F.size(base)))
        .otherwise(base)
    )
    return seen.select(
        *SHEET,
        "route",
        final.alias("names"),
        F.size(names).alias("__named"),
        F.size("__one").alias("__width"),
        ((F.col("route") == "pad") | numeric).alias("__stays"),
    )


def chunk_reshape(tab_rows: DataFrame, width: int = ERROR_MAP_WIDTH) -> DataFrame:
    """The non-empty fields of the first line regrouped in rows of ``width``.

    The first group names the columns and stays as a row; an incomplete last
    group is left out.
    """
    first = over_blocks(tab_rows, SHEET, "row_idx", {"__first": whole_min(F.col("row_idx"))})
    fields = F.filter("vals", lambda v: v != "")
    line = first.filter(F.col("row_idx") == F.col("__first")).select(*SHEET, fields.alias("fields"))
    cells = line.select(
        *SHEET,
        F.slice("fields", 1, width).alias("names"),
        F.size("fields").alias("n"),
        F.posexplode("fields").alias("at", "value"),
    )
    group = F.floor(F.col("at") / width).cast("int")
    return (
        cells.filter((group + 1) * width <= F.col("n"))
        .select(
            *SHEET,
            group.alias("row_idx"),
            (F.col("at") % width).alias("col_idx"),
            F.element_at("names", (F.col("at") % width + 1).cast("int")).alias("name"),
            "value",
        )
    )


def column_membership(headers: DataFrame, required: list[str], names: str = "names") -> DataFrame:
    """Tables whose column names include all of ``required``."""
    wanted = F.array(*[F.lit(r) for r in required])
    return headers.filter(F.size(F.array_except(wanted, F.col(names))) == 0)
