"""Fixed-width files, delimited files and API payloads, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import delimited, fixed_width
from gridloom.operators.grid import ROW, SHEET
from gridloom.operators.quarantine import check, tee, unit_errors
from gridloom.session import settle
from gridloom.sources import files, payload


def fixed_width_views(lines: DataFrame, layout: DataFrame, codebook: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First view: the slices of a layout. Second view: codes replaced by labels.

    ``lines(source, …, value)`` of all files that share the layout, whose
    columns are ``Description, Positions, Length, Value``.
    """
    slices = fixed_width.collect_slices(fixed_width.layout_positions(layout))
    with_codes = fixed_width.conditional_extra_slices(lines)
    first = fixed_width.layout_names(fixed_width.fixed_width_slice(with_codes, slices))
    return first, fixed_width.codebook_decode(first, codebook, fixed_width.coded_columns(first, codebook))


def layout_slices(files_: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of many files with different layouts, as ``(source, line_no, field, value)``.

    ``files_`` are layout rows per file (``layout_for_file`` and
    ``layout_range``): one join instead of one job per file.
    """
    return lines.join(files_.select("source", "start", "length", "Data").distinct(), "source").select(
        "source",
        "line_no",
        "start",
        F.col("Data").alias("field"),
        F.substring(F.col("value"), F.col("start"), F.col("length")).alias("value"),
    )


# Fixed value: the ending of error maps.
ERROR_MAP_SUFFIX = ".MapErrors"


def text_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Delimited files of uneven shape: ``(names, rows, errors)``.

    Files of error maps hold one line that is regrouped; files that fit in no
    way get a second attempt. Excluded names, files that fail it too and rows
    of another width than their heading end in ``errors``.
    """
    lines = files.text_lines(spark, root, "space")
    excluded = files.name_excluded(F.col("source"), files.EXCLUDED_TEXT_NAMES)
    named = tee(check(files.as_lines(lines), {"excluded by name": ~excluded}), "names")
    is_map = F.col("source").endswith(ERROR_MAP_SUFFIX)
    sniffed = settle(delimited.sniff_table(delimited.delimited_layout(named.good.filter(~is_map))))
    first_names = settle(delimited.text_names(sniffed))
    names = first_names.filter("mode != 'bad'")
    data = sniffed.filter("mode != 'bad'").join(names.select(*SHEET, "names", "header_is_data"), SHEET).filter(
        (F.col("position") > F.col("header_end")) | (F.col("header_is_data") & (F.col("position") == 0))
    )
    judged = tee(check(data, {"row is not as wide as the heading": F.size("vals") == F.size("names")}), "layout")
    second_names, retried = _second_attempt(named.good, first_names.filter("mode = 'bad'").select(*SHEET))
    second = tee(retried, "second attempt")
    map_names, maps = _error_maps(named.good.filter(is_map))
    errors = unit_errors(named.errors.unionAll(judged.errors).unionAll(second.errors))
    rows = judged.good.select(*ROW, "vals").unionByName(second.good.select(*ROW, "vals")).unionByName(maps)
    return names.unionByName(second_names).unionByName(map_names), rows, errors


def _second_attempt(lines: DataFrame, bad: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and checked rows of the files that no width fits at first; one row that does not fit fails its file."""
    retried = settle(delimited.retry_parse(delimited.tab_fields(lines.join(bad, SHEET))))
    facts = retried.groupBy(*SHEET).agg(
        F.first("route").alias("mode"), F.first("names").alias("names"), F.bool_and(F.coalesce("fits", F.lit(False))).alias("__all_fit")
    )
    facts = settle(facts)
    names = facts.filter("__all_fit").select(*SHEET, "mode", F.lit(False).alias("header_is_data"), "names")
    rows = retried.join(facts.select(*SHEET, "__all_fit"), SHEET)
    return names, check(rows, {"no width fits": F.col("__all_fit")})


def _error_maps(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names and rows of the regrouped first lines of error maps."""
    cells = settle(delimited.chunk_reshape(delimited.tab_fields(lines)))
    rows = cells.groupBy(*SHEET, F.col("row_idx").cast("long").alias("row_idx")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "value"))), lambda c: c["value"]).alias("vals")
    )
    heads = cells.filter("row_idx = 0").groupBy(*SHEET).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("col_idx", "name"))), lambda c: c["name"]).alias("names")
    )
    return heads.select(*SHEET, F.lit("map").alias("mode"), F.lit(False).alias("header_is_data"), "names"), rows


def combined_payloads(payloads: DataFrame, groups: list[str], source: str = "source") -> dict[str, DataFrame]:
    """One table per group of payload files, with the columns of all its files."""
    return {
        g: payload.json_envelope(files.name_include_filter(payloads, [g], source).select(source, "payload"))
        for g in groups
    }
