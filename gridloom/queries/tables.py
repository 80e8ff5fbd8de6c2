"""Whole families of sheets and pages: grid rows in, named tables out."""

from pyspark.sql import functions as F

from gridloom import sinks
from gridloom.plans import pages, workbook
from gridloom.queries.decoders import pages_with_tables
from gridloom.queries.inputs import doc_grid, part_rows, scratch
from gridloom.queries.registry import query
from gridloom.session import settle
from gridloom.sources.html import html_table_cells


@query("sheet_tables_gov")
def sheet_tables_gov(spark, sf_dir):
    return workbook.sheet_tables(part_rows(spark, sf_dir), workbook.GOV).long()


@query("sheet_tables_uspto")
def sheet_tables_uspto(spark, sf_dir):
    return workbook.sheet_tables(doc_grid(spark, sf_dir), workbook.USPTO).long()


@query("sheet_tables_uspto_special")
def sheet_tables_uspto_special(spark, sf_dir):
    return workbook.sheet_tables(doc_grid(spark, sf_dir), workbook.USPTO_SPECIAL).long()


@query("sheet_tables_dl")
def sheet_tables_dl(spark, sf_dir):
    return workbook.dl_tables(part_rows(spark, sf_dir)).long()


@query("sheet_tables_soi")
def sheet_tables_soi(spark, sf_dir):
    return workbook.soi_tables(part_rows(spark, sf_dir)).long()


@query(
    "page_unions",
    """WITH p AS (SELECT *, p_partkey // 100 AS page, row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) AS rn,
        3 + CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 11 = 0 THEN 4 ELSE 0 END AS width FROM part)
      SELECT CASE page % 2 WHEN 0 THEN 'NSDUHDetTabsSect' ELSE 'NSDUHDetTabsApp' END AS output_group, 'Table_1_' || (page % 3) AS table_name,
        CAST(2 * sum(CASE WHEN rn > 1 AND width > 3 THEN (width - 1) // 3 ELSE 1 END) AS BIGINT) AS n_rows, 2 * count(DISTINCT page) AS n_tables
      FROM p GROUP BY 1, 2""",
)
def page_unions(spark, sf_dir):
    """Every page holds its captioned table twice, and three captions recur on the pages of a folder."""
    number = F.regexp_extract("url", r"(\d+)$", 1)
    caption = F.concat(F.lit("Table 1."), (number.cast("int") % 3).cast("string"), F.lit("A –"))
    group = F.when(number.cast("int") % 2 == 0, "NSDUHDetTabsSect").otherwise("NSDUHDetTabsApp")
    html = F.replace("html", F.concat(F.lit("Table 1."), number, F.lit("A –")), caption)
    twice = pages_with_tables(spark, sf_dir).select(F.concat(F.lit("https://t.example.org/p/"), group, number).alias("url"), F.concat(html, html).alias("html"))
    cells = settle(html_table_cells(twice).filter("table_idx % 2 = 1"))
    found = pages.cell_tables(cells)
    rows = pages.page_unions(found, pages.page_outputs(cells, found.names))
    target = scratch(spark, "unions")
    sinks.route_write(rows, target)
    written = spark.read.parquet(target)
    return written.groupBy("output_group", "table_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("source", "table_id").alias("n_tables")
    )


@query("page_tables")
def page_tables(spark, sf_dir):
    found = pages.page_tables(pages_with_tables(spark, sf_dir))
    return found.long().withColumn("sheet", F.col("sheet").cast("int"))
