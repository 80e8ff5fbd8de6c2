"""What the plans must look like."""

from pyspark.sql import functions as F

from gridloom.operators import grid, html_tables, splits, structure as st
from gridloom.plans import pages
from gridloom.plans.workbook import SheetTables
from gridloom.queries.registry import load

SF = "/root/testdata/sf0.001"
QUERIES, _ = load()


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_lookup_is_a_broadcast(spark):
    text = plan(QUERIES["codebook_lookup"](spark, SF))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_lookup_without_broadcast_still_works(spark):
    """A code list over the size limit goes through a sort-merge join, with the same rows."""
    rows = lambda: sorted(map(tuple, QUERIES["codebook_lookup"](spark, SF).collect()), key=str)
    small = rows()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(QUERIES["codebook_lookup"](spark, SF))
        assert rows() == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_its_columns(spark):
    text = plan(QUERIES["table_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_column_tests_take_one_aggregate(spark):
    """One aggregate over all columns, not a job per column."""
    cells = spark.createDataFrame([("f", "s", 0, 0, "x")], "source string, sheet string, row_idx long, col_idx int, value string")
    text = plan(grid.column_profile(cells), "optimizedPlan")
    assert text.count("Aggregate") == 1


def test_summaries_read_narrow_columns(spark):
    """The summary of a scan does not shuffle the cells of the rows."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select(
        F.col("source"), F.col("doc_id").cast("string").alias("sheet"), F.posexplode(F.split("text", "\n")).alias("row_idx", "v")
    )
    rows = rows.select("source", "sheet", F.col("row_idx").cast("long"), F.split("v", " ").alias("vals"))
    text = plan(st.classify_rows_html(rows))
    partial = [line for line in text.splitlines() if "partial_min" in line]
    assert partial and all("vals" not in line for line in partial)


def test_results_by_row_are_merged_with_the_rows(spark):
    """What a rule says of every row is as long as the table: however small its files are, it is not broadcast."""
    rows = spark.createDataFrame([("f", "s", i, ["a", "1"], "body", i) for i in range(4)], "source string, sheet string, row_idx long, vals array<string>, role string, island long")
    spans = spark.createDataFrame(
        [("u", 1, "tbody", i, 0, [("a", 2)]) for i in range(4)], "url string, table_idx int, part string, row_idx int, slice_idx int, cells array<struct<text string, rowspan int>>"
    )
    outputs = rows.select("source", "sheet", *[F.lit(c).alias(c) for c in ("folder", "output_group", "table_name", "place", "table_id")])
    header = spans.select("url", "table_idx", F.array(F.lit("a")).alias("header")).distinct()
    for df in (
        st.indent_path(rows.select("source", "sheet", "row_idx", "vals")),
        st.carry_label_uspto(rows),
        st.keep_label_uspto_special(rows),
        st.carry_label_soi(rows),
        st.collapse_lone_rows(rows),
        splits.split_tables_down(rows),
        html_tables.insert_rowspans(spans),
        pages.page_unions(SheetTables(rows, rows, rows), outputs),
    ):
        joins = [line for line in plan(df).splitlines() if "Join" in line]
        assert any("SortMergeJoin" in line for line in joins)
        # Only the sheets of several blocks, one row each, may be broadcast.
        assert all("LeftSemi" in line for line in joins if "BroadcastHashJoin" in line)
    sliced = plan(html_tables.wide_row_slice(spans, header, cells="cells"))
    assert "SortMergeJoin" in sliced
