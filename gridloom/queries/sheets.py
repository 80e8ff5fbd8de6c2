"""Row and column tests of a grid, over the sheets made from ``part``."""

from pyspark.sql import functions as F

from gridloom.operators import grid, splits
from gridloom.queries.inputs import DOC_GRID, PART_CELLS, doc_grid, part_cells, part_rows, show, sql_show
from gridloom.queries.registry import query

_CELLS = "SELECT source, sheet, row_idx, col_idx, value FROM"
_KEEP = f"WITH {PART_CELLS} SELECT c.source, c.sheet, c.row_idx, c.col_idx, c.value FROM part_cells c JOIN part_columns k USING (source, sheet, col_idx) WHERE "


@query("cell_counts", f"WITH {PART_CELLS} SELECT source, sheet, row_idx, count(value) AS n_cells, count(*) - count(value) AS n_nulls FROM part_cells GROUP BY 1, 2, 3")
def cell_counts(spark, sf_dir):
    return grid.cell_counts(part_cells(spark, sf_dir))


@query("drop_empty_columns", _KEEP + "n_values > 0")
def drop_empty_columns(spark, sf_dir):
    return grid.drop_empty_columns(part_cells(spark, sf_dir))


@query("drop_sparse_columns", _KEEP + "n_values >= 2")
def drop_sparse_columns(spark, sf_dir):
    return grid.drop_sparse_columns(part_cells(spark, sf_dir))


@query("drop_star_columns", _KEEP + "NOT (n_values IN (1, 2) AND has_star)")
def drop_star_columns(spark, sf_dir):
    return grid.drop_star_columns(part_cells(spark, sf_dir))


@query("drop_marker_columns", _KEEP + "NOT has_line")
def drop_marker_columns(spark, sf_dir):
    return grid.drop_marker_columns(part_cells(spark, sf_dir))


@query(
    "drop_empty_rows_cols",
    _KEEP + """n_values > 0 AND EXISTS (SELECT 1 FROM part_cells o WHERE o.source = c.source AND o.sheet = c.sheet
      AND o.row_idx = c.row_idx AND o.value IS NOT NULL)""",
)
def drop_empty_rows_cols(spark, sf_dir):
    return grid.drop_empty_rows_cols(part_cells(spark, sf_dir))


@query(
    "compact_columns",
    f"""WITH {PART_CELLS}, k AS (SELECT source, sheet, col_idx, CAST(row_number() OVER (PARTITION BY source, sheet ORDER BY col_idx) - 1 AS INT) AS ni
        FROM part_columns WHERE n_values > 0)
      SELECT source, sheet, row_idx, ni AS col_idx, value FROM part_cells JOIN k USING (source, sheet, col_idx)""",
)
def compact_columns(spark, sf_dir):
    return grid.compact_columns(grid.drop_empty_columns(part_cells(spark, sf_dir)))


@query(
    "drop_leading_gap_column",
    f"""WITH {PART_CELLS}, f AS (SELECT source, sheet, arg_min(vals, row_idx) AS fv FROM part_rows GROUP BY 1, 2)
      SELECT source, sheet, row_idx, {sql_show('CASE WHEN fv[1] IS NULL AND fv[2] IS NOT NULL THEN vals[2:] ELSE vals END')} AS vals
      FROM part_rows JOIN f USING (source, sheet)""",
)
def drop_leading_gap_column(spark, sf_dir):
    out = grid.drop_leading_gap_column(part_rows(spark, sf_dir))
    return out.withColumn("vals", show("vals"))


@query(
    "first_rows",
    f"""WITH {PART_CELLS} SELECT source, sheet, row_idx, row_idx = min(row_idx) OVER (PARTITION BY source, sheet) AS is_first FROM part_rows""",
)
def first_rows(spark, sf_dir):
    return grid.first_rows(part_rows(spark, sf_dir)).drop("vals")


@query(
    "to_rows",
    f"WITH {PART_CELLS} SELECT source, sheet, row_idx, {sql_show('vals')} AS vals FROM part_rows",
)
def to_rows(spark, sf_dir):
    return grid.to_rows(part_cells(spark, sf_dir)).withColumn("vals", show("vals"))


@query(
    "null_normalise",
    f"""WITH {PART_CELLS} SELECT source, sheet, row_idx, col_idx, CASE WHEN trim(v) NOT IN ('', 'nan') THEN v END AS value FROM
      (SELECT *, CASE col_idx WHEN 3 THEN coalesce(value, '  ') WHEN 4 THEN coalesce(value, ' nan ') ELSE value END AS v FROM part_cells)""",
)
def null_normalise(spark, sf_dir):
    raw = F.when(F.col("col_idx") == 3, F.coalesce("value", F.lit("  "))).when(
        F.col("col_idx") == 4, F.coalesce("value", F.lit(" nan "))
    )
    return grid.normalise_cells(part_cells(spark, sf_dir).withColumn("value", F.coalesce(raw, F.col("value"))))


@query(
    "row_filters",
    f"""WITH {PART_CELLS}, m AS (SELECT source, sheet, row_idx,
        [vals[1], CASE WHEN row_idx % 5 = 0 THEN 'Description' ELSE vals[2] END, CASE row_idx % 3 WHEN 0 THEN 'C1' WHEN 1 THEN 'c1' ELSE vals[3] END] AS vals FROM part_rows)
      SELECT source, sheet, row_idx, {sql_show('vals')} AS vals FROM m
      WHERE NOT coalesce(vals[2] = 'Description' AND vals[3] IN ('C1', 'c1'), false) AND len(list_filter(vals, lambda x: x IS NOT NULL)) >= 2""",
)
def row_filters(spark, sf_dir):
    k = F.col("row_idx")
    marked = part_rows(spark, sf_dir).withColumn(
        "vals",
        F.array(
            F.col("vals")[0],
            F.when(k % 5 == 0, "Description").otherwise(F.col("vals")[1]),
            F.when(k % 3 == 0, "C1").when(k % 3 == 1, "c1").otherwise(F.col("vals")[2]),
        ),
    )
    out = grid.keep_rows_with(grid.drop_description_marker_rows(marked), 2)
    return out.withColumn("vals", show("vals"))


_ACROSS = """, placed AS (SELECT *, row_number() OVER (PARTITION BY source, sheet ORDER BY col_idx) - 1 AS place FROM part_columns),
  opened AS (SELECT *, has_table AND place > 0 AS opens FROM placed),
  parts AS (SELECT *, CAST(sum(opens::INT) OVER w AS BIGINT) AS part, coalesce(lead(opens) OVER w, false) AS before_start FROM opened
            WINDOW w AS (PARTITION BY source, sheet ORDER BY col_idx)),
  kept AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, sheet, part ORDER BY col_idx) - 1 AS INT) AS ni FROM parts WHERE {rule})
  SELECT source, sheet, part, row_idx, ni AS col_idx, value FROM part_cells JOIN kept USING (source, sheet, col_idx)"""


@query("split_tables_across", f"WITH {PART_CELLS}" + _ACROSS.format(rule="NOT (before_start AND n_values = 0)"))
def split_tables_across(spark, sf_dir):
    return splits.split_tables_across(part_cells(spark, sf_dir))


@query("split_tables_across_shared", f"WITH {PART_CELLS}" + _ACROSS.format(rule="NOT before_start AND n_values >= 2"))
def split_tables_across_shared(spark, sf_dir):
    return splits.split_tables_across(part_cells(spark, sf_dir), gap="always", minimum=2)


@query(
    "split_tables_down",
    rf"""WITH RECURSIVE {DOC_GRID},
      f AS (SELECT source, sheet, row_idx, row_number() OVER w AS spot, n = 0 AS blank, n > 1 AS is_full,
          n = 0 AND coalesce(lead(n) OVER w, 0) > 1 AND coalesce(lead(nulls) OVER w, 0) > 2 AS gap, coalesce(starts_with(trim(firstv), 'Table'), false) AS title,
          n > 0 AND ((width // 2 > n AND n <> 1) OR (n = 1 AND c0 IS NULL)) AND
            CASE WHEN n = 1 THEN coalesce(lead(n) OVER w, 0) > 1 ELSE len(list_filter(vals, lambda v: v IS NOT NULL AND regexp_matches(trim(v), '^\p{{L}}'))) > 1 END AS sparse
        FROM rowfacts WINDOW w AS (PARTITION BY source, sheet ORDER BY row_idx)),
      walk AS (SELECT DISTINCT source, sheet, CAST(0 AS BIGINT) AS spot, CAST(NULL AS BIGINT) AS row_idx, false AS header, 0 AS pending, false AS starts FROM f
        UNION ALL SELECT source, sheet, spot, row_idx, CASE WHEN blank THEN h0 OR (gap AND p0 > 10) ELSE h2 OR (p2 = 0 AND is_full) END,
            CASE WHEN NOT blank THEN least(p2 + 1, 11) WHEN gap AND p0 > 10 AND h0 THEN 0 ELSE p0 END, NOT blank AND p2 = 0
          FROM (SELECT *, h1 AND NOT (sparse AND p1 > 10) AS h2, CASE WHEN sparse AND h1 AND p1 > 10 THEN 0 ELSE p1 END AS p2
            FROM (SELECT f.*, walk.header AS h0, walk.pending AS p0, title OR walk.header AS h1, CASE WHEN title THEN 0 ELSE walk.pending END AS p1
              FROM walk JOIN f ON f.source = walk.source AND f.sheet = walk.sheet AND f.spot = walk.spot + 1))),
      numbered AS (SELECT walk.*, blank, sum(starts::INT) OVER (PARTITION BY walk.source, walk.sheet ORDER BY walk.spot) - 1 AS table_id
        FROM walk JOIN f ON f.source = walk.source AND f.sheet = walk.sheet AND f.spot = walk.spot)
      SELECT source, sheet, CAST(table_id AS BIGINT) AS table_id, min(row_idx) AS first_row, max(row_idx) AS last_row, count(*) AS n_rows FROM numbered WHERE NOT blank GROUP BY 1, 2, 3""",
)
def split_tables_down(spark, sf_dir):
    out = splits.split_tables_down(doc_grid(spark, sf_dir))
    return out.groupBy("source", "sheet", "table_id").agg(
        F.min("row_idx").alias("first_row"), F.max("row_idx").alias("last_row"), F.count(F.lit(1)).alias("n_rows")
    )


@query("drop_blank_rows", f"WITH {DOC_GRID} SELECT source, sheet, row_idx, {sql_show('vals')} AS vals FROM rowfacts WHERE n > 0")
def drop_blank_rows(spark, sf_dir):
    return grid.drop_blank_rows(doc_grid(spark, sf_dir)).withColumn("vals", show("vals"))
