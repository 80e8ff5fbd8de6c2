"""Inputs of the registered queries, derived from the given tables.

Each has a Spark form and the same projection as a SQL common table
expression, so both engines start from equal rows. Nothing is left out:
every row of the table and every line of a text takes part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.grid import to_cells
from gridloom.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, for queries that write."""
    return f"{ensure_checkpoint_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


def show(vals: Column | str) -> Column:
    """An array as text, NULL cells as ``~``."""
    return F.array_join(vals, "|", "~")


SHOW = "array_to_string(list_transform({0}, lambda x: coalesce(x, '~')), '|')"


def sql_show(vals: str) -> str:
    return SHOW.format(vals)


# ---- lines of the documents ---------------------------------------------


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "source",
        F.col("doc_id").cast("string").alias("sheet"),
        F.posexplode(F.split("text", "\n")).alias("row_idx", "value"),
    ).withColumn("row_idx", F.col("row_idx").cast("long"))


DOC_LINES = """doc_lines AS (
  SELECT source, CAST(doc_id AS VARCHAR) AS sheet, unnest(range(len(ls))) AS row_idx, unnest(ls) AS value
  FROM (SELECT source, doc_id, string_split(text, chr(10)) AS ls FROM documents))"""


def doc_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as rows, sentences as cells.

    By their length some cells become empty, headings with a colon, file
    names, numbers, notes or single words; first cells are indented.
    """

    def cell(x: Column, i: Column) -> Column:
        n = F.length(x)
        kind = (
            F.when(n % 5 == 0, F.lit(None).cast("string"))
            .when(n % 11 == 0, F.concat(x, F.lit(":")))
            .when(n % 13 == 0, F.concat(x, F.lit(".pdf")))
            .when(n % 17 == 0, F.concat(F.lit("Table "), x))
            .when(n % 19 == 0, F.concat(F.lit("* "), x))
            .when(n % 23 == 0, n.cast("string"))
            .when(n % 29 == 0, F.concat(F.lit("Effective "), x))
            .when(n % 31 == 0, F.split(x, " ")[0])
            .otherwise(x)
        )
        indent = F.repeat(F.lit(" "), F.length(F.split(x, " ")[0]) % 4)
        return F.when(i == 0, F.concat(indent, kind)).otherwise(kind)

    lines = doc_lines(spark, sf_dir)
    return lines.select(
        "source", "sheet", "row_idx", F.transform(F.split("value", r"\. "), cell).alias("vals")
    )


DOC_GRID = (
    DOC_LINES
    + """, doc_grid AS (
  SELECT source, sheet, row_idx,
         list_transform(string_split(value, '. '), lambda x, i:
           CASE WHEN i = 1 THEN repeat(' ', length(string_split(x, ' ')[1]) % 4) ELSE '' END ||
           CASE WHEN length(x) % 5 = 0 THEN NULL
                WHEN length(x) % 11 = 0 THEN x || ':'
                WHEN length(x) % 13 = 0 THEN x || '.pdf'
                WHEN length(x) % 17 = 0 THEN 'Table ' || x
                WHEN length(x) % 19 = 0 THEN '* ' || x
                WHEN length(x) % 23 = 0 THEN CAST(length(x) AS VARCHAR)
                WHEN length(x) % 29 = 0 THEN 'Effective ' || x
                WHEN length(x) % 31 = 0 THEN string_split(x, ' ')[1]
                ELSE x END) AS vals
  FROM doc_lines),
rowfacts AS (
  SELECT source, sheet, row_idx, vals, len(vals) AS width,
         len(list_filter(vals, lambda x: x IS NOT NULL)) AS n,
         len(list_filter(vals, lambda x: x IS NULL)) AS nulls,
         vals[1] AS c0, vals[2] AS c1, vals[3] AS c2, vals[13] AS c12, vals[-1] AS cl, vals[-2] AS cl2,
         list_filter(vals, lambda x: x IS NOT NULL)[1] AS firstv
  FROM doc_grid)"""
)


# ---- a grid with columns of every kind ----------------------------------


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per type and brand: gaps, star, marker and ``Table`` columns."""
    k, s, name = F.col("p_partkey"), F.col("p_size"), F.col("p_name")
    cents = F.round(F.col("p_retailprice") * 100).cast("long").cast("string")
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("source"),
        F.col("p_brand").alias("sheet"),
        k.alias("row_idx"),
        F.array(
            F.when(k % 7 != 0, name),
            F.when(k % 7 != 1, s.cast("string")),
            F.when(k % 7 != 2, cents),
            F.when(s >= 48, F.lit("*")),
            F.when(s == 50, F.lit("Line")),
            F.when(s == 1, F.concat(F.lit("Table "), name)),
            F.when(s <= 2, name),
            F.when(s % 10 == 3, F.concat(F.lit("Table "), name)),
        ).alias("vals"),
    )


def part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(part_rows(spark, sf_dir))


PART_CELLS = """part_rows AS (
  SELECT p_type AS source, p_brand AS sheet, p_partkey AS row_idx,
    [CASE WHEN p_partkey % 7 <> 0 THEN p_name END,
     CASE WHEN p_partkey % 7 <> 1 THEN CAST(p_size AS VARCHAR) END,
     CASE WHEN p_partkey % 7 <> 2 THEN CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) END,
     CASE WHEN p_size >= 48 THEN '*' END,
     CASE WHEN p_size = 50 THEN 'Line' END,
     CASE WHEN p_size = 1 THEN 'Table ' || p_name END,
     CASE WHEN p_size <= 2 THEN p_name END,
     CASE WHEN p_size % 10 = 3 THEN 'Table ' || p_name END] AS vals
  FROM part),
part_cells AS (
  SELECT source, sheet, row_idx, unnest(range(8))::INT AS col_idx, unnest(vals) AS value FROM part_rows),
part_columns AS (
  SELECT source, sheet, col_idx, count(value) AS n_values, count(*) AS n_rows,
         bool_or(coalesce(value = '*', false)) AS has_star, bool_or(coalesce(value = 'Line', false)) AS has_line,
         bool_or(coalesce(starts_with(value, 'Table'), false)) AS has_table
  FROM part_cells GROUP BY 1, 2, 3)"""


# ---- fixed-width lines ---------------------------------------------------


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as records: status, priority digit, customer, cents."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long").cast("string")
    line = F.concat(
        "o_orderstatus",
        F.substring("o_orderpriority", 1, 1),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0"),
        F.lpad(cents, 12, " "),
    )
    path = F.concat(F.lit("finance/"), F.when(F.col("o_custkey") % 2 == 0, "2017Fin_PID").otherwise("2017plain"), F.lit(".txt"))
    return table(spark, sf_dir, "orders").select(path.alias("source"), F.col("o_orderkey").alias("line_no"), line.alias("value"))


ORDER_LINES = """order_lines AS (
  SELECT 'finance/' || CASE WHEN o_custkey % 2 = 0 THEN '2017Fin_PID' ELSE '2017plain' END || '.txt' AS source,
         o_orderkey AS line_no,
         o_orderstatus || substr(o_orderpriority, 1, 1) || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
           || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), 12, ' ') AS value
  FROM orders)"""

ORDER_SLICES = [(1, 1, "status"), (2, 1, "priority"), (3, 9, "customer"), (12, 12, "cents"), (22, 10, "tail")]

# A code list as a file holds it: one code twice, one without a label, one missing, one name of no column.
CODEBOOK = [
    (0, "O", "open", "status"),
    (1, "O", "open order", "status"),
    (2, "F", None, "status"),
    (3, "1", "urgent", "priority"),
    (4, "2", "high", "priority"),
    (5, "5", "low", "priority"),
    (6, "5", "lowest", "priority"),
    (7, "X", "unused", "flag"),
]


def codebook(spark: SparkSession) -> DataFrame:
    """As a local relation, so that Spark knows its size as it does for a file."""
    text = lambda v: "cast(null as string)" if v is None else f"'{v}'"
    rows = ", ".join(f"({i}, {text(c)}, {text(d)}, {text(n)})" for i, c, d, n in CODEBOOK)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(row_idx, Code, Desription, Name)")


SQL_CODEBOOK = """codebook(row_idx, Code, Label, Name) AS (VALUES
  (0, 'O', 'open', 'status'), (1, 'O', 'open order', 'status'), (2, 'F', NULL, 'status'),
  (3, '1', 'urgent', 'priority'), (4, '2', 'high', 'priority'), (5, '5', 'low', 'priority'),
  (6, '5', 'lowest', 'priority'), (7, 'X', 'unused', 'flag')),
lastcodes AS (
  SELECT Name, Code, Label FROM (
    SELECT *, row_number() OVER (PARTITION BY Name, Code ORDER BY row_idx DESC) AS rn FROM codebook) WHERE rn = 1)"""
