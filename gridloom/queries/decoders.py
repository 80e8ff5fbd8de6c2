"""File decoders and tables of pages.

The given tables hold no workbooks, archives or HTML tables, so Spark writes
them first, in bounded blocks of rows, and the decoders read them back.
"""

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from gridloom.operators import html_tables as ht
from gridloom.queries.inputs import PART_CELLS, part_rows, show, sql_show, table
from gridloom.queries.registry import query
from gridloom.sources import archive, html, workbook

# Files made by a shuffle are few and small here; stored ones lie spread already.
def _spread(files):
    return files.repartition(files.sparkSession.sparkContext.defaultParallelism)


ROWS_PER_FILE, ROWS_PER_SHEET = 2000, 500

# ---- workbooks ----------------------------------------------------------

_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _sheet_xml(rows: pd.DataFrame, shared: list[str]) -> str:
    lines = []
    for at, vals in zip(rows["at"], rows["vals"]):
        cells = []
        for i, v in enumerate(vals):
            if v is None:
                continue
            name = f"{chr(65 + i)}{at + 1}"
            if v.isdigit():
                cells.append(f'<c r="{name}"><v>{v}</v></c>')
            elif i % 2 == 0:
                shared.append(v)
                cells.append(f'<c r="{name}" t="s"><v>{len(shared) - 1}</v></c>')
            else:
                cells.append(f'<c r="{name}" t="inlineStr"><is><t>{escape(v)}</t></is></c>')
        lines.append(f'<row r="{at + 1}">{"".join(cells)}</row>')
    return f'<worksheet xmlns="{_NS}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def _encode_workbook(pdf: pd.DataFrame) -> pd.DataFrame:
    shared: list[str] = []
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        names = sorted(pdf["sheet"].unique())
        for i, name in enumerate(names):
            rows = pdf[pdf["sheet"] == name].sort_values("at")
            book.writestr(f"xl/worksheets/sheet{i}.xml", _sheet_xml(rows, shared))
        sheets = "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i}"/>' for i, n in enumerate(names))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS}" xmlns:r="{_REL}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>' for i in range(len(names)))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{_NS}">{strings}</sst>')
    return pd.DataFrame({"path": [pdf["file"].iloc[0]], "content": [out.getvalue()]})


def workbooks(spark, sf_dir):
    """One workbook per block of keys, a sheet per smaller block."""
    key = F.col("row_idx")
    number = lambda n: F.floor(n).cast("string")
    rows = part_rows(spark, sf_dir).select(
        F.concat(F.lit("bronze/lot "), number(key / ROWS_PER_FILE), F.lit(".xlsx")).alias("file"),
        F.concat(F.lit("part "), number(key % ROWS_PER_FILE / ROWS_PER_SHEET)).alias("sheet"),
        (key % ROWS_PER_SHEET).alias("at"),
        "vals",
    )
    return _spread(rows.groupBy("file").applyInPandas(_encode_workbook, "path string, content binary"))


@query(
    "workbook_cells",
    f"""WITH {PART_CELLS} SELECT 'bronze/lot ' || (row_idx // {ROWS_PER_FILE}) || '.xlsx' AS source,
      'part ' || (row_idx % {ROWS_PER_FILE} // {ROWS_PER_SHEET}) AS sheet, row_idx % {ROWS_PER_SHEET} AS row_idx, col_idx, value
      FROM part_cells WHERE value IS NOT NULL""",
)
def workbook_cells(spark, sf_dir):
    rows = workbook.decode_workbooks(workbooks(spark, sf_dir)).filter("error is null")
    cells = rows.select("source", "sheet", "row_idx", F.posexplode("vals").alias("col_idx", "value"))
    return cells.filter("value is not null")


@query(
    "sheet_path",
    f"""WITH f AS (SELECT DISTINCT 'bronze/lot_' || (p_partkey // {ROWS_PER_FILE}) AS stem, p_partkey % {ROWS_PER_FILE} // {ROWS_PER_SHEET} AS k FROM part),
      n AS (SELECT *, count(*) OVER (PARTITION BY stem) AS n FROM f)
      SELECT 'part ' || k AS sheet, CASE WHEN n > 1 THEN stem || '/part_' || k ELSE stem END AS table_path FROM n""",
)
def sheet_path(spark, sf_dir):
    rows = workbook.decode_workbooks(workbooks(spark, sf_dir)).filter("error is null")
    return workbook.sheet_path(rows).select("sheet", "table_path").distinct()


# Styles: plain, a date, a date of its own format, a time, a number that only looks like one.
_STYLES = f"""<styleSheet xmlns="{_NS}"><numFmts><numFmt numFmtId="170" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="171" formatCode="0 &quot;days&quot;"/></numFmts>
  <cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs></styleSheet>"""


def _encode_orders(pdf: pd.DataFrame) -> pd.DataFrame:
    lines = []
    for at, row in enumerate(pdf.sort_values("o_orderkey").itertuples(), 1):
        serial = (row.o_orderdate - pd.Timestamp("1899-12-30")) / pd.Timedelta(days=1)
        cells = [
            f"<v>{row.o_orderkey}</v>", f"<v>{row.o_totalprice:.17g}</v>", f' s="{1 + at % 2}"><v>{serial:.15g}</v>', f' s="3"><v>{row.o_custkey}</v>',
            ' t="e"><v>#N/A</v>' if row.o_orderkey % 3 == 0 else f' t="str"><v>{row.o_orderstatus}</v>',
            f' t="inlineStr"><is><t>{"NA" if row.o_orderkey % 5 == 0 else row.o_orderpriority}</t></is>',
        ]
        text = "".join(f'<c r="{chr(65 + i)}{at}"{"" if c.startswith(" ") else ">"}{c}</c>' for i, c in enumerate(cells))
        lines.append(f'<row r="{at}">{text}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/worksheets/sheet0.xml", f'<worksheet xmlns="{_NS}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_NS}" xmlns:r="{_REL}"><sheets><sheet name="o" sheetId="1" r:id="rId0"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId0" Target="worksheets/sheet0.xml"/></Relationships>')
        book.writestr("xl/styles.xml", _STYLES)
    return pd.DataFrame({"path": [pdf["file"].iloc[0]], "content": [out.getvalue()]})


@query(
    "workbook_values",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, CAST(o_custkey AS VARCHAR) AS o_custkey,
      CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 > 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def workbook_values(spark, sf_dir):
    """Orders with all digits of their price, dates as day numbers, error and missing cells; a price reads as it was."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").withColumn("file", F.concat(F.lit("o/"), F.floor(key / ROWS_PER_FILE).cast("string"), F.lit(".xlsx")))
    files = orders.groupBy("file").applyInPandas(_encode_orders, "path string, content binary")
    rows = workbook.decode_workbooks(_spread(files)).filter("error is null")
    names = ["o_orderkey", "o_totalprice", "o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority"]
    read = rows.select(*[F.col("vals")[i].alias(n) for i, n in enumerate(names)])
    # The shortest text of a price has no more digits than the price itself.
    short = F.when(F.length("o_totalprice") <= 12, F.col("o_totalprice")).cast("double")
    return read.withColumns({"o_orderkey": F.col("o_orderkey").cast("long"), "o_totalprice": short})


# ---- archives -----------------------------------------------------------


def _encode_archive(pdf: pd.DataFrame) -> pd.DataFrame:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as target:
        for name, text in zip(pdf["name"], pdf["text"]):
            target.writestr(name, text)
    return pd.DataFrame({"path": [pdf["file"].iloc[0]], "content": [out.getvalue()]})


@query(
    "archive_expand",
    """SELECT 'raw/' || source || '_' || (doc_id // 100) || '.zip' AS archive, 'raw/' || source || '_' || (doc_id // 100) || '/' ||
        CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN lang || '/' ELSE 'inner/' END || doc_id || '.txt' AS path,
      length(text) AS n_chars, text FROM documents""",
)
def archive_expand(spark, sf_dir):
    """Documents zipped a hundred at a time: members at the top, one and two folders deep."""
    key = F.col("doc_id")
    name = key.cast("string")
    folder = F.when(key % 3 == 0, "").when(key % 3 == 1, F.concat("lang", F.lit("/"))).otherwise("outer/inner/")
    files = (
        table(spark, sf_dir, "documents")
        .select(
            F.concat(F.lit("raw/"), "source", F.lit("_"), F.floor(key / 100).cast("string"), F.lit(".zip")).alias("file"),
            F.concat(folder, name, F.lit(".txt")).alias("name"),
            "text",
        )
        .groupBy("file")
        .applyInPandas(_encode_archive, "path string, content binary")
    )
    text = F.decode("content", "UTF-8")
    return archive.expand_archives(_spread(files)).select("archive", "path", F.length(text).alias("n_chars"), text.alias("text"))


# ---- HTML tables --------------------------------------------------------



def pages_with_tables(spark, sf_dir):
    """Two tables per page of a hundred parts: a plain one, and one with spans, classes and wide rows."""
    k = F.col("p_partkey")
    tag = lambda t, c, attrs="": F.concat(F.lit(f"<{t}{attrs}>"), c, F.lit(f"</{t}>"))
    size = F.col("p_size").cast("string")
    plain = F.concat(F.lit("<tr>"), tag("td", "p_name"), tag("th", F.concat(F.lit(" "), "p_brand", F.lit(" "))), F.lit("</tr>"))
    label = F.concat(F.lit('<th class="sub'), (k % 3).cast("string"), F.lit('">'), "p_type", F.lit("</th>"))
    first = F.concat(
        F.lit('<td rowspan="'), F.when(k % 5 == 0, "2").otherwise("1"), F.lit('" colspan="'), F.when(k % 7 == 0, "2").otherwise("1"), F.lit('">'), "p_name", F.lit("</td>"),
    )
    wide = F.when(k % 11 == 0, F.concat(tag("td", "p_brand"), tag("td", size), tag("td", "p_type"), tag("td", F.lit("&amp;")))).otherwise("")
    spanned = F.concat(F.lit("<tr>"), label, first, tag("td", size), wide, F.lit("</tr>"))
    ordered = lambda c: F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), c.alias("c")))), lambda x: x["c"]), ""
    )
    page = F.floor(k / 100)
    pages = (
        table(spark, sf_dir, "part")
        .groupBy(page.alias("page_no"))
        .agg(ordered(plain).alias("plain"), ordered(spanned).alias("spanned"))
        .select(
            F.concat(F.lit("https://t.example.org/p/"), F.col("page_no").cast("string")).alias("url"),
            F.concat(
                F.lit('<html><body><h1> Parts <b>list</b></h1><div class="x view-header">seen '),
                F.col("page_no").cast("string"),
                F.lit('</div><table><tr><th>Name</th><th>Brand</th></tr>'),
                "plain",
                F.lit('</table><div class="view-footer"> end </div><table><caption>Table 1.'),
                F.col("page_no").cast("string"),
                F.lit('A – Use</caption><thead><tr><th rowspan="2">Kind</th><th colspan="2">Part</th></tr><tr><th>Name</th><th>Size</th></tr></thead><tbody>'),
                "spanned",
                F.lit("</tbody><tfoot><tr><td>Source: parts</td></tr></tfoot></table></body></html>"),
            ).alias("html"),
        )
    )
    return _spread(pages)


@query(
    "html_table_cells",
    f"""WITH p AS (SELECT *, 'https://t.example.org/p/' || (p_partkey // 100) AS url, CAST(row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) AS INT) AS rn FROM part),
      u AS (SELECT DISTINCT url FROM p),
      c AS (
      SELECT url, 0 AS table_idx, 'tbody' AS part, 0 AS row_idx, i AS cell_idx, 'th' AS tag, CASE i WHEN 0 THEN 'Name' ELSE 'Brand' END AS text, 1 AS rowspan, 1 AS colspan, '' AS row_class FROM u, (SELECT unnest([0, 1]) AS i)
      UNION ALL SELECT url, 0, 'tbody', rn, 0, 'td', p_name, 1, 1, '' FROM p
      UNION ALL SELECT url, 0, 'tbody', rn, 1, 'th', p_brand, 1, 1, '' FROM p
      UNION ALL SELECT url, 1, 'caption', 0, 0, 'caption', 'Table 1.' || string_split(url, '/')[-1] || 'A – Use', 1, 1, NULL FROM u
      UNION ALL SELECT url, 1, 'tfoot', 0, 0, 'tfoot', 'Source: parts', 1, 1, NULL FROM u
      UNION ALL SELECT url, 1, 'thead', r, i, 'th', t, rs, cs, '' FROM u, (VALUES (0, 0, 'Kind', 2, 1), (0, 1, 'Part', 1, 2), (1, 0, 'Name', 1, 1), (1, 1, 'Size', 1, 1)) h(r, i, t, rs, cs)
      UNION ALL SELECT url, 1, 'tbody', rn + 1, 0, 'th', p_type, 1, 1, 'sub' || (p_partkey % 3) FROM p
      UNION ALL SELECT url, 1, 'tbody', rn + 1, 1, 'td', p_name, CASE WHEN p_partkey % 5 = 0 THEN 2 ELSE 1 END, CASE WHEN p_partkey % 7 = 0 THEN 2 ELSE 1 END, 'sub' || (p_partkey % 3) FROM p
      UNION ALL SELECT url, 1, 'tbody', rn + 1, 2, 'td', CAST(p_size AS VARCHAR), 1, 1, 'sub' || (p_partkey % 3) FROM p
      UNION ALL SELECT url, 1, 'tbody', rn + 1, 3 + i, 'td', [p_brand, CAST(p_size AS VARCHAR), p_type, '&'][i + 1], 1, 1, 'sub' || (p_partkey % 3) FROM p, (SELECT unnest([0, 1, 2, 3]) AS i) WHERE p_partkey % 11 = 0)
      SELECT * FROM c""",
)
def html_table_cells(spark, sf_dir):
    return html.html_table_cells(pages_with_tables(spark, sf_dir))


@query(
    "html_simple_table",
    """WITH p AS (SELECT *, 'https://t.example.org/p/' || (p_partkey // 100) AS url, CAST(row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) AS INT) AS rn FROM part)
      SELECT url, 0 AS row_idx, 'Name|Brand' AS vals, 'Partslist. seen ' || string_split(url, '/')[-1] AS header, 'end' AS footer FROM (SELECT DISTINCT url FROM p)
      UNION ALL SELECT url, rn, p_brand || '|' || p_name, 'Partslist. seen ' || string_split(url, '/')[-1], 'end' FROM p""",
)
def html_simple_table(spark, sf_dir):
    """The text of a note is its pieces, each stripped, without a space between."""
    pages = pages_with_tables(spark, sf_dir)
    rows = html.simple_table_rows(html.html_table_cells(pages))
    return rows.join(html.page_notes(pages), "url").withColumn("vals", show("vals"))


@query(
    "class_indent",
    """SELECT 'https://t.example.org/p/' || (p_partkey // 100) AS url, repeat(' ', p_partkey % 3) || p_type AS text, count(*) AS n FROM part GROUP BY 1, 2""",
)
def class_indent(spark, sf_dir):
    cells = ht.class_indent(html.html_table_cells(pages_with_tables(spark, sf_dir)))
    labels = cells.filter("table_idx = 1 and part = 'tbody' and cell_idx = 0")
    return labels.groupBy("url", "text").agg(F.count(F.lit(1)).alias("n"))


# Cells of a spanned row, and what the row before pushes into it: an empty cell below each copy of its name.
_SPANNED = """p AS (SELECT *, 'https://t.example.org/p/' || (p_partkey // 100) AS url, CAST(row_number() OVER (PARTITION BY p_partkey // 100 ORDER BY p_partkey) AS INT) AS rn,
    (CASE WHEN p_partkey % 7 = 0 THEN [p_name, p_name] ELSE [p_name] END) || [CAST(p_size AS VARCHAR)] ||
    (CASE WHEN p_partkey % 11 = 0 THEN [p_brand, CAST(p_size AS VARCHAR), p_type, '&'] ELSE CAST([] AS VARCHAR[]) END) AS later FROM part)"""
_PUSHED = "(CASE WHEN above % 5 = 0 AND above % 7 = 0 THEN ['', ''] WHEN above % 5 = 0 THEN [''] ELSE CAST([] AS VARCHAR[]) END)"


@query(
    "span_expand",
    f"""WITH {_SPANNED}, u AS (SELECT DISTINCT url FROM p),
      t AS (SELECT *, lag(p_partkey) OVER (PARTITION BY url ORDER BY p_partkey) AS above FROM p),
      r AS (
      SELECT url, 0 AS table_idx, 'tbody' AS part, 0 AS row_idx, ['Name', 'Brand'] AS vals FROM u
      UNION ALL SELECT url, 0, 'tbody', rn, [p_name, p_brand] FROM p
      UNION ALL SELECT url, 1, 'thead', 0, ['Kind', 'Part', 'Part'] FROM u
      UNION ALL SELECT url, 1, 'thead', 1, ['', 'Name', 'Size'] FROM u
      UNION ALL SELECT url, 1, 'tbody', rn + 1, [p_type] || {_PUSHED} || later FROM t)
      SELECT url, table_idx, part, row_idx, array_to_string(vals, '|') AS vals FROM r""",
)
def span_expand(spark, sf_dir):
    cells = html.html_table_cells(pages_with_tables(spark, sf_dir))
    return ht.span_expand(cells).withColumn("vals", show("vals"))


@query(
    "wide_row_slice",
    f"""WITH {PART_CELLS}, w AS (SELECT source, sheet, row_idx, vals, min(row_idx) OVER (PARTITION BY source, sheet) AS lo FROM part_rows),
      e AS (SELECT *, unnest(CASE WHEN row_idx > lo THEN [3, 6] ELSE [8] END) AS stop, unnest(CASE WHEN row_idx > lo THEN [0, 1] ELSE [0] END) AS slice_idx FROM w)
      SELECT source, sheet AS table_idx, row_idx, CAST(slice_idx AS INT) AS slice_idx, {sql_show('vals[1:stop]')} AS vals FROM e""",
)
def wide_row_slice(spark, sf_dir):
    """Rows of eight cells under a heading of three: prefixes of three and six."""
    rows = part_rows(spark, sf_dir).withColumnRenamed("sheet", "table_idx")
    header = rows.groupBy("source", "table_idx").agg(F.slice(F.min_by("vals", "row_idx"), 1, 3).alias("header"))
    return ht.wide_row_slice(rows, header, ["source"]).withColumn("vals", show("vals"))


@query(
    "html_page_grid",
    f"""WITH {_SPANNED}, u AS (SELECT DISTINCT url FROM p),
      w AS (SELECT *, [repeat(' ', p_partkey % 3) || p_type] || later AS cells FROM p),
      s AS (SELECT url, rn, p_partkey, cells, unnest(CASE WHEN rn > 1 AND len(cells) > 3 THEN range(3, len(cells), 3) ELSE [len(cells)] END) AS stop FROM w),
      t AS (SELECT *, lag(p_partkey) OVER x AS above, row_number() OVER x AS spot FROM s WINDOW x AS (PARTITION BY url ORDER BY rn, stop)),
      r AS (
      SELECT url, CAST(0 AS BIGINT) AS row_idx, ['Table 1.' || string_split(url, '/')[-1] || 'A – Use'] AS vals, false AS is_header FROM u
      UNION ALL SELECT url, 1, ['Kind ', 'Part Name', 'Part Size'], true FROM u
      UNION ALL SELECT url, spot + 1, [cells[1]] || {_PUSHED} || cells[2:stop], false FROM t
      UNION ALL SELECT url, max(spot) + 2, ['Source: parts'], false FROM t GROUP BY url)
      SELECT url AS source, '1' AS sheet, row_idx, array_to_string(vals, '|') AS vals, is_header FROM r""",
)
def html_page_grid(spark, sf_dir):
    cells = html.html_table_cells(pages_with_tables(spark, sf_dir)).filter("table_idx = 1")
    return ht.page_grid(cells).withColumn("vals", show("vals"))


@query(
    "captions",
    """SELECT 'https://t.example.org/p/' || n AS url, 1 AS table_idx, 'Table 1.' || n || 'A – Use' AS text, 'Table_1_' || n AS key
      FROM (SELECT DISTINCT p_partkey // 100 AS n FROM part)""",
)
def captions(spark, sf_dir):
    return ht.captions(html.html_table_cells(pages_with_tables(spark, sf_dir)))
