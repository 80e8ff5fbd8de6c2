"""Delimited text of uneven shape, over the lines of ``documents``."""

from pyspark.sql import functions as F

from gridloom.operators import delimited as dl
from gridloom.queries.inputs import DOC_LINES, doc_lines, show, sql_show
from gridloom.queries.registry import query

# Sentences become fields between wide blanks, clauses fields between tabs. Some
# files get a ruler, some a trailing tab below the heading, some a first data
# line with empty fields, some nothing but one line.
_RAW = (
    DOC_LINES
    + """, raw AS (SELECT source, sheet, row_idx, CASE
      WHEN CAST(sheet AS INT) % 6 = 0 AND row_idx = 0 THEN string_split(value, ' ')[1] || ' x'
      WHEN CAST(sheet AS INT) % 6 = 0 AND row_idx = 1 THEN '---- --'
      WHEN CAST(sheet AS INT) % 6 = 0 THEN string_split(value, ' ')[1] || chr(9) || length(value)
      WHEN CAST(sheet AS INT) % 6 = 1 AND row_idx = 0 THEN 'a' || chr(9) || 'b'
      WHEN CAST(sheet AS INT) % 6 = 1 THEN string_split(value, ' ')[1] || chr(9) || length(value) || chr(9)
      WHEN CAST(sheet AS INT) % 6 = 2 AND row_idx = 0 THEN 'code' || chr(9) || '2010'
      WHEN CAST(sheet AS INT) % 6 = 2 THEN string_split(value, ' ')[1] || chr(9) || chr(9) ||
        CASE WHEN row_idx > 1 AND length(value) % 2 = 0 THEN 'note' ELSE '' END || chr(9) || 'n' || length(value)
      ELSE replace(replace(value, '. ', '   '), ', ', chr(9)) END AS value FROM doc_lines)"""
)


def raw_lines(spark, sf_dir):
    value, k, i, tab = F.col("value"), F.col("sheet").cast("int") % 6, F.col("row_idx"), F.lit("\t")
    word, n = F.split(value, " ")[0], F.length(value).cast("string")
    note = F.when((i > 1) & (F.length(value) % 2 == 0), "note").otherwise("")
    text = (
        F.when((k == 0) & (i == 0), F.concat(word, F.lit(" x")))
        .when((k == 0) & (i == 1), "---- --")
        .when(k == 0, F.concat(word, tab, n))
        .when((k == 1) & (i == 0), F.concat(F.lit("a"), tab, F.lit("b")))
        .when(k == 1, F.concat(word, tab, n, tab))
        .when((k == 2) & (i == 0), F.concat(F.lit("code"), tab, F.lit("2010")))
        .when(k == 2, F.concat(word, tab, tab, note, tab, F.lit("n"), n))
        .otherwise(F.replace(F.replace(value, F.lit(". "), F.lit("   ")), F.lit(", "), tab))
    )
    return doc_lines(spark, sf_dir).withColumn("value", text)


_GRID = _RAW + r""", g AS (SELECT source, sheet, row_idx, flatten(list_transform(string_split(value, chr(9)), lambda w: regexp_split_to_array(trim(w), '\s\s+'))) AS vals
  FROM raw WHERE trim(value, ' ' || chr(9)) <> '')"""
_SNIFF = _GRID + r""", p AS (SELECT *, row_number() OVER (PARTITION BY source, sheet ORDER BY row_idx) - 1 AS position FROM g),
  hd AS (SELECT source, sheet, count(*) AS n_rows, list(vals ORDER BY position) AS hd FROM p GROUP BY 1, 2),
  e AS (SELECT source, sheet, n_rows, hd[1] AS h, hd[2] AS r1, hd[3] AS r2, hd,
          list_position(list_transform(hd[1:10], lambda v: regexp_matches(v[1], '^[- ]*$')), true) - 1 AS ruler0 FROM hd),
  f AS (SELECT *, CASE WHEN len(h) <= 2 AND ruler0 >= 1 THEN ruler0 END AS ruler, coalesce(r1[-1] = '', false) AS ee FROM e),
  i AS (SELECT *, hd[ruler] AS above, hd[ruler + 2] AS below,
          CASE WHEN ee THEN r1[1:len(r1) - 1] ELSE r1 END AS c1, CASE WHEN ee THEN r2[1:len(r2) - 1] ELSE r2 END AS c2 FROM f),
  k AS (SELECT *, CASE WHEN len(above) < len(below) THEN regexp_split_to_array(trim(above[1]), '\s+') ELSE above END AS ruled FROM i),
  md AS (SELECT *, CASE WHEN n_rows = 1 THEN 'header_only' WHEN coalesce(len(ruled) = len(below), false) THEN 'ruler'
      WHEN NOT len(h) < len(r1) THEN 'plain' WHEN len(h) = len(c1) THEN 'trim'
      WHEN len(c1) = len(c2) AND len(h) = len(list_filter(c1, lambda v: trim(v) <> '')) THEN 'unnamed' ELSE 'bad' END AS mode FROM k),
  sn AS (SELECT p.source, p.sheet, p.row_idx, p.position, md.mode, md.n_rows, CASE WHEN mode = 'ruler' THEN ruled ELSE h END AS header,
      CASE WHEN mode = 'ruler' THEN ruler ELSE 0 END AS header_end,
      CASE WHEN mode = 'trim' AND ee THEN p.vals[1:len(p.vals) - 1]
           WHEN mode = 'unnamed' THEN list_filter(CASE WHEN ee THEN p.vals[1:len(p.vals) - 1] ELSE p.vals END, lambda x, j: coalesce(trim(c1[j]) <> '', false))
           ELSE p.vals END AS vals FROM p JOIN md USING (source, sheet))"""
_CLEAN = "regexp_replace(trim(v), '[^A-Za-z0-9]+', '_', 'g')"


def _rows(spark, sf_dir):
    return dl.delimited_layout(raw_lines(spark, sf_dir))


@query("delimited_layout", f"WITH {_GRID} SELECT source, sheet, row_idx, {sql_show('vals')} AS vals FROM g")
def delimited_layout(spark, sf_dir):
    return _rows(spark, sf_dir).withColumn("vals", show("vals"))


@query(
    "sniff_table",
    f"WITH {_SNIFF} SELECT source, sheet, row_idx, mode, {sql_show('header')} AS header, {sql_show('vals')} AS vals FROM sn",
)
def sniff_table(spark, sf_dir):
    out = dl.sniff_table(_rows(spark, sf_dir))
    return out.select("source", "sheet", "row_idx", "mode", show("header").alias("header"), show("vals").alias("vals"))


@query(
    "ruler_header",
    f"WITH {_SNIFF} SELECT source, sheet, row_idx, {sql_show('header')} AS header, {sql_show('vals')} AS vals FROM sn WHERE mode = 'ruler' AND position > header_end",
)
def ruler_header(spark, sf_dir):
    out = dl.ruler_header(_rows(spark, sf_dir))
    return out.withColumns({"header": show("header"), "vals": show("vals")})


@query(
    "ragged_trim",
    f"WITH {_SNIFF} SELECT source, sheet, row_idx, mode, {sql_show('header')} AS header, {sql_show('vals')} AS vals FROM sn WHERE mode IN ('trim', 'unnamed') AND position > header_end",
)
def ragged_trim(spark, sf_dir):
    out = dl.ragged_trim(_rows(spark, sf_dir))
    return out.withColumns({"header": show("header"), "vals": show("vals")})


@query(
    "header_only_table",
    f"""WITH {_SNIFF} SELECT source, sheet, CAST(j - 1 AS INT) AS col_idx, v AS raw, {_CLEAN} AS name
      FROM (SELECT source, sheet, unnest(header) AS v, unnest(range(1, len(header) + 1)) AS j FROM sn WHERE mode = 'header_only') WHERE v <> ''""",
)
def header_only_table(spark, sf_dir):
    return dl.header_only_table(_rows(spark, sf_dir))


@query(
    "text_names",
    f"""WITH {_SNIFF}, nm AS (SELECT source, sheet, mode, list_transform(list_filter(header, lambda v: v <> ''), lambda v: {_CLEAN}) AS nm FROM sn WHERE position = 0),
      nu AS (SELECT *, len(list_filter(nm, lambda x: regexp_matches(x, '^[0-9]+$'))) > 0 AS header_is_data FROM nm)
      SELECT source, sheet, mode, header_is_data, {sql_show("CASE WHEN header_is_data THEN list_transform(nm, lambda x, j: 'col_' || j) ELSE nm END")} AS names FROM nu""",
)
def text_names(spark, sf_dir):
    return dl.text_names(dl.sniff_table(_rows(spark, sf_dir))).withColumn("names", show("names"))


@query(
    "sniff_quarantine",
    f"WITH {_SNIFF} SELECT source || '/' || sheet AS source, 'text' AS stage, 'no width fits' AS reason, count(*) AS n_rows FROM sn WHERE mode = 'bad' GROUP BY 1",
)
def sniff_quarantine(spark, sf_dir):
    """Files whose heading and rows fit in no way are reported, not lost."""
    from gridloom.operators.quarantine import check, quarantine_units

    sniffed = dl.sniff_table(_rows(spark, sf_dir)).withColumn("source", F.concat_ws("/", "source", "sheet"))
    return quarantine_units(check(sniffed, {"no width fits": F.col("mode") != "bad"}), "text")


_TAB = _RAW + ", tb AS (SELECT source, sheet, row_idx, string_split(value, chr(9)) AS vals FROM raw WHERE trim(value, ' ' || chr(9)) <> '')"
_RETRY = _TAB + r""", p AS (SELECT *, row_number() OVER (PARTITION BY source, sheet ORDER BY row_idx) - 1 AS position FROM tb),
  hd AS (SELECT source, sheet, list(vals ORDER BY position) AS hd FROM p GROUP BY 1, 2),
  e AS (SELECT source, sheet, hd[1] AS h, hd[2] AS r1, hd[3] AS r2,
      list_transform(list_filter(hd[1], lambda v: v <> ''), lambda v: regexp_replace(trim(v), '[^A-Za-z0-9]+', '_', 'g')) AS nm FROM hd),
  f AS (SELECT *, CASE WHEN NOT coalesce(starts_with(nm[-1], '_') OR len(r1) <> len(nm), false) THEN 'fit'
      WHEN coalesce(r2[-1] = '', false) THEN 'trim' ELSE 'pad' END AS route,
      list_transform(CASE WHEN h[-1] = '' THEN h[1:len(h) - 1] ELSE h END, lambda v: regexp_replace(trim(v), '[^A-Za-z0-9]+', '_', 'g')) AS tr FROM e),
  k AS (SELECT *, CASE route WHEN 'fit' THEN nm WHEN 'trim' THEN tr END AS base FROM f),
  l AS (SELECT *, coalesce(len(list_filter(base, lambda x: regexp_matches(x, '^[0-9]+$'))) > 0, false) AS num FROM k),
  o AS (SELECT *, CASE WHEN route = 'pad' THEN list_transform(r1, lambda x, j: 'col_' || j) WHEN num THEN list_transform(base, lambda x, j: 'col_' || j) ELSE base END AS names FROM l),
  q AS (SELECT p.source, p.sheet, p.row_idx, p.position, route, names, num, nm, p.vals, r1, greatest(1, len(p.vals) - len(nm)) AS excess FROM p JOIN o USING (source, sheet)),
  z AS (SELECT *, list_filter(list_transform(vals, lambda v, j: CASE WHEN v = '' THEN j END), lambda j: j IS NOT NULL) AS em FROM q),
  y AS (SELECT *, CASE route
      WHEN 'fit' THEN CASE WHEN len(em) > 0 AND len(vals) <> len(nm) THEN list_filter(vals, lambda v, j: NOT list_contains(em[1:excess], j)) ELSE vals END
      WHEN 'trim' THEN CASE WHEN vals[-1] = '' THEN vals[1:len(vals) - 1] ELSE vals END
      ELSE CASE WHEN position = 0 THEN list_concat(vals, list_transform(range(greatest(len(r1) - len(vals), 0)), lambda j: ' ')) ELSE vals END END AS nv FROM z)
  SELECT source, sheet, row_idx, route, """ + sql_show("names") + " AS names, " + sql_show("nv") + """ AS vals, len(nv) = len(names) AS fits FROM y
  WHERE position > 0 OR route = 'pad' OR num"""


@query("retry_parse", f"WITH {_RETRY}")
def retry_parse(spark, sf_dir):
    out = dl.retry_parse(dl.tab_fields(raw_lines(spark, sf_dir)))
    return out.withColumns({"names": show("names"), "vals": show("vals")})


@query(
    "chunk_reshape",
    f"""WITH {DOC_LINES}, tb AS (SELECT source, sheet, row_idx, list_filter(string_split(value, ' '), lambda v: v <> '') AS fields,
        row_number() OVER (PARTITION BY source, sheet ORDER BY row_idx) AS rn FROM doc_lines WHERE trim(value) <> ''),
      c AS (SELECT source, sheet, fields, len(fields) AS n, unnest(fields) AS value, unnest(range(len(fields))) AS spot FROM tb WHERE rn = 1)
      SELECT source, sheet, CAST(spot // 5 AS INT) AS row_idx, CAST(spot % 5 AS INT) AS col_idx, fields[spot % 5 + 1] AS name, value
      FROM c WHERE (spot // 5 + 1) * 5 <= n""",
)
def chunk_reshape(spark, sf_dir):
    """Words stand for the fields of an error map."""
    lines = doc_lines(spark, sf_dir).withColumn("value", F.replace("value", F.lit(" "), F.lit("\t")))
    return dl.chunk_reshape(dl.tab_fields(lines))


@query(
    "column_membership",
    f"""WITH {DOC_LINES}, w AS (SELECT source, sheet, row_idx, string_split(value, ' ') AS names FROM doc_lines)
      SELECT source, sheet, row_idx FROM w WHERE list_contains(names, 'the') AND list_contains(names, 'of')""",
)
def column_membership(spark, sf_dir):
    headers = doc_lines(spark, sf_dir).withColumn("names", F.split("value", " "))
    return dl.column_membership(headers, ["the", "of"]).select("source", "sheet", "row_idx")
