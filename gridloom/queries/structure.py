"""Headers, row roles, labels and notes, over the sheets made from ``documents``."""

from pyspark.sql import functions as F

from gridloom.operators import splits, structure as st
from gridloom.operators.grid import drop_blank_rows
from gridloom.queries.inputs import DOC_GRID, DOC_LINES, PART_CELLS, doc_grid, doc_lines, part_rows, show, sql_show, table
from gridloom.queries.registry import query

_W = f"WITH {DOC_GRID}"
_SHOWN = f"{sql_show('vals')} AS vals"
_BODY = "(n > 1 OR (n = 1 AND c0 IS NULL))"
_ALPHA = r"'^\p{L}+$'"

# ---- header depth -------------------------------------------------------

_GOV = "(c0 IS NULL OR nulls >= 1)"
_USPTO = f"(c0 IS NULL OR (row_idx = 0 AND nulls >= 1) OR coalesce(regexp_matches(c0, {_ALPHA}) AND regexp_matches(cl, {_ALPHA}), false))"
_DL = f"""(c0 IS NULL OR (nulls = 4 AND c2 IS NULL AND c1 IS NOT NULL) OR (nulls = 8 AND c12 IS NOT NULL)
  OR (nulls > 2 AND c1 IS NOT NULL AND c2 IS NOT NULL AND cl IS NULL AND cl2 IS NOT NULL)
  OR (nulls < 6 AND len(list_filter(vals, lambda x: x IS NOT NULL AND NOT regexp_matches(regexp_replace(x, '[ ().]', '', 'g'), {_ALPHA}))) = 0))"""


def _run(p: str) -> str:
    return f""", stops AS (SELECT source, sheet, min(row_idx) FILTER (NOT {p}) AS stop FROM rowfacts GROUP BY 1, 2),
      runs AS (SELECT r.*, stop IS NULL OR row_idx < stop AS is_header FROM rowfacts r JOIN stops USING (source, sheet))"""


def _depth(p: str) -> str:
    return f"{_W}{_run(p)} SELECT source, sheet, count(*) FILTER (is_header) AS depth FROM runs GROUP BY 1, 2"


@query("header_depth_gov", _depth(_GOV))
def header_depth_gov(spark, sf_dir):
    return st.header_depth(st.gov_prefix(doc_grid(spark, sf_dir)), st.header_row_gov())


@query("header_depth_uspto", _depth(_USPTO))
def header_depth_uspto(spark, sf_dir):
    rows = doc_grid(spark, sf_dir).withColumn("position", F.col("row_idx"))
    return st.header_depth(rows, st.header_row_uspto())


@query("header_depth_dl", _depth(_DL))
def header_depth_dl(spark, sf_dir):
    return st.header_depth(doc_grid(spark, sf_dir), st.header_row_dl())


@query(
    "header_depth_soi",
    _W
    + """, b AS (SELECT *, row_idx AS position, c0 IS NULL AS se, (c0 IS NULL OR nulls > 1 OR (row_idx <= 1 AND nulls = 1)) AS looks FROM rowfacts),
      c AS (SELECT *, sum(CASE WHEN looks THEN 0 ELSE 1 END) OVER (PARTITION BY source, sheet ORDER BY position) AS others FROM b),
      f AS (SELECT source, sheet, count(*) AS n_all, min(position) FILTER (others = 4 AND NOT looks) AS fourth, arg_max(se, position) AS ends_empty FROM c GROUP BY 1, 2),
      g AS (SELECT *, coalesce(fourth, n_all) AS reach, n_all - CASE WHEN ends_empty THEN 1 ELSE 0 END AS n_rows FROM f),
      h AS (SELECT *, CASE WHEN reach = n_rows THEN reach - 1 ELSE reach END AS scanned FROM g),
      a AS (SELECT source, sheet, max(position) AS anchor FROM c JOIN h USING (source, sheet) WHERE se AND position <= scanned AND position < n_rows GROUP BY 1, 2)
      SELECT source, sheet, n_rows, scanned, CASE WHEN n_rows >= 5 AND n_rows >= scanned THEN coalesce(anchor, 0) END AS depth
      FROM h LEFT JOIN a USING (source, sheet)""",
)
def header_depth_soi(spark, sf_dir):
    return st.header_depth_soi(doc_grid(spark, sf_dir).withColumn("position", F.col("row_idx")))


# ---- header text --------------------------------------------------------

# Rows without the prefix: here two words side by side make a heading too.
_GOV_WORDS = f"(c0 IS NULL OR nulls >= 1 OR coalesce(regexp_matches(c0, {_ALPHA}) AND regexp_matches(c1, {_ALPHA}), false))"


@query("header_depth_gov_words", _depth(_GOV_WORDS))
def header_depth_gov_words(spark, sf_dir):
    """Cells without the leading space of the family, so that rows of words count."""
    return st.header_depth(doc_grid(spark, sf_dir), st.header_row_gov())


_HEAD = (
    _run(_GOV_WORDS)
    + """, heads AS (SELECT *, row_idx = min(row_idx) OVER w AS is_first, row_idx = max(row_idx) OVER w AS is_last
        FROM runs WHERE is_header WINDOW w AS (PARTITION BY source, sheet)),
      hcells AS (SELECT source, sheet, row_idx, is_first, is_last, n, CAST(unnest(range(len(vals))) AS INT) AS col_idx, unnest(vals) AS value FROM heads),
      filled AS (SELECT source, sheet, row_idx, col_idx, is_first, is_last,
        CASE WHEN is_last THEN value
             WHEN is_first AND n = 1 THEN CASE WHEN col_idx > 0 THEN max(value) OVER (PARTITION BY source, sheet, row_idx) END
             ELSE last_value(value IGNORE NULLS) OVER (PARTITION BY source, sheet, row_idx ORDER BY col_idx ROWS UNBOUNDED PRECEDING) END AS value
        FROM hcells)"""
)


def _header_cells(spark, sf_dir):
    rows = st.mark_leading_run(doc_grid(spark, sf_dir), st.header_row_gov()).filter("is_header")
    ends = rows.groupBy("source", "sheet").agg(F.min("row_idx").alias("lo"), F.max("row_idx").alias("hi"))
    marked = rows.join(ends, ["source", "sheet"]).select(
        "source",
        "sheet",
        "row_idx",
        (F.col("row_idx") == F.col("lo")).alias("is_first"),
        (F.col("row_idx") == F.col("hi")).alias("is_last"),
        F.posexplode("vals").alias("col_idx", "value"),
    )
    return marked


@query("header_ffill", f"{_W}{_HEAD} SELECT * FROM filled")
def header_ffill(spark, sf_dir):
    return st.header_ffill(_header_cells(spark, sf_dir))


@query(
    "header_flatten",
    f"{_W}{_HEAD} SELECT source, sheet, col_idx, string_agg(coalesce(value, ' '), ' ' ORDER BY row_idx) AS raw FROM filled GROUP BY 1, 2, 3",
)
def header_flatten(spark, sf_dir):
    return st.header_flatten(st.header_ffill(_header_cells(spark, sf_dir)))


@query(
    "header_flatten_stripped",
    f"""{_W}{_HEAD}, pieces AS (SELECT source, sheet, col_idx, list(coalesce(value, '~~') ORDER BY row_idx) AS ps FROM filled GROUP BY 1, 2, 3)
      SELECT source, sheet, col_idx, CASE WHEN len(ps) = 1 THEN nullif(ps[1], '~~') ELSE list_reduce(
        list_transform(ps, lambda p, i: CASE WHEN p = '~~' THEN ' ' WHEN i = 1 THEN p ELSE trim(p) END),
        lambda a, b: coalesce(CASE WHEN a = ' ' THEN a ELSE trim(a) END, ' ') || ' ' || b) END AS raw FROM pieces""",
)
def header_flatten_stripped(spark, sf_dir):
    return st.header_flatten(st.header_ffill(_header_cells(spark, sf_dir)), strip_pieces=True)


# ---- indentation --------------------------------------------------------


@query(
    "indent_path",
    _W
    + """, lab AS (SELECT source, sheet, row_idx, length(c0) - length(ltrim(c0)) AS k, trim(c0) AS label FROM rowfacts WHERE c0 IS NOT NULL),
      anc AS (SELECT r.source, r.sheet, r.row_idx, s.k, s.label FROM lab r JOIN lab s
                ON s.source = r.source AND s.sheet = r.sheet AND s.row_idx <= r.row_idx
              WHERE NOT EXISTS (SELECT 1 FROM lab t WHERE t.source = r.source AND t.sheet = r.sheet
                AND t.row_idx > s.row_idx AND t.row_idx <= r.row_idx AND t.k <= s.k)),
      paths AS (SELECT source, sheet, row_idx, string_agg(label, ' ' ORDER BY k) AS p FROM anc GROUP BY 1, 2, 3)
      SELECT source, sheet, row_idx, """
    + sql_show("CASE WHEN p IS NULL THEN vals ELSE list_concat([p], vals[2:]) END")
    + " AS vals FROM rowfacts LEFT JOIN paths USING (source, sheet, row_idx)",
)
def indent_path(spark, sf_dir):
    return st.indent_path(doc_grid(spark, sf_dir)).withColumn("vals", show("vals"))


@query("drop_label_rows", f"{_W} SELECT source, sheet, row_idx, {_SHOWN} FROM rowfacts WHERE n >= 2")
def drop_label_rows(spark, sf_dir):
    return st.drop_label_rows(doc_grid(spark, sf_dir)).withColumn("vals", show("vals"))


@query("drop_label_rows_first", f"{_W} SELECT source, sheet, row_idx, {_SHOWN} FROM rowfacts WHERE n >= 2 AND c0 IS NOT NULL")
def drop_label_rows_first(spark, sf_dir):
    return st.drop_label_rows(doc_grid(spark, sf_dir), need_first=True).withColumn("vals", show("vals"))


# ---- row roles ----------------------------------------------------------

_HTML_ROLES = f""", f AS (SELECT source, sheet, min(row_idx) FILTER ({_BODY}) AS fb, max(row_idx) FILTER (NOT {_BODY} AND n = 1) AS ls FROM rowfacts GROUP BY 1, 2),
  roles AS (SELECT r.*, CASE WHEN n = 0 THEN 'blank' WHEN {_BODY} THEN 'body' WHEN fb IS NULL OR row_idx < fb THEN 'title'
    WHEN row_idx = ls THEN 'footer' ELSE 'other' END AS role FROM rowfacts r JOIN f USING (source, sheet))"""


@query("classify_rows_html", f"{_W}{_HTML_ROLES} SELECT source, sheet, row_idx, role FROM roles")
def classify_rows_html(spark, sf_dir):
    return st.classify_rows_html(doc_grid(spark, sf_dir)).drop("vals")


@query(
    "classify_rows_gov",
    f"""{_W}, a AS (SELECT *, lag(n) OVER (PARTITION BY source, sheet ORDER BY row_idx) AS pn FROM rowfacts),
      b AS (SELECT *, n > 0 AND ({_BODY} OR coalesce(ends_with(firstv, ':') AND coalesce(pn, 0) <> 1, false))
              AND len(list_filter(vals, lambda x: contains(x, '.pdf'))) = 0 AS body FROM a),
      c AS (SELECT *, coalesce(sum(body::INT) OVER (PARTITION BY source, sheet ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bodies FROM b),
      d AS (SELECT *, sum(CASE WHEN NOT body AND bodies = 0 THEN n ELSE 0 END) OVER (PARTITION BY source, sheet) AS titles FROM c)
      SELECT source, sheet, row_idx, CASE WHEN n = 0 THEN 'blank' WHEN body THEN 'body' WHEN bodies = 0 THEN 'title'
        WHEN titles > 1 AND bodies > 1 AND n = 1 THEN 'footer' ELSE 'other' END AS role FROM d""",
)
def classify_rows_gov(spark, sf_dir):
    return st.classify_rows_gov(doc_grid(spark, sf_dir)).drop("vals")


_USPTO_ROLES = f""", a AS (SELECT *, {_BODY} AS body, NOT {_BODY} AND n = 1 AS single FROM rowfacts),
  b AS (SELECT *, coalesce(sum(body::INT) OVER (PARTITION BY source, sheet ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bodies FROM a),
  c AS (SELECT *, coalesce(single AND bodies > 1 AND (NOT regexp_matches(c0, '^\\p{{L}}') OR starts_with(c0, 'changed') OR starts_with(c0, 'Effective')), false) AS cand FROM b),
  d AS (SELECT *, sum((single AND bodies = 0)::INT) OVER w AS titles, min(CASE WHEN cand THEN row_idx END) OVER w AS note FROM c WINDOW w AS (PARTITION BY source, sheet)),
  roles AS (SELECT *, CASE WHEN n = 0 THEN 'blank' WHEN body THEN 'body' WHEN bodies = 0 THEN 'title' WHEN cand AND titles > 1 THEN 'footer'
    WHEN titles > 1 AND note < row_idx THEN 'other' ELSE 'label' END AS role FROM d)"""


@query("classify_rows_uspto", f"{_W}{_USPTO_ROLES} SELECT source, sheet, row_idx, role FROM roles")
def classify_rows_uspto(spark, sf_dir):
    return st.classify_rows_uspto(doc_grid(spark, sf_dir)).drop("vals")


@query(
    "classify_rows_dl",
    f"""{_W}, a AS (SELECT *, coalesce(n > 1 OR (n = 1 AND c0 IS NULL AND NOT contains(firstv, '=') AND NOT contains(firstv, '*'))
          OR (n = 1 AND (regexp_matches(trim(firstv), '^[0-9]+$') OR regexp_matches(replace(firstv, '.', ''), '^[0-9]+$')))
          OR (n = 1 AND length(c0) = 2) OR (n = 1 AND nulls = 3 AND regexp_matches(replace(firstv, ' ', ''), {_ALPHA})), false) AS body FROM rowfacts),
      f AS (SELECT source, sheet, min(row_idx) FILTER (body) AS fb FROM a GROUP BY 1, 2)
      SELECT source, sheet, row_idx, CASE WHEN n = 0 THEN 'blank' WHEN body THEN 'body' WHEN fb IS NULL OR row_idx < fb THEN 'title' ELSE 'footer' END AS role
      FROM a JOIN f USING (source, sheet)""",
)
def classify_rows_dl(spark, sf_dir):
    return st.classify_rows_dl(doc_grid(spark, sf_dir)).drop("vals")


_SOI_ROLES = f""", a AS (SELECT *, {_BODY} AS body, sum((n > 1)::INT) OVER (PARTITION BY source, sheet ORDER BY row_idx) AS isl FROM rowfacts),
  f AS (SELECT source, sheet, min(row_idx) FILTER (body) AS fb, max(isl) AS islands FROM a GROUP BY 1, 2),
  roles AS (SELECT a.*, CAST(isl AS BIGINT) AS island, CASE WHEN n = 0 THEN 'blank' WHEN body THEN 'body' WHEN fb IS NULL OR row_idx < fb THEN 'title'
    WHEN isl = islands THEN 'footer' ELSE 'body' END AS role FROM a JOIN f USING (source, sheet))"""


@query("classify_rows_soi", f"{_W}{_SOI_ROLES} SELECT source, sheet, row_idx, island, role FROM roles")
def classify_rows_soi(spark, sf_dir):
    return st.classify_rows_soi(doc_grid(spark, sf_dir)).drop("vals")


@query(
    "collapse_lone_rows",
    f"""{_W}{_SOI_ROLES}, lone AS (SELECT *, role = 'body' AND n = 1 AND c0 IS NOT NULL AS lone FROM roles),
      j AS (SELECT source, sheet, island, min(row_idx) AS row_idx, string_agg(c0, ' ' ORDER BY row_idx) AS txt FROM lone WHERE lone GROUP BY 1, 2, 3)
      SELECT l.source, l.sheet, l.row_idx, {sql_show("CASE WHEN j.txt IS NULL THEN vals ELSE list_concat([j.txt], vals[2:]) END")} AS vals
      FROM lone l LEFT JOIN j ON j.source = l.source AND j.sheet = l.sheet AND j.row_idx = l.row_idx WHERE NOT lone OR j.txt IS NOT NULL""",
)
def collapse_lone_rows(spark, sf_dir):
    out = st.collapse_lone_rows(st.classify_rows_soi(doc_grid(spark, sf_dir)))
    return out.select("source", "sheet", "row_idx", show("vals").alias("vals"))


@query(
    "soi_normalise",
    f"""WITH {PART_CELLS}, m AS (SELECT source, sheet, row_idx, CASE WHEN row_idx % 11 = 0 THEN list_transform(vals, lambda v: '* note')
          WHEN row_idx % 3 = 0 THEN list_transform(vals, lambda v: 'same') WHEN row_idx % 5 = 0 THEN list_concat(['NUMBER'], vals[2:])
          ELSE list_concat(vals[1:7], ['-1']) END AS vals FROM part_rows),
      e AS (SELECT *, min(row_idx) OVER w AS lo, max(row_idx) OVER w AS hi FROM m WINDOW w AS (PARTITION BY source, sheet))
      SELECT source, sheet, row_idx, {sql_show('''CASE WHEN vals[1] = '* note' OR (vals[1] = 'same' AND row_idx = hi)
          THEN list_transform(vals, lambda v, i: CASE WHEN i = 1 THEN v END)
        WHEN vals[1] = 'NUMBER' THEN list_concat([NULL], vals[2:])
        WHEN row_idx = lo AND vals[8] = '-1' THEN list_concat(vals[1:7], [NULL]) ELSE vals END''')} AS vals FROM e""",
)
def soi_normalise(spark, sf_dir):
    k, vals = F.col("row_idx"), F.col("vals")
    marked = part_rows(spark, sf_dir).withColumn(
        "vals",
        F.when(k % 11 == 0, F.transform(vals, lambda v: F.lit("* note")))
        .when(k % 3 == 0, F.transform(vals, lambda v: F.lit("same")))
        .when(k % 5 == 0, F.concat(F.array(F.lit("NUMBER")), F.slice(vals, 2, 7)))
        .otherwise(F.concat(F.slice(vals, 1, 7), F.array(F.lit("-1")))),
    )
    return st.soi_normalise(marked).withColumn("vals", show("vals"))


# ---- carried labels -----------------------------------------------------


@query(
    "carry_label_uspto",
    f"""{_W}{_USPTO_ROLES}, p AS (SELECT *, coalesce(lag(n) OVER (PARTITION BY source, sheet ORDER BY row_idx), 0) AS pn FROM roles),
      q AS (SELECT *, sum((n = 0 OR (role = 'label' AND pn <> 1))::INT) OVER (PARTITION BY source, sheet ORDER BY row_idx) AS isl FROM p),
      t AS (SELECT source, sheet, row_idx, string_agg(CASE WHEN pn = 1 THEN ' ' || c0 ELSE c0 END, '') OVER (PARTITION BY source, sheet, isl ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS txt FROM q WHERE role = 'label'),
      u AS (SELECT q.*, last_value(CASE WHEN n = 0 THEN '' ELSE txt END IGNORE NULLS) OVER (PARTITION BY q.source, q.sheet ORDER BY q.row_idx ROWS UNBOUNDED PRECEDING) AS lbl
            FROM q LEFT JOIN t ON t.source = q.source AND t.sheet = q.sheet AND t.row_idx = q.row_idx)
      SELECT source, sheet, row_idx, {sql_show("CASE WHEN coalesce(lbl, '') <> '' THEN list_concat([lbl || ' ' || coalesce(c0, '')], vals[2:]) ELSE vals END")} AS vals
      FROM u WHERE role = 'body'""",
)
def carry_label_uspto(spark, sf_dir):
    out = st.carry_label_uspto(st.classify_rows_uspto(doc_grid(spark, sf_dir)))
    return out.withColumn("vals", show("vals"))


@query(
    "keep_label_uspto_special",
    f"""{_W}{_USPTO_ROLES}, p AS (SELECT *, CASE WHEN n = 1 THEN c0 END AS f, role = 'label' AS is_label, coalesce(lag(n) OVER x, 0) AS pn,
        last_value(CASE WHEN role = 'label' THEN 1 WHEN n = 0 THEN 0 END IGNORE NULLS) OVER (PARTITION BY source, sheet ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_above
        FROM roles WINDOW x AS (PARTITION BY source, sheet ORDER BY row_idx)),
      q AS (SELECT *, coalesce(is_label AND pn = 1 AND open_above = 1 AND NOT starts_with(f, ' '), false) AS joins FROM p),
      r AS (SELECT *, sum(((is_label AND NOT joins) OR n = 0)::INT) OVER (PARTITION BY source, sheet ORDER BY row_idx) AS chain FROM q),
      t AS (SELECT source, sheet, row_idx, string_agg(CASE WHEN joins THEN ' ' || trim(f) ELSE f END, '') OVER (PARTITION BY source, sheet, chain ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS txt FROM r WHERE is_label),
      k AS (SELECT r.*, txt, CASE WHEN joins THEN txt ELSE f END AS g FROM r LEFT JOIN t ON t.source = r.source AND t.sheet = r.sheet AND t.row_idx = r.row_idx WHERE role IN ('body', 'label')),
      m AS (SELECT *, coalesce(n = 1 AND g = 'Patent Matters', false) AS mover FROM k),
      v AS (SELECT *, coalesce(lag(mover) OVER (PARTITION BY source, sheet ORDER BY row_idx), false) AS moved FROM m),
      z AS (SELECT *, CASE WHEN moved THEN concat_ws(' ', 'Patent Matters', g) ELSE g END AS final FROM v),
      o AS (SELECT *, CASE WHEN moved THEN concat_ws(' ', 'Patent Matters', coalesce(CASE WHEN joins THEN txt END, c0)) ELSE coalesce(CASE WHEN joins THEN txt END, c0) END AS shown
            FROM z WHERE NOT mover AND NOT coalesce(n = 1 AND (ends_with(final, ':') OR NOT starts_with(final, ' ')), false))
      SELECT source, sheet, row_idx, {sql_show("list_concat([shown], vals[2:])")} AS vals FROM o WHERE shown IS NOT NULL""",
)
def keep_label_uspto_special(spark, sf_dir):
    out = st.keep_label_uspto_special(st.classify_rows_uspto(doc_grid(spark, sf_dir)))
    return out.withColumn("vals", show("vals"))


@query(
    "carry_label_soi",
    f"""{_W}, a AS (SELECT *, n = 1 AS lone, lag(n = 1) OVER w AS before, row_number() OVER w AS spot, count(*) OVER (PARTITION BY source, sheet) AS total
          FROM rowfacts WHERE n > 0 WINDOW w AS (PARTITION BY source, sheet ORDER BY row_idx)),
      b AS (SELECT *, spot > total - 2 AS exempt, sum((NOT (lone AND coalesce(before, false) AND spot <= total - 1))::INT) OVER (PARTITION BY source, sheet ORDER BY row_idx) AS run FROM a),
      t AS (SELECT source, sheet, max(row_idx) AS row_idx, count(*) AS n_run, string_agg(firstv, ' ' ORDER BY row_idx) AS txt FROM b WHERE lone GROUP BY source, sheet, run),
      c AS (SELECT b.*, n_run, txt FROM b LEFT JOIN t ON t.source = b.source AND t.sheet = b.sheet AND t.row_idx = b.row_idx),
      d AS (SELECT *, last_value(CASE WHEN NOT exempt THEN txt END IGNORE NULLS) OVER (PARTITION BY source, sheet ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS prefix FROM c)
      SELECT source, sheet, row_idx, prefix, {sql_show("CASE WHEN n_run > 1 THEN list_transform(vals, lambda v, i: CASE WHEN i = 1 THEN txt END) ELSE vals END")} AS vals
      FROM d WHERE NOT lone OR (exempt AND txt IS NOT NULL)""",
)
def carry_label_soi(spark, sf_dir):
    out = st.carry_label_soi(drop_blank_rows(doc_grid(spark, sf_dir)))
    return out.withColumn("vals", show("vals"))


# ---- notes --------------------------------------------------------------

_NOTES = (
    _HTML_ROLES
    + """, pieces AS (SELECT source, sheet, role, row_idx, unnest(list_filter(vals, lambda x: x IS NOT NULL)) AS piece FROM roles WHERE role IN ('title', 'footer')),
  notes AS (SELECT source, sheet, string_agg(piece, '. ' ORDER BY row_idx) FILTER (role = 'title') AS header,
                   string_agg(piece, '. ' ORDER BY row_idx) FILTER (role = 'footer') AS footer FROM pieces GROUP BY 1, 2)"""
)


@query("notes_concat", f"{_W}{_NOTES} SELECT * FROM notes")
def notes_concat(spark, sf_dir):
    return st.notes_concat(st.classify_rows_html(doc_grid(spark, sf_dir)))


@query(
    "annotate",
    f"{_W}{_NOTES} SELECT 'a/b/' || source AS source, sheet, row_idx, header, footer, 'b/' || source AS file_name FROM roles LEFT JOIN notes USING (source, sheet) WHERE role = 'body'",
)
def annotate(spark, sf_dir):
    rows = doc_grid(spark, sf_dir).withColumn("source", F.concat(F.lit("a/b/"), "source"))
    roles = st.classify_rows_html(rows)
    return st.annotate(roles.filter("role = 'body'").drop("role", "vals"), st.notes_concat(roles))


@query(
    "footer_propagate",
    """WITH t AS (SELECT 'conversations' AS source, CAST(conv_id AS VARCHAR) AS sheet, turn AS table_id,
        CASE WHEN role <> 'assistant' THEN NULL WHEN length(text) % 5 = 0 THEN 'Footnotes at end of table.' ELSE string_split(text, ' ')[1] END AS own FROM conversations),
      v AS (SELECT *, CASE WHEN NOT contains(own, 'Footnotes at end of table') THEN own END AS valid FROM t)
      SELECT source, sheet, table_id, coalesce(valid, arg_max(valid, CASE WHEN valid IS NOT NULL THEN table_id END) OVER (PARTITION BY source, sheet)) AS footer,
        row_number() OVER (PARTITION BY source, sheet ORDER BY valid IS NULL, table_id) - 1 AS place FROM v""",
)
def footer_propagate(spark, sf_dir):
    footer = (
        F.when(F.col("role") != "assistant", F.lit(None).cast("string"))
        .when(F.length("text") % 5 == 0, "Footnotes at end of table.")
        .otherwise(F.split("text", " ")[0])
    )
    tables = table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("source"),
        F.col("conv_id").cast("string").alias("sheet"),
        F.col("turn").alias("table_id"),
        footer.alias("footer"),
    )
    return st.footer_propagate(tables)


# ---- sections -----------------------------------------------------------

_NOTE_TITLE = "Indicates type of service provided; this field applies only to special districts (records with type=4)."
_SECTION_LINES = (
    DOC_LINES
    + f""", lines AS (SELECT source, sheet, row_idx AS line_no, CASE length(value) % 9 WHEN 0 THEN 'Level Code Description'
        WHEN 1 THEN 'State Name Abbreviation State Code' WHEN 2 THEN '{_NOTE_TITLE}'
        WHEN 3 THEN regexp_replace(string_split(value, ' ')[1], '[^A-Za-z]', '', 'g') ELSE value END AS value FROM doc_lines)"""
)


def _section_lines(spark, sf_dir):
    value = F.col("value")
    kind = F.length(value) % 9
    text = (
        F.when(kind == 0, "Level Code Description")
        .when(kind == 1, "State Name Abbreviation State Code")
        .when(kind == 2, _NOTE_TITLE)
        .when(kind == 3, F.regexp_replace(F.split(value, " ")[0], "[^A-Za-z]", ""))
        .otherwise(value)
    )
    return doc_lines(spark, sf_dir).select("source", "sheet", F.col("row_idx").alias("line_no"), text.alias("value"))


_SECTIONS = (
    _SECTION_LINES
    + r""", m AS (SELECT *, (contains(value, 'Level Code Description') OR contains(value, 'State Name Abbreviation State Code') OR contains(value, 'Indicates type of service provided; this field applies only to special districts (records with type=4).')) AS title,
        regexp_matches(regexp_replace(replace(value, '3rd', ''), '[ –().,/"\-“”=]', '', 'g'), '^\p{L}+$') AND NOT starts_with(value, 'I ') AND NOT starts_with(value, 'R ')
          AND NOT regexp_matches(value, 'Analyst correction|Imputed|Unknown|Reported|Alternative source') AS closes FROM lines),
      s AS (SELECT *, last_value(CASE WHEN title THEN 'open' WHEN closes THEN 'closed' END IGNORE NULLS) OVER (PARTITION BY source, sheet ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS state,
        last_value(CASE WHEN title THEN 'open' WHEN closes THEN 'closed' END IGNORE NULLS) OVER (PARTITION BY source, sheet ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM m),
      g AS (SELECT *, title AND (closes OR coalesce(was, 'closed') = 'closed') AS starts FROM s),
      h AS (SELECT *, CAST(sum(starts::INT) OVER w AS BIGINT) AS section, last_value(CASE WHEN starts THEN value END IGNORE NULLS) OVER w AS heading,
        max(CASE WHEN closes THEN line_no END) OVER (PARTITION BY source, sheet) AS last_close FROM g WINDOW w AS (PARTITION BY source, sheet ORDER BY line_no ROWS UNBOUNDED PRECEDING)),
      k AS (SELECT *, list_filter(string_split(value, ' '), lambda t: t <> '') AS tok FROM h WHERE state = 'open' AND NOT starts),
      sections AS (SELECT source, sheet, section, line_no, last_close,
        CASE heading WHEN 'Level Code Description' THEN 'Level_of_estimate_code' WHEN 'State Name Abbreviation State Code' THEN 'State_code' ELSE 'Function_code_for_special_districts' END AS "Name",
        CASE WHEN heading = 'State Name Abbreviation State Code' THEN tok[-1] ELSE string_split(value, ' ')[1] END AS "Code",
        CASE WHEN heading = 'State Name Abbreviation State Code' THEN array_to_string(tok[1:len(tok) - 2], ' ')
             WHEN contains(value, ' ') THEN substr(value, strpos(value, ' ') + 1) END AS "Desription"
        FROM k WHERE heading IN ('Level Code Description', 'State Name Abbreviation State Code', 'Indicates type of service provided; this field applies only to special districts (records with type=4).'))"""
)
_SECTION_COLUMNS = 'SELECT source, sheet, section, line_no, "Name", "Code", "Desription" FROM sections'
_KEYS = ["source", "sheet"]


@query("section_extract", f"WITH {_SECTIONS} {_SECTION_COLUMNS}")
def section_extract(spark, sf_dir):
    return splits.section_extract(_section_lines(spark, sf_dir), keys=_KEYS)


@query("section_extract_closed", f"WITH {_SECTIONS} {_SECTION_COLUMNS} WHERE last_close > line_no")
def section_extract_closed(spark, sf_dir):
    """Only sections that a later line closes."""
    return splits.section_extract(_section_lines(spark, sf_dir), keys=_KEYS, flush_last=False)
