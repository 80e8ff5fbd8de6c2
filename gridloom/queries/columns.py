"""Column names: names come from the words and lines of ``documents`` and ``part``."""

from pyspark.sql import functions as F

from gridloom.operators import naming, structure
from gridloom.queries.inputs import PART_CELLS, part_rows, table
from gridloom.queries.registry import query

# Headings: the sentences of a line are the cells of a heading row.
_RAW = """raw AS (
  SELECT source, CAST(doc_id AS VARCHAR) || ':' || ln AS sheet, CAST(i - 1 AS INT) AS col_idx,
         CASE WHEN length(h) % 7 = 0 THEN NULL WHEN length(h) % 5 = 0 THEN ' ' || length(h) || '.0 ' ELSE h END AS raw
  FROM (SELECT source, doc_id, ln, unnest(hs) AS h, unnest(range(1, len(hs) + 1)) AS i
        FROM (SELECT source, doc_id, ln, string_split(l, '. ') AS hs
              FROM (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS l,
                           unnest(range(len(string_split(text, chr(10))))) AS ln FROM documents))))"""


def _raw(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "l"))
    cells = lines.select(
        "source",
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("ln").cast("string")).alias("sheet"),
        F.posexplode(F.split("l", r"\. ")).alias("col_idx", "h"),
    )
    n = F.length("h")
    raw = (
        F.when(n % 7 == 0, F.lit(None).cast("string"))
        .when(n % 5 == 0, F.concat(F.lit(" "), n.cast("string"), F.lit(".0 ")))
        .otherwise(F.col("h"))
    )
    return cells.select("source", "sheet", "col_idx", raw.alias("raw"))


def _names(rule: str) -> str:
    return f"WITH {_RAW} SELECT source, sheet, col_idx, raw, {rule} AS name FROM raw"


_EXCEL = "regexp_replace(replace(trim(raw), '.0', ''), '[^a-zA-Z0-9]', '_', 'g')"
_POSITION = "'col_' || col_idx"


@query("clean_name_excel", _names(f"coalesce({_EXCEL}, {_POSITION})"))
def clean_name_excel(spark, sf_dir):
    return naming.clean_names(_raw(spark, sf_dir), "excel")


@query("clean_name_html", _names(f"coalesce(trim({_EXCEL}, '_'), {_POSITION})"))
def clean_name_html(spark, sf_dir):
    return naming.clean_names(_raw(spark, sf_dir), "html")


@query(
    "clean_name_dl",
    _names(f"CASE WHEN length(trim(raw)) > 1 THEN regexp_replace(replace(trim(raw), '.0', ''), '[^a-zA-Z0-9%#]', '_', 'g') ELSE {_POSITION} END"),
)
def clean_name_dl(spark, sf_dir):
    return naming.clean_names(_raw(spark, sf_dir), "dl")


@query("clean_name_text", _names("CASE WHEN raw <> '' THEN regexp_replace(trim(raw), '[^A-Za-z0-9]+', '_', 'g') END"))
def clean_name_text(spark, sf_dir):
    return naming.clean_names(_raw(spark, sf_dir), "text")


@query("clean_name_csv", _names("translate(raw, ' .()', '____')"))
def clean_name_csv(spark, sf_dir):
    return naming.clean_names(_raw(spark, sf_dir), "csv")


@query("clean_name_layout", _names("translate(raw, ' ,;{}()=' || chr(10) || chr(9), '__________')"))
def clean_name_layout(spark, sf_dir):
    return naming.clean_names(_raw(spark, sf_dir), "layout")


@query("positional_names", _names(_POSITION))
def positional_names(spark, sf_dir):
    return naming.positional_names(_raw(spark, sf_dir))


# Names for repeats: brands of a type as one heading, in key order; some carry a suffix already.
_BRANDS = """brands AS (
  SELECT 'part' AS source, 'lot' || (p_partkey // 40) AS sheet, CAST(p_partkey % 40 AS INT) AS col_idx,
         CASE WHEN p_size % 9 = 0 THEN lower(p_type) || '_2' WHEN p_size % 9 = 1 THEN lower(p_type) ELSE p_type END AS name FROM part)"""


def _brands(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    name = (
        F.when(size % 9 == 0, F.concat(F.lower("p_type"), F.lit("_2")))
        .when(size % 9 == 1, F.lower("p_type"))
        .otherwise(F.col("p_type"))
    )
    return table(spark, sf_dir, "part").select(
        F.lit("part").alias("source"),
        F.concat(F.lit("lot"), F.floor(k / 40).cast("string")).alias("sheet"),
        (k % 40).cast("int").alias("col_idx"),
        name.alias("name"),
    )


# One name after the other, with all names before it at hand.
_PICK = """CASE WHEN NOT list_contains(w.taken, lower(r.name)) THEN r.name ELSE r.name || '_' ||
  list_filter(range(greatest(r.use, 2), r.use + len(w.taken) + 3), lambda k: NOT list_contains(w.taken, lower(r.name || '_' || k)))[1] END"""
_DEDUPE = f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY source, sheet ORDER BY col_idx) AS place,
    row_number() OVER (PARTITION BY source, sheet, lower(name) ORDER BY col_idx) AS use FROM brands),
  walk AS (SELECT DISTINCT source, sheet, CAST(0 AS BIGINT) AS place, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS INT) AS col_idx, CAST(NULL AS VARCHAR) AS name FROM brands
    UNION ALL SELECT r.source, r.sheet, r.place, list_append(w.taken, lower({_PICK})), r.col_idx, {_PICK}
      FROM walk w JOIN ranked r ON r.source = w.source AND r.sheet = w.sheet AND r.place = w.place + 1),
  p3 AS (SELECT source, sheet, col_idx, name FROM walk WHERE place > 0)"""


@query("dedupe_names", f"WITH RECURSIVE {_BRANDS}{_DEDUPE} SELECT * FROM p3")
def dedupe_names(spark, sf_dir):
    return naming.dedupe_names(_brands(spark, sf_dir))


@query(
    "truncate_names",
    f"""WITH RECURSIVE {_RAW}, brands AS (SELECT source, sheet, col_idx, left(coalesce(raw, 'col_' || col_idx), 40) AS name FROM raw){_DEDUPE}
      SELECT * FROM p3""",
)
def truncate_names(spark, sf_dir):
    named = _raw(spark, sf_dir).select(
        "source", "sheet", "col_idx", F.coalesce("raw", F.concat(F.lit("col_"), F.col("col_idx").cast("string"))).alias("name")
    )
    return naming.truncate_names(named, 40)


@query(
    "numeric_header_guard",
    f"""WITH {_RAW}, n AS (SELECT source, sheet, col_idx, regexp_replace(trim(coalesce(raw, '')), '[^A-Za-z0-9]+', '_', 'g') AS nm0 FROM raw),
      m AS (SELECT *, CASE WHEN col_idx % 3 = 1 THEN left(nm0, 2) ELSE nm0 END AS nm FROM n),
      g AS (SELECT *, bool_or(regexp_matches(nm, '^[0-9]+$')) OVER (PARTITION BY source, sheet) AS header_is_data FROM m)
      SELECT source, sheet, col_idx, header_is_data, CASE WHEN header_is_data THEN 'col_' || (col_idx + 1) ELSE nm END AS name FROM g""",
)
def numeric_header_guard(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    cleaned = F.regexp_replace(F.trim(F.coalesce("raw", F.lit(""))), "[^A-Za-z0-9]+", "_")
    named = raw.select(
        "source", "sheet", "col_idx", F.when(F.col("col_idx") % 3 == 1, F.left(cleaned, F.lit(2))).otherwise(cleaned).alias("name")
    )
    return naming.numeric_header_guard(named)


@query(
    "dl_header_guard",
    f"""WITH {_RAW}, r AS (SELECT source, sheet, col_idx, CASE WHEN col_idx % 4 = 3 THEN raw ELSE string_split(coalesce(raw, '='), ' ')[1] END AS raw FROM raw),
      b AS (SELECT *, regexp_replace(trim(raw), '[^a-zA-Z0-9=()-]', '', 'g') AS bare FROM r),
      v AS (SELECT source, sheet,
        bool_or(coalesce(regexp_matches(bare, '^[A-Za-z]+$'), false)) AND bool_or(coalesce(contains(bare, '='), false)) AS a,
        coalesce(bool_and(bare IS NOT NULL AND NOT regexp_matches(bare, '^[A-Za-z]+$')) FILTER (col_idx > 0), true)
          AND NOT coalesce(bool_or(contains(bare, '-') OR contains(bare, '(')) FILTER (col_idx > 0), false)
          AND NOT bool_or(col_idx = 0 AND bare IS NOT NULL AND bare = '') AS b,
        bool_or(coalesce(contains(bare, 'Sheet'), false)) AS c FROM b GROUP BY 1, 2)
      SELECT r.source, r.sheet, r.col_idx, r.raw, v.a OR v.b OR v.c AS keep_positional FROM r JOIN v USING (source, sheet)""",
)
def dl_header_guard(spark, sf_dir):
    first_word = F.split(F.coalesce("raw", F.lit("=")), " ")[0]
    raw = _raw(spark, sf_dir).withColumn("raw", F.when(F.col("col_idx") % 4 == 3, F.col("raw")).otherwise(first_word))
    return naming.dl_header_guard(raw)


@query(
    "first_row_names",
    f"""WITH {PART_CELLS}, f AS (SELECT source, sheet, arg_min(vals, row_idx) AS fv FROM part_rows GROUP BY 1, 2)
      SELECT source, sheet, col_idx, coalesce(regexp_replace(replace(trim(v), '.0', ''), '[^a-zA-Z0-9]', '_', 'g'), 'col_' || col_idx) AS name
      FROM (SELECT source, sheet, unnest(range(8))::INT AS col_idx, unnest(fv) AS v FROM f)""",
)
def first_row_names(spark, sf_dir):
    names = structure.first_row_names(part_rows(spark, sf_dir))
    return naming.clean_names(names, "excel").drop("raw")
