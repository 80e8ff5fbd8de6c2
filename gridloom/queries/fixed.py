"""Fixed-width text and code lists, over the lines made from ``orders``."""

from pyspark.sql import functions as F

from gridloom.operators import fixed_width as fw
from gridloom.queries.inputs import (
    ORDER_LINES,
    ORDER_SLICES,
    SQL_CODEBOOK,
    codebook,
    order_lines,
    scratch,
    table,
)
from gridloom.queries.registry import query
from gridloom.sinks import two_view_write
from gridloom.sources import files

_SLICED = """sliced AS (
  SELECT source, line_no, substr(value, 1, 1) AS status, substr(value, 2, 1) AS priority,
         substr(value, 3, 9) AS customer, substr(value, 12, 12) AS cents, substr(value, 22, 10) AS tail
  FROM order_lines)"""


@query("fixed_width_slice", f"WITH {ORDER_LINES}, {_SLICED} SELECT * FROM sliced")
def fixed_width_slice(spark, sf_dir):
    return fw.fixed_width_slice(order_lines(spark, sf_dir), ORDER_SLICES)


@query(
    "conditional_extra_slices",
    f"""WITH {ORDER_LINES} SELECT source, line_no, value,
      CASE WHEN source LIKE '%Fin_PID%' OR source LIKE '%modp_pu%' THEN substr(value, 1, 2) END AS "State_code",
      CASE WHEN source LIKE '%Fin_PID%' OR source LIKE '%modp_pu%' THEN substr(value, 3, 1) END AS "Type_code"
      FROM order_lines""",
)
def conditional_extra_slices(spark, sf_dir):
    return fw.conditional_extra_slices(order_lines(spark, sf_dir))


def _layout(spark, sf_dir):
    """A layout row per line item: fields named by flag, positions from line number and quantity."""
    items = table(spark, sf_dir, "lineitem")
    start, length = F.col("l_linenumber"), F.col("l_quantity").cast("int")
    return items.select(
        F.concat_ws(" ", F.lit("field of"), "l_returnflag", "l_linestatus").alias("Description"),
        F.concat_ws("-", start.cast("string"), (start + length - 1).cast("string")).alias("Positions"),
        length.cast("string").alias("Length"),
    )


@query(
    "layout_positions",
    """SELECT DISTINCT replace('field of ' || l_returnflag || ' ' || l_linestatus, ' ', '_') AS "Description",
      CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_linenumber + CAST(l_quantity AS INT) - 1 AS VARCHAR) AS "Positions",
      CAST(CAST(l_quantity AS INT) AS VARCHAR) AS "Length", CAST(l_linenumber AS VARCHAR) AS "START" FROM lineitem""",
)
def layout_positions(spark, sf_dir):
    return fw.layout_positions(_layout(spark, sf_dir))


@query(
    "layout_range",
    """WITH l AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3
        WHEN 0 THEN CAST(l_partkey AS VARCHAR)
        WHEN 1 THEN CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
        ELSE l_returnflag || '-' || CAST(l_partkey AS VARCHAR) END AS "Location" FROM lineitem),
      p AS (SELECT *, TRY_CAST(string_split("Location", '-')[1] AS INT) AS "start",
                      TRY_CAST(string_split("Location", '-')[-1] AS INT) AS "end" FROM l)
      SELECT l_orderkey, l_linenumber, "Location", "start", "end", "end" - "start" + 1 AS length
      FROM p WHERE "end" - "start" + 1 IS NOT NULL""",
)
def layout_range(spark, sf_dir):
    part = F.col("l_partkey").cast("string")
    location = (
        F.when(F.col("l_linenumber") % 3 == 0, part)
        .when(F.col("l_linenumber") % 3 == 1, F.concat_ws("-", F.col("l_linenumber").cast("string"), part))
        .otherwise(F.concat_ws("-", "l_returnflag", part))
    )
    return fw.layout_range(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", location.alias("Location"))
    )


_DECODED = f"""WITH {ORDER_LINES}, {_SLICED}, {SQL_CODEBOOK}
  SELECT s.source, s.line_no,
    CASE WHEN a.Code IS NOT NULL THEN a.Label ELSE s.status END AS status,
    CASE WHEN b.Code IS NOT NULL THEN b.Label ELSE s.priority END AS priority,
    s.customer, s.cents, s.tail
  FROM sliced s
  LEFT JOIN lastcodes a ON a.Name = 'status' AND a.Code = s.status
  LEFT JOIN lastcodes b ON b.Name = 'priority' AND b.Code = s.priority"""


def decoded_orders(spark, sf_dir):
    first = fw.fixed_width_slice(order_lines(spark, sf_dir), ORDER_SLICES)
    codes = codebook(spark)
    return fw.codebook_decode(first, codes, fw.coded_columns(first, codes))


@query("codebook_decode", _DECODED)
def codebook_decode(spark, sf_dir):
    return decoded_orders(spark, sf_dir)


@query(
    "codebook_lookup",
    f"""WITH {ORDER_LINES}, {_SLICED}, {SQL_CODEBOOK}
      SELECT s.priority, a.Label AS label, a.Code IS NOT NULL AS matched, count(*) AS n
      FROM sliced s LEFT JOIN lastcodes a ON a.Name = 'priority' AND a.Code = s.priority GROUP BY 1, 2, 3""",
)
def codebook_lookup(spark, sf_dir):
    sliced = fw.fixed_width_slice(order_lines(spark, sf_dir), ORDER_SLICES)
    found = fw.codebook_lookup(sliced, codebook(spark), "priority")
    return found.groupBy("priority", "label", "matched").agg(F.count(F.lit(1)).alias("n"))


@query(
    "layout_for_file",
    """WITH files AS (SELECT p_partkey, 'wild/' || p_type || '/' || replace(p_name, ' ', '_') || '.txt' AS source FROM part),
      listed AS (SELECT upper(replace(p_name, ' ', '_') || '.txt') AS name, CAST(p_size % 4 AS VARCHAR) AS decade,
                        row_number() OVER (PARTITION BY upper(replace(p_name, ' ', '_')) ORDER BY p_partkey) AS rn
                 FROM part WHERE p_name NOT LIKE 'hot%'),
      layout AS (SELECT DISTINCT CAST(s_nationkey % 3 AS VARCHAR) AS decade, s_nationkey || '-' || (s_nationkey + 4) AS "Location", 'n' || s_nationkey AS "Data" FROM supplier)
      SELECT f.p_partkey, f.source, l.decade, y."Location", y."Data" FROM files f
      JOIN listed l ON l.rn = 1 AND l.name = upper(string_split(f.source, '/')[-1]) JOIN layout y ON y.decade = l.decade""",
)
def layout_for_file(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit(".txt"))
    data_files = part.select("p_partkey", F.concat_ws("/", F.lit("wild"), "p_type", name).alias("source"))
    file_list = part.filter(~F.col("p_name").startswith("hot")).select(
        F.upper(name).alias("File Name"),
        (F.col("p_size") % 4).cast("string").alias("use_layout_decade"),
        F.col("p_partkey").alias("row_idx"),
    )
    key = F.col("s_nationkey")
    layout = table(spark, sf_dir, "supplier").select(
        (key % 3).cast("string").alias("decade"),
        F.concat_ws("-", key.cast("string"), (key + 4).cast("string")).alias("Location"),
        F.concat(F.lit("n"), key.cast("string")).alias("Data"),
    )
    return fw.layout_for_file(data_files, file_list, layout).select("p_partkey", "source", "decade", "Location", "Data")


@query("two_view_write", _DECODED)
def two_views(spark, sf_dir):
    """Both views written from one read of the text; the second is the result."""
    first = fw.fixed_width_slice(order_lines(spark, sf_dir), ORDER_SLICES)
    codes = codebook(spark)
    target = scratch(spark, "views")
    columns = fw.coded_columns(first, codes)
    two_view_write(first, lambda df: fw.codebook_decode(df, codes, columns), f"{target}/first", f"{target}/second")
    return spark.read.parquet(f"{target}/second")


@query(
    "layout_names",
    """SELECT c_custkey AS "cust_key__id_", c_name AS "name_a__b_", c_acctbal AS "x_y_z" FROM customer""",
)
def layout_names(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return fw.layout_names(
        customers.select(
            F.col("c_custkey").alias("cust key (id)"), F.col("c_name").alias("name{a,;b}"), F.col("c_acctbal").alias("x=y\tz")
        )
    )


@query(
    "manifest_batch",
    """WITH m AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2),
      l AS (SELECT 'bronze/' || source || '.txt' AS data_path, lang,
                   unnest(string_split(text, chr(10))) AS value FROM documents)
      SELECT l.data_path, 'layouts/' || l.lang || '/' AS layout_path, 'codes/' || l.lang || '.csv' AS code_path,
             count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_chars
      FROM l JOIN m ON 'bronze/' || m.source || '.txt' = l.data_path AND m.lang = l.lang
      WHERE l.value <> '' GROUP BY 1, 2, 3""",
)
def manifest_batch(spark, sf_dir):
    """Lines of all data files of a manifest, read in one scan, each beside its entry."""
    target = scratch(spark, "batch")
    docs = table(spark, sf_dir, "documents")
    docs.select("source", "lang", F.col("text").alias("value")).write.partitionBy("source", "lang").text(target)
    found = files.file_inventory(spark, target, [".txt"])
    part = lambda name: F.regexp_extract("path", rf"/{name}=([^/]*)/", 1)
    manifest = files.manifest_triples(
        found.select(
            F.col("path").alias("file"),
            F.concat(F.lit("layouts/"), part("lang"), F.lit(".pdf")).alias("layout"),
            F.concat(F.lit("codes/"), part("lang"), F.lit(".csv")).alias("codes"),
        )
    )
    lines = files.manifest_batch(spark, manifest)
    data = F.concat(F.lit("bronze/"), F.regexp_extract("data_path", "/source=([^/]*)/", 1), F.lit(".txt"))
    return lines.groupBy(data.alias("data_path"), "layout_path", "code_path").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("value")).alias("n_chars")
    )


_ENTRIES = """m AS (SELECT DISTINCT '/bronze/' || p_brand || '.txt' AS data_path, '/layouts/' || p_brand || '/' AS layout_path,
  '/codes/' || (p_size % 10) || '.csv' AS code_path FROM part)"""


@query(
    "manifest_join",
    f"""WITH {_ENTRIES}
      SELECT 'layout' AS role, 's3:' || layout_path || 'p' || p_partkey || '.csv' AS source, data_path, code_path
        FROM part JOIN m ON layout_path = '/layouts/' || p_brand || '/'
      UNION ALL SELECT 'code', code_path, data_path, code_path FROM (SELECT DISTINCT '/codes/' || s_suppkey % 12 || '.csv' AS c FROM supplier) JOIN m ON c = code_path
      UNION ALL SELECT 'data', data_path, data_path, code_path FROM (SELECT DISTINCT '/bronze/' || p_brand || '.txt' AS d FROM part) JOIN m ON d = data_path""",
)
def manifest_join(spark, sf_dir):
    """The three roles of a file in a manifest; a layout folder covers the files directly inside."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    text = lambda *c: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in c])
    brand = F.col("p_brand")
    manifest = files.manifest_triples(
        part.select(
            text("/bronze/", brand, ".txt").alias("file"),
            text("/layouts/", brand, ".pdf").alias("layout"),
            text("/codes/", (F.col("p_size") % 10).cast("string"), ".csv").alias("codes"),
        ).distinct()
    )
    scanned = {
        "layout": part.select(text("s3:/layouts/", brand, "/p", F.col("p_partkey").cast("string"), ".csv").alias("source")),
        "code": supplier.select(text("/codes/", (F.col("s_suppkey") % 12).cast("string"), ".csv").alias("source")).distinct(),
        "data": part.select(text("/bronze/", brand, ".txt").alias("source")).distinct(),
    }
    found = [
        files.manifest_join(rows, manifest, role).select(F.lit(role).alias("role"), "source", "data_path", "code_path")
        for role, rows in scanned.items()
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])
