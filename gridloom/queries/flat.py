"""Files, names of files, payloads, unions and sinks."""

from pyspark.sql import functions as F

from gridloom import sinks
from gridloom.functions import text
from gridloom.operators import combine, quarantine as q, splits
from gridloom.queries.inputs import DOC_LINES, doc_lines, scratch, table
from gridloom.queries.registry import query
from gridloom.sources import files, payload

# ---- files and their names ----------------------------------------------


@query(
    "file_inventory",
    """SELECT 'source=' || source || '/lang=' || lang AS folder, CAST(sum(octet_length(encode(replace(text, chr(10), ' '))) + 1) AS BIGINT) AS bytes
      FROM documents GROUP BY 1""",
)
def file_inventory(spark, sf_dir):
    """Texts written as lines in a folder per source and language; the listing alone tells their sizes."""
    target = scratch(spark, "inventory")
    lines = table(spark, sf_dir, "documents").select("source", "lang", F.translate("text", "\n", " ").alias("value"))
    lines.write.partitionBy("source", "lang").text(target)
    found = files.file_inventory(spark, target, [".txt"])
    folder = F.regexp_extract("path", r"(source=[^/]*/lang=[^/]*)/[^/]*$", 1)
    return found.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"))


@query("inventory_suffixes", "SELECT url FROM pages WHERE url LIKE '%.html' OR url LIKE '%/'")
def inventory_suffixes(spark, sf_dir):
    return files.with_suffix(table(spark, sf_dir, "pages"), [".html", "/"], "url").select("url")


@query(
    "path_regex_filter",
    r"SELECT page_id, url FROM pages WHERE regexp_matches(url, '/(en|de)/[0-9]+$') OR regexp_matches(url, 'utm_source')",
)
def path_regex_filter(spark, sf_dir):
    found = files.path_regex_filter(table(spark, sf_dir, "pages"), "/(en|de)/[0-9]+$,utm_source", "url")
    return found.select("page_id", "url")


_BASE = "string_split(url, '/')[-1]"


@query(
    "name_exclude_filter",
    f"SELECT page_id, url FROM pages WHERE NOT (contains({_BASE}, '.html') OR contains({_BASE}, '#top') OR contains({_BASE}, '?'))",
)
def name_exclude_filter(spark, sf_dir):
    return files.name_exclude_filter(table(spark, sf_dir, "pages"), [".html", "#top", "?"], "url").select("page_id", "url")


@query(
    "path_segment_filter",
    """WITH s AS (SELECT page_id, url, TRY_CAST(string_split(url, '/')[5] AS INT) AS segment_value FROM pages)
      SELECT *, segment_value > 500 AS "keep" FROM s""",
)
def path_segment_filter(spark, sf_dir):
    return files.path_segment_filter(table(spark, sf_dir, "pages"), 4, 500, "url").select(
        "page_id", "url", "segment_value", "keep"
    )


@query("name_include_filter", "SELECT url FROM pages WHERE contains(url, 'blog') OR contains(url, 'spam')")
def name_include_filter(spark, sf_dir):
    return files.name_include_filter(table(spark, sf_dir, "pages"), ["blog", "spam"], "url").select("url")


def _documents_paths(spark, sf_dir):
    kind = F.when(F.col("p_size") % 3 == 0, "Tech Doc ").when(F.col("p_size") % 3 == 1, "Technical Documentation ").otherwise("Notes ")
    ending = F.when(F.col("p_size") % 2 == 0, ".pdf").otherwise(".txt")
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(kind, "p_name", ending).alias("path"))


@query(
    "layout_documents",
    """WITH p AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Tech Doc ' WHEN 1 THEN 'Technical Documentation ' ELSE 'Notes ' END
        || p_name || CASE WHEN p_size % 2 = 0 THEN '.pdf' ELSE '.txt' END AS path FROM part)
      SELECT * FROM p WHERE path LIKE '%.pdf' AND path LIKE '%Tech%' AND path NOT LIKE '%old%'""",
)
def layout_documents(spark, sf_dir):
    return files.layout_documents(_documents_paths(spark, sf_dir))


@query("text_lines", f"WITH {DOC_LINES} SELECT sheet, row_idx, value FROM doc_lines WHERE trim(value) <> ''")
def text_lines(spark, sf_dir):
    return files.drop_blank_lines(doc_lines(spark, sf_dir), "space").select("sheet", "row_idx", "value")


@query(
    "text_file_lines",
    f"""WITH {DOC_LINES} SELECT source, count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_chars, 0::BIGINT AS misnumbered
      FROM doc_lines WHERE value <> '' GROUP BY 1""",
)
def text_file_lines(spark, sf_dir):
    """Lines written as text files, in folders per source, and read back in splits.

    Numbers must run from 0 without a gap in every file, over all its splits.
    """
    target = scratch(spark, "text")
    lines = doc_lines(spark, sf_dir).filter(F.col("value") != "").select("source", "value")
    lines.write.partitionBy("source").text(target)
    read = files.text_lines(spark, target, "keep")
    per_file = read.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("value")).alias("chars"),
        F.count_distinct("line_no").alias("numbers"),
        F.max("line_no").alias("last"),
    )
    folder = F.regexp_extract("source", r"/source=([^/]+)/", 1)
    in_order = (F.col("last") + 1 == F.col("n")) & (F.col("numbers") == F.col("n"))
    return per_file.groupBy(folder.alias("source")).agg(
        F.sum("n").alias("n_lines"),
        F.sum("chars").alias("n_chars"),
        F.sum((~in_order).cast("int")).alias("misnumbered"),
    )


def _csv(spark, sf_dir):
    target = scratch(spark, "csv")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc id"), F.col("text").alias("full.text"), F.col("lang").alias("lang (iso)")
    )
    keep = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"}
    docs.write.option("header", "true").options(**keep).csv(target)
    return target


@query(
    "csv_scan",
    """SELECT CAST(doc_id AS VARCHAR) AS "doc_id", length(text) AS "n_chars", lang AS "lang__iso_" FROM documents""",
)
def csv_scan(spark, sf_dir):
    """Texts with line breaks and quotes survive; names are cleaned."""
    # The files were written with doubled quotes.
    found = files.csv_scan(spark, _csv(spark, sf_dir), escape='"')
    named = found.select(*[F.col(f"`{c}`").alias(_csv_name(c)) for c in found.columns])
    return named.select("doc_id", F.length("full_text").alias("n_chars"), "lang__iso_")


def _csv_name(name: str) -> str:
    return name.translate(str.maketrans({c: "_" for c in text.CSV_NAME_CHARACTERS}))


@query("csv_scan_infer", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def csv_scan_infer(spark, sf_dir):
    target = scratch(spark, "csv")
    sinks.csv_export(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), target)
    found = files.csv_scan(spark, target, infer=True, multi_line=False)
    return found.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))


@query(
    "table_scan",
    "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1",
)
def table_scan(spark, sf_dir):
    items = files.table_scan(spark, f"{sf_dir}/lineitem.parquet")
    recent = items.filter(F.col("l_shipdate") >= F.to_timestamp(F.lit("1997-01-01")))
    return recent.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query("manifest_urls", """SELECT trim(replace(' ' || html_title || url, ' ', '%20')) AS "URL" FROM
  (SELECT url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS html_title FROM pages)""")
def manifest_urls(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    manifest = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit(" "), title, "url").alias("Url"))
    return files.manifest_urls(manifest.select(F.col("page_id").cast("string"), "Url"))


# ---- payloads -----------------------------------------------------------


@query(
    "json_envelope",
    """SELECT event_id, i::INT AS record_idx, CASE i WHEN 0 THEN props->>'k' END AS k,
      CASE i WHEN 1 THEN event_type END AS "TypeName" FROM events, (SELECT unnest([0, 1]) AS i)""",
)
def json_envelope(spark, sf_dir):
    """Both envelope forms, two records each."""
    records = F.concat(F.lit("["), "props", F.lit(',{"TypeName":"'), "event_type", F.lit('"}]'))
    body = F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit('{"BEAAPI":{"Data":'), records, F.lit("}}"))
    ).otherwise(F.concat(F.lit('{"BEAAPI":{"Results":{"Data":'), records, F.lit("}}}")))
    return payload.json_envelope(table(spark, sf_dir, "events").select("event_id", body.alias("payload")))


@query(
    "payload_errors",
    """SELECT CAST(event_id AS VARCHAR) AS source, 'payload' AS stage, CASE event_id % 4 WHEN 0 THEN 'not JSON'
        WHEN 1 THEN 'no data envelope' WHEN 2 THEN 'records are no list of objects' END AS reason FROM events WHERE event_id % 4 < 3
      UNION ALL SELECT CAST(event_id AS VARCHAR), 'good', event_type FROM events WHERE event_id % 4 = 3""",
)
def payload_errors(spark, sf_dir):
    """Three kinds of broken payloads beside good ones; every payload comes out as records or as an error."""
    kind = F.col("event_id") % 4
    record = F.concat(F.lit('{"TypeName":"'), "event_type", F.lit('"}'))
    body = (
        F.when(kind == 0, F.concat(F.lit('{"BEAAPI":{"Data":['), record))
        .when(kind == 1, F.concat(F.lit('{"BEAAPI":{"Error":'), record, F.lit("}}")))
        .when(kind == 2, F.lit('{"BEAAPI":{"Data":"none"}}'))
        .otherwise(F.concat(F.lit('{"BEAAPI":{"Data":['), record, F.lit("]}}")))
    )
    checked = payload.checked_payloads(table(spark, sf_dir, "events").select(F.col("event_id").alias("source"), body.alias("payload")))
    records = payload.json_envelope(q.good(checked), fields=["TypeName"])
    read = records.select(F.col("source").cast("string").alias("source"), F.lit("good").alias("stage"), F.col("TypeName").alias("reason"))
    return q.quarantine(checked, "payload").unionByName(read)


@query("json_param_values", 'SELECT event_id, event_type || event_id AS "Indicator_Name" FROM events')
def json_param_values(spark, sf_dir):
    body = F.concat(
        F.lit('{"BEAAPI":{"Results":{"ParamValue":[{"Key":"'), "event_type", "event_id", F.lit('","Desc":"d"}]}}}')
    )
    events = table(spark, sf_dir, "events").select("event_id", body.alias("payload"))
    return payload.json_param_values(events, name="Indicator_Name")


_DATASETS = ["ITA", "IIP", "IntlServTrade", "IntlServSTA"]


def _requests(spark, sf_dir):
    keys = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    sharded = splits.equal_frequency_shard(keys, "c_custkey", 10)
    dataset = F.element_at(F.array(*[F.lit(d) for d in _DATASETS]), (F.col("c_custkey") % 4 + 1).cast("int"))
    shard = F.concat(F.lit("SHARD_"), F.col("shard").cast("string"))
    return payload.request_template(sharded, dataset, F.col("c_name"), shard)


_SQL_REQUESTS = """WITH p AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer),
  s AS (SELECT *, 'SHARD_' || CAST(greatest(0, ceil(10 * i / (n - 1)) - 1) AS INT) AS api_key FROM p),
  r AS (SELECT *, '?&UserID=' || api_key || CASE c_custkey % 4
     WHEN 0 THEN '&method=GetData&DataSetName=ITA&Indicator=' || c_name || '&AreaOrCountry=ALL&Frequency=A,QSA,QNSA&Year=ALL&ResultFormat=json'
     WHEN 1 THEN '&method=GetData&DataSetName=IIP&TypeOfInvestment=' || c_name || '&Component=ChgPos,ChgPosNie,ChgPosOth,ChgPosPrice,ChgPosTrans,ChgPosXRate,Pos&Frequency=A,QNSA&Year=ALL&ResultFormat=json'
     WHEN 2 THEN '&method=GetData&DataSetName=IntlServTrade&TypeOfService=' || c_name || '&TradeDirection=ALL&Affiliation=ALL&AreaOrCountry=ALL&Year=ALL&ResultFormat=json'
     ELSE '&method=GetData&DataSetName=IntlServSTA&Channel=ALL&Destination=ALL&Industry=' || c_name || '&AreaOrCountry=ALL&Year=ALL&ResultFormat=json' END AS relative_url FROM s)"""


@query(
    "request_template",
    _SQL_REQUESTS
    + " SELECT c_custkey, api_key, relative_url, 'https://apps.bea.gov/api/data/' || relative_url AS full_url FROM r",
)
def request_template(spark, sf_dir):
    return _requests(spark, sf_dir).select("c_custkey", "api_key", "relative_url", "full_url")


@query(
    "url_to_path",
    _SQL_REQUESTS
    + """ SELECT c_custkey, 'apps.bea.gov/api/' || d || '/' || replace(replace(relative_url, 'data', d), '?', '-') AS blob_path
      FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN 'ITA' WHEN 1 THEN 'IIP' WHEN 2 THEN 'IntlServTrade' ELSE 'IntlServSTA' END AS d FROM r)""",
)
def url_to_path(spark, sf_dir):
    return _requests(spark, sf_dir).select("c_custkey", "blob_path")


@query(
    "equal_frequency_shard",
    """SELECT o_orderkey, CAST(greatest(0, ceil(10 * i / (n - 1)) - 1) AS INT) AS shard FROM
      (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)""",
)
def equal_frequency_shard(spark, sf_dir):
    return splits.equal_frequency_shard(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 10)


@query("even_split", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) AS INT) AS chunk FROM orders")
def even_split(spark, sf_dir):
    return splits.even_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7)


# ---- paths and URLs -----------------------------------------------------


@query(
    "output_path",
    r"""SELECT page_id, replace(regexp_replace(regexp_replace(url, '^https://', ''), '\.[^.]*$', ''), ' ', '_') AS stem,
      CASE WHEN regexp_matches(string_split(url, '/')[-1], '^[0-9]+$') THEN replace(url, 'https://', '')
           ELSE replace(url, 'https://', '') || '/main' END AS page_path FROM pages""",
)
def output_path(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.output_path(url, "https://").alias("stem"), text.page_output_path(url).alias("page_path")
    )


@query(
    "dedupe_path_segments",
    """WITH s AS (SELECT page_id, unnest(string_split(url || '/' || string_split(url, '/')[3] || '/x/x', '/')) AS seg,
                         unnest(range(len(string_split(url, '/')) + 3)) AS i FROM pages),
      f AS (SELECT page_id, seg, min(i) AS i FROM s GROUP BY 1, 2)
      SELECT page_id, string_agg(seg, '/' ORDER BY i) AS path FROM f GROUP BY 1""",
)
def dedupe_path_segments(spark, sf_dir):
    url = F.concat_ws("/", "url", F.split("url", "/")[2], F.lit("x"), F.lit("x"))
    return table(spark, sf_dir, "pages").select("page_id", text.dedupe_path_segments(url).alias("path"))


@query(
    "caption_key",
    """WITH c AS (SELECT page_id, 'Table ' || page_id || '.' || (page_id % 9) || 'A – ' || regexp_extract(html, '<title>([^<]*)</title>', 1) AS caption FROM pages),
      h AS (SELECT *, trim(string_split(trim(caption), '–')[1]) AS head FROM c)
      SELECT page_id, translate(left(head, length(head) - 1), ' .', '__') AS key FROM h""",
)
def caption_key(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    key = F.col("page_id").cast("string")
    caption = F.concat(F.lit("Table "), key, F.lit("."), (F.col("page_id") % 9).cast("string"), F.lit("A – "), title)
    return table(spark, sf_dir, "pages").select("page_id", text.caption_key(caption).alias("key"))


@query(
    "scalar_functions",
    r"""SELECT doc_id, regexp_matches(w, '^\p{L}+$') AS alpha, regexp_matches(w, '^[0-9]+$') AS digits,
      CASE WHEN trim(w) NOT IN ('', 'nan') THEN w END AS normal, replace(replace(url_encode(w), '%2F', '/'), '%3A', ':') AS quoted
      FROM (SELECT doc_id, unnest(string_split(replace(text, chr(10), ' '), ' ')) AS w FROM documents)""",
)
def scalar_functions(spark, sf_dir):
    """Predicates and quoting over every word of every document."""
    words = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")).alias("w")
    )
    w = F.col("w")
    return words.select(
        "doc_id",
        text.is_alpha(w).alias("alpha"),
        text.is_digits(w).alias("digits"),
        text.null_normalise(w).alias("normal"),
        text.url_quote(w).alias("quoted"),
    )


# ---- distinct rows and unions -------------------------------------------


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def dedup_rows(spark, sf_dir):
    return combine.dedup_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query(
    "dedup_subset",
    """SELECT doc_id, text, source FROM (SELECT doc_id, text, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def dedup_subset(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return combine.dedup_subset(docs, ["text"], "doc_id")


@query(
    "distinct_folders",
    r"SELECT regexp_extract(url, '^(.*/)[^/]*$', 1) AS folder, min(page_id) AS first_seen FROM pages GROUP BY 1",
)
def distinct_folders(spark, sf_dir):
    return combine.distinct_folders(table(spark, sf_dir, "pages"), "url", "page_id")


@query(
    "union_by_name_merge",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS kind FROM customer
      UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
      UNION ALL SELECT p_partkey, p_name, NULL, p_type FROM part""",
)
def union_by_name_merge(spark, sf_dir):
    """Names differ in case, columns are missing on either side."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("BALANCE"), F.col("s_suppkey").alias("KEY"), F.col("s_name").alias("Name"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"))
    return combine.union_by_name_merge([c, s, p])


@query(
    "union_stored",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS kind FROM customer
      UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
      UNION ALL SELECT p_partkey, p_name, NULL, p_type FROM part""",
)
def union_stored(spark, sf_dir):
    """The same from stored tables, in one scan."""
    paths = []
    for name, columns in [
        ("customer", {"key": "c_custkey", "name": "c_name", "balance": "c_acctbal"}),
        ("supplier", {"BALANCE": "s_acctbal", "KEY": "s_suppkey", "Name": "s_name"}),
        ("part", {"key": "p_partkey", "name": "p_name", "kind": "p_type"}),
    ]:
        paths.append(scratch(spark, name))
        sinks.overwrite_table(table(spark, sf_dir, name).select(*[F.col(c).alias(n) for n, c in columns.items()]), paths[-1])
    return combine.union_stored(spark, paths)


@query(
    "union_positional",
    """SELECT CAST(c_custkey AS VARCHAR) AS "Code", c_name AS "Desription", 'Customer_code' AS "Name" FROM customer
      UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, 'Supplier_code' FROM supplier""",
)
def union_positional(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Customer_code"), F.col("c_name").alias("Description"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("Supplier_code"), F.col("s_name").alias("Description"))
    return combine.union_positional([c, s])


@query(
    "concat_by_name",
    """SELECT c_name AS api_url FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT p_name FROM part""",
)
def concat_by_name(spark, sf_dir):
    names = {"customer": "c_name", "supplier": "s_name", "part": "p_name"}
    return combine.concat_by_name([table(spark, sf_dir, t).select(F.col(c).alias("api_url")) for t, c in names.items()])


@query(
    "union_same_key",
    """WITH t AS (SELECT l_orderkey AS key_no, 'T' || l_orderkey AS key, l_linenumber AS table_id, CAST(min(l_quantity) AS INT) % 3 AS n_cols
                  FROM lineitem GROUP BY 1, 2, 3),
      f AS (SELECT *, first_value(n_cols) OVER w AS fc, row_number() OVER w - 1 AS spot FROM t WINDOW w AS (PARTITION BY key ORDER BY table_id))
      SELECT key, table_id, n_cols, CASE WHEN n_cols = fc THEN key ELSE key || '_' || (spot - 1) END AS output,
             CAST(CASE WHEN n_cols = fc THEN 2147483647 ELSE spot - 1 END AS INT) AS out_place FROM f""",
)
def union_same_key(spark, sf_dir):
    tables = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("key"), F.col("l_linenumber").alias("table_id"))
        .agg((F.min("l_quantity").cast("int") % 3).alias("n_cols"))
    )
    return combine.union_same_key(tables)


@query(
    "route_outputs",
    """WITH t AS (SELECT p_partkey AS table_id, p_type AS folder, CASE WHEN p_size % 2 = 0 THEN 'NSDUHDetTabsSect' || p_size ELSE 'NSDUHDetTabsApp' || p_size END || '.htm' AS source,
                  CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand END AS key FROM part),
      g AS (SELECT *, CASE WHEN contains(source, 'NSDUHDetTabsSect') THEN 'NSDUHDetTabsSect' ELSE 'NSDUHDetTabsApp' END AS output_group FROM t)
      SELECT table_id, folder, source, output_group, CASE WHEN key = '' THEN 'index_' ||
        CAST(sum(CASE WHEN key = '' THEN 1 ELSE 0 END) OVER (PARTITION BY folder, output_group ORDER BY table_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
        ELSE key END AS table_name FROM g""",
)
def route_outputs(spark, sf_dir):
    size = F.col("p_size")
    name = F.when(size % 2 == 0, "NSDUHDetTabsSect").otherwise("NSDUHDetTabsApp")
    tables = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("table_id"),
        F.col("p_type").alias("folder"),
        F.concat(name, size.cast("string"), F.lit(".htm")).alias("source"),
        F.when(size % 5 == 0, "").otherwise(F.col("p_brand")).alias("key"),
    )
    return combine.route_outputs(tables).drop("key")


# ---- bad records --------------------------------------------------------


def _checked(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("first", F.split("text", " ")[0])
    rules = {
        "first word is a number": F.col("first").try_cast("int").isNull(),
        "text is long enough": F.col("n_chars") >= 100,
        "ends with a full stop": F.col("text").endswith("."),
    }
    return q.check(docs, rules)


_SQL_CHECKED = """WITH c AS (SELECT *, CASE
    WHEN TRY_CAST(string_split(text, ' ')[1] AS INT) IS NOT NULL THEN 'first word is a number'
    WHEN NOT n_chars >= 100 THEN 'text is long enough'
    WHEN NOT ends_with(text, '.') THEN 'ends with a full stop' END AS reason FROM documents)"""


@query("quarantine", _SQL_CHECKED + " SELECT source, 'documents' AS stage, reason FROM c WHERE reason IS NOT NULL")
def quarantine(spark, sf_dir):
    return q.quarantine(_checked(spark, sf_dir), "documents")


@query("quarantine_good", _SQL_CHECKED + " SELECT doc_id, source FROM c WHERE reason IS NULL")
def quarantine_good(spark, sf_dir):
    return q.good(_checked(spark, sf_dir)).select("doc_id", "source")


@query(
    "quarantine_units",
    _SQL_CHECKED + " SELECT source, 'documents' AS stage, min(reason) AS reason, count(*) AS n_rows FROM c WHERE reason IS NOT NULL GROUP BY 1",
)
def quarantine_units(spark, sf_dir):
    return q.quarantine_units(_checked(spark, sf_dir), "documents")


@query("error_log", _SQL_CHECKED + " SELECT source, 'documents' AS stage, reason FROM c WHERE reason IS NOT NULL")
def error_log(spark, sf_dir):
    target = scratch(spark, "errors")
    sinks.error_log(q.quarantine(_checked(spark, sf_dir), "documents"), target)
    return files.csv_scan(spark, target)


@query(
    "quarantine_tee",
    _SQL_CHECKED
    + """ SELECT doc_id, source, reason, sum((reason IS NULL)::INT) OVER ()::BIGINT AS n_good, sum((reason IS NOT NULL)::INT) OVER ()::BIGINT AS n_bad
      FROM (SELECT CASE WHEN reason IS NULL THEN doc_id END AS doc_id, source, reason FROM c)""",
)
def quarantine_tee(spark, sf_dir):
    """Good documents and the log of bad ones, written in one pass and read again."""
    table_path, log_path = scratch(spark, "good"), scratch(spark, "log")
    n_good, n_bad = sinks.write_outcomes(_checked(spark, sf_dir), "documents", table_path, log_path)
    kept = files.table_scan(spark, table_path).select("doc_id", "source", F.lit(None).cast("string").alias("reason"))
    log = files.csv_scan(spark, log_path).select(F.lit(None).cast("long").alias("doc_id"), "source", "reason")
    return kept.unionAll(log).withColumns({"n_good": F.lit(n_good).cast("long"), "n_bad": F.lit(n_bad).cast("long")})


# ---- sinks --------------------------------------------------------------


@query("overwrite_table", "SELECT s_suppkey, s_acctbal FROM supplier")
def overwrite_table(spark, sf_dir):
    """The second write replaces rows and schema of the first."""
    target = scratch(spark, "table")
    suppliers = table(spark, sf_dir, "supplier")
    sinks.overwrite_table(suppliers.select("s_suppkey", "s_name"), target)
    sinks.overwrite_table(suppliers.select("s_suppkey", "s_acctbal"), target)
    return files.table_scan(spark, target)


@query(
    "append_merge_schema",
    """SELECT c_custkey AS key, c_name AS name, NULL::DOUBLE AS balance FROM customer
      UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def append_merge_schema(spark, sf_dir):
    target = scratch(spark, "append")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    sinks.append_merge_schema(c, target)
    sinks.append_merge_schema(s, target)
    return files.table_scan(spark, target, merge_schema=True)


@query("csv_export", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, (SELECT 1::BIGINT) AS n_files FROM nation")
def csv_export(spark, sf_dir):
    target = scratch(spark, "export")
    sinks.csv_export(table(spark, sf_dir, "nation"), target, single=True)
    n_files = files.file_inventory(spark, target, [".csv"]).count()
    return files.csv_scan(spark, target).select("n_nationkey", "n_name", F.lit(n_files).cast("long").alias("n_files"))


@query("single_file_write", "SELECT c_custkey, 1::BIGINT AS n_files FROM customer")
def single_file_write(spark, sf_dir):
    target = scratch(spark, "single")
    sinks.single_file_write(table(spark, sf_dir, "customer").select("c_custkey"), target)
    n_files = files.file_inventory(spark, target, [".parquet"]).count()
    return files.table_scan(spark, target).withColumn("n_files", F.lit(n_files).cast("long"))


@query(
    "register_table",
    """SELECT 'soi_tax_stats_' || replace('21in.' || r_name, '.', '_') AS table_name, r_regionkey FROM region""",
)
def register_table(spark, sf_dir):
    path = F.concat(F.lit("bronze/21in."), "r_name", F.lit("/"))
    sinks.register_table(spark, f"{sf_dir}/region.parquet", "gridloom_registered")
    return spark.table("gridloom_registered").select(sinks.table_name(path).alias("table_name"), "r_regionkey")


@query(
    "route_write",
    "SELECT p_partkey, p_type AS output_group, p_brand AS table_name FROM part",
)
def route_write(spark, sf_dir):
    target = scratch(spark, "routed")
    parts = table(spark, sf_dir, "part")
    sinks.route_write(parts.select("p_partkey", F.col("p_type").alias("output_group"), F.col("p_brand").alias("table_name")), target)
    return files.table_scan(spark, target)


@query(
    "view_paths",
    """SELECT page_id, regexp_replace(url, '/?[^/]*$', '') || '/' || string_split(string_split(url, '/')[-1], '.')[1] || '_first_view' AS first_view,
      regexp_replace(url, '/?[^/]*$', '') || '/' || string_split(string_split(url, '/')[-1], '.')[1] || '_second_view' AS second_view FROM pages""",
)
def view_paths(spark, sf_dir):
    first, second = sinks.view_paths(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", first.alias("first_view"), second.alias("second_view"))


@query("column_select_rename", "SELECT c_custkey AS key, c_name AS name FROM customer")
def column_select_rename(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").drop("c_acctbal", "c_nationkey", "c_mktsegment")
    return customers.withColumnRenamed("c_custkey", "key").withColumnRenamed("c_name", "name")
