"""Links of the stored pages, listings and the closure of a tree."""

from pyspark.sql import functions as F

from gridloom.operators import links
from gridloom.queries.inputs import table
from gridloom.queries.registry import query

_QUOTE = "replace(replace(url_encode({0}), '%2F', '/'), '%3A', ':')"
# Beside the anchors the pages have: other case, single quotes, none, references, a ">" in a title, no address.
_LINKS = f"""l AS (SELECT url, CAST(unnest(range(len(hs))) AS INT) AS spot, unnest(hs) AS href
  FROM (SELECT url, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) || ['/b/' || page_id || '.csv?x=1&y=é', '/c/' || page_id, '/a' || page_id || 'e', 'f&' || page_id || '.zip'] AS hs FROM pages))"""


def _pages(spark, sf_dir):
    key = F.col("page_id").cast("string")
    more = [
        ('<A HREF = "/b/', '.csv?x=1&amp;y=&#xe9;">B</A>'),
        ("<a class=k data-href='no' href='/c/", "'>C</a><a name=\"here\">D</a>"),
        ('<a title="a > b" href=/a', "e>E</a>"),
        ('<a\nhref="f&#38;', '.zip"\n>F</a>'),
    ]
    html = F.concat("html", *[x for before, after in more for x in (F.lit(before), key, F.lit(after))])
    return table(spark, sf_dir, "pages").withColumn("html", html)


@query("page_links", f"WITH {_LINKS} SELECT url, spot, {_QUOTE.format('href')} AS link FROM l")
def page_links(spark, sf_dir):
    return links.page_links(_pages(spark, sf_dir)).withColumnRenamed("at", "spot")


@query(
    "page_links_filtered",
    f"WITH {_LINKS} SELECT url, spot, {_QUOTE.format('href')} AS link FROM l WHERE regexp_matches(href, '^/[a-m]') OR regexp_matches(href, 'e$')",
)
def page_links_filtered(spark, sf_dir):
    found = links.page_links(_pages(spark, sf_dir), ["^/[a-m]", "e$"])
    return found.withColumnRenamed("at", "spot")


_ROOT = "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
_FULL = "CASE WHEN NOT contains({0}, '/') THEN regexp_extract(url, '^(.*)/[^/]*$', 1) || '/' || {0} ELSE {0} END"
_ABSOLUTE = f"CASE WHEN starts_with({_FULL}, 'https://') THEN {_FULL} ELSE {_ROOT} || {_FULL} END"


@query(
    "absolute_url",
    f"WITH {_LINKS}, b AS (SELECT url, spot, CASE WHEN spot % 2 = 0 THEN ltrim(href, '/') ELSE href END AS b FROM l) SELECT url, spot, {_ABSOLUTE.format('b')} AS link FROM b",
)
def absolute_url(spark, sf_dir):
    """Every other link made a bare file name."""
    found = _pages(spark, sf_dir).select("url", F.posexplode(links.anchors(F.col("html"))).alias("spot", "href"))
    bare = F.when(F.col("spot") % 2 == 0, F.regexp_replace("href", "^/+", "")).otherwise(F.col("href"))
    return found.select("url", "spot", links.absolute_url(bare, F.col("url")).alias("link"))


# A small web: every page links to the folder form of another one as well.
_WEB = f"""web AS (SELECT 'https://w.example.com/d' || page_id || '/' AS url,
    html || '<a href="https://w.example.com/d' || ((page_id * 7 + 3) % (SELECT count(*) FROM pages)) || '/">next</a><a href="file' || page_id || '.csv">f</a>' AS html FROM pages),
  wl AS (SELECT url, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM web),
  q AS (SELECT url, href, {_QUOTE.format('href')} AS link FROM wl),
  m AS (SELECT * FROM q WHERE regexp_matches(link, '^/[a-m]|[.]csv$')),
  mh AS (SELECT * FROM q WHERE regexp_matches(href, '^/[a-m]|[.]csv$')),
  found AS (SELECT url, link AS f FROM m WHERE NOT (starts_with(link, 'https://') AND ends_with(link, '/'))
    UNION ALL SELECT q.url, mh.link FROM q JOIN mh ON mh.url = q.link WHERE starts_with(q.link, 'https://') AND ends_with(q.link, '/'))"""


@query("one_hop_links", f"WITH {_WEB} SELECT DISTINCT url, {_ABSOLUTE.format('f')} AS link FROM found")
def one_hop_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    key = F.col("page_id")
    url = lambda k: F.concat(F.lit("https://w.example.com/d"), k.cast("string"), F.lit("/"))
    target = (key * 7 + 3) % pages.agg(F.count(F.lit(1))).scalar()
    html = F.concat(
        "html",
        F.lit('<a href="'),
        url(target),
        F.lit('">next</a><a href="file'),
        key.cast("string"),
        F.lit('.csv">f</a>'),
    )
    web = pages.select(url(key).alias("url"), html.alias("html"))
    return links.one_hop_links(web, ["^/[a-m]", "[.]csv$"])


def _listing_pages(spark, sf_dir):
    """Index pages made from ``customer``, at most 500 entries each."""
    key = F.col("c_custkey")
    folder = key % 10 == 0
    size = F.when(folder, "&lt;dir&gt;").otherwise(F.col("c_nationkey").cast("string"))
    href = F.concat(F.lit("/pub/"), key.cast("string"), F.when(folder, "/").otherwise(".csv"))
    ways = F.array(F.lit(' <a href="'), F.lit(" <A class='f' HREF='"), F.lit(" <a href="))
    ends = F.array(F.lit('">'), F.lit("'>"), F.lit(">"))
    key = key.cast("int")
    entry = F.concat(
        F.lit("<br> 9/1/2021, 10:30 AM   "), size, F.element_at(ways, key % 3 + 1), href, F.element_at(ends, key % 3 + 1), F.col("c_name"), F.lit("</a>")
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key.alias("k"), entry.alias("e")))), lambda x: x["e"]), "")
    page = F.concat(F.lit("https://ftp.example.org/pub/"), F.floor(key / 500).cast("string"), F.lit("/"))
    return (
        table(spark, sf_dir, "customer")
        .groupBy(page.alias("url"))
        .agg(F.concat(F.lit('<html><pre><a href="/pub/">[To Parent Directory]</a>'), body, F.lit("</pre></html>")).alias("html"))
    )


_ENTRIES = """SELECT '9/1/2021 10:30 AM' AS "Last modified", CASE WHEN c_custkey % 10 = 0 THEN '-' ELSE CAST(c_nationkey AS VARCHAR) END AS "Size",
  c_name AS "Name", 'https://ftp.example.org/pub/' || c_custkey || CASE WHEN c_custkey % 10 = 0 THEN '/' ELSE '.csv' END AS "Url",
  'https://ftp.example.org/pub/' || (c_custkey // 500) || '/' AS "Parent_Directory" FROM customer"""
# The size is removed wherever its text occurs, as single digits do in the date.
_DATED = """WITH e AS ({entries}) SELECT * REPLACE (CASE WHEN "Size" = '-' THEN "Last modified" ELSE trim(replace("Last modified" || '   ' || "Size", "Size", '')) END AS "Last modified") FROM e"""


@query("listing_page_entries", _DATED.format(entries=_ENTRIES))
def listing_page_entries(spark, sf_dir):
    return links.listing_entries(_listing_pages(spark, sf_dir))


@query("listing_files", _DATED.format(entries=_ENTRIES) + """ WHERE "Size" <> '-'""")
def listing_files(spark, sf_dir):
    return links.listing_files(links.listing_entries(_listing_pages(spark, sf_dir)))


# A directory tree of five levels, with links back up.
_EDGES = """edges AS (
  SELECT '/' AS parent, r_name || '/' AS child, true AS is_folder FROM region
  UNION SELECT r_name || '/', n_name || '/', true FROM nation JOIN region ON r_regionkey = n_regionkey
  UNION SELECT n_name || '/', '/', true FROM nation
  UNION SELECT n_name || '/', c_name || '/', true FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION SELECT c_name || '/', 'order' || o_orderkey, false FROM orders JOIN customer ON c_custkey = o_custkey
  UNION SELECT 'lost' || s_suppkey || '/', s_name, false FROM supplier)"""


def _edges(spark, sf_dir):
    region, nation, customer, orders, supplier = (
        table(spark, sf_dir, t) for t in ("region", "nation", "customer", "orders", "supplier")
    )
    name = lambda c: F.concat(F.col(c), F.lit("/"))
    yes, no = F.lit(True).alias("is_folder"), F.lit(False).alias("is_folder")
    pieces = [
        region.select(F.lit("/").alias("parent"), name("r_name").alias("child"), yes),
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(name("r_name"), name("n_name"), yes),
        nation.select(name("n_name"), F.lit("/"), yes),
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(name("n_name"), name("c_name"), yes),
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            name("c_name"), F.concat(F.lit("order"), F.col("o_orderkey").cast("string")), no
        ),
        supplier.select(F.concat(F.lit("lost"), F.col("s_suppkey").cast("string"), F.lit("/")), "s_name", no),
    ]
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.union(piece)
    return out


@query(
    "directory_closure",
    f"""WITH RECURSIVE {_EDGES}, seen AS (SELECT '/' AS folder UNION SELECT child FROM edges JOIN seen ON parent = folder WHERE is_folder)
      SELECT DISTINCT parent, child, is_folder FROM edges JOIN seen ON parent = folder""",
)
def directory_closure(spark, sf_dir):
    seeds = table(spark, sf_dir, "region").select(F.lit("/").alias("folder")).distinct()
    return links.directory_closure(_edges(spark, sf_dir), seeds)
