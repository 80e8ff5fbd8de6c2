"""Links between stored pages, and the closure of a directory tree."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import matches_any, site_root, strip, unescape, url_quote
from gridloom.session import ensure_checkpoint_dir

# A start tag of an anchor; a ">" inside quotes does not end it. Possessive, so no tag is tried twice.
ANCHOR = r"""(?i)<a(?=\s)(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# Its address: in double quotes, single quotes or none, after any other attributes.
_OTHER = r"""(?:\s++(?!href[\s=])[^\s=>]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+"""
HREF = rf"""(?i)^<a{_OTHER}\s++href\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))"""


def address(tag: Column) -> Column:
    """The address of an anchor's start tag, character references resolved; NULL for an anchor without one."""
    quoted = F.greatest(*[F.regexp_extract(tag, HREF, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(HREF), unescape(quoted))


def anchors(html: Column) -> Column:
    """The addresses of a page's anchors, in order."""
    found = F.transform(F.regexp_extract_all(html, F.lit(ANCHOR), F.lit(0)), address)
    return F.filter(found, lambda h: h.isNotNull())


def page_links(pages: DataFrame, patterns: Sequence[str] = (), keep: Sequence[str] = ("url",)) -> DataFrame:
    """One row per link of a page, percent-quoted."""
    links = pages.select(*keep, F.posexplode(anchors(F.col("html"))).alias("at", "href"))
    return links.filter(matches_any(F.col("href"), patterns)).select(*keep, "at", url_quote(F.col("href")).alias("link"))


def absolute_url(link: Column, page: Column) -> Column:
    """Scheme and host of the page before a link that has none of its own."""
    folder = F.regexp_extract(page, r"^(.*)/[^/]*$", 1)
    bare_file = F.size(F.split(link, "/")) <= 1
    full = F.when(bare_file, F.concat(folder, F.lit("/"), link)).otherwise(link)
    return F.when(full.startswith("https://"), full).otherwise(F.concat(site_root(page), full))


def one_hop_links(pages: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Matching links of every page; links to a folder page give that page's matching links.

    The stored pages stand for the web: a folder link is looked up by its URL.
    """
    links = page_links(pages)
    is_file = F.size(F.split("link", "/")) <= 1
    wanted = matches_any(F.col("link"), patterns)
    folder = F.col("link").startswith("https://") & F.col("link").endswith("/") & ~(is_file & wanted)
    direct = links.filter(~folder & wanted).select("url", F.col("link").alias("found"))
    # The matching links of a folder page; quoting is applied to the raw link once.
    inner = page_links(pages, patterns).select(F.col("url").alias("link"), F.col("link").alias("found"))
    followed = links.filter(folder).select("url", "link").join(inner, "link").select("url", "found")
    found = direct.unionByName(followed)
    return found.select("url", absolute_url(F.col("found"), F.col("url")).alias("link")).distinct()


def listing_entries(pages: DataFrame) -> DataFrame:
    """Entries of index pages: the text before each link of a ``pre`` block holds date and size."""
    body = F.regexp_extract("html", r"(?is)<pre[^>]*>(.*?)</pre>", 1)
    entries = pages.select(
        "url",
        F.posexplode(F.regexp_extract_all(body, F.lit(r"""(?is)((?:[^<]++|<dir>|<br\s*/?>|<hr\s*/?>|<img[^>]*>)*+<a\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+>[^<]*+)</a>"""), F.lit(1))).alias("at", "entry"),
    )
    before = F.regexp_extract("entry", r"""(?is)^(.*?)<a\s""", 1)
    text = strip(F.replace(F.regexp_replace(before, r"(?is)<br\s*/?>|<hr\s*/?>|<img[^>]*>", ""), F.lit(","), F.lit("")))
    text = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    size = F.element_at(F.split(text, r"\s+"), -1)
    date = strip(F.when(size == "", text).otherwise(F.replace(text, size, F.lit(""))))
    return entries.filter("at > 0").select(
        date.alias("Last modified"),
        F.replace(size, F.lit("<dir>"), F.lit("-")).alias("Size"),
        strip(F.regexp_extract("entry", r"(?is)>([^<>]*)$", 1)).alias("Name"),
        F.concat(site_root(F.col("url")), address(F.regexp_extract("entry", ANCHOR, 0))).alias("Url"),
        F.col("url").alias("Parent_Directory"),
    )


def listing_files(entries: DataFrame) -> DataFrame:
    """Files of a listing: no folders, no way up, at least two known values."""
    return entries.filter((F.col("Size") != "-") & (F.col("Name") != "Parent Directory")).dropna(thresh=2)


def directory_closure(
    entries: DataFrame, seeds: DataFrame, parent: str = "parent", child: str = "child", is_folder: str = "is_folder"
) -> DataFrame:
    """All entries reachable from the seed folders.

    ``entries(parent, child, is_folder)`` are listings already fetched. Edges and the folders visited so far are kept in
    buckets of the folder, so a round shuffles only the folders it finds: it reads the edges of the last round's folders
    where they lie, deals their children out once, and drops those visited, which lie there already; cycles therefore end.
    A round is one write; its number of new folders is counted while it is written. All tables are in the shared folder,
    which keeps the plan short and survives the loss of an executor.
    """
    spark = entries.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = _Buckets(spark, n, "parent")
    visited = _Buckets(spark, n, "folder")
    edges.add(
        entries.select(F.col(parent).alias("parent"), F.col(child).alias("child"), F.col(is_folder).alias("is_folder")).distinct()
    )
    new = visited.add(seeds.select(F.col(seeds.columns[0]).alias("folder")).where("folder is not null").repartition(n, "folder").distinct(), 0)
    at = 0
    while new:
        # Both lie in buckets of the folder: merged where they are.
        last = visited.read().filter(F.col("round") == at).select(F.col("folder").alias("parent"))
        found = edges.read().filter("is_folder and child is not null").join(last.hint("merge"), "parent")
        targets = found.select(F.col("child").alias("folder")).repartition(n, "folder").distinct()
        at += 1
        # An anti join would be pushed below the other join, which would deal out the edges.
        known = visited.read().select("folder", F.lit(True).alias("known")).hint("merge")
        new = visited.add(targets.join(known, "folder", "left").filter("known is null").select("folder"), at)
    return edges.read().join(visited.read().select(F.col("folder").alias("parent")).hint("merge"), "parent").select("parent", "child", "is_folder")


class _Buckets:
    """A table in the shared folder, in buckets of one column; every ``add`` is a part of its own."""

    def __init__(self, spark: SparkSession, n: int, column: str) -> None:
        self.spark, self.n, self.column = spark, n, column
        self.name = f"gridloom_{column}_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark)}/gridloom/{self.name}"

    def add(self, rows: DataFrame, at: int | None = None) -> int:
        """Write rows; returns how many they were."""
        seen = Observation()
        parted = rows if at is None else rows.withColumn("round", F.lit(at))
        writer = parted.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").option("path", self.path).format("parquet")
        writer = writer.bucketBy(self.n, self.column).sortBy(self.column)
        writer.saveAsTable(self.name)
        return seen.get["n"]

    def read(self) -> DataFrame:
        return self.spark.table(self.name)
