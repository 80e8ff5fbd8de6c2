"""Files as DataFrames: inventories, filters, lines, CSV, tables, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from gridloom.functions.text import (
    base_name,
    contains_any,
    ends_with_any,
    matches_any,
    path_segment,
    strip,
)
from gridloom.sources.records import csv_records

# Suffixes and name parts of the file families.
WORKBOOK_SUFFIXES = [".xls", ".xlsx"]
TEXT_SUFFIXES = [".txt", ".TXT"]
HTML_SUFFIXES = [".htm", ".html"]
EXCLUDED_TEXT_NAMES = [
    ".exe", ".txt", ".contacts", ".zip", ".tar", ".xml", ".gz", "README", ".doc", ".pdf", ".gif", ".sf",
]
EXCLUDED_GOV_NAMES = ["old"]
EXCLUDED_USPTO_NAMES = ["How_to_Query"]
LAYOUT_DOCUMENT_NAMES = ["Technical Documentation", "Tech Doc"]
GOV_YEAR_SEGMENT, GOV_YEAR_AFTER = 8, 2009


def file_inventory(spark: SparkSession, root: str, suffixes: Sequence[str] = ()) -> DataFrame:
    """Recursive listing ``(path, length, modificationTime)``; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return with_suffix(files.select("path", "length", "modificationTime"), suffixes)


def with_suffix(paths: DataFrame, suffixes: Sequence[str], path: str = "path") -> DataFrame:
    """Case-sensitive suffix test; no suffix keeps all."""
    return paths.filter(ends_with_any(F.col(path), suffixes)) if suffixes else paths


def path_regex_filter(paths: DataFrame, patterns: Sequence[str] | str | None, path: str = "path") -> DataFrame:
    """Paths in which any pattern is found; none keeps all.

    A text is split on commas; a list lets patterns contain commas.
    """
    if isinstance(patterns, str):
        patterns = [p for p in patterns.split(",")] if patterns else []
    return paths.filter(matches_any(F.col(path), patterns or []))


def name_excluded(path: Column, parts: Sequence[str]) -> Column:
    return contains_any(base_name(path), parts)


def name_exclude_filter(paths: DataFrame, parts: Sequence[str], path: str = "path") -> DataFrame:
    return paths.filter(~name_excluded(F.col(path), parts))


def path_segment_filter(
    paths: DataFrame, segment: int = GOV_YEAR_SEGMENT, above: int = GOV_YEAR_AFTER, path: str = "path"
) -> DataFrame:
    """Adds ``segment_value`` (NULL for no number, for the quarantine) and ``keep``."""
    number = path_segment(F.col(path), segment).try_cast("int")
    return paths.withColumn("segment_value", number).withColumn("keep", F.col("segment_value") > above)


def name_include_filter(paths: DataFrame, parts: Sequence[str], path: str = "path") -> DataFrame:
    return paths.filter(contains_any(F.col(path), parts))


def layout_documents(paths: DataFrame, path: str = "path") -> DataFrame:
    """Layout documents: a PDF with one of two names, not an old one."""
    c = F.col(path)
    return paths.filter(c.endswith(".pdf") & contains_any(c, LAYOUT_DOCUMENT_NAMES) & ~c.contains("old"))


def text_lines(spark: SparkSession, paths: str | Sequence[str], blank: str = "empty") -> DataFrame:
    """``lines(source, line_no, value)`` with true line numbers, blank lines dropped.

    Files are read in splits, however large. A line number is the place inside
    its split (ids grow within a task) plus the lines of the splits before it,
    which takes one small aggregate per split and no sort of the text.
    ``blank``: drop ``empty`` lines, ``space`` drops white space lines too,
    ``keep`` drops none.
    """
    raw = spark.read.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("__start"),
        "value",
        F.monotonically_increasing_id().alias("__id"),
    )
    splits = raw.groupBy("source", "__start").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__lines"))
    before = Window.partitionBy("source").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        "source", "__start", (F.coalesce(F.sum("__lines").over(before), F.lit(0)) - F.col("__first")).alias("__shift")
    )
    lines = raw.join(offsets, ["source", "__start"]).select(
        "source", (F.col("__id") + F.col("__shift")).alias("line_no"), "value"
    )
    return drop_blank_lines(lines, blank)


def drop_blank_lines(lines: DataFrame, blank: str = "empty") -> DataFrame:
    if blank == "empty":
        return lines.filter(F.col("value") != "")
    if blank == "space":
        return lines.filter(strip(F.col("value")) != "")
    return lines


def document_lines(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Lines of texts that are stored as values: ``(keys…, line_no, value)``."""
    return df.select(*keys, F.posexplode(F.split(text, "\n")).alias("line_no", "value"))


def as_lines(lines: DataFrame, sheet: str = "text") -> DataFrame:
    """Lines in the shape of the grid operators."""
    return lines.select("source", F.lit(sheet).alias("sheet"), F.col("line_no").alias("row_idx"), "value")


def csv_scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    infer: bool = False,
    multi_line: bool = True,
    header: bool = True,
    escape: str | None = None,
) -> DataFrame:
    """CSV with all columns as text, or with inferred types.

    ``multi_line`` keeps line breaks inside quotes. Files are read in splits either way (see ``sources.records``), but
    inferred types of files with such breaks are read a file a task. ``escape`` is what stands before a quote inside
    quotes.
    """
    options = {"header": str(header).lower(), "multiLine": str(multi_line).lower(), **({"escape": escape} if escape else {})}
    reader = spark.read.options(**options)
    places = list(paths) if not isinstance(paths, str) else paths
    if infer or not multi_line:
        return reader.option("inferSchema", str(infer).lower()).csv(places)
    # Names from the first record, types all text: no other record is read for them.
    schema = reader.csv(places).schema
    if not schema.fields:
        return spark.createDataFrame([], schema)
    records = csv_records(spark, places, header, escape=escape or "\\")
    parsed = records.select(F.from_csv("value", _ddl(schema), options).alias("r"))
    return parsed.select("r.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def table_scan(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def manifest_urls(manifest: DataFrame) -> DataFrame:
    """Spaces as ``%20`` in every column, names in upper case, ``URL`` trimmed."""
    quoted = manifest.select(*[F.replace(F.col(f"`{c}`"), F.lit(" "), F.lit("%20")).alias(c.upper()) for c in manifest.columns])
    return quoted.select(strip(F.col("URL")).alias("URL"))


def manifest_triples(manifest: DataFrame) -> DataFrame:
    """``(data_path, layout_path, code_path)``; a PDF layout stands for a folder of tables."""
    data, layout, code = manifest.columns[:3]
    return manifest.select(
        F.col(data).alias("data_path"),
        F.replace(F.col(layout), F.lit(".pdf"), F.lit("/")).alias("layout_path"),
        F.col(code).alias("code_path"),
    )


def manifest_join(scanned: DataFrame, manifest: DataFrame, role: str, source: str = "source") -> DataFrame:
    """Rows of all scanned files beside their manifest entry, in one join.

    ``role`` is ``data``, ``layout`` or ``code``. Paths are compared without a
    scheme; a layout folder covers the files directly inside.
    """
    bare = lambda c: F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    key = bare(F.col(source))
    if role == "layout":
        folder = F.regexp_replace(key, r"[^/]*$", "")
        return scanned.withColumn("__key", folder).join(
            manifest.withColumn("__key", bare(F.col("layout_path"))), "__key"
        ).drop("__key")
    return scanned.withColumn("__key", key).join(
        manifest.withColumn("__key", bare(F.col(f"{role}_path"))), "__key"
    ).drop("__key")


def manifest_batch(spark: SparkSession, manifest: DataFrame, blank: str = "empty") -> DataFrame:
    """All data files of a manifest read in one scan, each line with its entry.

    The paths of the manifest come to the driver, as for any file scan.
    """
    paths = [r["data_path"] for r in manifest.select("data_path").distinct().toLocalIterator()]
    return manifest_join(text_lines(spark, paths, blank), manifest, "data")


