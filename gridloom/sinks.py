"""Writing tables, views, single files and error logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.text import quote_regex
from gridloom.operators.combine import union_by_name_merge
from gridloom.operators.quarantine import tee
from gridloom.session import settle_counted


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace data and schema of a table folder."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_merge_schema(df: DataFrame, path: str) -> None:
    """Append; columns new to the table are merged when it is read with ``merge_schema``."""
    df.write.mode("append").parquet(path)


def combine_tables(tables: list[DataFrame], path: str) -> None:
    """All tables under one merged schema, in one write."""
    overwrite_table(union_by_name_merge(tables), path)


def csv_export(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a heading, a file per task; one file if ``single``, which one task then writes."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", "true").csv(path)


def single_file_write(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(path)


def table_name(path: Column, prefix: str = "soi_tax_stats_") -> Column:
    """Catalog name of a table folder: its last part, dots as ``_``."""
    last = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.concat(F.lit(prefix), F.replace(last, F.lit("."), F.lit("_")))


def register_table(spark: SparkSession, path: str, name: str, persist: bool = False) -> None:
    """Make a stored table known by name, as a catalog table or a session view."""
    df = spark.read.parquet(path)
    if persist:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)


def error_log(quarantined: DataFrame, path: str) -> bool:
    """Write the error rows if there is at least one; tells whether it did.

    The rows are worked out once and counted while they are written; the log is made from what was written.
    """
    written, seen = settle_counted(quarantined)
    if not seen["n"]:
        return False
    csv_export(written, path)
    return True


def write_outcomes(checked: DataFrame, stage: str, path: str, log_path: str, source: str = "source") -> tuple[int, int]:
    """Good rows as a table, error rows as a log if there are any; the input is read once. Numbers of good and bad rows."""
    outcome = tee(checked, stage, source)
    overwrite_table(outcome.good, path)
    if outcome.n_bad:
        csv_export(outcome.errors, log_path)
    return outcome.n_good, outcome.n_bad


def view_paths(path: Column) -> tuple[Column, Column]:
    """Folder and stem of a text file with the endings of its two views."""
    folder = F.regexp_replace(path, r"/?[^/]*$", "")
    stem = F.element_at(F.split(F.element_at(F.split(path, "/"), -1), quote_regex(".")), 1)
    base = F.concat_ws("/", folder, stem)
    return F.concat(base, F.lit("_first_view")), F.concat(base, F.lit("_second_view"))


def two_view_write(first: DataFrame, second_of, first_path: str, second_path: str) -> None:
    """Write a table and a table made from it; the source is read once."""
    overwrite_table(first, first_path)
    overwrite_table(second_of(first.sparkSession.read.schema(first.schema).parquet(first_path)), second_path)


def route_write(df: DataFrame, path: str) -> None:
    """One folder per output group and table name."""
    overwrite_table(df, path, partition_by=["output_group", "table_name"])
