"""Fixed-width text: layouts, slicing and code lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.text import base_name, clean_name_layout

# Paths whose lines start with a state and a type code.
STATE_TYPE_PATHS = ["Fin_PID", "modp_pu"]
STATE_TYPE_SLICES = [(1, 2, "State code"), (3, 1, "Type code")]


def layout_positions(layout: DataFrame) -> DataFrame:
    """``start`` from the part of ``Positions`` before the dash; exact repeats removed."""
    return layout.select(
        F.replace(F.col("Description"), F.lit(" "), F.lit("_")).alias("Description"),
        "Positions",
        "Length",
        F.split("Positions", "-")[0].alias("START"),
    ).distinct()


def layout_range(layout: DataFrame, location: str = "Location") -> DataFrame:
    """``a-b`` → start, end and length; rows without two numbers are dropped."""
    first, last = F.substring_index(location, "-", 1), F.substring_index(location, "-", -1)
    return (
        layout.withColumn("start", first.try_cast("int"))
        .withColumn("end", last.try_cast("int"))
        .withColumn("length", F.col("end") - F.col("start") + 1)
        .dropna(subset=["length"])
    )


def slice_columns(slices: Sequence[tuple[int, int, str]], value: str = "value") -> list[Column]:
    """One substring per distinct ``(start, length, name)``, ordered by position."""
    return [F.substring(value, start, length).alias(name) for start, length, name in sorted(set(slices))]


def fixed_width_slice(
    lines: DataFrame, slices: Sequence[tuple[int, int, str]], value: str = "value"
) -> DataFrame:
    """Slices are not trimmed; a short line gives short or empty fields."""
    return lines.select("*", *slice_columns(slices, value)).drop(value)


def collect_slices(layout: DataFrame, start: str = "START", length: str = "Length", name: str = "Description") -> list:
    """The layout as Python tuples.

    Only the layout travels to the driver: one row per field of a record.
    """
    picked = layout.select(
        F.col(start).try_cast("int").alias("s"), F.col(length).try_cast("int").alias("l"), F.col(name).alias("n")
    ).dropna()
    return sorted({(r["s"], r["l"], r["n"]) for r in picked.distinct().toLocalIterator()})


def conditional_extra_slices(lines: DataFrame, path: str = "source", value: str = "value") -> DataFrame:
    """State and type code for the paths that have them, NULL for the others."""
    applies = F.col(path).rlike("|".join(STATE_TYPE_PATHS))
    return lines.select(
        "*",
        *[
            F.when(applies, F.substring(value, start, length)).alias(name.replace(" ", "_"))
            for start, length, name in STATE_TYPE_SLICES
        ],
    )


def layout_names(df: DataFrame) -> DataFrame:
    """All columns under their cleaned layout names."""
    table = str.maketrans({c: "_" for c in " ,;{}()\n\t="})
    return df.select(*[F.col(f"`{c}`").alias(c.translate(table)) for c in df.columns])


def last_codes(codebook: DataFrame, order: str) -> DataFrame:
    """The last row of every ``(Name, Code)``; partial aggregation, no window."""
    return codebook.groupBy("Name", "Code").agg(F.max_by(F.struct("Desription"), order)["Desription"].alias("label"))


def codebook_lookup(
    df: DataFrame, codebook: DataFrame, column: str, name: str | None = None, order: str = "row_idx"
) -> DataFrame:
    """Left lookup of one column: adds ``matched`` and ``label``."""
    codes = (
        last_codes(codebook.filter(F.col("Name") == (name or column)), order)
        .select(F.col("Code").alias(column), "label", F.lit(True).alias("matched"))
    )
    # No hint: Spark broadcasts the code list if its measured size allows, and
    # sort-merges with skew splitting otherwise.
    return df.join(codes, column, "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def codebook_decode(
    df: DataFrame, codebook: DataFrame, columns: Sequence[str], order: str = "row_idx"
) -> DataFrame:
    """Replace codes by labels.

    Exact, untrimmed match; the last row of a code wins; unmatched codes stay;
    a matched code with a NULL label becomes NULL.
    """
    out = df
    for column in columns:
        found = codebook_lookup(out, codebook, column, order=order)
        value = F.when(F.col("matched"), F.col("label")).otherwise(F.col(column))
        out = found.withColumn(column, value).drop("matched", "label")
    return out.select(*df.columns)


def coded_columns(df: DataFrame, codebook: DataFrame) -> list[str]:
    """Columns of ``df`` that the codebook names; others in it are ignored."""
    named = codebook.filter(F.col("Name").isin(list(df.columns))).select("Name").distinct()
    found = {r["Name"] for r in named.toLocalIterator()}
    return [c for c in df.columns if c in found]


def layout_for_file(files: DataFrame, file_list: DataFrame, layout: DataFrame, path: str = "source") -> DataFrame:
    """Layout rows of every file, by upper-cased base name and decade.

    ``file_list`` keeps the first row of a file name (``row_idx`` order), the
    layout is stripped of exact repeats; files without a match drop out.
    """
    first = file_list.groupBy("File Name").agg(
        F.min_by(F.struct("use_layout_decade"), "row_idx")["use_layout_decade"].alias("decade")
    )
    named = files.withColumn("File Name", F.upper(base_name(F.col(path))))
    return named.join(first, "File Name").join(layout.distinct(), "decade")
