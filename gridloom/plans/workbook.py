"""From grid rows to named tables, by the rules of a family of sheets.

A profile picks operators; all sheets of all files go through them together.
Tables of different shape stay in one long form (``names`` beside ``rows``)
until one of them is asked for or written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.ordered import dense_position, join_by_row, join_facts, last_seen, over_blocks, with_blocks
from gridloom.operators import grid, naming, splits, structure
from gridloom.operators.grid import COLUMN, ROW, SHEET, cell, n_nulls
from gridloom.session import settle


@dataclass(frozen=True)
class Profile:
    """Rules of a family; see the presets below."""

    name: str
    # Grid clean-up before any row is looked at.
    prepare: Callable[[DataFrame], DataFrame]
    # Sheets for which this holds for the first row have no heading to find.
    plain: Callable[[Column], Column]
    # Names of plain sheets: by position (all rows are data) or from the first row.
    plain_names: str
    classify: Callable[[DataFrame], DataFrame]
    header_row: Callable[[], Column]
    # Rows of the heading run that are not joined.
    depth_offset: int = 0
    carry: Callable[[DataFrame], DataFrame] | None = None
    # What happens to labels that stand alone, after lending their text.
    drop_labels: bool = True
    need_first: bool = False
    cleaner: str = "excel"
    prefix: Callable[[DataFrame], DataFrame] | None = None
    # Rows whose value under this name ends in a colon go.
    heading_column: str | None = None


@dataclass(frozen=True)
class SheetTables:
    """``names(source, sheet, col_idx, name)``, ``rows(source, sheet, row_idx, vals)``, ``notes``."""

    names: DataFrame
    rows: DataFrame
    notes: DataFrame

    def long(self) -> DataFrame:
        """One row per non-empty cell, under the name of its column."""
        cells = grid.to_cells(self.rows).filter("value is not null")
        return cells.join(self.names.select(*COLUMN, "name"), COLUMN).select(*ROW, "col_idx", "name", "value")

    def schemas(self) -> DataFrame:
        """``(source, sheet, columns)``: the columns that hold a value, in order."""
        used = grid.to_cells(self.rows).filter("value is not null").select(*COLUMN).distinct()
        named = self.names.join(used, COLUMN)
        ordered = F.array_sort(F.collect_list(F.struct("col_idx", "name")))
        return named.groupBy(*SHEET).agg(ordered.alias("columns"))

    def table(self, source: str, sheet: str) -> DataFrame:
        """One table with its own columns; only its names come to the driver."""
        this = (F.col("source") == source) & (F.col("sheet") == sheet)
        found = self.schemas().filter(this).select("columns").first()
        columns = found["columns"] if found else []
        picked = [cell(F.col("vals"), c["col_idx"]).alias(c["name"]) for c in columns]
        notes = self.notes.filter(this).select("header", "footer").first()
        extra = [F.lit(notes[k]).alias(k.title()) for k in ("header", "footer") if notes and notes[k]]
        return self.rows.filter(this).select("row_idx", *picked, *extra)

    def write(self, path: str) -> None:
        """All tables, in one write whatever the number of schemas.

        ``path`` has a folder per schema, source and sheet, with cells in columns ``c0``, ``c1``, … up to the widest table;
        ``path/_schemas`` has the names of these columns per schema, ``path/_tables`` the schema and notes per table.
        ``stored_table`` gives a table its names back.
        """
        schemas = settle(self.schemas().withColumn("schema", F.md5(F.to_json("columns"))))
        width = schemas.agg(F.max(F.size("columns"))).first()[0] or 0
        at = F.transform("columns", lambda c: c["col_idx"])
        picked = [F.try_element_at("vals", F.try_element_at("__at", F.lit(i + 1)) + 1).alias(f"c{i}") for i in range(width)]
        blocked = with_blocks(self.rows, "row_idx")
        annotated = join_facts(blocked, schemas.select(*SHEET, "schema", at.alias("__at")), SHEET)
        annotated.select("schema", *ROW, *picked).write.mode("overwrite").partitionBy("schema", *SHEET).parquet(path)
        names = schemas.groupBy("schema").agg(F.first(F.transform("columns", lambda c: c["name"])).alias("names"))
        names.write.mode("overwrite").parquet(f"{path}/_schemas")
        schemas.select(*SHEET, "schema").join(self.notes, SHEET, "left").write.mode("overwrite").parquet(f"{path}/_tables")


def stored_table(spark: SparkSession, path: str, source: str, sheet: str) -> DataFrame:
    """One table that ``SheetTables.write`` stored, with its own columns and notes; only its files are read."""
    this = (F.col("source") == source) & (F.col("sheet") == sheet)
    found = spark.read.parquet(f"{path}/_tables").filter(this).join(spark.read.parquet(f"{path}/_schemas"), "schema").first()
    if found is None:
        raise KeyError((source, sheet))
    named = [F.col(f"c{i}").alias(name) for i, name in enumerate(found["names"])]
    notes = [F.lit(found[k]).alias(k.title()) for k in ("header", "footer") if found[k]]
    # Folder names are texts, whatever they look like.
    columns = ["row_idx long", *[f"c{i} string" for i in range(len(found["names"]))], "schema string", *[f"{c} string" for c in SHEET]]
    rows = spark.read.schema(", ".join(columns)).parquet(path)
    return rows.filter(this & (F.col("schema") == found["schema"])).select("row_idx", *named, *notes)


def _first_facts(rows: DataFrame, plain: Callable[[Column], Column]) -> DataFrame:
    # The test of each row goes into the aggregate, not its cells: a hash aggregate instead of one that sorts whole rows.
    tested = rows.select(*ROW, F.coalesce(plain(F.col("vals")), F.lit(False)).alias("__plain"))
    first = tested.groupBy(*SHEET).agg(F.min_by("__plain", "row_idx").alias("is_plain"))
    return first.select(*SHEET, F.coalesce("is_plain", F.lit(False)).alias("is_plain"))


def sheet_tables(rows: DataFrame, profile: Profile) -> SheetTables:
    """Names, data rows and notes of every sheet."""
    ready = settle(with_blocks(profile.prepare(grid.normalise_rows(rows)), "row_idx"))
    kinds = settle(_first_facts(ready, profile.plain))
    sorted_out = ready.drop("__block").join(kinds, SHEET)
    plain_names, plain_rows = _plain(sorted_out.filter("is_plain").drop("is_plain"), profile)

    found = sorted_out.filter("not is_plain").drop("is_plain")
    classified = settle(profile.classify(profile.prefix(found) if profile.prefix else found))
    body = profile.carry(classified) if profile.carry else classified.filter("role = 'body'").select(*ROW, "vals")
    placed = settle(dense_position(body, SHEET, "row_idx"))
    depth = settle(
        structure.header_depth(placed, profile.header_row()).withColumn(
            "depth", F.greatest(F.col("depth") - profile.depth_offset, F.lit(0))
        )
    )
    names, data = structure.split_header(placed.join(depth, SHEET), F.col("depth"))
    return _finish(
        profile,
        naming.clean_names(names, profile.cleaner),
        structure.indent_path(data.select(*ROW, "vals")),
        structure.notes_concat(classified),
        plain_names,
        plain_rows,
    )


def _plain(rows: DataFrame, profile: Profile) -> tuple[DataFrame, DataFrame]:
    names = structure.first_row_names(rows)
    if profile.plain_names == "position":
        return naming.positional_names(names), rows.select(*ROW, "vals")
    marked = grid.first_rows(rows)
    return naming.clean_names(names, "excel"), marked.filter("not is_first").select(*ROW, "vals")


def _finish(profile, names, rows, notes, plain_names, plain_rows) -> SheetTables:
    if profile.drop_labels:
        rows = structure.drop_label_rows(rows, need_first=profile.need_first)
    every_name = names.select(*COLUMN, "name").unionByName(plain_names.select(*COLUMN, "name"))
    # Written first, as unique names are joined back to them: else cells, headings and names are worked out twice.
    unique = settle(naming.dedupe_names(settle(every_name)))
    if profile.heading_column:
        # Group headings are rows whose description ends in a colon.
        at = unique.filter(F.col("name") == profile.heading_column).groupBy(*SHEET).agg(F.min("col_idx").alias("__at"))
        text = F.try_element_at("vals", F.col("__at") + 1)
        rows = rows.join(at, SHEET, "left").filter(~F.coalesce(text.endswith(":"), F.lit(False))).drop("__at")
    return SheetTables(unique, settle(rows.unionByName(plain_rows)), settle(notes))


# ---- preparation --------------------------------------------------------


def prepare_gov(rows: DataFrame) -> DataFrame:
    slim = grid.select_columns(rows, (F.col("n_values") > 0) & ~F.col("has_line"))
    return grid.drop_leading_gap_column(grid.drop_description_marker_rows(grid.drop_blank_rows(slim)))


def prepare_dl(rows: DataFrame) -> DataFrame:
    starred = F.col("n_values").isin(1, 2) & F.col("has_star")
    return grid.drop_blank_rows(grid.select_columns(rows, (F.col("n_values") > 0) & ~starred))


def _no_gap(vals: Column) -> Column:
    return n_nulls(vals) == 0


GOV = Profile(
    name="gov",
    prepare=prepare_gov,
    plain=_no_gap,
    plain_names="position",
    prefix=structure.gov_prefix,
    classify=structure.classify_rows_gov,
    header_row=structure.header_row_gov,
    drop_labels=False,
    heading_column="Description",
)

USPTO = Profile(
    name="uspto",
    prepare=lambda rows: rows,
    plain=_no_gap,
    plain_names="first_row",
    classify=structure.classify_rows_uspto,
    header_row=structure.header_row_uspto,
    depth_offset=1,
    carry=structure.carry_label_uspto,
    need_first=True,
)

USPTO_SPECIAL = replace(USPTO, name="uspto_special", carry=structure.keep_label_uspto_special, drop_labels=False)


def dl_tables(rows: DataFrame) -> SheetTables:
    """The DL family: no indentation; some headings are no headings."""
    ready = settle(with_blocks(prepare_dl(grid.normalise_rows(rows)), "row_idx")).drop("__block")
    classified = settle(structure.classify_rows_dl(ready))
    placed = settle(dense_position(classified.filter("role = 'body'").select(*ROW, "vals"), SHEET, "row_idx"))
    depth = structure.header_depth(placed, structure.header_row_dl())
    first = placed.filter("position = 0").select(*SHEET, n_nulls(F.col("vals")).alias("gaps"), F.size("vals").alias("w"))
    # A heading of one row is taken as it is; without one, a gappy first row names nothing.
    facts = settle(
        depth.join(first, SHEET).select(
            *SHEET,
            F.when(F.col("depth") == 1, 0).otherwise(F.col("depth")).alias("depth"),
            (((F.col("depth") == 0) & (F.col("gaps") > 3)) | ((F.col("w") == 1) & (F.col("gaps") == 0))).alias("nameless"),
        )
    )
    names, data = structure.split_header(placed.join(facts, SHEET), F.col("depth"))
    guarded = naming.dl_header_guard(names).join(facts.select(*SHEET, "nameless", "depth"), SHEET)
    by_position = F.col("keep_positional") | F.col("nameless")
    cleaned = naming.clean_names(guarded, "dl")
    named = settle(
        cleaned.withColumn(
            "name", F.when(by_position, F.concat(F.lit("col_"), F.col("col_idx").cast("string"))).otherwise(F.col("name"))
        )
    )
    # Where names go by position the heading itself stays as the first row.
    stays = named.filter(by_position).select(*SHEET, "col_idx", "raw", "nameless", "depth")
    heading = stays.groupBy(*SHEET).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "raw"))), lambda c: c["raw"]).alias("vals"),
    )
    at = placed.groupBy(*SHEET).agg(F.min("row_idx").alias("row_idx"))
    kept = heading.join(at, SHEET).select(*ROW, "vals")
    unique = settle(naming.dedupe_names(named.select(*COLUMN, "name")))
    rows_out = settle(data.select(*ROW, "vals").unionByName(kept))
    return SheetTables(unique, rows_out, settle(structure.notes_concat(classified)))


def soi_tables(rows: DataFrame) -> SheetTables:
    """The tax statistics family: several tables per sheet, sideways and downwards.

    ``sheet`` of the result is ``<sheet>|<part>|<table>``.
    """
    cells = grid.to_cells(grid.normalise_rows(rows))
    parts = splits.split_tables_across(grid.drop_empty_columns(cells))
    named = F.concat_ws("|", "sheet", F.col("part").cast("string"))
    slim = grid.drop_sparse_columns(parts.withColumn("sheet", named).drop("part"))
    ready = settle(grid.to_rows(grid.compact_columns(slim)))
    kinds = settle(_first_facts(ready, _no_gap))
    sorted_out = ready.join(kinds, SHEET)
    plain = sorted_out.filter("is_plain").drop("is_plain")
    plain_names = naming.clean_names(structure.first_row_names(plain), "excel")
    plain_rows = grid.first_rows(plain).filter("not is_first").select(*ROW, "vals")

    split = splits.split_tables_down(sorted_out.filter("not is_plain").drop("is_plain"))
    table = F.concat_ws("|", "sheet", F.col("table_id").cast("string"))
    tables = split.withColumn("sheet", table).drop("table_id")
    classified = settle(structure.classify_rows_soi(structure.soi_normalise(tables)))
    body = structure.collapse_lone_rows(classified).filter("role = 'body'").select(*ROW, "vals")
    placed = settle(dense_position(body, SHEET, "row_idx"))
    shaped = settle(structure.soi_header_rows(placed, structure.header_depth_soi(placed)))
    # Rows were dropped from the heading, so positions are counted again.
    again = structure.shift_blank_headers(dense_position(shaped.drop("position"), SHEET, "row_idx"))
    names, data = structure.split_header(again, F.col("depth"), strip_pieces=True)
    carried = structure.carry_label_soi(data.select(*ROW, "vals"))
    prefixes = settle(carried)
    paths = join_by_row(structure.indent_path(prefixes.select(*ROW, "vals")), prefixes.select(*ROW, "prefix"), ROW)
    notes = _soi_notes(structure.notes_concat(classified), placed)
    every_name = naming.clean_names(names, "excel").select(*COLUMN, "name").unionByName(
        plain_names.select(*COLUMN, "name")
    )
    return SheetTables(
        settle(naming.truncate_names(every_name)),
        settle(structure.apply_prefix(paths).unionByName(plain_rows)),
        settle(notes),
    )


def _soi_notes(notes: DataFrame, placed: DataFrame) -> DataFrame:
    """Titles hold until the next title of the sheet; footers spread over it."""
    every = placed.select(*SHEET).distinct().join(notes, SHEET, "left")
    pieces = F.split("sheet", r"\|")
    base = F.array_join(F.slice(pieces, F.lit(1), F.size(pieces) - 1), "|")
    tables = every.select(
        "source", base.alias("sheet"), F.element_at(pieces, -1).cast("long").alias("table_id"), "header", "footer"
    )
    titled = over_blocks(tables, SHEET, "table_id", {"header": last_seen(F.col("header"))})
    footed = structure.footer_propagate(tables.select(*SHEET, "table_id", "footer"))
    joined = titled.drop("footer").join(footed.drop("place"), [*SHEET, "table_id"])
    return joined.select(
        "source", F.concat_ws("|", "sheet", F.col("table_id").cast("string")).alias("sheet"), "header", "footer"
    )
