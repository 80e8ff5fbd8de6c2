"""Headers, row roles, labels and notes of a sheet.

Input is ``rows(source, sheet, row_idx, vals)`` with NULL for empty cells.
Facts about a whole sheet (its first body row, its number of titles) and about
neighbouring rows come from ``over_blocks``, so a sheet of any length is spread
over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.blockwise import carry_through
from gridloom.functions.ordered import (
    join_by_row,
    no_blocks,
    over_blocks,
    previous,
    running_total,
    whole_first,
    whole_last,
    whole_max,
    whole_min,
    whole_sum,
    with_blocks,
)
from gridloom.functions.text import indent_level, is_alpha, is_digits, starts_with_letter, strip
from gridloom.operators.carried import BODY, LABEL, Indentation, KeptLabels, LoneRuns, RunningLabel
from gridloom.operators.grid import (
    COLUMN,
    ROW,
    SHEET,
    cell,
    first_value,
    n_cells,
    n_nulls,
    non_null,
    to_cells,
)
from gridloom.session import settle

# Headings of the government finance sheets that carry no prefix.
GOV_HEADINGS = ["Revenue1", "Expenditure1", "Debt outstanding", "Cash and security holdings"]
# Openings of a note in the patent office sheets.
USPTO_NOTE_OPENINGS = ["changed", "Effective"]
USPTO_JOINED_LABEL = "Patent Matters"
END_OF_TABLE_NOTE = "Footnotes at end of table"


# ---- header rows --------------------------------------------------------


def gov_prefix(rows: DataFrame) -> DataFrame:
    """One leading space on every cell but the four headings.

    The headings thereby sit above all other labels in the indentation path.
    """
    value = lambda v: F.when(strip(v).isin(GOV_HEADINGS), strip(v)).otherwise(F.concat(F.lit(" "), v))
    return rows.withColumn("vals", F.transform("vals", value))


def header_row_gov() -> Column:
    vals = F.col("vals")
    words = is_alpha(cell(vals, 0)) & is_alpha(cell(vals, 1))
    return cell(vals, 0).isNull() | (n_nulls(vals) >= 1) | F.coalesce(words, F.lit(False))


def header_row_uspto() -> Column:
    """Needs ``position``, the 0-based place of the row among the body rows."""
    vals = F.col("vals")
    words = is_alpha(cell(vals, 0)) & is_alpha(cell(vals, -1))
    return (
        cell(vals, 0).isNull()
        | ((F.col("position") == 0) & (n_nulls(vals) >= 1))
        | F.coalesce(words, F.lit(False))
    )


def header_row_dl() -> Column:
    vals = F.col("vals")
    nulls = n_nulls(vals)
    at = lambda i: cell(vals, i)
    words = F.forall(non_null(vals), lambda v: is_alpha(F.regexp_replace(v, "[ ().]", "")))
    return (
        at(0).isNull()
        | ((nulls == 4) & at(2).isNull() & at(1).isNotNull())
        | ((nulls == 8) & at(12).isNotNull())
        | ((nulls > 2) & at(1).isNotNull() & at(2).isNotNull() & at(-1).isNull() & at(-2).isNotNull())
        | (words & (nulls < 6))
    )


def mark_leading_run(rows: DataFrame, predicate: Column, name: str = "is_header") -> DataFrame:
    """Mark the rows before the first one that fails ``predicate``."""
    # The test becomes a column first, so that only it is read for the summary.
    tested = rows.withColumn("__fails", ~predicate)
    out = over_blocks(tested, SHEET, "row_idx", {"__stop": whole_min(F.when(F.col("__fails"), F.col("row_idx")))})
    before = F.col("__stop").isNull() | (F.col("row_idx") < F.col("__stop"))
    return out.withColumn(name, before).drop("__stop", "__fails")


def header_depth(rows: DataFrame, predicate: Column) -> DataFrame:
    """``depth`` per sheet: length of the leading run of header rows.

    Two aggregates, no sort: the first failing row of a sheet, then the number
    of rows before it.
    """
    marked = mark_leading_run(rows, predicate)
    return marked.groupBy(*SHEET).agg(F.count_if("is_header").alias("depth"))


def header_depth_soi(rows: DataFrame) -> DataFrame:
    """Header depth with three tolerated rows, by position in the body.

    Input rows carry ``position`` (0-based, dense). Output per sheet: ``n_rows``
    without a trailing row that starts empty, ``scanned`` (rows up to the
    fourth that does not look like a heading) and ``depth`` (position of the
    last scanned row that starts empty, 0 if none). Sheets under five rows or
    shorter than ``scanned`` have NULL depth: they are no tables.
    """
    vals = F.col("vals")
    starts_empty = cell(vals, 0).isNull()
    looks = starts_empty | (n_nulls(vals) > 1) | ((F.col("position") <= 1) & (n_nulls(vals) == 1))
    counted = over_blocks(
        rows.select(*SHEET, "position", starts_empty.alias("starts_empty"), looks.alias("looks")),
        SHEET,
        "position",
        {"others": running_total(F.when(F.col("looks"), 0).otherwise(1))},
    )
    facts = counted.groupBy(*SHEET).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.min(F.when((F.col("others") == 4) & ~F.col("looks"), F.col("position"))).alias("fourth"),
        F.max_by("starts_empty", "position").alias("ends_empty"),
    )
    facts = facts.withColumn("reach", F.coalesce("fourth", "n_all")).withColumn(
        "n_rows", F.col("n_all") - F.when((F.col("reach") > 0) & F.col("ends_empty"), 1).otherwise(0)
    )
    # A fourth ordinary row at position n_rows would be the dropped one.
    facts = facts.withColumn(
        "scanned", F.when(F.col("reach") == F.col("n_rows"), F.col("reach") - 1).otherwise(F.col("reach"))
    )
    anchor = (
        counted.join(settle(facts.select(*SHEET, "scanned", "n_rows")), SHEET)
        .filter(F.col("starts_empty") & (F.col("position") <= F.col("scanned")) & (F.col("position") < F.col("n_rows")))
        .groupBy(*SHEET)
        .agg(F.max("position").alias("anchor"))
    )
    usable = (F.col("n_rows") >= 5) & (F.col("n_rows") >= F.col("scanned"))
    return facts.join(anchor, SHEET, "left").select(
        *SHEET, "n_rows", "scanned", F.when(usable, F.coalesce("anchor", F.lit(0))).alias("depth")
    )


def header_ffill(header_cells: DataFrame) -> DataFrame:
    """Fill gaps of header rows from the left.

    Input: cells of the header rows with ``is_first`` and ``is_last``. The last
    row stays as it is; a first row with a single value is spread over all
    columns but the first. Windows run inside one row, so a group is as large
    as the sheet is wide.
    """
    row = Window.partitionBy(*ROW)
    left = F.last("value", ignorenulls=True).over(
        row.orderBy("col_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = (
        F.when(F.col("is_last"), F.col("value"))
        .when(F.col("is_first") & (F.count("value").over(row) == 1), F.when(F.col("col_idx") > 0, F.max("value").over(row)))
        .otherwise(left)
    )
    return header_cells.withColumn("value", filled)


def header_flatten(filled: DataFrame, strip_pieces: bool = False) -> DataFrame:
    """Names per column: the header rows joined top-down by one space."""
    pieces = F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "value"))), lambda c: c["value"])
    grouped = filled.groupBy(*COLUMN).agg(pieces.alias("pieces"))
    if strip_pieces:
        join = lambda acc, v: F.concat(
            F.coalesce(strip(acc), F.lit(" ")), F.lit(" "), F.coalesce(strip(v), F.lit(" "))
        )
        rest = F.slice("pieces", 2, F.greatest(F.size("pieces") - 1, F.lit(0)))
        raw = F.aggregate(rest, F.col("pieces")[0], join)
    else:
        raw = F.array_join(F.transform("pieces", lambda v: F.coalesce(v, F.lit(" "))), " ")
    return grouped.select(*COLUMN, raw.alias("raw"))


def split_header(rows: DataFrame, depth: Column, strip_pieces: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(names, body)`` of rows that carry ``position`` and a header depth.

    Depth 0 takes the first row as it is; depth 1 still merges two rows.
    """
    consumed = F.when(depth == 0, 1).when(depth == 1, 2).otherwise(depth)
    marked = rows.withColumn("__consumed", consumed)
    head = (
        marked.filter(F.col("position") < F.col("__consumed"))
        .withColumn("is_first", (F.col("position") == 0) & (F.col("__consumed") > 1))
        .withColumn("is_last", F.col("position") == F.col("__consumed") - 1)
    )
    cells = head.select(*ROW, "is_first", "is_last", F.posexplode("vals").alias("col_idx", "value"))
    names = header_flatten(header_ffill(cells), strip_pieces)
    # One row has nothing to join: an empty name stays NULL and is named by position, all others are as they are.
    single = head.filter(F.col("__consumed") == 1).select(*SHEET, F.posexplode("vals").alias("col_idx", "one"))
    empty = single.filter("one is null").select(*COLUMN, F.lit(True).alias("__empty"))
    names = names.join(empty, COLUMN, "left").select(*COLUMN, F.when(F.col("__empty").isNull(), F.col("raw")).alias("raw"))
    body = marked.filter(F.col("position") >= F.col("__consumed")).drop("__consumed")
    return names, body


# ---- indentation --------------------------------------------------------


def indent_path(rows: DataFrame) -> DataFrame:
    """First cell prefixed by the labels it is indented under, however many depths there are.

    A label is an ancestor when no later row is as shallow.
    """
    first = cell(F.col("vals"), 0)
    facts = {"level": F.coalesce(indent_level(first), F.lit(0)), "label": strip(first)}
    paths = carry_through(rows, SHEET, "row_idx", facts, Indentation())
    vals = F.when(F.col("__path").isNotNull(), replace_first(F.col("vals"), F.col("__path"))).otherwise(F.col("vals"))
    return join_by_row(rows, paths, ROW, "left").withColumn("vals", vals).select(*rows.columns)


def replace_first(vals: Column, value: Column) -> Column:
    return F.concat(F.array(value), F.slice(vals, 2, F.greatest(F.size(vals) - 1, F.lit(0))))


def drop_label_rows(rows: DataFrame, need_first: bool = False) -> DataFrame:
    """Rows with fewer than two cells go after lending their label.

    ``need_first`` also drops rows without a first cell, as the patent office
    family does.
    """
    kept = n_cells(F.col("vals")) >= 2
    return rows.filter(kept & cell(F.col("vals"), 0).isNotNull() if need_first else kept)


# ---- row roles ----------------------------------------------------------


def _facts(rows: DataFrame, **more: Column) -> DataFrame:
    """What the rules ask about a row, as small columns beside its cells.

    Summaries then read these columns only, and chained scans share a shuffle.
    """
    vals = F.col("vals")
    facts = {"__n": n_cells(vals), "__open": cell(vals, 0).isNull()}
    return with_blocks(rows.withColumns({**facts, **more}), "row_idx")


def _settled_facts(rows: DataFrame, **more: Column) -> DataFrame:
    """The facts alone, written once: for rules that take several scans.

    The scans then run over these small columns, and the rows themselves are
    read twice in all: for the facts and to join the decision.
    """
    marked = _facts(rows, **more)
    return settle(marked.select(*[c for c in marked.columns if c not in rows.columns or c in ROW or c == "role"]))


def _done(df: DataFrame, *columns: str) -> DataFrame:
    return no_blocks(df).drop("__n", "__open", *columns)


def _roles(body: Column, title: Column, footer: Column) -> Column:
    return (
        F.when(F.col("__n") == 0, "blank")
        .when(body, "body")
        .when(title, "title")
        .when(footer, "footer")
        .otherwise("other")
    )


def _full() -> Column:
    """More than one cell, or a single one that is not the label."""
    return (F.col("__n") > 1) | ((F.col("__n") == 1) & F.col("__open"))


def _lone() -> Column:
    return (F.col("__n") == 1) & ~F.col("__open")


def _early() -> Column:
    """No body row yet, given the first body row as ``__first``."""
    return F.col("__first").isNull() | (F.col("row_idx") < F.col("__first"))


def classify_rows_html(rows: DataFrame) -> DataFrame:
    """Titles before the first body row; of the single cells after it only the last is a footer."""
    seen = over_blocks(
        _facts(rows),
        SHEET,
        "row_idx",
        {
            "__first": whole_min(F.when(_full(), F.col("row_idx"))),
            "__last": whole_max(F.when(_lone(), F.col("row_idx"))),
        },
    )
    role = _roles(_full(), _early(), F.col("row_idx") == F.col("__last"))
    return _done(seen.withColumn("role", role), "__first", "__last")


def classify_rows_dl(rows: DataFrame) -> DataFrame:
    """Some single cells are body rows; all others after the first body row are footers."""
    vals = F.col("vals")
    n, value = n_cells(vals), first_value(vals)
    one = n == 1
    numeric = is_digits(strip(value)) | value.rlike(r"^(\d+|\d*\.\d+|\d+\.\d*)$")
    body = (
        (n > 1)
        | (one & cell(vals, 0).isNull() & ~value.contains("=") & ~value.contains("*"))
        | (one & numeric)
        | (one & cell(vals, 0).isNotNull() & (F.length(cell(vals, 0)) == 2))
        | (one & (n_nulls(vals) == 3) & is_alpha(F.replace(strip(value), F.lit(" "), F.lit(""))))
    )
    marked = _facts(rows, __body=F.coalesce(body, F.lit(False)))
    first = whole_min(F.when(F.col("__body"), F.col("row_idx")))
    seen = over_blocks(marked, SHEET, "row_idx", {"__first": first})
    return _done(seen.withColumn("role", _roles(F.col("__body"), _early(), F.lit(True))), "__first", "__body")


def classify_rows_gov(rows: DataFrame) -> DataFrame:
    """Group headings (ending in a colon) are body rows unless they follow a lone cell.

    Rows with a ``.pdf`` cell never are. Notes need more than one title and
    more than one body row before them.
    """
    vals = F.col("vals")
    marked = _settled_facts(
        rows,
        __colon=F.coalesce(first_value(vals).endswith(":"), F.lit(False)),
        __pdf=F.exists(vals, lambda v: F.coalesce(v.contains(".pdf"), F.lit(False))),
    )
    n = F.col("__n")
    before = over_blocks(marked, SHEET, "row_idx", {"__prev": previous(n)})
    heading = F.col("__colon") & (F.coalesce("__prev", F.lit(0)) != 1)
    body = before.withColumn("__body", (n > 0) & (_full() | heading) & ~F.col("__pdf"))
    counted = over_blocks(
        body, SHEET, "row_idx", {"__bodies": running_total(F.col("__body").cast("int"), inclusive=False)}
    )
    early = ~F.col("__body") & (F.col("__bodies") == 0)
    titled = over_blocks(counted, SHEET, "row_idx", {"__titles": whole_sum(F.when(early, n))})
    note = (F.col("__titles") > 1) & (F.col("__bodies") > 1) & (n == 1)
    return join_by_row(rows, titled.select(*ROW, _roles(F.col("__body"), early, note).alias("role")), ROW)


def classify_rows_uspto(rows: DataFrame) -> DataFrame:
    """Notes must not open with a letter (two openings excepted); other lone
    cells before any note are labels for the rows below."""
    value = cell(F.col("vals"), 0)
    opening = ~starts_with_letter(value) | value.rlike("^(?:" + "|".join(USPTO_NOTE_OPENINGS) + ")")
    marked = _facts(rows, __opening=F.coalesce(opening, F.lit(False)))
    counted = over_blocks(
        marked, SHEET, "row_idx", {"__bodies": running_total(_full().cast("int"), inclusive=False)}
    )
    early = _lone() & (F.col("__bodies") == 0)
    candidate = _lone() & (F.col("__bodies") > 1) & F.col("__opening")
    seen = over_blocks(
        counted,
        SHEET,
        "row_idx",
        {
            "__titles": whole_sum(early.cast("int")),
            "__note": whole_min(F.when(candidate, F.col("row_idx"))),
        },
    )
    many = F.col("__titles") > 1
    role = (
        F.when(F.col("__n") == 0, "blank")
        .when(_full(), "body")
        .when(early, "title")
        .when(candidate & many, "footer")
        .when(F.coalesce(many & (F.col("__note") < F.col("row_idx")), F.lit(False)), "other")
        .otherwise("label")
    )
    return _done(seen.withColumn("role", role), "__opening", "__bodies", "__titles", "__note")


def soi_normalise(rows: DataFrame) -> DataFrame:
    """Cell repairs of the tax statistics family before its rows are classified.

    A row of one repeated value keeps it once if it opens with ``*`` or is the
    last row; ``-1`` in the last cell of the first row and ``NUMBER`` in the
    first column are empty.
    """
    vals = F.col("vals")
    seen = over_blocks(
        rows, SHEET, "row_idx", {"__first": whole_min(F.col("row_idx")), "__last": whole_max(F.col("row_idx"))}
    )
    width = F.size(vals)
    blanks = lambda n: F.when(n > 0, F.array_repeat(F.lit(None).cast("string"), n)).otherwise(
        F.array().cast("array<string>")
    )
    repeated = (F.size(F.array_distinct(vals)) == 1) & cell(vals, 0).isNotNull()
    starred = strip(cell(vals, 0)).startswith("*")
    once = repeated & (F.coalesce(starred, F.lit(False)) | (F.col("row_idx") == F.col("__last")))
    minus = (F.col("row_idx") == F.col("__first")) & (cell(vals, -1) == "-1")
    number = cell(vals, 0) == "NUMBER"
    cut_last = F.when(F.coalesce(minus, F.lit(False)), F.concat(F.slice(vals, F.lit(1), F.greatest(width - 1, F.lit(0))), F.array(F.lit(None).cast("string")))).otherwise(vals)
    out = seen.withColumn("vals", F.when(once, F.concat(F.array(cell(vals, 0)), blanks(width - 1))).otherwise(cut_last))
    nulled = replace_first(F.col("vals"), F.lit(None).cast("string"))
    return out.withColumn("vals", F.when(F.coalesce(number, F.lit(False)), nulled).otherwise(F.col("vals"))).drop(
        "__first", "__last"
    )


def classify_rows_soi(rows: DataFrame) -> DataFrame:
    """Lone cells after the start are body rows; those after the last full row are footers.

    Adds ``island``, the number of full rows up to here: lone cells of one
    island stand together.
    """
    full = F.col("__n") > 1
    seen = over_blocks(
        _facts(rows),
        SHEET,
        "row_idx",
        {
            "__first": whole_min(F.when(_full(), F.col("row_idx"))),
            "island": running_total(full.cast("int")),
            "__islands": whole_sum(full.cast("int")),
        },
    )
    role = (
        F.when(F.col("__n") == 0, "blank")
        .when(_full(), "body")
        .when(_early(), "title")
        .when(F.col("island") == F.col("__islands"), "footer")
        .otherwise("body")
    )
    return _done(seen.withColumn("role", role), "__first", "__islands")


def collapse_lone_rows(classified: DataFrame) -> DataFrame:
    """Several lone body rows between two full rows become one joined row.

    Only the lone rows are grouped; full rows pass through a left join on
    their own key.
    """
    vals = F.col("vals")
    lone = (F.col("role") == "body") & (n_cells(vals) == 1) & cell(vals, 0).isNotNull()
    joined = (
        classified.filter(lone)
        .groupBy(*SHEET, "island")
        .agg(
            F.min("row_idx").alias("row_idx"),
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("row_idx", cell(vals, 0).alias("v")))), lambda c: c["v"]),
                " ",
            ).alias("__text"),
        )
    )
    out = join_by_row(classified, joined.drop("island"), ROW, "left")
    keep = ~lone | F.col("__text").isNotNull()
    return (
        out.filter(keep)
        .withColumn("vals", F.when(F.col("__text").isNotNull(), replace_first(vals, F.col("__text"))).otherwise(vals))
        .drop("__text")
    )


# ---- labels carried to later rows ---------------------------------------


def _role_code() -> Column:
    return F.when(F.col("role") == "body", BODY).when(F.col("role") == "label", LABEL).otherwise(0)


def carry_label_uspto(rows: DataFrame) -> DataFrame:
    """Prefix body rows with the label above them.

    Input: all rows with ``role`` of ``classify_rows_uspto``. Neighbouring
    lone cells join with a space, a later one replaces them, a blank row ends
    the label. Output: the body rows.
    """
    vals = F.col("vals")
    facts = {"n": n_cells(vals), "role": _role_code(), "first": F.when(F.col("role") == "label", cell(vals, 0))}
    labels = carry_through(rows, SHEET, "row_idx", facts, RunningLabel())
    prefixed = F.concat(F.col("__label"), F.lit(" "), F.coalesce(cell(vals, 0), F.lit("")))
    out = F.when(F.col("__label").isNotNull(), replace_first(vals, prefixed)).otherwise(vals)
    return join_by_row(rows.filter(F.col("role") == "body"), labels, ROW, "left").select(*ROW, out.alias("vals"))


def keep_label_uspto_special(rows: DataFrame) -> DataFrame:
    """The sheets whose lone cells stay as rows.

    Input: rows with ``role``. A lone cell right after another row of one cell
    continues the text of the label above, unless it is indented; ``Patent
    Matters`` moves in front of the next row; then labels that end in a colon
    or are not indented go.
    """
    vals = F.col("vals")
    facts = {"n": n_cells(vals), "role": _role_code(), "first": F.when(n_cells(vals) == 1, cell(vals, 0))}
    decided = carry_through(rows, SHEET, "row_idx", facts, KeptLabels(USPTO_JOINED_LABEL))
    text = F.coalesce("__text", cell(vals, 0))
    shown = F.when(F.col("__above"), F.concat_ws(" ", F.lit(USPTO_JOINED_LABEL), text)).otherwise(text)
    out = join_by_row(rows, decided, ROW).withColumn("__shown", shown).filter("__shown is not null")
    return out.select(*ROW, replace_first(vals, F.col("__shown")).alias("vals"))


def carry_label_soi(rows: DataFrame) -> DataFrame:
    """Runs of lone rows join into a label for all later labelled rows.

    Input: body rows below the header. The last two rows are exempt: a run
    that reaches them ends in a row instead of a label. The label goes in
    ``prefix``, to be put before the indentation path of the row.
    """
    vals = F.col("vals")
    lone = n_cells(vals) == 1
    facts = {"lone": lone, "first": F.when(lone, first_value(vals))}
    decided = carry_through(rows, SHEET, "row_idx", facts, LoneRuns())
    only = F.transform(vals, lambda v, i: F.when(i == 0, F.col("__text")))
    text = F.when(F.col("__text").isNotNull(), only).otherwise(vals)
    return join_by_row(rows, decided, ROW).select(*ROW, text.alias("vals"), "prefix")


def apply_prefix(rows: DataFrame) -> DataFrame:
    """Put ``prefix`` before the first cell where there is one."""
    vals = F.col("vals")
    use = F.col("prefix").isNotNull() & cell(vals, 0).isNotNull()
    text = F.concat_ws(" ", F.col("prefix"), cell(vals, 0))
    return rows.withColumn("vals", F.when(use, replace_first(vals, text)).otherwise(vals)).drop("prefix")


# ---- notes --------------------------------------------------------------


def notes_concat(classified: DataFrame) -> DataFrame:
    """``header`` and ``footer`` text of every sheet, pieces joined by ``'. '``."""
    pieces = lambda role: F.array_join(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("row_idx", "__cells")))),
                lambda c: c["__cells"],
            )
        ),
        ". ",
    )
    nonempty = lambda c: F.when(c != "", c)
    return (
        classified.filter(F.col("role").isin("title", "footer"))
        .withColumn("__cells", non_null(F.col("vals")))
        .groupBy(*SHEET)
        .agg(nonempty(pieces("title")).alias("header"), nonempty(pieces("footer")).alias("footer"))
    )


def annotate(rows: DataFrame, notes: DataFrame) -> DataFrame:
    """Header and footer text beside every row, and the last two path parts."""
    path = F.split("source", "/")
    name = F.array_join(F.slice(path, F.greatest(F.size(path) - 1, F.lit(1)), F.lit(2)), "/")
    # One row per sheet; written, so that Spark knows its size and broadcasts it or splits large sheets.
    return rows.join(settle(notes), SHEET, "left").withColumn("file_name", name)


def footer_propagate(tables: DataFrame) -> DataFrame:
    """Tables without a footer get the last one of their sheet.

    Input ``tables(source, sheet, table_id, footer)``. A footer that points to
    the end of the table counts as none. ``place`` numbers the tables of a
    sheet, those with a footer of their own first.
    """
    own = F.col("footer").isNotNull() & ~F.col("footer").contains(END_OF_TABLE_NOTE)
    marked = tables.withColumn("__own", F.coalesce(own, F.lit(False)))
    one = F.col("__own").cast("int")
    seen = over_blocks(
        marked,
        SHEET,
        "table_id",
        {
            "__last": whole_last(F.when(F.col("__own"), F.col("footer")), "table_id"),
            "__before": running_total(one, inclusive=False),
            "__others": running_total(1 - one, inclusive=False),
            "__owned": whole_sum(one),
        },
    )
    place = F.when(F.col("__own"), F.col("__before")).otherwise(F.col("__owned") + F.col("__others"))
    return seen.select(
        *SHEET,
        "table_id",
        F.when(F.col("__own"), F.col("footer")).otherwise(F.col("__last")).alias("footer"),
        place.cast("long").alias("place"),
    )


def soi_header_rows(rows: DataFrame, depths: DataFrame) -> DataFrame:
    """Repair the header rows of the tax statistics family.

    Input: rows with ``position``; ``depths`` of ``header_depth_soi``. Adds
    ``depth``, the number of rows to flatten (0: the first row alone), shifts a
    gappy row under the heading one cell left and drops a row of column
    numbers. Sheets without a usable depth drop out.
    """
    usable = depths.filter("depth is not null").select(*SHEET, F.col("depth").alias("__d"), "n_rows")
    placed = rows.join(settle(usable), SHEET).filter(F.col("position") < F.col("n_rows"))
    vals = F.col("vals")
    seen = over_blocks(
        placed,
        SHEET,
        "position",
        {
            "__at": whole_first_at(F.col("position") == F.col("__d")),
            "__above": whole_first_at(F.col("position") == F.col("__d") - 1),
        },
    )
    bare = lambda v: F.regexp_replace(v, r"[()\[\]-]", "")
    number = lambda row: F.coalesce(is_digits(F.coalesce(bare(cell(row, 1)), bare(cell(row, 2)))), F.lit(False))
    deep = F.col("__d") > 1
    shift = deep & (n_nulls(F.col("__at")) > 3) & ~number(F.col("__at"))
    seen = seen.withColumn("__shift", shift).withColumn(
        "__n", F.col("__d") - F.col("__shift").cast("int")
    )
    tested = F.when(F.col("__shift"), F.col("__above")).otherwise(F.col("__at"))
    seen = seen.withColumn("__numbers", deep & number(tested))
    depth = F.when(deep & ~F.col("__numbers"), F.col("__n") + 1).otherwise(F.col("__n"))
    seen = seen.withColumn("depth", depth)
    numbers_row = F.col("__numbers") & (F.col("position") == F.col("__n"))
    # A heading of one row is followed by a row that is no data.
    second = (F.col("depth") == 1) & (
        F.col("position") == F.when(F.col("__numbers"), F.lit(2)).otherwise(F.lit(1))
    )
    moved = F.concat(F.slice(vals, 2, 2), F.slice(vals, F.lit(3), F.greatest(F.size(vals) - 2, F.lit(0))))
    return (
        seen.filter(~numbers_row & ~second)
        .withColumn("vals", F.when(F.col("__shift") & (F.col("position") == F.col("__d")), moved).otherwise(vals))
        .withColumn("depth", F.when(F.col("depth") == 1, 0).otherwise(F.col("depth")))
        .select(*ROW, "position", "vals", "depth")
    )


def whole_first_at(condition: Column):
    """``vals`` of the one row of a sheet that meets ``condition``."""
    return whole_first(F.when(condition, F.col("vals")), "position")


def first_row_names(rows: DataFrame) -> DataFrame:
    """``names(source, sheet, col_idx, raw)`` from the first row of every sheet."""
    first = rows.groupBy(*SHEET).agg(F.min_by("vals", "row_idx").alias("vals"))
    return first.select(*SHEET, F.posexplode("vals").alias("col_idx", "raw"))


def shift_blank_headers(rows: DataFrame) -> DataFrame:
    """Heading rows without a name for the first column take that of the second.

    Input: rows with ``position`` and ``depth``. A lone value in the first row
    is spread over the other columns, so it names the first column neither.
    """
    vals = F.col("vals")
    head = (F.col("position") < F.col("depth")) & (F.col("depth") > 1)
    spread = (F.col("position") == 0) & (n_cells(vals) == 1)
    blank = (
        rows.filter(head)
        .groupBy(*SHEET)
        .agg(F.bool_and(cell(vals, 0).isNull() | spread).alias("__blank"))
        .filter("__blank")
    )
    marked = rows.join(settle(blank), SHEET, "left")
    moved = F.concat(F.slice(vals, 2, 1), F.slice(vals, F.lit(2), F.greatest(F.size(vals) - 1, F.lit(0))))
    return marked.withColumn("vals", F.when(head & F.col("__blank"), moved).otherwise(vals)).drop("__blank")
