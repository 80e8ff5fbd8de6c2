"""Several tables in one sheet: splits downwards and sideways, sections, shards."""

from __future__ import annotations

from functools import cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.blockwise import Block, Machine, State, carry_through
from gridloom.functions.ordered import (
    join_by_row,
    last_seen,
    next_seen,
    no_blocks,
    over_blocks,
    running_total,
    with_blocks,
)
from gridloom.functions.text import is_alpha, starts_with_letter, strip
from gridloom.session import settle
from gridloom.operators.grid import COLUMN, SHEET, cell, column_profile, first_value, n_cells, n_nulls, non_null

# A table is complete after more than this many rows.
ROWS_OF_A_TABLE = 10

# ---- downwards ----------------------------------------------------------


def _flags(vals: Column) -> Column:
    """What a row says by itself, as one number; see ``Down``."""
    n = n_cells(vals)
    letters = F.size(F.filter(non_null(vals), lambda v: starts_with_letter(strip(v))))
    lone_off_column = (n == 1) & cell(vals, 0).isNull()
    flags = [
        n == 0,
        F.coalesce(strip(first_value(vals)).startswith("Table"), F.lit(False)),
        (n > 0) & (((F.floor(F.size(vals) / 2) > n) & (n != 1)) | lone_off_column),
        n > 1,
        letters > 1,
        n == 1,
        n_nulls(vals) > 2,
    ]
    return reduce(lambda x, y: x + y, [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(flags)]).cast("int")


def _step(state: tuple[bool, int], blank: bool, gap: bool, title: bool, sparse: bool, full: bool):
    """State after a row: header seen, rows in the pending table (more than ten count as eleven).

    The third value tells whether the row is the first of a table.
    """
    header, pending = state
    long = pending > ROWS_OF_A_TABLE
    if blank:
        if gap and long:
            return True, 0 if header else pending, False
        return header, pending, False
    if title:
        header, pending, long = True, 0, False
    if sparse and header and long:
        header, pending = False, 0
    starts = pending == 0
    if starts and full:
        header = True
    return header, min(pending + 1, ROWS_OF_A_TABLE + 1), starts


_STATES = [(h, p) for h in (False, True) for p in range(ROWS_OF_A_TABLE + 2)]


@cache
def _machine() -> Machine:
    """The rule as moves by code of a row: the five flags of ``_step`` in one number."""
    index = {s: i for i, s in enumerate(_STATES)}
    steps = [[_step(state, *(bool(code >> i & 1) for i in range(5))) for state in _STATES] for code in range(1 << 5)]
    return Machine([[index[(h, p)] for h, p, _ in row] for row in steps], [[starts for _, _, starts in row] for row in steps])


class Down:
    """Tables below each other: the state is header seen or not, and 0 to 11 rows in the pending table."""

    out = "table_id long"

    @staticmethod
    def _codes(flags: np.ndarray, following: int) -> np.ndarray:
        """Codes of rows, of which some look at the row below; ``following`` are the flags of the one below the last."""
        below = np.append(flags[1:], following)
        blank, title, sparse, full, letters, lone = ((flags >> i & 1).astype(bool) for i in range(6))
        full_below, gaps_below = (below >> 3 & 1).astype(bool), (below >> 6 & 1).astype(bool)
        heading = np.where(lone, full_below, letters)
        parts = (blank, blank & full_below & gaps_below, title, sparse & heading, full)
        return sum(part.astype(np.int64) << i for i, part in enumerate(parts))

    def summarise(self, block: Block) -> State:
        """All rows but the last, whose code depends on the next block."""
        flags = block["flags"].astype(np.int64)
        ends, tables = _machine().ends(self._codes(flags, 0)[:-1])
        return {"first": int(flags[0]), "last": int(flags[-1]), "ends": ends.tolist(), "tables": tables.tolist()}

    def chain(self, summaries: list[State]) -> list[State]:
        machine, state, tables, starts = _machine(), 0, 0, []
        for s, below in zip(summaries, [*summaries[1:], {"first": 0}], strict=True):
            starts.append({"state": state, "tables": tables, "below": below["first"]})
            tables += s["tables"][state]
            state = s["ends"][state]
            (last,) = self._codes(np.array([s["last"]]), below["first"])
            tables += int(machine.marked[last, state])
            state = int(machine.following[last, state])
        return starts

    def alone(self, block: Block) -> State:
        return {"state": 0, "tables": 0, "below": 0}

    def run(self, block: Block, start: State) -> tuple[np.ndarray, dict]:
        flags = block["flags"].astype(np.int64)
        tables = start["tables"] + np.cumsum(_machine().marks(self._codes(flags, start["below"]), start["state"])) - 1
        at = np.flatnonzero(flags & 1 == 0)
        return at, {"table_id": tables[at]}


def split_tables_down(rows: DataFrame) -> DataFrame:
    """Number the tables of a sheet; blank rows go.

    Whether a row opens a table depends on how many rows the pending table has, which the rule itself resets. That state
    is small, so a block of rows is a function from state to state; see ``Down`` and ``functions.blockwise``.
    """
    numbered = carry_through(rows, SHEET, "row_idx", {"flags": _flags(F.col("vals"))}, Down())
    return join_by_row(rows, numbered, [*SHEET, "row_idx"])


# ---- sideways -----------------------------------------------------------


def split_tables_across(cells: DataFrame, gap: str = "empty", minimum: int = 0) -> DataFrame:
    """A column (not the first) with a cell opening ``Table`` starts a new part.

    ``gap`` says what happens to the column just before: ``empty`` drops it if
    it has no value, ``always`` drops it in any case. Columns with fewer than
    ``minimum`` values go, the rest are renumbered per part.
    """
    by_column = Window.partitionBy(*SHEET).orderBy("col_idx")  # one row per column
    marked = column_profile(cells).withColumn("place", F.row_number().over(by_column) - 1)
    opens = F.col("has_table_mark") & (F.col("place") > 0)
    upto = by_column.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = marked.withColumn("opens", opens).withColumn("part", F.sum(F.col("opens").cast("int")).over(upto))
    before_start = F.coalesce(F.lead("opens").over(by_column), F.lit(False))
    dropped = before_start if gap == "always" else before_start & (F.col("n_values") == 0)
    kept = settle(
        parts.withColumn("__drop", dropped)
        .filter(~F.col("__drop") & (F.col("n_values") >= minimum))
        .withColumn("__new", F.row_number().over(Window.partitionBy(*SHEET, "part").orderBy("col_idx")) - 1)
        .select(*COLUMN, "part", "__new")
    )
    return cells.join(kept, COLUMN).select(
        *SHEET, F.col("part").cast("long").alias("part"), "row_idx", F.col("__new").alias("col_idx"), "value"
    )


# ---- sections of extracted text -----------------------------------------

# Titles that open a code list and the name its codes get.
SECTION_NAMES = {
    "Level Code Description": "Level_of_estimate_code",
    "State Name Abbreviation State Code": "State_code",
    "Type Code Description": "Type_code",
    "Item Code Description": "Item_code",
    "Indicates type of service provided; this field applies only to special districts (records with type=4).": "Function_code_for_special_districts",
    "Flags Description": "Imputation_type/item_data_flag",
    "Type-Codes Description": "Type_code",
}
STATE_SECTION = "State Name Abbreviation State Code"
# What may stand between the letters of a closing line, and lines that never close.
CLOSING_MARKS_FIRST, CLOSING_WORD, CLOSING_MARKS_LAST = " –().,/", "3rd", '"-“”='
NEVER_CLOSING_STARTS = ["I ", "R "]
NEVER_CLOSING_WORDS = ["Analyst correction", "Imputed", "Unknown", "Reported", "Alternative source"]


def section_extract(
    lines: DataFrame,
    titles: dict[str, str] | None = None,
    state_title: str = STATE_SECTION,
    flush_last: bool = True,
    keys: list[str] | None = None,
    order: str = "line_no",
) -> DataFrame:
    """Code lists inside running text: ``(…, section, line_no, Name, Code, Desription)``.

    A line that contains a title opens a section; a line of letters only closes
    it. ``flush_last=False`` leaves out a section no line closes.
    """
    titles = SECTION_NAMES if titles is None else titles
    keys = ["source"] if keys is None else keys
    value = F.col("value")
    # Single characters go together; "3rd" is looked for once the ones before it are gone.
    letters = F.translate(strip(value), CLOSING_MARKS_FIRST, "")
    letters = F.translate(F.replace(letters, F.lit(CLOSING_WORD), F.lit("")), CLOSING_MARKS_LAST, "")
    either = lambda tests: reduce(lambda x, y: x | y, tests)
    closes = (
        is_alpha(letters)
        & ~either([value.startswith(w) for w in NEVER_CLOSING_STARTS])
        & ~either([value.contains(w) for w in NEVER_CLOSING_WORDS])
    )
    marked = with_blocks(lines, order).withColumns(
        {"__closes": closes, "__title": either([value.contains(t) for t in titles])}
    )
    event = F.when(F.col("__title"), "open").when(F.col("__closes"), "closed")
    states = over_blocks(
        marked,
        keys,
        order,
        {"__before": last_seen(event, inclusive=False), "__state": last_seen(event)},
    )
    # A title line inside an open section is one of its rows unless it closes the section.
    starts = F.col("__title") & (F.col("__closes") | (F.coalesce("__before", F.lit("closed")) == "closed"))
    states = states.withColumn("__starts", starts)
    sections = over_blocks(
        states,
        keys,
        order,
        {
            "section": running_total(F.col("__starts").cast("int")),
            "__heading": last_seen(F.when(F.col("__starts"), value)),
            "__later": next_seen(F.when(F.col("__closes"), F.lit(1)), inclusive=False),
        },
    )
    rows = sections.filter((F.col("__state") == "open") & ~F.col("__starts"))
    if not flush_last:
        rows = rows.filter(F.col("__later").isNotNull())
    heading = F.col("__heading")
    rows = no_blocks(rows)
    names = F.create_map(*[F.lit(x) for pair in titles.items() for x in pair])
    tokens = F.filter(F.split(value, r"\s+"), lambda t: t != "")
    parts = F.split(value, " ", 2)
    is_state = heading == state_title
    code = F.when(is_state, F.try_element_at(tokens, F.lit(-1))).otherwise(parts[0])
    rest = F.when(
        is_state, F.array_join(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(0))), " ")
    ).otherwise(F.try_element_at(parts, F.lit(2)))
    return rows.filter(heading.isin(list(titles))).select(
        *keys,
        "section",
        order,
        F.element_at(names, heading).alias("Name"),
        code.alias("Code"),
        rest.alias("Desription"),
    )


# ---- shards -------------------------------------------------------------


def global_position(df: DataFrame, order: str) -> DataFrame:
    """Adds ``__i``, the 0-based place of a row in the whole table, and ``__n``, its number of rows.

    Rows are written in ranges of the order, one per task, numbered inside their range and shifted by the rows of the
    ranges before, of which only the counts come to the driver. No task sees more than its range.
    """
    spark = df.sparkSession
    ranged = settle(df.repartitionByRange(F.col(order)).withColumn("__range", F.spark_partition_id()))
    counts = {r["__range"]: r["n"] for r in ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).collect()}
    shifts, total = [], 0
    for at in sorted(counts):
        shifts.append((at, total))
        total += counts[at]
    offsets = spark.createDataFrame(shifts, "__range int, __shift long")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    placed = ranged.withColumn("__inside", inside).join(offsets, "__range")
    return placed.withColumns({"__i": F.col("__shift") + F.col("__inside"), "__n": F.lit(total).cast("long")}).select(*df.columns, "__i", "__n")


def equal_frequency_shard(df: DataFrame, order: str, k: int, name: str = "shard") -> DataFrame:
    """Quantile bucket (0 … k-1) of the row position."""
    placed = global_position(df, order)
    # Whole numbers: ceil(k·i / (n-1)) without a rounding error for large n.
    bucket = F.greatest(F.expr(f"({k} * __i + greatest(__n - 1, 1) - 1) div greatest(__n - 1, 1)") - 1, F.lit(0))
    return placed.withColumn(name, bucket.cast("int")).drop("__i", "__n")


def even_split(df: DataFrame, order: str, k: int, name: str = "chunk") -> DataFrame:
    """k contiguous chunks (1 … k), the first ``n mod k`` one row longer."""
    placed = global_position(df, order)
    chunk = F.expr(
        f"""case when __i < (__n % {k}) * (__n div {k} + 1)
                 then __i div (__n div {k} + 1) + 1
                 else (__n % {k}) + (__i - (__n % {k}) * (__n div {k} + 1)) div greatest(__n div {k}, 1) + 1 end"""
    )
    return placed.withColumn(name, chunk.cast("int")).drop("__i", "__n")
